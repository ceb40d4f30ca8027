"""Regressions, quantiles and the stable baseline."""

from pyspark.sql import functions as F

from permeate.functions.regression import fit_lines, residual_std
from permeate.functions.scalars import severity
from permeate.functions.timing import DAY, micros
from permeate.operators import fouling as f
from permeate.operators.quality import band_filter
from permeate.operators.quantiles import fence, group_quantiles
from permeate.operators.rolling import derivatives, moving_average
from permeate.plans.adapter import BANDS, LOG_SQL, ORDERED_SQL, ordered_log, prepared, sensor_log
from permeate.plans.registry import query, rounded
from permeate.schema import CHART_SLOPE_LIMITS, DECLINE_LIMITS

X = "((us - 1704067200000000) / 1e6)"
R2 = "case when regr_syy({y}, {x}) = 0 then 0 else regr_r2({y}, {x}) end"
CLASS = """case when abs({s}) < {a} then 'low' when abs({s}) < {b} then 'medium' when abs({s}) < {c} then 'high' else 'critical' end"""


def classes(slope: str, limits) -> str:
    return CLASS.format(s=slope, a=limits[0], b=limits[1], c=limits[2])


@query(
    "g1_line_fit",
    f"""select unit_id, count(*) as n, round(regr_slope(perm_tc, {X}) * 86400, 8) as slope_per_day,
      round(avg(perm_tc) + regr_slope(perm_tc, {X}) * (min({X}) - avg({X})), 6) as intercept,
      round({R2.format(y='perm_tc', x=X)}, 8) as r_squared
    from log where perm_tc is not null group by 1""",
    LOG_SQL,
)
def line(spark, sf):
    fit = fit_lines(sensor_log(spark, sf), "perm_tc")
    return fit.withColumn("slope_per_day", F.col("slope") * 86400).select(
        "unit_id", "n", *rounded("slope_per_day", digits=8), *rounded("intercept"), *rounded("r_squared", digits=8)
    )


@query(
    "g2_residual_std",
    f""", fit as (select unit_id, regr_slope(tmp, {X}) as b, regr_intercept(tmp, {X}) as a, count(*) as n from log group by 1)
    select unit_id, round(sqrt(sum(pow(tmp - (a + b * {X}), 2)) / (max(n) - 2)), 6) as residual_std
    from log join fit using (unit_id) group by 1""",
    LOG_SQL,
)
def residuals(spark, sf):
    return fit_lines(sensor_log(spark, sf), "tmp").select(
        "unit_id", F.round(residual_std(F.col("n"), F.col("ss_res")), 6).alias("residual_std")
    )


@query(
    "g3_global_tmp_slope",
    f"""select unit_id, count(*) as n_rows, round(regr_slope(tmp, {X}) * 3600, 9) as slope_per_hour,
      round(regr_slope(tmp, {X}) * 86400, 8) as slope_per_day, round({R2.format(y='tmp', x=X)}, 8) as r_squared,
      {classes(f'regr_slope(tmp, {X}) * 3600', (0.005, 0.02, 0.05))} as fouling_class
    from ordered where good group by 1""",
)
def tmp_slope(spark, sf):
    return f.tmp_slopes(band_filter(sensor_log(spark, sf), BANDS)).select(
        "unit_id", "n_rows", *rounded("slope_per_hour", digits=9), *rounded("slope_per_day", "r_squared", digits=8), "fouling_class"
    )


@query(
    "f3_f4_f5_severity",
    f""", steps as (select unit_id, seq, (tmp - lag(tmp) over w) / nullif((us - lag(us) over w) / 3600e6, 0) / 100 as s
      from log window w as (partition by unit_id order by us, seq))
    select unit_id, {classes('s', (0.005, 0.02, 0.05))} as by_hour, {classes('s', CHART_SLOPE_LIMITS)} as by_chart,
      {classes('s', DECLINE_LIMITS)} as by_percent, count(*) as n from steps where s is not null group by 1, 2, 3, 4""",
    LOG_SQL,
)
def severities(spark, sf):
    step = F.col("tmp_derivative") / 100
    rows = derivatives(ordered_log(spark, sf).select("unit_id", "us", "seq", "rn", "tmp"), ["tmp"])
    return (
        rows.filter(step.isNotNull())
        .groupBy(
            "unit_id",
            severity(step, (0.005, 0.02, 0.05)).alias("by_hour"),
            severity(step, CHART_SLOPE_LIMITS).alias("by_chart"),
            severity(step, DECLINE_LIMITS).alias("by_percent"),
        )
        .agg(F.count("*").alias("n"))
    )


@query(
    "g4_means",
    "select unit_id, round(avg(flux), 6) as avg_flux, round(avg(recovery), 6) as avg_recovery, round(avg(perm_tc), 6) as avg_perm from log group by 1",
    LOG_SQL,
)
def means(spark, sf):
    return sensor_log(spark, sf).groupBy("unit_id").agg(
        *[F.round(F.avg(c), 6).alias(n) for c, n in (("flux", "avg_flux"), ("recovery", "avg_recovery"), ("perm_tc", "avg_perm"))]
    )


DAILY = """daily as (select unit_id, cast(floor(us / 86400000000) as bigint) * 86400000000 as us,
    case when count(*) >= 10 then quantile_cont(perm_tc, 0.1) else min(perm_tc) end as daily_value, count(*) as n
  from log where perm_tc is not null group by 1, 2)"""
FENCED_DAILY = LOG_SQL + ", " + DAILY + """, q as (select unit_id, count(*) as qn, quantile_cont(daily_value, 0.25) as q1,
    quantile_cont(daily_value, 0.75) as q3 from daily group by 1),
points as (select d.unit_id, us, daily_value, row_number() over (partition by d.unit_id order by us) - 1 as rn
  from daily d join q using (unit_id) where qn < 4 or daily_value between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1)),
starts as (select unit_id, case when count(*) >= 5 then avg(daily_value) filter (rn < 5) else arg_min(daily_value, rn) end as stable_start
  from points group by 1)"""


@query("g6_daily_low", "select unit_id, us, n, round(daily_value, 6) as daily_value from daily", LOG_SQL + ", " + DAILY)
def daily_low(spark, sf):
    return f.daily_low(sensor_log(spark, sf)).select("unit_id", "us", "n", *rounded("daily_value"))


@query(
    "g6_order_price_low",
    """select o_custkey % 1000 as customer_group, cast(floor(epoch_us(o_orderdate) / 86400000000 / 90) as bigint) as quarter,
      case when count(*) >= 10 then round(quantile_cont(o_totalprice, 0.1), 4) else round(min(o_totalprice), 4) end as low_price,
      count(*) as n from orders group by 1, 2""",
    "",
)
def order_prices(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        (F.col("o_custkey") % 1000).alias("customer_group"),
        F.floor(micros("o_orderdate") / DAY / 90).cast("long").alias("quarter"),
        F.col("o_orderkey").alias("seq"), "o_totalprice",
    )
    low = group_quantiles(orders, "o_totalprice", {"p10": 0.1, "low": 0.0}, ["customer_group", "quarter"])
    return low.select(
        "customer_group", "quarter",
        F.round(F.when(F.col("n") >= 10, F.col("p10")).otherwise(F.col("low")), 4).alias("low_price"), "n",
    )


@query(
    "g7_fence",
    """, q as (select unit_id, quantile_cont(tmp, 0.25) as q1, quantile_cont(tmp, 0.75) as q3 from log group by 1)
    select unit_id, seq, tmp between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside,
      round(q1 - 1.5 * (q3 - q1), 6) as fence_low, round(q3 + 1.5 * (q3 - q1), 6) as fence_high
    from log join q using (unit_id)""",
    LOG_SQL,
)
def fences(spark, sf):
    return fence(sensor_log(spark, sf).select("unit_id", "seq", "tmp"), "tmp").select(
        "unit_id", "seq", "inside", *rounded("fence_low", "fence_high")
    )


@query(
    "g7_lineitem_price_fence",
    """with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) as q1, quantile_cont(l_extendedprice, 0.75) as q3
      from lineitem group by 1)
    select l_returnflag, count(*) as n, round(sum(l_quantity), 2) as quantity from lineitem join q using (l_returnflag)
    where l_extendedprice between q1 - 0.5 * (q3 - q1) and q3 + 0.5 * (q3 - q1) group by 1""",
    "",
)
def price_fence(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_returnflag", "l_extendedprice", "l_quantity", "l_orderkey", "l_linenumber"
    )
    kept = fence(lines, "l_extendedprice", ["l_returnflag"], ("l_orderkey", "l_linenumber"), reach=0.5).filter("inside")
    return kept.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


WEEK = ORDERED_SQL + f""", smooth as (select *, avg(perm_tc) over (partition by unit_id order by rn rows between 49 preceding and current row) as perm_tc_sma
  from ordered),
week as (select * from smooth join (select unit_id, min(us) as f from log group by 1) using (unit_id) where us < f + 604800000000),
shape as (select unit_id, count(*) as n, cast(floor(3600 / quantile_cont(gap, 0.5)) as bigint) as ph
  from (select unit_id, (us - lag(us) over (partition by unit_id order by rn)) / 1e6 as gap from week) group by 1),
cand as (select w.unit_id, g.i as window_no, count(*) as n_rows, count(perm_tc) as n_readings,
    regr_slope(perm_tc, {X}) as slope, avg(perm_tc_sma) as level, min(us) as start_us, max(us) as end_us
  from week w join shape s using (unit_id), generate_series(0, 400) g(i)
  where ph > 0 and g.i * ph * 4 < n - ph * 24 and rn >= g.i * ph * 4 and rn < g.i * ph * 4 + ph * 24
  group by 1, 2 having count(*) - count(perm_tc) <= 0.1 * count(*) and regr_slope(perm_tc, {X}) is not null),
best as (select unit_id, arg_min(struct_pack(window_no, slope, level, n_rows, start_us, end_us), row(abs(slope), window_no)) as b from cand group by 1),
base as (select o.unit_id, case when o.n_week >= 10 then coalesce(b.b.level, o.mean_week) end as baseline, c.cur
  from (select unit_id, count(*) as n_week, avg(perm_tc_sma) as mean_week from week group by 1) o
  left join best b using (unit_id) join (select unit_id, arg_max(perm_tc_sma, rn) as cur from smooth group by 1) c using (unit_id))"""


def smoothed(spark, sf):
    return prepared(
        spark, sf, "smoothed",
        lambda: moving_average(ordered_log(spark, sf).select("unit_id", "us", "seq", "rn", "perm_tc"), ["perm_tc"], 50),
    )


@query(
    "g8_candidate_windows",
    """select unit_id, window_no, n_rows, n_readings, round(slope * 86400, 7) as slope_per_day, round(level, 6) as level, start_us, end_us from cand""",
    WEEK,
)
def candidates(spark, sf):
    windows = f.stable_windows(f.baseline_week(smoothed(spark, sf)))
    return windows.withColumn("slope_per_day", F.col("slope") * 86400).select(
        "unit_id", "window_no", "n_rows", "n_readings", *rounded("slope_per_day", digits=7), *rounded("level"), "start_us", "end_us"
    )


@query(
    "g8_stable_window",
    """select unit_id, b.window_no as window_no, round(b.slope * 86400, 7) as slope_per_day, round(b.level, 6) as level,
      b.n_rows as n_rows, b.start_us as start_us, b.end_us as end_us from best""",
    WEEK,
)
def stable(spark, sf):
    best = f.most_stable_window(f.stable_windows(f.baseline_week(smoothed(spark, sf))))
    return best.withColumn("slope_per_day", F.col("slope") * 86400).select(
        "unit_id", "window_no", *rounded("slope_per_day", digits=7), *rounded("level"), "n_rows", "start_us", "end_us"
    )


@query(
    "g9_permeability_decline",
    """select unit_id, round(baseline, 6) as permeability_baseline, round(cur, 6) as current_level,
      round(case when baseline > 0 then (baseline - cur) / baseline * 100 when baseline is not null then 0 end, 6) as permeability_decline_baseline
    from base""",
    WEEK,
)
def decline(spark, sf):
    return f.permeability_baseline(smoothed(spark, sf)).select(
        "unit_id", *rounded("permeability_baseline", "current_level", "permeability_decline_baseline")
    )


@query(
    "g9_decline_on_rows",
    """select unit_id, seq, round(baseline, 6) as permeability_baseline,
      round((baseline - cur) / baseline * 100, 6) as permeability_decline_baseline,
      case when baseline is null then 1 else 0 end as uses_fallback
    from smooth join base using (unit_id)""",
    WEEK,
)
def decline_rows(spark, sf):
    rows = f.add_decline(smoothed(spark, sf))
    return rows.select(
        "unit_id", "seq", *rounded("permeability_baseline", "permeability_decline_baseline"),
        F.col("permeability_baseline").isNull().cast("int").alias("uses_fallback"),
    )


@query(
    "g10_stable_start",
    "select unit_id, round(stable_start, 6) as stable_start, round(stable_start * 0.6, 6) as critical_level from starts",
    FENCED_DAILY,
)
def stable_start(spark, sf):
    return f.stable_start(daily_points(spark, sf)).select("unit_id", *rounded("stable_start", "critical_level"))


def daily_points(spark, sf):
    return prepared(spark, sf, "daily_points", lambda: f.fenced_daily_low(sensor_log(spark, sf)))
