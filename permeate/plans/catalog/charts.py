"""Chart tables."""

from pyspark.sql import functions as F

from permeate.operators import charts as ch
from permeate.operators.fouling import daily_low, stable_start
from permeate.plans.adapter import LOG_SQL, ordered_log, prepared, sensor_log
from permeate.plans.catalog.cycles import CLEANINGS, CYCLE_TABLE, RATES, cleaning_table, cycle_table, rate_table, recursive
from permeate.plans.catalog.figures import FORECAST, forecasts
from permeate.plans.catalog.fouling import FENCED_DAILY, classes, daily_points
from permeate.plans.registry import query, rounded, stamp_text
from permeate.schema import CHART_SLOPE_LIMITS, DECLINE_LIMITS

# The forecast expressions without the log they start from.
FORECAST_ONLY = FORECAST[len(LOG_SQL) + 2 :]


@query(
    "k1_series",
    """, sized as (select *, count(*) over (partition by unit_id) as n from ordered),
    sampled as (select *, row_number() over (partition by unit_id order by rn) - 1 as srn from sized
      where n <= 300 or rn % (n // 300) = 0 or rn = n - 1),
    smooth as (select unit_id, ts, tmp, perm_tc, avg(tmp) over w as tmp_sma, avg(perm_tc) over w as perm_sma, avg(temp_c) over w as temperature
      from sampled window w as (partition by unit_id order by srn rows between 49 preceding and current row))
    select unit_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, 'tmp' as parameter, round(tmp, 6) as raw, round(tmp_sma, 6) as sma,
      round(temperature, 6) as temperature from smooth
    union all select unit_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 'perm_tc', round(perm_tc, 6), round(perm_sma, 6), round(temperature, 6) from smooth""",
)
def series(spark, sf):
    return ch.series(ordered_log(spark, sf), ["tmp", "perm_tc"], 300).select(
        "unit_id", stamp_text("ts"), "parameter", *rounded("raw", "sma", "temperature")
    )


SX = "((start_us - 1704067200000000) / 1e6)"
_POINTS = """quart as (select unit_id, count(*) as qn, quantile_cont(tmp_start, 0.25) as q1, quantile_cont(tmp_start, 0.75) as q3 from cycles group by 1),
points as (select unit_id, start_us, tmp_start from cycles join quart using (unit_id)
  where qn < 4 or tmp_start between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))"""
# The rate queries name their quartiles "quart" too, so the chart's points get names of their own.
_POINTS_APART = _POINTS.replace("quart", "chart_quart")
_TREND = f"""trend as (select unit_id, count(*) as n, regr_slope(tmp_start, {SX}) as b, regr_intercept(tmp_start, {SX}) as a,
    case when regr_syy(tmp_start, {SX}) = 0 then 0 else regr_r2(tmp_start, {SX}) end as r2,
    sqrt(regr_syy(tmp_start, {SX}) * (1 - regr_r2(tmp_start, {SX})) / greatest(count(*) - 2, 1)) as sd,
    max({SX}) as xl, max(start_us) as last_us, arg_max(tmp_start, start_us) as last_value from points group by 1)"""


def start_points(spark, sf):
    return prepared(spark, sf, "start_points", lambda: ch.cycle_start_points(cycle_table(spark, sf)))


@query(
    "k2_cycle_start_points",
    f"select unit_id, start_us as us, round(tmp_start, 6) as tmp_start, case when n > 2 then round(a + b * {SX}, 6) end as trend from points join trend using (unit_id)",
    ", ".join([CYCLE_TABLE, _POINTS, _TREND]),
)
def points(spark, sf):
    return ch.cycle_start_points(cycle_table(spark, sf)).select("unit_id", "us", *rounded("tmp_start", "trend"))


_RANGE = ("2024-01-05 00:00:00", "2024-01-25 00:00:00")
_SEEN = _TREND.replace("from points group by 1", f"from points where make_timestamp(start_us) between timestamp '{_RANGE[0]}' and timestamp '{_RANGE[1]}' group by 1 having count(*) >= 2")
_REFIT = ", ".join([CYCLE_TABLE, _POINTS, _SEEN]) + """, ends as (select unit_id, max(start_us) as all_last, max((start_us - 1704067200000000) / 1e6) as xa from points group by 1),
refit as (select unit_id, n, b, r2, sd, a + b * xa as fitted, a + b * (xa + 604800) as predicted, all_last,
  case when b > 0 then (6.0 - (a + b * xa)) / (b * 86400) end as days from trend join ends using (unit_id))"""


@query(
    "k3_trend_refit",
    """select unit_id, n, round(b * 86400, 7) as slope_per_day, round(r2, 7) as r_squared, round(fitted, 6) as fitted_at_last,
      round(predicted, 6) as predicted_value, round(sd * 1.96, 6) as margin, round(days, 3) as days_to_threshold from refit""",
    _REFIT,
)
def refit(spark, sf):
    return ch.refit(start_points(spark, sf), "tmp_start", *_RANGE).select(
        "unit_id", "n", *rounded("slope_per_day", "r_squared", digits=7),
        *rounded("fitted_at_last", "predicted_value", "margin"), *rounded("days_to_threshold", digits=3),
    )


@query(
    "k3_refit_cone",
    """select unit_id, cast(i as int) as point, all_last + cast(round(i / 19.0e0 * 604800000000) as bigint) as us,
      round(fitted + i / 19.0e0 * (predicted - fitted), 6) as "value",
      round(fitted + i / 19.0e0 * (predicted - 1.96 * sd - fitted), 6) as lower,
      round(fitted + i / 19.0e0 * (predicted + 1.96 * sd - fitted), 6) as upper
    from refit, generate_series(0, 19) g(i)""",
    _REFIT,
)
def refit_cone(spark, sf):
    return _path(ch.refit_path(ch.refit(start_points(spark, sf), "tmp_start", *_RANGE)))


def _path(df):
    us = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', time)").alias("us")
    return df.select("unit_id", "point", us, *rounded("value", "lower", "upper"))


@query(
    "k4_k5_forecast_path",
    """select unit_id, cast(i as int) as point, p.last_us + cast(round(i / 19.0e0 * (horizon_us - p.last_us)) as bigint) as us,
      round(last_value + i / 19.0e0 * (predicted_value - last_value), 6) as "value",
      round(last_value + i / 19.0e0 * (lower_bound - last_value), 6) as lower,
      round(last_value + i / 19.0e0 * (upper_bound - last_value), 6) as upper
    from trend p join (select * exclude (last_us) from forecasts where parameter = 'TMP') f using (unit_id), generate_series(0, 19) g(i)""",
    ", ".join([CYCLE_TABLE, FORECAST_ONLY.replace("points", "daily_points"), _POINTS, _TREND]),
)
def forecast_path(spark, sf):
    tmp = forecasts(spark, sf).filter("parameter = 'TMP'")
    return _path(ch.forecast_path(start_points(spark, sf), "tmp_start", tmp))


@query(
    "k6_threshold_lines",
    """select unit_id, round(threshold_value, 6) as level, strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%f') as time from (
      select f.unit_id, threshold_value, horizon_us as us from forecasts f where parameter = 'Permeability TC'
      union all
      select f.unit_id, threshold_value, (select min(us) from log where log.unit_id = f.unit_id) from forecasts f where parameter = 'Permeability TC')""",
    FORECAST,
)
def threshold_lines(spark, sf):
    perm = forecasts(spark, sf).filter("parameter = 'Permeability TC'")
    return ch.threshold_line(sensor_log(spark, sf), perm, F.col("threshold_value")).select(
        "unit_id", *rounded("level"), stamp_text("time")
    )


@query(
    "k7_cleaning_markers",
    """select unit_id, strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%f') as cleaning_time,
      round(coalesce(lo, 0) , 6) as y_low, round(coalesce(hi, 6), 6) as y_high
    from cleanings left join (select unit_id, min(tmp_start) * 0.7 as lo, max(tmp_start) * 1.3 as hi from points group by 1) using (unit_id)""",
    ", ".join([CYCLE_TABLE, CLEANINGS, _POINTS]),
)
def markers(spark, sf):
    return ch.cleaning_markers(cleaning_table(spark, sf), start_points(spark, sf), "tmp_start").select(
        "unit_id", stamp_text("cleaning_time"), *rounded("y_low", "y_high")
    )


UX = "((us - 1704067200000000) / 1e6)"
_DAILY_TREND = f"""trend as (select unit_id, count(*) as n, regr_slope(daily_value, {UX}) as b, regr_intercept(daily_value, {UX}) as a,
    case when regr_syy(daily_value, {UX}) = 0 then 0 else regr_r2(daily_value, {UX}) end as r2,
    max(us) as last_us, arg_max(daily_value, us) as last_value from points group by 1)"""


@query(
    "k8_daily_baseline_trend",
    f"select unit_id, us, round(daily_value, 6) as daily_value, case when n > 2 then round(a + b * {UX}, 6) end as trend from points join trend using (unit_id)",
    FENCED_DAILY + ", " + _DAILY_TREND,
)
def daily_trend(spark, sf):
    daily = prepared(spark, sf, "daily_low", lambda: daily_low(sensor_log(spark, sf)))
    return ch.trend_points(daily, "daily_value").select("unit_id", "us", *rounded("daily_value", "trend"))


@query(
    "k9_tmp_note",
    f"""select unit_id, {classes('(b * 3600)', CHART_SLOPE_LIMITS)} as fouling_class, round(b * 86400, 7) as slope_per_day, round(t.r2, 7) as r_squared,
      round(reversible_rate, 6) as reversible_rate,
      round(case when b > 0 and 6 - (a + b * xl) > 0 then (6 - (a + b * xl)) / (b * 86400) end, 3) as days_to_threshold
    from trend t left join rates using (unit_id) where n > 2""",
    recursive(", ".join([RATES, _POINTS_APART, _TREND])),
)
def tmp_note(spark, sf):
    return ch.tmp_note(start_points(spark, sf), rate_table(spark, sf)).select(
        "unit_id", "fouling_class", *rounded("slope_per_day", "r_squared", digits=7), *rounded("reversible_rate"),
        *rounded("days_to_threshold", digits=3),
    )


@query(
    "k9_decline_note",
    f"""select unit_id, {classes('(b * 86400 / stable_start * 100)', DECLINE_LIMITS)} as decline_class, round(b * 86400, 7) as slope_per_day,
      round(r2, 7) as r_squared, round(abs(b * 86400 / stable_start * 100), 6) as decline_percent_per_day,
      round(case when b < 0 and (stable_start * 0.6 - last_value) / (b * 86400) > 0 then (stable_start * 0.6 - last_value) / (b * 86400) end, 3) as days_to_critical
    from trend join starts using (unit_id) where n > 2""",
    FENCED_DAILY + ", " + _DAILY_TREND,
)
def decline_note(spark, sf):
    points = daily_points(spark, sf)
    return ch.decline_note(points, stable_start(points)).select(
        "unit_id", "decline_class", *rounded("slope_per_day", "r_squared", digits=7), *rounded("decline_percent_per_day"),
        *rounded("days_to_critical", digits=3),
    )


@query(
    "k10_cycle_comparison",
    "select unit_id, cycle_id, round(tmp_slope, 6) as tmp_slope, duration_hours from cycles",
    CYCLE_TABLE,
)
def comparison(spark, sf):
    return ch.cycle_comparison(cycle_table(spark, sf)).select("unit_id", "cycle_id", *rounded("tmp_slope"), "duration_hours")
