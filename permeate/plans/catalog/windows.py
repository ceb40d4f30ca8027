"""Derivatives, moving statistics, edges and scalar formulas."""

from pyspark.sql import functions as F

from permeate.functions import scalars as s
from permeate.functions.timing import calendar_features, day_of, micros, parse_stamp, plus_days, to_stamp
from permeate.operators import rolling as w
from permeate.plans.adapter import LOG_SQL, ordered_log, sensor_log
from permeate.plans.registry import query, rounded, stamp_text

_BY = "partition by unit_id order by us, seq"


def _log(spark, sf, *columns):
    return ordered_log(spark, sf).select("unit_id", "us", "seq", "rn", *columns)


@query(
    "e1_derivatives",
    f"""select unit_id, seq,
      round((tmp - lag(tmp) over w) / nullif((us - lag(us) over w) / 3600e6, 0), 6) as tmp_derivative,
      round((flux - lag(flux) over w) / nullif((us - lag(us) over w) / 3600e6, 0), 6) as flux_derivative
    from log window w as ({_BY})""",
    LOG_SQL,
)
def derivatives(spark, sf):
    return w.derivatives(_log(spark, sf, "tmp", "flux"), ["tmp", "flux"]).select(
        "unit_id", "seq", *rounded("tmp_derivative", "flux_derivative")
    )


def _range(hours: int) -> str:
    return f"(partition by unit_id order by us range between {hours * 3600_000_000 - 1} preceding and current row)"


@query(
    "e2_rolling_mean",
    "select unit_id, seq, "
    + ", ".join(
        f"round(avg({c}) over {_range(h)}, 6) as {c}_mean_{h}h" for c in ("tmp", "perm_tc") for h in (6, 12, 24)
    )
    + " from log",
    LOG_SQL,
)
def rolling_mean(spark, sf):
    names = [f"{c}_mean_{h}h" for c in ("tmp", "perm_tc") for h in (6, 12, 24)]
    out = w.time_statistics(_log(spark, sf, "tmp", "perm_tc"), ["tmp", "perm_tc"], statistics=("mean",))
    return out.select("unit_id", "seq", *rounded(*names))


# Infinite readings are missing; readings far away (5e8) and a counter beyond 3e8 stay in.
_FAULTS = LOG_SQL + """, faulty as (select unit_id, us, seq, 1234567.8e0 + case when seq % 3 = 0 then 1e-3 else 0 end as total,
    3e8 + seq * 1e3 as counter,
    case when seq % 100 = 0 then null when seq % 100 = 50 then 5e8 else tmp end as tmp from log)"""


@query(
    "e2_e3_faults_and_totals",
    "select unit_id, seq, "
    + ", ".join(f"round({f}({c}) over {_range(24)}, 2) as {c}_{n}_24h" for n, f in (("mean", "avg"), ("std", "stddev_samp")) for c in ("total", "counter", "tmp"))
    + " from faulty",
    _FAULTS,
)
def faults_and_totals(spark, sf):
    """A totaliser that hardly moves, a counter far from its median, and readings among which
    some are infinite (missing) or far away (kept)."""
    seq = F.col("seq")
    fault = F.when(seq % 100 == 0, float("inf")).when(seq % 100 == 50, 5e8)
    log = _log(spark, sf, "tmp").withColumn("tmp", F.coalesce(fault, F.col("tmp")))
    log = log.withColumn("total", F.lit(1234567.8) + F.when(seq % 3 == 0, 1e-3).otherwise(0.0))
    log = log.withColumn("counter", F.lit(3e8) + seq.cast("double") * 1e3)
    out = w.time_statistics(log, ["total", "counter", "tmp"], ("24h",))
    names = [f"{c}_{n}_24h" for n in ("mean", "std") for c in ("total", "counter", "tmp")]
    return out.select("unit_id", "seq", *rounded(*names, digits=2))


@query(
    "e3_rolling_std",
    "select unit_id, seq, "
    + ", ".join(f"round(stddev_samp({c}) over {_range(h)}, 5) as {c}_std_{h}h" for c in ("tmp", "flux") for h in (6, 24))
    + " from log",
    LOG_SQL,
)
def rolling_std(spark, sf):
    names = [f"{c}_std_{h}h" for c in ("tmp", "flux") for h in (6, 24)]
    out = w.time_statistics(_log(spark, sf, "tmp", "flux"), ["tmp", "flux"], ("6h", "24h"), ("std",))
    return out.select("unit_id", "seq", *rounded(*names, digits=5))


@query(
    "e4_rolling_slope",
    "select unit_id, seq, "
    + ", ".join(f"round(avg(step) over {_range(h)}, 6) as tmp_slope_{h}h" for h in (6, 12, 24))
    + f""" from (select *, (tmp - lag(tmp) over ({_BY})) / nullif((us - lag(us) over ({_BY})) / 3600e6, 0) as step from log)""",
    LOG_SQL,
)
def rolling_slope(spark, sf):
    return w.rolling_slopes(_log(spark, sf, "tmp")).select("unit_id", "seq", *rounded(*[f"tmp_slope_{h}h" for h in (6, 12, 24)]))


@query(
    "e5_decline_from_window_start",
    f"""select unit_id, seq, round((f - perm_tc) / f * 100, 6) as perm_tc_decline_7d
    from (select *, first_value(perm_tc) over {_range(168)} as f from log)""",
    LOG_SQL,
)
def decline(spark, sf):
    return w.decline_from_window_start(_log(spark, sf, "perm_tc")).select("unit_id", "seq", *rounded("perm_tc_decline_7d"))


LAGS = (1, 12, 72, 144, 288)


@query(
    "e6_lags",
    "select unit_id, seq, " + ", ".join(f"round(lag(tmp, {k}) over w, 6) as tmp_lag_{k}" for k in LAGS) + f" from log window w as ({_BY})",
    LOG_SQL,
)
def lags(spark, sf):
    return w.lag_features(_log(spark, sf, "tmp"), "tmp").select("unit_id", "seq", *rounded(*[f"tmp_lag_{k}" for k in LAGS]))


_ROW_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


@query(
    "e7_row_statistics",
    "select unit_id, seq, "
    + ", ".join(
        f"round({f}(tmp) over ({_BY} rows between {k - 1} preceding and current row), 5) as tmp_roll_{n}_{k}"
        for k in (12, 72, 288)
        for n, f in _ROW_STATS.items()
    )
    + " from log",
    LOG_SQL,
)
def row_statistics(spark, sf):
    names = [f"tmp_roll_{n}_{k}" for k in (12, 72, 288) for n in _ROW_STATS]
    return w.row_statistics(_log(spark, sf, "tmp"), "tmp").select("unit_id", "seq", *rounded(*names, digits=5))


@query(
    "e8_rolling_max",
    f"select unit_id, seq, round(max(tmp) over ({_BY} rows between 5 preceding and current row), 6) as tmp_roll_max_6 from log",
    LOG_SQL,
)
def rolling_max(spark, sf):
    return w.row_statistics(_log(spark, sf, "tmp"), "tmp", (6,), ("max",)).select("unit_id", "seq", *rounded("tmp_roll_max_6"))


@query(
    "e9_edges",
    f"""select unit_id, seq, "on" and not was as rising, not "on" and was as falling from (
      select *, coalesce(lag("on") over ({_BY}), false) as was from (select *, program = 21 as "on" from log))
    where ("on" and not was) or (not "on" and was)""",
    LOG_SQL,
)
def edges(spark, sf):
    return w.edges(_log(spark, sf, "program"), F.col("program") == 21).filter("rising or falling").select(
        "unit_id", "seq", "rising", "falling"
    )


@query(
    "e10_increments",
    f"""select unit_id, seq, step as increment from (select *, chemical_timer - lag(chemical_timer) over ({_BY}) as step from log)
    where step > 0""",
    LOG_SQL,
)
def increments(spark, sf):
    return w.increments(_log(spark, sf, "chemical_timer"), "chemical_timer").select("unit_id", "seq", "increment")


@query(
    "e11_first_and_last",
    """select unit_id, round(arg_min(tmp, us), 6) as tmp_first, round(arg_max(tmp, us), 6) as tmp_last,
      round(arg_min(flux, us), 6) as flux_first, round(arg_max(flux, us), 6) as flux_last from log group by 1""",
    LOG_SQL,
)
def first_and_last(spark, sf):
    return w.first_and_last(sensor_log(spark, sf), ["tmp", "flux"]).select(
        "unit_id", *rounded("tmp_first", "tmp_last", "flux_first", "flux_last")
    )


@query(
    "l6_current_tmp",
    "select unit_id, max(us) as us, round(arg_max(tmp, us), 6) as current_tmp from log group by 1",
    LOG_SQL,
)
def last_row(spark, sf):
    return sensor_log(spark, sf).groupBy("unit_id").agg(
        F.max("us").alias("us"), F.round(F.max_by("tmp", F.struct("us", "seq")), 6).alias("current_tmp")
    )


@query(
    "e13_seconds_since_start",
    "select unit_id, seq, (us - min(us) over (partition by unit_id)) / 1e6 as time_numeric from log",
    LOG_SQL,
)
def seconds(spark, sf):
    return w.seconds_since_start(sensor_log(spark, sf).select("unit_id", "seq", "us")).select(
        "unit_id", "seq", "time_numeric"
    )


@query(
    "a4_stamp_parse",
    """select unit_id, seq, us - us % 10000 as us, strftime(make_timestamp(us - us % 10000), '%Y-%m-%d %H:%M:%S.%f') as ts from log""",
    LOG_SQL,
)
def stamps(spark, sf):
    log = sensor_log(spark, sf)
    hundredths = F.lpad(F.floor(F.pmod(F.col("us"), F.lit(1_000_000)) / 10_000).cast("string"), 2, "0")
    raw = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), hundredths)
    return log.select("unit_id", "seq", parse_stamp(raw).alias("ts")).select("unit_id", "seq", micros("ts").alias("us"), stamp_text("ts"))


@query(
    "f1_temperature_normalised",
    """select unit_id, seq, round(perm_tc / pow(1.025e0, temp_c - 10), 6) as permeability_normalized,
      round(flux / pow(1.025e0, temp_c - 10), 6) as flux_normalized from log""",
    LOG_SQL,
)
def normalised(spark, sf):
    return sensor_log(spark, sf).select(
        "unit_id", "seq",
        F.round(s.at_reference_temperature(F.col("perm_tc"), F.col("temp_c"), 10), 6).alias("permeability_normalized"),
        F.round(s.at_reference_temperature(F.col("flux"), F.col("temp_c"), 10), 6).alias("flux_normalized"),
    )


@query(
    "f2_efficiencies",
    """select unit_id, seq, round(perm_tc / (tmp + 0.1e0), 6) as hydraulic_efficiency,
      round(v_crossflow / (tmp + 0.1e0), 6) as crossflow_efficiency,
      round(recovery / (specific_power + 0.001e0), 4) as recovery_per_energy from log""",
    LOG_SQL,
)
def efficiencies(spark, sf):
    c = F.col
    return sensor_log(spark, sf).select(
        "unit_id", "seq",
        F.round(s.hydraulic_efficiency(c("perm_tc"), c("tmp")), 6).alias("hydraulic_efficiency"),
        F.round(s.crossflow_efficiency(c("v_crossflow"), c("tmp")), 6).alias("crossflow_efficiency"),
        F.round(s.recovery_per_energy(c("recovery"), c("specific_power")), 4).alias("recovery_per_energy"),
    )


@query(
    "f6_calendar",
    """select unit_id, seq, cast(hour(ts) as int) as "hour", cast(isodow(ts) - 1 as int) as day_of_week, cast(day(ts) as int) as day_of_month,
      cast(case when isodow(ts) >= 6 then 1 else 0 end as int) as is_weekend,
      round(sin(2 * pi() * hour(ts) / 24), 6) as hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) as hour_cos from log""",
    LOG_SQL,
)
def calendar(spark, sf):
    return sensor_log(spark, sf).withColumns(calendar_features(F.col("ts"))).select(
        "unit_id", "seq", "hour", "day_of_week", "day_of_month", "is_weekend", *rounded("hour_sin", "hour_cos")
    )


@query(
    "f7_log_transform",
    "select unit_id, seq, round(ln(tmp + 0.1e0), 6) as log_tmp, round(exp(ln(tmp + 0.1e0)) - 0.1e0, 6) as back from log",
    LOG_SQL,
)
def log_transform(spark, sf):
    logged = s.to_log(F.col("tmp"))
    return sensor_log(spark, sf).select(
        "unit_id", "seq", F.round(logged, 6).alias("log_tmp"), F.round(s.from_log(logged), 6).alias("back")
    )


@query(
    "f8_day_floor",
    "select unit_id, strftime(date_trunc('day', ts), '%Y-%m-%d') as day, count(*) as n, min(us) as first_us from log group by 1, 2",
    LOG_SQL,
)
def day_floor(spark, sf):
    day = F.date_format(to_stamp(day_of(F.col("us")) * 86_400_000_000), "yyyy-MM-dd").alias("day")
    return sensor_log(spark, sf).groupBy("unit_id", day).agg(F.count("*").alias("n"), F.min("us").alias("first_us"))


@query(
    "f9_half_even",
    "select unit_id, seq, round_even(value / 10, 1) as tenths from log",
    LOG_SQL,
)
def half_even(spark, sf):
    return sensor_log(spark, sf).select("unit_id", "seq", s.half_even(F.col("value") / 10, 1).alias("tenths"))


@query(
    "f12_plus_days",
    """select unit_id, seq, us + cast(round(tmp * 86400000000) as bigint) as later_us from log""",
    LOG_SQL,
)
def later(spark, sf):
    return sensor_log(spark, sf).select("unit_id", "seq", plus_days(F.col("us"), F.col("tmp")).alias("later_us"))
