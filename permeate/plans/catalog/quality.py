"""Filters, checks and the validation report."""

from pyspark.sql import functions as F

from permeate.functions.missing import drop_missing, enough
from permeate.functions.timing import DAY, micros_of, span
from permeate.operators import quality as q
from permeate.operators.fouling import baseline_week
from permeate.operators.joins import append_per_unit
from permeate.plans.adapter import BANDS, LOG_SQL, ordered_log, sensor_log
from permeate.plans.registry import query, rounded, stamp_text

RANGE = ("2024-01-05 06:00:00", "2024-01-20 18:00:00")


@query(
    "b1_missing_columns",
    """select place, col as "column", col not in (select column_name from (describe events)) as missing
    from (values (0, 'ts'), (1, 'value'), (2, 'flow'), (3, 'event_type')) as t(place, col)""",
    "",
)
def missing(spark, sf):
    return q.missing_table(spark.read.parquet(f"{sf}/events.parquet"), ["ts", "value", "flow", "event_type"])


@query("b2_keep_columns", "select unit_id, us, seq, tmp, perm_tc, flux from log", LOG_SQL)
def keep(spark, sf):
    bands = {c: BANDS[c] for c in ("tmp", "perm_tc", "flux")}
    return q.keep_columns(sensor_log(spark, sf), bands, ("unit_id", "us", "seq"))


@query("b3_band_filter", "select unit_id, us, seq, tmp, perm_tc from ordered where good")
def bands(spark, sf):
    return q.band_filter(ordered_log(spark, sf), BANDS).select("unit_id", "us", "seq", "tmp", "perm_tc")


@query("b4_from_stamp", f"select unit_id, us, seq, tmp from log where ts >= timestamp '{RANGE[0]}'", LOG_SQL)
def from_stamp(spark, sf):
    return sensor_log(spark, sf).filter(F.col("ts") >= F.lit(RANGE[0]).cast("timestamp_ntz")).select("unit_id", "us", "seq", "tmp")


@query(
    "b5_baseline_week",
    f"""select unit_id, us, seq, perm_tc from log
    where ts >= timestamp '{RANGE[0]}' and ts < timestamp '{RANGE[0]}' + interval 7 day""",
    LOG_SQL,
)
def half_open(spark, sf):
    return baseline_week(sensor_log(spark, sf), RANGE[0]).select("unit_id", "us", "seq", "perm_tc")


@query(
    "b6_visible_range",
    f"select unit_id, us, seq, tmp from log where ts between timestamp '{RANGE[0]}' and timestamp '{RANGE[1]}'",
    LOG_SQL,
)
def closed(spark, sf):
    inside = F.col("us").between(micros_of(RANGE[0]), micros_of(RANGE[1]))
    return sensor_log(spark, sf).filter(inside).select("unit_id", "us", "seq", "tmp")


@query("b7_drop_missing", "select unit_id, us, seq, perm_tc from log where perm_tc is not null", LOG_SQL)
def dropped(spark, sf):
    return drop_missing(sensor_log(spark, sf).select("unit_id", "us", "seq", "perm_tc"), ["perm_tc"])


@query(
    "b10_append_constant",
    """select l.unit_id, l.us, l.seq, round(m.peak, 6) as peak
    from log l join (select unit_id, max(tmp) as peak from log group by 1) m using (unit_id)""",
    LOG_SQL,
)
def constant(spark, sf):
    log = sensor_log(spark, sf).select("unit_id", "us", "seq", "tmp")
    peaks = log.groupBy("unit_id").agg(F.max("tmp").alias("peak"))
    return append_per_unit(log, peaks).select("unit_id", "us", "seq", *rounded("peak"))


@query(
    "b11_evidence_guard",
    """select unit_id, cast(floor(us / 86400000000) as bigint) as day, count(*) as n,
      case when count(*) >= 10 then round(avg(value), 4) end as mean_value
    from log group by 1, 2""",
    LOG_SQL,
)
def guard(spark, sf):
    day = F.floor(F.col("us") / DAY).cast("long").alias("day")
    return sensor_log(spark, sf).groupBy("unit_id", day).agg(
        F.count("*").alias("n"), enough(F.count("*"), 10, F.round(F.avg("value"), 4)).alias("mean_value")
    )


CHECKED = ("tmp", "perm_tc", "flux", "temp_c")


@query(
    "c1_missing_share",
    " union all ".join(
        f"""select unit_id, '{c}' as "column", round(avg(case when {c} is null then 1.0 else 0.0 end) * 100, 6)
        as missing_percent from log group by 1"""
        for c in CHECKED
    ),
    LOG_SQL,
)
def missing(spark, sf):
    return q.missing_share(sensor_log(spark, sf), CHECKED).select("unit_id", "column", *rounded("missing_percent"))


_FIRST_FAIL = "coalesce(" + ", ".join(
    f"case when not coalesce({c} between {lo} and {hi}, false) then '{c}' end" for c, (lo, hi) in BANDS.items()
) + ")"


@query(
    "c2_first_fail_counts",
    f"""select unit_id, parameter, count(*) as removed
    from (select unit_id, {_FIRST_FAIL} as parameter from log) where parameter is not null group by 1, 2""",
    LOG_SQL,
)
def outliers(spark, sf):
    return q.outlier_counts(ordered_log(spark, sf), BANDS)


_GAPS = """, steps as (select unit_id, us, lag(us) over (partition by unit_id order by us, seq) as prev from log),
gaps as (select unit_id, make_timestamp(prev) as gap_start, make_timestamp(us) as gap_end, (us - prev) / 60e6 as minutes
  from steps where us - prev > 3600000000)"""


@query(
    "c3_stamp_gaps",
    """select unit_id, strftime(gap_start, '%Y-%m-%d %H:%M:%S.%f') as gap_start,
    strftime(gap_end, '%Y-%m-%d %H:%M:%S.%f') as gap_end, minutes from gaps""",
    LOG_SQL + _GAPS,
)
def gaps(spark, sf):
    return q.stamp_gaps(ordered_log(spark, sf), 60).select(
        "unit_id", stamp_text("gap_start"), stamp_text("gap_end"), "minutes"
    )


@query(
    "l2_first_gaps",
    """select unit_id, strftime(gap_start, '%Y-%m-%d %H:%M:%S.%f') as gap_start, minutes
    from gaps order by gaps.gap_start, unit_id limit 5""",
    LOG_SQL + _GAPS,
)
def first_gaps(spark, sf):
    return q.first_gaps(q.stamp_gaps(ordered_log(spark, sf), 60)).select("unit_id", stamp_text("gap_start"), "minutes")


@query(
    "c4_validation_report",
    f""", marked as (select *, {_FIRST_FAIL} as failed, lag(us) over (partition by unit_id order by us, seq) as prev from ordered)
    select unit_id, count(*) as rows_in, count(*) - count(failed) as rows_out, count(failed) as rows_removed,
      count(*) filter (failed = 'tmp') as tmp_outliers, count(*) filter (failed = 'perm_tc') as perm_outliers,
      round(avg(case when perm_tc is null then 1.0 else 0.0 end) * 100, 6) as perm_missing,
      count(*) filter (us - prev > 3600000000) as n_gaps,
      concat_ws('; ',
        case when count(*) filter (us - prev > 3600000000) > 0
          then 'Detected ' || count(*) filter (us - prev > 3600000000) || ' timestamp gaps' end,
        case when avg(case when perm_tc is null then 1.0 else 0.0 end) > 0.05
          then 'Columns with >5% missing: perm_tc' end) as warnings,
      strftime(min(ts) filter (failed is null), '%Y-%m-%d %H:%M:%S.%f') as time_range_start,
      strftime(max(ts) filter (failed is null), '%Y-%m-%d %H:%M:%S.%f') as time_range_end
    from marked group by 1""",
)
def report(spark, sf):
    out = q.validation_report(ordered_log(spark, sf), BANDS, list(BANDS), 60)
    return out.select(
        "unit_id", "rows_in", "rows_out", "rows_removed",
        F.col("outliers")["tmp"].alias("tmp_outliers"),
        F.col("outliers")["perm_tc"].alias("perm_outliers"),
        F.round(F.col("missing_percent")["perm_tc"], 6).alias("perm_missing"),
        "n_gaps",
        F.concat_ws("; ", "warnings").alias("warnings"),
        stamp_text("time_range_start"), stamp_text("time_range_end"),
    )


@query(
    "c5_time_range",
    """, steps as (select unit_id, ts, us, (us - lag(us) over (partition by unit_id order by us, seq)) / 1e6 as gap from log)
    select unit_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as start_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as end_time,
      (max(us) - min(us)) / 3600e6 as duration_hours, (max(us) - min(us)) / 86400e6 as duration_days,
      count(*) as n_rows, round(quantile_cont(gap, 0.5), 7) as median_interval_s from steps group by 1""",
    LOG_SQL,
)
def time_range(spark, sf):
    return q.time_range(ordered_log(spark, sf)).select(
        "unit_id", stamp_text("start_time"), stamp_text("end_time"),
        "duration_hours", "duration_days", "n_rows", *rounded("median_interval_s", digits=7),
    )


@query(
    "c6_durations",
    """select unit_id, seq, (us - f) / 1e6 as seconds, (us - f) / 60e6 as minutes,
      (us - f) / 3600e6 as hours, (us - f) / 86400e6 as days
    from (select *, min(us) over (partition by unit_id) as f from log)""",
    LOG_SQL,
)
def durations(spark, sf):
    log = sensor_log(spark, sf).select("unit_id", "us", "seq")
    starts = log.groupBy("unit_id").agg(F.min("us").alias("f"))
    return append_per_unit(log, starts).select(
        "unit_id", "seq",
        *[
            span(F.col("f"), F.col("us"), unit).alias(unit)
            for unit in ("seconds", "minutes", "hours", "days")
        ],
    )


@query(
    "c7_retention",
    """select unit_id, count(*) as rows_in, count(*) filter (good) as rows_out, count(*) - count(*) filter (good) as rows_removed,
    round(count(*) filter (good) * 100.0 / count(*), 6) as retention_percent from ordered group by 1""",
)
def retention(spark, sf):
    return q.retention(ordered_log(spark, sf), BANDS).select(
        "unit_id", "rows_in", "rows_out", "rows_removed", *rounded("retention_percent")
    )


@query(
    "c8_column_summary",
    " union all ".join(
        f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 5) as mean, round(stddev_samp({c}), 5) as std,
        round(min({c}), 6) as min, round(max({c}), 6) as max, round(quantile_cont({c}, 0.25), 6) as q25,
        round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75 from log"""
        for c in ("tmp", "perm_tc", "flux", "recovery")
    ),
    LOG_SQL,
)
def summary(spark, sf):
    return q.column_summary(sensor_log(spark, sf), ["tmp", "perm_tc", "flux", "recovery"]).select(
        "column", "count", *rounded("mean", "std", digits=5), *rounded("min", "max", "q25", "q50", "q75")
    )
