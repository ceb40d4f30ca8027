"""Sources, sinks and continuous ingest."""

import uuid

from pyspark.sql import functions as F

from permeate.operators.fouling import tmp_slopes
from permeate.operators.ordering import row_index
from permeate.plans.adapter import LOG_SQL, once, sensor_log
from permeate.plans.catalog.cycles import CYCLE_TABLE, PERIODS, cycle_table
from permeate.plans.registry import query, rounded
from permeate.sources.logs import read_logs, readable, unreadable_counts
from permeate.sources.tables import file_info, load_json, load_parquet, save_csv, save_json, save_log
from permeate.storage import shared_folder
from permeate.streaming.ingest import DAILY_LOW, STATISTICS, current_periods, current_slopes, ingest_new_files


def _unit():
    """Unit folders are written as ``unit=<name>``."""
    return F.regexp_extract("file", "unit=([^/]+)/", 1)


def _fresh(spark, name):
    return f"{shared_folder(spark)}/permeate/{name}-{uuid.uuid4().hex}"


def logger_files(spark, sf):
    """The log as logger files: two groups whose headers differ in order, blanks and columns."""
    folder = _fresh(spark, "tsv")
    log = sensor_log(spark, sf).withColumn("stamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss SSSSSS"))
    c = F.col
    first = [c("unit_id").alias("unit"), c("stamp").alias("TimeStamp"), c("tmp").alias("TMP"),
             c("perm_tc").alias("Permeability TC"), c("flux").alias(" Flux "), c("program").alias("Active program number"),
             c("seq").alias("Row number"), c("temp_c").alias("01-TIT-01")]
    second = [c("unit_id").alias("unit"), c("seq").alias("Row number"), c("flux").alias("Flux"),
              c("program").alias("Active program number"), c("stamp").alias(" TimeStamp"), c("tmp").alias("TMP "),
              c("temp_c").alias("01-TIT-01"), c("perm_tc").alias("Permeability TC"), c("chemical_timer").alias("Chemical timer")]
    for part, columns, rest in (("a", first, 0), ("b", second, 1)):
        (
            log.filter(c("seq") % 2 == rest).select(*columns).write.partitionBy("unit")
            .option("header", True).option("sep", "\t").option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false").csv(f"{folder}/{part}")
        )
    return folder


@query(
    "a1_a2_a3_logger_files",
    """select unit_id, us, cast(seq as double) as row_number, round(tmp, 6) as tmp, round(perm_tc, 6) as perm_tc, round(flux, 6) as flux, program,
      round(temp_c, 6) as temp_c, case when seq % 2 = 1 then round(chemical_timer, 6) end as chemical_timer from log""",
    LOG_SQL,
)
def tsv(spark, sf):
    log = readable(read_logs(spark, logger_files(spark, sf), "*.csv", _unit()))
    return log.select("unit_id", "us", "row_number", *rounded("tmp", "perm_tc", "flux"), "program", *rounded("temp_c", "chemical_timer"))


@query(
    "a4_unreadable_stamps",
    "select unit_id, count_if(seq % 7 in (1, 3, 5)) as unreadable, count(*) as n_rows from log group by 1",
    LOG_SQL,
)
def unreadable(spark, sf):
    """Stamps cut to the year, with a word behind, and of no calendar day, among good ones."""
    c, good = F.col, F.date_format("ts", "yyyy-MM-dd HH:mm:ss SSSSSS")
    bad = F.when(c("seq") % 7 == 1, F.date_format("ts", "yyyy")).when(c("seq") % 7 == 3, F.concat(good, F.lit(" late")))
    stamp = bad.when(c("seq") % 7 == 5, F.concat(F.date_format("ts", "yyyy"), F.lit("-02-30 10:00:00"))).otherwise(good)
    folder = _fresh(spark, "tsv")
    log = sensor_log(spark, sf).select(c("unit_id").alias("unit"), stamp.alias("TimeStamp"), c("tmp").alias("TMP"))
    log.write.partitionBy("unit").option("header", True).option("sep", "\t").csv(folder)
    return unreadable_counts(read_logs(spark, folder, "*.csv", _unit()))


@query(
    "a5_parquet_by_day",
    """select unit_id, count(*) as n, round(sum(tmp), 4) as total from log where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-20' group by 1""",
    LOG_SQL,
)
def by_day(spark, sf):
    path = _fresh(spark, "days")
    save_log(sensor_log(spark, sf), path, "gzip")
    days = F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-19").cast("date"))
    return load_parquet(spark, path, ["unit_id", "day", "tmp"]).filter(days).groupBy("unit_id").agg(
        F.count("*").alias("n"), F.round(F.sum("tmp"), 4).alias("total")
    )


@query("a6_column_scan", "select event_type, count(*) as n, round(sum(value), 2) as total from events group by 1", "")
def scan(spark, sf):
    return load_parquet(spark, f"{sf}/events.parquet", ["event_type", "value"]).groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query("a7_file_info", "select count(*) as n_rows, 6 as n_columns from events", "")
def info(spark, sf):
    return file_info(spark, f"{sf}/events.parquet").select("n_rows", "n_columns")


X = "((us - 1704067200000000) / 1e6)"


@query(
    "a8_a9_json_round_trip",
    f"select unit_id, count(*) as n_rows, round(regr_slope(tmp, {X}) * 86400, 8) as slope_per_day from log group by 1",
    LOG_SQL,
)
def json_tables(spark, sf):
    slopes = tmp_slopes(sensor_log(spark, sf))
    path = _fresh(spark, "slopes")
    save_json(slopes, path)
    return load_json(spark, path, slopes.schema).select("unit_id", "n_rows", *rounded("slope_per_day", digits=8))


@query("a10_csv_export", "select unit_id, seq, round(tmp, 6) as tmp, round(perm_tc, 6) as perm_tc from log", LOG_SQL)
def csv_export(spark, sf):
    log = sensor_log(spark, sf).select("unit_id", "seq", "tmp", "perm_tc")
    path = _fresh(spark, "csv")
    save_csv(log, path)
    back = spark.read.schema(log.schema).option("header", True).csv(path)
    return back.select("unit_id", "seq", *rounded("tmp", "perm_tc"))


@query("a11_cycle_summary", "select unit_id, cycle_id, n_rows, start_us, end_us from cycles", CYCLE_TABLE)
def summary_table(spark, sf):
    return cycle_table(spark, sf).select("unit_id", "cycle_id", "n_rows", "start_us", "end_us")


@query(
    "m1_union_by_name",
    "select unit_id, count(*) as n, count(flux) as n_flux, round(sum(tmp), 4) as total from (select unit_id, tmp, flux from log union all select unit_id, tmp, null from log) group by 1",
    LOG_SQL,
)
def union(spark, sf):
    log = sensor_log(spark, sf)
    both = log.select("unit_id", "tmp", "flux").unionByName(log.select("tmp", "unit_id"), allowMissingColumns=True)
    return both.groupBy("unit_id").agg(
        F.count("*").alias("n"), F.count("flux").alias("n_flux"), F.round(F.sum("tmp"), 4).alias("total")
    )


@query(
    "l1_time_order",
    "select unit_id, seq, us, row_number() over (partition by unit_id order by us, seq) - 1 as rn from log",
    LOG_SQL,
)
def time_order(spark, sf):
    return row_index(sensor_log(spark, sf).select("unit_id", "us", "seq")).select("unit_id", "seq", "us", "rn")


def ingested(spark, sf):
    """The log taken in by the stream in two batches; returns the store's folder."""

    def build():
        store = _fresh(spark, "store")
        ingest_new_files(spark, logger_files(spark, sf), store, "*.csv", _unit(), max_files=6)
        return store

    return once(spark, sf, "ingested", build)


# What the bands let through of the files of :func:`logger_files`.
_GOOD = """tmp between 0 and 8 and perm_tc is not null and perm_tc between 0 and 20 and flux between 0 and 30
  and temp_c between -10 and 30"""


@query(
    "n1_incremental_slopes",
    f"""select unit_id, count(*) as n, round(regr_slope(tmp, {X}) * 86400, 8) as slope_per_day, round(regr_r2(tmp, {X}), 8) as r_squared
    from log where {_GOOD} group by 1""",
    LOG_SQL,
)
def incremental_slopes(spark, sf):
    return current_slopes(spark, ingested(spark, sf)).withColumn("slope_per_day", F.col("slope") * 86400).select(
        "unit_id", "n", *rounded("slope_per_day", "r_squared", digits=8)
    )


@query(
    "n1_incremental_daily_low",
    f"""select unit_id, cast(floor(us / 86400000000) as bigint) * 86400000000 as us, count(*) as n,
      round(case when count(*) >= 10 then quantile_cont(perm_tc, 0.1) else min(perm_tc) end, 6) as daily_value
    from log where {_GOOD} group by 1, 2""",
    LOG_SQL,
)
def incremental_low(spark, sf):
    return spark.read.parquet(f"{ingested(spark, sf)}/{DAILY_LOW}").select("unit_id", "us", "n", *rounded("daily_value"))


@query("n1_incremental_cycles", "select unit_id, period, start_us, end_us, n_rows from periods", PERIODS)
def incremental_cycles(spark, sf):
    """Filtration periods kept up to date by ingest, from runs per unit and day."""
    return current_periods(spark, ingested(spark, sf)).select("unit_id", "period", "start_us", "end_us", "n_rows")


@query(
    "n1_a12_incremental_ingest",
    """select unit_id, strftime(date_trunc('day', make_timestamp(us)), '%Y-%m-%d') as day, count(*) as n,
      round(sum(m), 4) as mean_total, round(sum(s), 4) as std_total from (
        select unit_id, us, avg(tmp) over w as m, stddev_samp(tmp) over w as s from log
        window w as (partition by unit_id order by us range between 86399999999 preceding and current row))
    group by 1, 2""",
    LOG_SQL,
)
def incremental(spark, sf):
    statistics = spark.read.parquet(f"{ingested(spark, sf)}/{STATISTICS}")
    return statistics.groupBy("unit_id", F.date_format("day", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("n"),
        F.round(F.sum("tmp_mean_24h"), 4).alias("mean_total"),
        F.round(F.sum("tmp_std_24h"), 4).alias("std_total"),
    )
