"""Continuous ingest: new logger files are appended to the store and results brought up to date."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from permeate.functions.regression import fit_from_moments, moments
from permeate.functions.timing import day_of
from permeate.operators.fouling import daily_low
from permeate.operators.ordering import UNIT
from permeate.operators.quality import band_filter
from permeate.operators.rolling import time_statistics
from permeate.schema import FILTRATION, bands_for
from permeate.sources.logs import NoLogFile, files_without_header, parse_lines, readable
from permeate.sources.tables import save_log
from permeate.storage import attach, stage

STATISTICS, MOMENTS, DAILY_LOW = "window_statistics", "daily_moments", "daily_low"
#: Runs of the filtration program per unit and day, and the first row and size of every day.
CYCLE_RUNS, CYCLE_DAYS = "cycle_runs", "cycle_days"
#: Files that could not be read, per batch, with their number of lines.
SET_ASIDE = "files_without_header"
#: Batches whose rows the result tables hold.
REFRESHED = "refreshed"


def _stored(spark: SparkSession, store: str) -> DataFrame:
    known: dict[str, StructField] = {}
    for row in spark.read.parquet(f"{store}/schema").orderBy("batch").collect():  # one row per batch
        for f in StructType.fromJson(json.loads(row.schema)):
            known.setdefault(f.name, f)
    fields = [*known.values(), StructField("batch", LongType())]
    return spark.read.schema(StructType(fields)).parquet(f"{store}/raw")


def stored_log(spark: SparkSession, store: str) -> DataFrame:
    """All rows ingested so far, partitioned by ``unit_id`` and ``day``."""
    return _stored(spark, store).drop("batch")


def _remember(spark: SparkSession, store: str, batch_id: int, schema: StructType) -> None:
    """Keep the batch's columns, so that no reader has to open all files to learn them."""
    one = spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1)
    one.write.mode("overwrite").parquet(f"{store}/schema/batch={batch_id}")


def _batch_ids(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the batches noted below ``path``."""
    try:
        return {row.batch for row in spark.read.parquet(path).select("batch").distinct().collect()}
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


class _Refreshes:
    """Which batches the result tables still lack.

    A batch may touch every day, so bringing the results up to date costs as much as all rows so
    far.  In a backlog that is done when as many batches wait as are in the results already (after
    1, 2, 4, 8, ... batches) and at the end, so its cost in all stays in proportion to the rows.
    What waits is known from the store, so a run that was ended leaves nothing out.
    """

    def __init__(self, spark: SparkSession, store: str, on_batch: Callable[[SparkSession, str, DataFrame], None]):
        self.store, self.on_batch = store, on_batch
        done = _batch_ids(spark, f"{store}/{REFRESHED}")
        self.waiting, self.done = sorted(_batch_ids(spark, f"{store}/schema") - done), len(done)

    def add(self, spark: SparkSession, batch_id: int, at_once: bool) -> None:
        if batch_id not in self.waiting:
            self.waiting.append(batch_id)
        if at_once or len(self.waiting) >= self.done:
            self.bring_up(spark)

    def bring_up(self, spark: SparkSession) -> None:
        if not self.waiting:
            return
        self.on_batch(spark, self.store, _stored(spark, self.store).filter(F.col("batch").isin(self.waiting)).drop("batch"))
        for batch_id in self.waiting:
            one = spark.createDataFrame([(batch_id,)], "id long").coalesce(1)
            one.write.mode("overwrite").parquet(f"{self.store}/{REFRESHED}/batch={batch_id}")
        self.done, self.waiting = self.done + len(self.waiting), []


def _on_days(log: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of the given (unit_id, day) pairs.

    The days are put into the plan as literals, so only their folders are read; their number is
    bounded by the calendar.
    """
    days = [row.day for row in pairs.select("day").distinct().collect()]
    return attach(log.filter(F.col("day").isin(days)), pairs, ["unit_id", "day"], "left_semi")


def _days_around(pairs: DataFrame, first: int, last: int) -> DataFrame:
    """The (unit_id, day) pairs widened to the days ``first`` … ``last`` around each."""
    shifted = F.transform(F.sequence(F.lit(first), F.lit(last)), lambda i: F.date_add("day", i))
    return pairs.select("unit_id", F.explode(shifted).alias("day")).distinct()


def _replace_days(df: DataFrame, path: str) -> None:
    """Overwrite only the (unit_id, day) partitions present in ``df``."""
    place = ["unit_id", "day", *[c for c in ("us", "seq") if c in df.columns]]
    (
        df.repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("unit_id", "day")
        .parquet(path)
    )


def refresh_statistics(log: DataFrame, touched: DataFrame, path: str, column: str = "tmp") -> None:
    """Recompute 24 h statistics of the days a batch can change: its own and the next one.

    A day's windows reach into the day before, so that day is read but not rewritten.
    """
    changed = _days_around(touched, 0, 1)
    needed = _on_days(log.select("unit_id", "day", "us", "seq", column), _days_around(changed, -1, 0))
    fresh = time_statistics(needed, [column], ("24h",)).join(changed, ["unit_id", "day"], "left_semi")
    _replace_days(fresh, path)


def refresh_cycles(log: DataFrame, touched: DataFrame, store: str, program: int = FILTRATION) -> None:
    """Rewrite the runs of ``program`` and the day figures of the days a batch touched.

    A run is a longest stretch of a day's rows in the program: its first stamp, its first row's
    place in the day, its rows, and the stamp of the row that ends it that day (NULL when the
    run reaches the day's end).  A day's figures are its rows and its first and last row.  Both
    depend on the day's rows alone, so a late file only rewrites the days it falls on.  One task
    holds one unit's rows of one day.
    """
    if "program" not in log.columns:
        return
    days = _on_days(log.select("unit_id", "day", "us", "seq", "program"), touched)
    w = Window.partitionBy("unit_id", "day").orderBy("us", "seq")
    inside = F.col("program").eqNullSafe(program)
    marked = days.withColumn("_in", inside).withColumns(
        {"_k": F.row_number().over(w) - 1, "_prev": F.lag(inside).over(w), "_next_us": F.lead("us").over(w)}
    )
    opens = F.when(F.col("_in") & ~F.coalesce(F.col("_prev"), F.lit(False)), 1).otherwise(0)
    place = F.struct("us", "seq")
    runs = (
        marked.withColumn("_run", F.sum(opens).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .where("_in")
        .groupBy("unit_id", "day", "_run")
        .agg(
            F.min("us").alias("start_us"),
            F.min("_k").alias("start_k"),
            F.count("*").alias("n_rows"),
            F.max_by("_next_us", place).alias("closed_us"),
        )
        .drop("_run")
    )
    figures = marked.groupBy("unit_id", "day").agg(
        F.count("*").alias("rows"),
        F.min("us").alias("first_us"),
        F.min_by("_in", place).alias("first_in"),
        F.max("us").alias("last_us"),
    )
    _replace_days(runs, f"{store}/{CYCLE_RUNS}")
    _replace_days(figures, f"{store}/{CYCLE_DAYS}")


def current_periods(spark: SparkSession, store: str) -> DataFrame:
    """Filtration periods of everything ingested so far, from the stored runs and day figures.

    A run that reaches the end of its day goes on in the unit's next day when that day opens in
    the program; otherwise the next day's first row ends it, or, on the last day, its own last
    row.  Runs joined this way are one period: unit_id, period (the place of its first row in the
    unit's log), start_us, end_us, n_rows, as the batch ``filtration_periods`` gives them.  The
    windows below see one row per day and per run of a unit, never its log rows.
    """
    runs = spark.read.parquet(f"{store}/{CYCLE_RUNS}")
    by_day = Window.partitionBy("unit_id").orderBy("day")
    days = spark.read.parquet(f"{store}/{CYCLE_DAYS}").withColumns(
        {
            "_offset": F.coalesce(F.sum("rows").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_next_first_us": F.lead("first_us").over(by_day),
            "_next_first_in": F.lead("first_in").over(by_day),
        }
    )
    joined = runs.join(days, ["unit_id", "day"]).withColumns(
        {
            "_rn": F.col("_offset") + F.col("start_k"),
            "_goes_on": F.col("closed_us").isNull() & F.coalesce(F.col("_next_first_in"), F.lit(False)),
            "_end": F.coalesce(F.col("closed_us"), F.col("_next_first_us"), F.col("last_us")),
        }
    )
    by_run = Window.partitionBy("unit_id").orderBy("day", "start_k")
    opens = F.when(F.coalesce(F.lag("_goes_on").over(by_run), F.lit(False)), 0).otherwise(1)
    chained = joined.withColumn("_opens", opens).withColumn(
        "_period", F.sum("_opens").over(by_run.rowsBetween(Window.unboundedPreceding, 0))
    )
    return chained.groupBy("unit_id", "_period").agg(
        F.min("_rn").alias("period"),
        F.min("start_us").alias("start_us"),
        F.max_by("_end", F.struct("day", "start_k")).alias("end_us"),
        F.sum("n_rows").alias("n_rows"),
    ).drop("_period")


def refresh(spark: SparkSession, store: str, batch: DataFrame) -> None:
    """Bring the store's result tables up to date after ``batch`` was added.

    Everything is kept per unit and day, and only the folders of the days that a batch touches are
    read; slopes over all time are put together from the daily sums.
    """
    touched = batch.select("unit_id", "day").distinct()
    log = stored_log(spark, store)
    refresh_statistics(log, touched, f"{store}/{STATISTICS}")
    refresh_cycles(log, touched, store)
    days = _on_days(log, touched)
    good = band_filter(days, bands_for(log.columns), UNIT)
    _replace_days(moments(good, "tmp", ("unit_id", "day")), f"{store}/{MOMENTS}")
    _replace_days(
        daily_low(good).withColumn("day", F.date_from_unix_date(day_of(F.col("us")).cast("int"))),
        f"{store}/{DAILY_LOW}",
    )


def current_slopes(spark: SparkSession, store: str) -> DataFrame:
    """TMP slope of each unit over everything ingested so far."""
    return fit_from_moments(spark.read.parquet(f"{store}/{MOMENTS}"))


def ingest_new_files(
    spark: SparkSession,
    inbox: str,
    store: str,
    pattern: str = "*.tsv",
    unit_id: Column | None = None,
    max_files: int = 1_000,
    on_batch: Callable[[SparkSession, str, DataFrame], None] = refresh,
    watch: bool = False,
):
    """Take in every file of ``inbox`` not seen before and refresh the results.

    ``watch=False`` stops when the inbox is empty; ``watch=True`` returns the running query.  No
    file is skipped while a batch is busy: it is part of the next one.  A repeated batch rewrites
    its own folder, so a restart adds no row twice.  Files without a header are listed and skipped.
    ``on_batch`` gets the rows of one batch, or, in a backlog, of several (:class:`_Refreshes`).
    """
    refreshes = _Refreshes(spark, store, on_batch)
    lines = (
        spark.readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(inbox)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    )

    def take(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        path = f"{store}/raw/batch={batch_id}"
        batch = stage(batch, "batch")  # the text is read once, whatever is done with it
        set_aside = files_without_header(batch).coalesce(1)
        set_aside.write.mode("overwrite").parquet(f"{store}/{SET_ASIDE}/batch={batch_id}")
        try:
            log = parse_lines(batch, unit_id)
        except NoLogFile:
            return
        save_log(readable(log), path)
        _remember(session, store, batch_id, session.read.parquet(path).schema)
        refreshes.add(session, batch_id, at_once=watch)

    writer = lines.writeStream.foreachBatch(take).option("checkpointLocation", f"{store}/_checkpoint")
    if watch:
        return writer.trigger(processingTime="1 minute").start()
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    refreshes.bring_up(spark)
    return running
