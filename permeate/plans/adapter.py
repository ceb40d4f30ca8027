"""The given tables seen as a sensor log, and prepared tables that several queries share."""

from __future__ import annotations

import os
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from permeate.functions.timing import micros
from permeate.operators.ordering import row_index
from permeate.schema import bands_for
from permeate.storage import stage

SENSORS = (
    "value", "tmp", "perm_tc", "flux", "temp_c", "mem_retention", "recovery", "specific_power",
    "v_crossflow", "program", "chemical_timer",
)

# The same log for DuckDB; expressions match :func:`sensor_log` one by one.  Readings are square
# roots, so that means of them do not fall on exact rounding ties.
LOG_SQL = """log as (
  select event_type as unit_id, ts, epoch_us(ts) as us, event_id as seq, value,
         sqrt(value) / 2.5e0 as tmp,
         case when k % 20 = 0 then null else 6e0 + sqrt(k) / 2.5e0 end as perm_tc,
         sqrt(user_id % 850) as flux,
         5e0 + sqrt(k * 5) as temp_c,
         sqrt(user_id % 2100) as mem_retention,
         50e0 + sqrt(user_id % 2450) as recovery,
         sqrt(user_id % 3500) / 2e2 as specific_power,
         1e0 + sqrt(user_id % 40) as v_crossflow,
         case when k < 90 then 10 when k < 98 then 21 else 32 end as program,
         cast(floor(k / 90.0) as double) as chemical_timer
  from (select *, cast(json_extract(props, '$.k') as int) as k from events))"""

ORDERED_SQL = LOG_SQL + """, ordered as (
  select *, row_number() over (partition by unit_id order by us, seq) - 1 as rn,
         tmp between 0 and 8 and perm_tc is not null and perm_tc between 0 and 20
         and mem_retention between 0 and 50 and flux between 0 and 30 and temp_c between -10 and 30
         and recovery between 0 and 100 and specific_power between 0 and 0.5
         and v_crossflow between 0 and 50 as good
  from log)"""


def sensor_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log with one unit per event type."""
    k, user = F.col("k"), F.col("user_id")
    # A generator, so the JSON is read once per row and not again in every column and filter.
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", "ts", "user_id", "event_type", "value", F.json_tuple("props", "k").alias("_k")
    )
    return events.withColumn("k", F.col("_k").cast("int")).select(
        F.col("event_type").alias("unit_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        micros("ts").alias("us"),
        F.col("event_id").alias("seq"),
        "value",
        (F.sqrt("value") / 2.5).alias("tmp"),
        F.when(k % 20 != 0, 6.0 + F.sqrt(k) / 2.5).alias("perm_tc"),
        F.sqrt(user % 850).alias("flux"),
        (5.0 + F.sqrt(k * 5)).alias("temp_c"),
        F.sqrt(user % 2100).alias("mem_retention"),
        (50.0 + F.sqrt(user % 2450)).alias("recovery"),
        (F.sqrt(user % 3500) / 200.0).alias("specific_power"),
        (1.0 + F.sqrt(user % 40)).alias("v_crossflow"),
        F.when(k < 90, 10).when(k < 98, 21).otherwise(32).alias("program"),
        F.floor(k / 90.0).cast("double").alias("chemical_timer"),
    )


BANDS = bands_for(list(SENSORS))

_made: dict[tuple, Any] = {}


def _version(spark: SparkSession, path: str) -> tuple:
    """Changes whenever the files behind ``path`` do."""
    if os.path.exists(path):
        info = os.stat(path)
        return info.st_mtime_ns, info.st_size
    row = spark.read.parquet(path).agg(
        F.max("_metadata.file_modification_time").cast("string"), F.count("*")
    ).first()
    return tuple(row)


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any]) -> Any:
    """The result of ``build``, made once per session and data version."""
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, f"{sf_dir}/events.parquet"), name)
    if key not in _made:
        _made[key] = build()
    return _made[key]


def forget() -> None:
    """Forget all tables and models that were made, so that the next query makes its own."""
    _made.clear()


def prepared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written once and then read by several queries, like the stage outputs of a batch run."""
    return once(spark, sf_dir, name, lambda: stage(build(), name))


def ordered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with ``rn``, the position of each row in its unit."""
    return prepared(spark, sf_dir, "log", lambda: row_index(sensor_log(spark, sf_dir)))
