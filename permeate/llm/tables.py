"""Small helpers that all operators of this subpackage share: columns, stored tables, numbering."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permeate.storage import shared_folder

#: A side of a join is broadcast only if its counted rows are at most so many (ids and numbers only).
BROADCAST_ROWS = 500_000
#: A task is worth so many narrow rows.
ROWS_A_TASK = 200_000
_INDEX_BITS = 33  # monotonically_increasing_id() holds the row's place in its partition below these


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, also where another column's name differs by case alone."""
    columns = df.columns
    places = []
    for name in names:
        exact = [i for i, c in enumerate(columns) if c == name]
        places.append((exact or [i for i, c in enumerate(columns) if c.lower() == name.lower()])[0])
    plain = df.toDF(*[f"_{i}" for i in range(len(columns))])
    return plain.select([F.col(f"_{i}").alias(name) for i, name in zip(places, names, strict=True)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder: later stages never repeat what led to it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/permeate/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in as many partitions as ``rows``, its number of rows or a bound of it, are worth."""
    worth = max(4, rows // ROWS_A_TASK)
    return df.coalesce(worth) if worth < parts(df.sparkSession) else df


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups_for(total: int, each: int, least: int = 1) -> int:
    """So many groups that each holds about ``each`` of ``total``."""
    return max(least, math.ceil(total / each))


def numbered(df: DataFrame, keys: list[Column], name: str, position: str) -> DataFrame:
    """``df`` with the place (from 0) of each row in the order of ``keys``, without a global window.

    Rows are dealt by ranges of the keys and written; a row's place is its place in its range
    plus the rows of all earlier ranges (one count per range reaches the driver).
    """
    ranged = (
        df.repartitionByRange(parts(df.sparkSession), *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    held = stored(ranged, name)
    rows_in = held.groupBy(F.shiftright("_at", _INDEX_BITS).alias("part")).count().collect()
    before, offsets = 0, []
    for part, count in sorted(rows_in):
        offsets.append((part, before))
        before += count
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    within = F.col("_at").bitwiseAND((1 << _INDEX_BITS) - 1)
    return (
        held.withColumn("_part", F.shiftright("_at", _INDEX_BITS))
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(position, F.col("_before") + within)
        .drop("_part", "_before", "_at")
    )
