"""Where intermediate tables are written so that a lost executor never repeats them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, may fall back to a
    folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="permeate-")
    return _local_folder


#: A side of a join with at most so many counted rows (keys and a few numbers) is broadcast.
FEW_ROWS = 200_000


def attach(df: DataFrame, values: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``values``, one row per key, to many rows, without moving those rows where it can be.

    An aggregate is estimated at the size of its input, so for a large log Spark alone would
    deal the whole log out by key. Where its estimate is above its own limit for broadcasting,
    the values are written and counted, and broadcast if they are few.
    """
    spark = df.sparkSession
    named = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(named)
    estimate = values._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(str(estimate)) > limit:
        values = stage(values, "attached")
        if values.count() <= FEW_ROWS:
            values = F.broadcast(values)
    return df.join(values, list(keys), how)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/permeate/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
