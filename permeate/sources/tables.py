"""Parquet, JSON and CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from permeate.functions.timing import day_of


def save_parquet(
    df: DataFrame,
    path: str,
    compression: str = "snappy",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_log(df: DataFrame, path: str, compression: str = "snappy", mode: str = "overwrite") -> None:
    """Log as Parquet by unit and day, in time order inside each file.

    The shuffle is by range over unit and time, so a long unit is spread over many tasks and a
    day's files stay together.
    """
    dated = df.withColumn("day", F.date_from_unix_date(day_of(F.col("us")).cast("int")))
    place = ["unit_id", "day", "us", "seq"]
    save_parquet(
        dated.repartitionByRange(*place).sortWithinPartitions(*place),
        path,
        compression,
        ("unit_id", "day"),
        mode,
    )


def load_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def file_info(spark: SparkSession, path: str) -> DataFrame:
    """Rows, columns and megabytes of a Parquet table (one row)."""
    df = spark.read.parquet(path)
    sizes = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.max("_metadata.file_size").alias("bytes")
    )
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        (F.sum("bytes") / 1048576.0).alias("size_mb"),
    )


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def load_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def save_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", separator).csv(path)
