"""Tab-separated logger files: every file has its own header, columns may differ or be reordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permeate.functions.missing import finite
from permeate.functions.timing import micros, parse_stamp
from permeate.schema import COLUMN_NAMES, column_name
from permeate.storage import attach, stage

_HEADER = r"(^|\t)\s*\"?TimeStamp\"?\s*(\t|$)"


def text_lines(spark: SparkSession, folder: str, pattern: str = "*.tsv") -> DataFrame:
    """Lines of all matching files with the file they come from."""
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def _cells(line: Column) -> Column:
    return F.transform(F.split(line, "\t"), lambda cell: F.btrim(cell, F.lit(' "\r')))


def file_headers(lines: DataFrame) -> DataFrame:
    """One row per file: its header cells, trimmed."""
    return (
        lines.filter(F.col("line").rlike(_HEADER))
        .groupBy("file")
        .agg(F.min("line").alias("_header"))
        .select("file", _cells(F.col("_header")).alias("names"))
    )


class NoLogFile(FileNotFoundError):
    """None of the files has a header."""


def columns_of(found: Sequence[str]) -> dict[str, str]:
    """Column name -> name in the files, for all their names; names that would fall together are
    told apart by a number."""
    columns: dict[str, str] = {}
    for raw in sorted(found, key=lambda name: (name not in COLUMN_NAMES, name)):
        base = column_name(raw) or "column"
        name, n = base, 1
        while name in columns:
            n += 1
            name = f"{base}_{n}"
        columns[name] = raw
    return columns


def files_without_header(lines: DataFrame) -> DataFrame:
    """Files that have no header, with their number of lines; none of their rows can be read."""
    counted = lines.groupBy("file").agg(
        F.count_if(F.col("line").rlike(_HEADER)).alias("_headers"), F.count("*").alias("n_lines")
    )
    return counted.filter("_headers = 0").drop("_headers")


def parse_lines(lines: DataFrame, unit_id: Column | None = None) -> DataFrame:
    """Log rows from text lines: columns are taken by name from each file's own header.

    A column a file lacks is NULL.  Only the set of column names reaches the driver.  The unit is
    the file's folder unless given.  ``seq`` is a hash of the line, so equal lines are the only ties.
    """
    headers = stage(file_headers(lines), "headers")
    found = [row.name for row in headers.select(F.explode("names").alias("name")).distinct().collect() if row.name]
    if not found:
        raise NoLogFile("no logger file with a TimeStamp column found")
    columns = columns_of(found)
    places = headers.select(
        "file",
        *[F.nullif(F.array_position("names", raw), F.lit(0)).cast("int").alias(f"_at_{c}") for c, raw in columns.items()],
    )
    text = lines.filter((F.length(F.trim("line")) > 0) & ~F.col("line").rlike(_HEADER))
    rows = attach(text, places, ["file"]).withColumn("_cells", _cells(F.col("line")))

    def cell(c: str) -> Column:
        return F.nullif(F.try_element_at("_cells", F.col(f"_at_{c}")), F.lit(""))

    def reading(c: str) -> Column:
        number = cell(c).try_cast("double")
        number = finite(number)
        return number.try_cast("int") if c == "program" else number

    unit = unit_id if unit_id is not None else F.regexp_extract("file", r"([^/]+)/[^/]+$", 1)
    out = rows.select(
        unit.alias("unit_id"),
        parse_stamp(cell("ts")).alias("ts"),
        cell("ts").alias("ts_raw"),
        F.xxhash64("file", "line").alias("seq"),
        *[reading(c).alias(c) for c in columns if c != "ts"],
    )
    return out.withColumn("us", micros("ts"))


def read_logs(
    spark: SparkSession, folder: str, pattern: str = "*.tsv", unit_id: Column | None = None
) -> DataFrame:
    """All logger files below ``folder`` as one log."""
    return parse_lines(text_lines(spark, folder, pattern), unit_id)


def readable(log: DataFrame) -> DataFrame:
    """Rows whose stamp could be read."""
    return log.filter(F.col("ts").isNotNull()).drop("ts_raw")


def unreadable_counts(log: DataFrame) -> DataFrame:
    """Rows per unit whose stamp could not be read."""
    return log.groupBy("unit_id").agg(F.count_if(F.col("ts").isNull()).alias("unreadable"), F.count("*").alias("n_rows"))
