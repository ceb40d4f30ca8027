"""Checks on the raw log: required columns, plausible bands, missing values, gaps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.functions.timing import MINUTE, SECOND, span, to_stamp
from permeate.operators.ordering import UNIT, frames, own_rows
from permeate.operators.quantiles import group_quantiles
from permeate.storage import attach

Bands = dict[str, tuple[float, float]]


def missing_table(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column, in order, and whether the log lacks it."""
    rows = [(i, c, c not in df.columns) for i, c in enumerate(required)]
    return df.sparkSession.createDataFrame(rows, "place int, column string, missing boolean")


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def keep_columns(df: DataFrame, bands: Bands, also: Sequence[str] = (*UNIT, "ts", "us", "seq")) -> DataFrame:
    """Keys, time and the banded columns only."""
    return df.select(*[c for c in df.columns if c in also or c in bands])


def sensors_of_units(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = UNIT) -> DataFrame:
    """Per unit those of ``columns`` that it has any reading of (``sensors``)."""
    held = [F.when(F.count(c) > 0, F.lit(c)) for c in columns]
    return df.groupBy(*keys).agg(F.array_compact(F.array(*held)).alias("sensors"))


def in_band(bands: Bands, sensors: Column | None = None) -> Column:
    """All banded readings present and plausible; never NULL.

    ``sensors``: the columns that the unit has; others are not asked for.
    """

    def fits(c: str, low: float, high: float) -> Column:
        plausible = F.coalesce(F.col(c).between(low, high), F.lit(False))
        return plausible if sensors is None else plausible | ~F.array_contains(sensors, c)

    return reduce(lambda a, b: a & b, [fits(c, *band) for c, band in bands.items()])


def band_filter(df: DataFrame, bands: Bands, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows whose banded readings are all plausible (plain comparisons, so they are pushed down).

    ``keys``: a unit without any reading of a sensor keeps its rows all the same.
    """
    if keys:
        held = attach(df, sensors_of_units(df, list(bands), keys).withColumnRenamed("sensors", "_sensors"), keys)
        return held.filter(in_band(bands, F.col("_sensors"))).drop("_sensors")
    return df.filter(
        reduce(lambda a, b: a & b, [F.col(c).between(lo, hi) for c, (lo, hi) in bands.items()])
    )


def first_failed_band(bands: Bands) -> Column:
    """Name of the first band a row fails, in band order; NULL for a good row."""
    return F.coalesce(
        *[
            F.when(~F.coalesce(F.col(c).between(lo, hi), F.lit(False)), F.lit(c))
            for c, (lo, hi) in bands.items()
        ]
    )


def outlier_counts(df: DataFrame, bands: Bands, keys: Sequence[str] = UNIT) -> DataFrame:
    """Rows removed by each band when the bands are applied one after another, in one pass."""
    return (
        df.select(*keys, first_failed_band(bands).alias("parameter"))
        .filter(F.col("parameter").isNotNull())
        .groupBy(*keys, "parameter")
        .agg(F.count("*").alias("removed"))
    )


def retention(df: DataFrame, bands: Bands, keys: Sequence[str] = UNIT) -> DataFrame:
    kept = F.count_if(in_band(bands))
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows_in"),
        kept.alias("rows_out"),
        (F.count("*") - kept).alias("rows_removed"),
        (kept * 100.0 / F.count("*")).alias("retention_percent"),
    )


def missing_share(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = UNIT) -> DataFrame:
    """Percent missing per column: one wide aggregate, then turned to rows."""
    wide = df.groupBy(*keys).agg(
        *[(F.avg(F.col(c).isNull().cast("double")) * 100.0).alias(c) for c in columns]
    )
    return wide.unpivot(list(keys), list(columns), "column", "missing_percent")


def stamp_gaps(
    ordered: DataFrame, max_minutes: float = 5, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Stretches longer than ``max_minutes`` without a row."""
    near, w = frames(ordered.select(*keys, "us", "rn"), 1, keys=keys, **blocks)
    gaps = own_rows(near.withColumn("_from", F.lag("us").over(w))).filter(
        F.col("us") - F.col("_from") > int(max_minutes * MINUTE)
    )
    return gaps.select(
        *keys,
        to_stamp(F.col("_from")).alias("gap_start"),
        to_stamp(F.col("us")).alias("gap_end"),
        span(F.col("_from"), F.col("us"), "minutes").alias("minutes"),
    )


def first_gaps(gaps: DataFrame, n: int = 5) -> DataFrame:
    return gaps.orderBy("gap_start", *[c for c in gaps.columns if c == "unit_id"]).limit(n)


def sample_intervals(ordered: DataFrame, keys: Sequence[str] = UNIT, **blocks) -> DataFrame:
    """Seconds since the previous row; NULL on the first row of a unit."""
    near, w = frames(ordered.select(*keys, "us", "seq", "rn"), 1, keys=keys, **blocks)
    return own_rows(
        near.withColumn("interval_s", (F.col("us") - F.lag("us").over(w)) / F.lit(float(SECOND)))
    )


def time_range(ordered: DataFrame, keys: Sequence[str] = UNIT, **blocks) -> DataFrame:
    """Start, end, duration, number of rows and the median sampling interval of each unit."""
    median = group_quantiles(
        sample_intervals(ordered, keys, **blocks), "interval_s", {"median_interval_s": 0.5}, keys
    ).drop("n")
    ends = ordered.groupBy(*keys).agg(
        F.min("us").alias("_from"), F.max("us").alias("_to"), F.count("*").alias("n_rows")
    )
    return ends.join(median, list(keys), "left").select(
        *keys,
        to_stamp(F.col("_from")).alias("start_time"),
        to_stamp(F.col("_to")).alias("end_time"),
        span(F.col("_from"), F.col("_to"), "hours").alias("duration_hours"),
        span(F.col("_from"), F.col("_to"), "days").alias("duration_days"),
        "n_rows",
        "median_interval_s",
    )


def column_summary(df: DataFrame, columns: Sequence[str], tie: Sequence[str] = ("seq",)) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles, one row per column."""
    ids = [c for c in tie if c in df.columns]
    long = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ids, list(columns), "column", "value"
    ).filter(F.col("value").isNotNull())
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = group_quantiles(
        long, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column"], tie
    ).drop("n")
    return moments.join(quartiles, "column")


def validation_report(
    ordered: DataFrame,
    bands: Bands,
    columns: Sequence[str],
    max_minutes: float = 5,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """One row per unit: rows in and out, removals per band, missing shares, gaps, warnings.

    The maps hold one entry per column.  Gaps are counted here; :func:`stamp_gaps` lists them,
    since there is no bound on their number.
    """
    keys = list(keys)
    failed = first_failed_band(bands)
    counts = ordered.select(*keys, "us", *columns, failed.alias("_failed")).groupBy(*keys).agg(
        F.count("*").alias("rows_in"),
        F.count_if(F.col("_failed").isNull()).alias("rows_out"),
        F.count("_failed").alias("rows_removed"),
        F.create_map(
            *[x for c in bands for x in (F.lit(c), F.count_if(F.col("_failed") == c))]
        ).alias("outliers"),
        F.create_map(
            *[
                x
                for c in columns
                for x in (F.lit(c), F.avg(F.col(c).isNull().cast("double")) * 100.0)
            ]
        ).alias("missing_percent"),
        F.min(F.when(F.col("_failed").isNull(), F.col("us"))).alias("_from"),
        F.max(F.when(F.col("_failed").isNull(), F.col("us"))).alias("_to"),
    )
    gaps = stamp_gaps(ordered, max_minutes, keys, **blocks).groupBy(*keys).agg(
        F.count("*").alias("n_gaps")
    )
    sparse = F.map_keys(F.map_filter("missing_percent", lambda _, pct: pct > 5.0))
    return (
        counts.join(gaps, keys, "left")
        .withColumn("n_gaps", F.coalesce("n_gaps", F.lit(0)))
        .withColumn(
            "warnings",
            F.array_compact(
                F.array(
                    F.when(F.col("n_gaps") > 0, F.format_string("Detected %d timestamp gaps", "n_gaps")),
                    F.when(
                        F.size(sparse) > 0,
                        F.format_string(
                            "Columns with >5%% missing: %s", F.array_join(F.array_sort(sparse), ", ")
                        ),
                    ),
                )
            ),
        )
        .withColumn("time_range_start", to_stamp(F.col("_from")))
        .withColumn("time_range_end", to_stamp(F.col("_to")))
        .drop("_from", "_to")
    )
