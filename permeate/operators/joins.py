"""Time joins without theta joins: both sides are merged into one ordered stream and the
latest interval (or next stamp) is carried along it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.operators.ordering import UNIT, ordered_pieces, running
from permeate.storage import attach


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str] = UNIT,
    start: str = "start_us",
    end: str = "end_us",
) -> DataFrame:
    """Points with the interval holding them, both ends included; others are dropped.

    The intervals of one series must not overlap.  Where one ends on the very stamp at which the
    next starts, the later one wins.
    """
    keys = list(keys)
    payload = [c for c in intervals.columns if c not in keys]
    events = points.select(*keys, F.col("us").alias("_at"), F.lit(1).alias("_kind"), F.col("seq").alias("_tie"),
                           F.struct(*points.columns).alias("_point"))
    opens = intervals.select(*keys, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.col(start).alias("_tie"),
                             F.struct(*payload).alias("_interval"))
    stream = ordered_pieces(
        events.unionByName(opens, allowMissingColumns=True), keys, ("_at", "_kind", "_tie"), "intervals"
    )
    carried = running(stream, {"_open": ("last", "_interval")}, keys=keys, pieces=True)
    return carried.filter((F.col("_kind") == 1) & (F.col("_at") <= F.col("_open")[end])).select(
        "_point.*", *[F.col("_open")[c].alias(c) for c in payload]
    )


def next_after(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str] = UNIT,
    out: str = "next_us",
) -> DataFrame:
    """Each left row with the first stamp of ``right`` strictly after it (NULL if none)."""
    keys = list(keys)
    rows = left.select(*keys, F.col("us").alias("_at"), F.lit(1).alias("_kind"), F.col("seq").alias("_tie"),
                       F.struct(*left.columns).alias("_row"))
    stamps = right.select(*keys, F.col("us").alias("_at"), F.lit(0).alias("_kind"), F.col("seq").alias("_tie"),
                          F.col("us").alias("_stamp"))
    stream = ordered_pieces(
        rows.unionByName(stamps, allowMissingColumns=True), keys, ("_at", "_kind", "_tie"), "next"
    )
    carried = running(
        stream, {out: ("last", "_stamp")}, keys=keys, reverse=True, inclusive=False, pieces=True
    )
    return carried.filter(F.col("_kind") == 1).select("_row.*", out)


def append_per_unit(df: DataFrame, values: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Add the per-unit values to every row of the unit.

    The rows stay where they are if the values are few (see :func:`attach`).
    """
    return attach(df, values, keys, "left")
