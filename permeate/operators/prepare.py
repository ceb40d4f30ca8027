"""Gap filling, smoothing and thinning of the ordered log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.functions.timing import MINUTE
from permeate.operators.ordering import UNIT, frames, own_rows, row_index, running, series_length
from permeate.storage import attach


def forward_fill(
    ordered: DataFrame, columns: Sequence[str], limit: int = 10, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Repeat the last reading over at most ``limit`` missing rows."""
    near, w = frames(ordered, limit, keys=keys, **blocks)
    recent = w.rowsBetween(-limit, 0)
    return own_rows(
        near.withColumns({c: F.last(c, ignorenulls=True).over(recent) for c in columns})
    )


def interpolate(
    ordered: DataFrame, columns: Sequence[str], limit: int = 10, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Straight line by row position over the first ``limit`` rows of a missing run.

    A run at the end repeats the last reading; a run at the start stays missing.
    """
    known = {
        f"_known_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("rn").alias("at")))
        for c in columns
    }
    ahead = running(
        ordered.withColumns(known),
        {f"_next_{c}": ("last", f"_known_{c}") for c in columns},
        keys=keys,
        reverse=True,
        **blocks,
    )
    near, w = frames(ahead, limit, keys=keys, **blocks)
    recent = w.rowsBetween(-limit, 0)
    both = own_rows(
        near.withColumns(
            {f"_prev_{c}": F.last(f"_known_{c}", ignorenulls=True).over(recent) for c in columns}
        )
    )

    def filled(c: str):
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        line = prev["v"] + (nxt["v"] - prev["v"]) * (F.col("rn") - prev["at"]) / (nxt["at"] - prev["at"])
        return F.coalesce(F.col(c), F.when(prev.isNotNull(), F.coalesce(line, prev["v"])))

    return both.withColumns({c: filled(c) for c in columns}).drop(
        *[f"_{part}_{c}" for c in columns for part in ("known", "prev", "next")]
    )


def gap_flags(
    ordered: DataFrame, max_minutes: float = 5, keys: Sequence[str] = UNIT, **blocks
) -> DataFrame:
    """Per unit: is there any stretch longer than ``max_minutes`` without a row?"""
    near, w = frames(ordered.select(*keys, "us", "rn"), 1, keys=keys, **blocks)
    steps = own_rows(near.withColumn("_step", F.col("us") - F.lag("us").over(w)))
    return steps.groupBy(*keys).agg(
        F.coalesce(F.max("_step") > int(max_minutes * MINUTE), F.lit(False)).alias("has_gap")
    )


def fill_gaps(
    ordered: DataFrame,
    columns: Sequence[str],
    method: str = "forward_fill",
    max_minutes: float = 5,
    limit: int = 10,
    gated: bool = True,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Fill missing readings.  ``gated``: only in units whose stamps show a gap at all."""
    if method == "drop":
        filled = row_index(ordered.dropna("any", subset=list(columns)).drop("rn"), keys, name="dropped")
    elif method == "forward_fill":
        filled = forward_fill(ordered, columns, limit, keys, **blocks)
    elif method == "interpolate":
        filled = interpolate(ordered, columns, limit, keys, **blocks)
    else:
        raise ValueError(f"unknown gap filling method: {method}")
    if not gated:
        return filled
    flags = gap_flags(ordered, max_minutes, keys, **blocks)
    untouched = attach(ordered, flags.filter(~F.col("has_gap")), keys, "left_semi")
    return attach(filled, flags.filter("has_gap"), keys, "left_semi").unionByName(untouched)


def stride_sample(ordered: DataFrame, max_points: int = 10_000, keys: Sequence[str] = UNIT) -> DataFrame:
    """Every k-th row and the last one, k = rows per wanted point; short series stay whole.

    The kept rows are renumbered, so the sample is again an ordered log.
    """
    keys = list(keys)
    sized = attach(ordered, series_length(ordered, keys, "_n"), keys)
    step = F.when(F.col("_n") <= max_points, F.lit(1)).otherwise(
        F.floor(F.col("_n") / F.lit(max_points))
    )
    last = F.col("rn") == F.col("_n") - 1
    return (
        sized.withColumn("_step", step)
        .filter((F.col("rn") % F.col("_step") == 0) | last)
        .withColumn("rn", F.ceil(F.col("rn") / F.col("_step")))
        .drop("_n", "_step")
    )
