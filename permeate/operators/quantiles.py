"""Exact quantiles of groups of any size.

Spark's ``percentile`` keeps all distinct values of a group in one buffer.  Here the values are
ordered once across the cluster and only the two ranks next to each quantile are picked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.operators.ordering import UNIT, row_index, series_length
from permeate.storage import attach


def group_quantiles(
    df: DataFrame,
    value: str,
    shares: dict[str, float],
    keys: Sequence[str] = UNIT,
    tie: Sequence[str] = ("seq",),
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group; ``shares`` maps name to share.

    ``tie`` columns only spread equal values over several tasks; they cannot change a result.
    """
    keys = list(keys)
    place = [value, *[c for c in tie if c in df.columns and c not in keys and c != value]]
    ranked = row_index(
        df.filter(F.col(value).isNotNull()).select(*keys, *place),
        keys,
        place,
        index="_rank",
        name="quantiles",
    )
    wanted = (
        series_length(ranked, keys, "_n")
        .select(
            *keys,
            "_n",
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(name).alias("name"), (F.lit(p) * (F.col("_n") - 1)).alias("at"))
                        for name, p in shares.items()
                    ]
                )
            ).alias("_q"),
        )
        .select(*keys, "_n", "_q.name", "_q.at")
        .withColumn(
            "_rank",
            F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))),
        )
    )
    picked = wanted.join(ranked, [*keys, "_rank"])
    low, high = F.min(value), F.max(value)
    steps = picked.groupBy(*keys, "name").agg(
        F.max("_n").alias("n"),
        (low + (high - low) * F.max(F.col("at") - F.floor("at"))).alias("_v"),
    )
    return steps.groupBy(*keys).agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in shares],
    )


def fence(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = UNIT,
    tie: Sequence[str] = ("seq",),
    reach: float = 1.5,
    at_least: int = 1,
) -> DataFrame:
    """Mark rows inside the interquartile fence (``inside``); small groups are kept whole."""
    keys = list(keys)
    quartiles = group_quantiles(df, value, {"_q1": 0.25, "_q3": 0.75}, keys, tie)
    limits = quartiles.select(
        *keys,
        F.col("n").alias("_fence_n"),
        (F.col("_q1") - reach * (F.col("_q3") - F.col("_q1"))).alias("fence_low"),
        (F.col("_q3") + reach * (F.col("_q3") - F.col("_q1"))).alias("fence_high"),
    )
    return (
        attach(df.filter(F.col(value).isNotNull()), limits, keys)
        .withColumn(
            "inside",
            (F.col("_fence_n") < at_least)
            | F.col(value).between(F.col("fence_low"), F.col("fence_high")),
        )
        .drop("_fence_n")
    )
