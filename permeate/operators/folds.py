"""Order-dependent greedy rules over event lists of any length.

A greedy rule carries one small state along a series.  The effect of a stretch of events on
that state is a small vector, and vectors of neighbouring stretches combine.  So the series is
cut into blocks: every block is summarised on its own, the summaries are chained (blocks, then
groups of blocks), and each block is replayed from its true starting state.  No task ever holds
more than one block of events or one group of summaries.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from permeate.operators.ordering import UNIT, ordered_pieces, running

GROUP = 4_096

# The rules travel with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class KeepApart:
    """Keep an event only if it lies more than ``distance`` after the last kept one.

    State: the first position that may be kept.  Summary: the state after a block for every
    state that can still matter at its start (``0 .. distance`` positions blocked).
    """

    start = -(2.0**62)

    def __init__(self, distance: int):
        self.distance = distance

    def summary(self, events: pd.DataFrame) -> list[float]:
        at = events["pos"].to_numpy(dtype=np.int64)
        base = int(events["_base"].iloc[0])
        after = np.searchsorted(at, at + self.distance, side="right")
        out = at + self.distance + 1
        for i in range(len(at) - 1, -1, -1):
            if after[i] < len(at):
                out[i] = out[after[i]]
        entry = base + np.arange(self.distance + 1)
        first = np.searchsorted(at, entry, side="left")
        left = np.where(first < len(at), out[np.minimum(first, len(at) - 1)], entry)
        return [float(base), *left.astype(float).tolist()]

    def follow(self, vector: np.ndarray, state: float) -> float:
        blocked = max(0.0, state - vector[0])
        return state if blocked > self.distance else float(vector[1 + int(blocked)])

    def combine(self, first: np.ndarray, second: np.ndarray) -> list[float]:
        return [float(first[0]), *[self.follow(second, s) for s in first[1:]]]

    def replay(self, events: pd.DataFrame, state: float) -> pd.DataFrame:
        chosen = []
        for at in events["pos"].tolist():
            keep = at >= state
            chosen.append(1.0 if keep else None)
            if keep:
                state = at + self.distance + 1
        return events.assign(outcome=chosen)


class ServeInTurn:
    """Each taker takes the earliest waiting item that has not expired.

    Items arrive and expire in the same order, so the state is just how many are gone.  A taker
    sees ``arrived`` items before it, of which ``expired`` are too old: the state becomes
    ``min(max(gone, expired) + 1, arrived)``.  Chains of such steps keep the form
    ``min(max(gone + a, b), c)``, which is the summary.
    """

    start = 0.0

    def summary(self, events: pd.DataFrame) -> list[float]:
        a, b, c = 0.0, -np.inf, np.inf
        for arrived, expired in zip(events["arrived"].tolist(), events["expired"].tolist()):
            a, b, c = self.combine((a, b, c), (1.0, min(expired + 1.0, arrived), float(arrived)))
        return [a, b, c]

    def follow(self, vector: np.ndarray, state: float) -> float:
        return min(max(state + vector[0], vector[1]), vector[2])

    def combine(self, first, second) -> list[float]:
        a1, b1, c1 = first
        a2, b2, c2 = second
        return [a1 + a2, min(max(b1 + a2, b2), c2), min(max(c1 + a2, b2), c2)]

    def replay(self, events: pd.DataFrame, state: float) -> pd.DataFrame:
        taken = []
        for arrived, expired in zip(events["arrived"].tolist(), events["expired"].tolist()):
            gone = max(state, float(expired))
            served = gone < arrived
            taken.append(gone if served else None)
            state = gone + 1.0 if served else float(arrived)
        return events.assign(outcome=taken)


def greedy(
    events: DataFrame,
    rule: KeepApart | ServeInTurn,
    index: str,
    keys: Sequence[str] = UNIT,
    block_rows: int = GROUP,
    group: int = GROUP,
) -> DataFrame:
    """Add ``outcome`` (double, NULL = not chosen) by applying ``rule`` in ``index`` order.

    ``index`` must be a unique whole number per series, so a block holds at most ``block_rows``
    events.
    """
    keys = list(keys)
    if isinstance(rule, KeepApart):
        block_rows = max(block_rows, rule.distance + 1)
    blocked = events.withColumn("_block", F.floor(F.col(index) / block_rows).cast("long")).withColumn(
        "_base", F.col("_block") * block_rows
    )
    key_fields = [events.schema[k] for k in keys]

    def shape(*fields: tuple) -> StructType:
        return StructType([*key_fields, *[StructField(n, t) for n, t in fields]])

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(index)
        return pdf[[*keys, "_block"]].iloc[[0]].assign(vector=[rule.summary(pdf)])

    summary_type = shape(("_block", LongType()), ("vector", ArrayType(DoubleType())))
    blocks = blocked.groupBy(*keys, "_block").applyInPandas(summarise, summary_type)
    grouped = blocks.withColumn("_group", F.floor(F.col("_block") / group).cast("long"))

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = pdf.sort_values("_block")["vector"].tolist()
        total = vectors[0]
        for vector in vectors[1:]:
            total = rule.combine(total, vector)
        return pdf[[*keys, "_group"]].iloc[[0]].assign(vector=[list(total)])

    group_type = shape(("_group", LongType()), ("vector", ArrayType(DoubleType())))
    groups = grouped.groupBy(*keys, "_group").applyInPandas(chain, group_type)

    def walk(column: str):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(column)
            state = float(pdf["_state"].iloc[0]) if "_state" in pdf else rule.start
            states = []
            for vector in pdf["vector"]:
                states.append(state)
                state = rule.follow(vector, state)
            return pdf[[*keys, column]].assign(_entry=states)

        return run

    group_entry = groups.groupBy(*keys).applyInPandas(
        walk("_group"), shape(("_group", LongType()), ("_entry", DoubleType()))
    )
    block_entry = (
        grouped.join(group_entry.withColumnRenamed("_entry", "_state"), [*keys, "_group"])
        .groupBy(*keys, "_group")
        .applyInPandas(walk("_block"), shape(("_block", LongType()), ("_entry", DoubleType())))
    )

    columns = [*events.columns, "outcome"]

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(index)
        return rule.replay(pdf, float(pdf["_entry"].iloc[0]))[columns]

    out = StructType([*events.schema.fields, StructField("outcome", DoubleType())])
    return (
        blocked.join(block_entry, [*keys, "_block"])
        .groupBy(*keys, "_block")
        .applyInPandas(replay, out)
    )


def keep_apart(
    events: DataFrame, distance: int = 100, position: str = "rn", keys: Sequence[str] = UNIT, **sizes
) -> DataFrame:
    """Events that survive greedy merging: each more than ``distance`` rows after the last kept."""
    marked = greedy(
        events.withColumn("pos", F.col(position).cast("long")),
        KeepApart(distance),
        "pos",
        keys,
        **sizes,
    )
    return marked.filter(F.col("outcome").isNotNull()).drop("outcome", "pos")


def first_takers(
    items: DataFrame,
    takers: DataFrame,
    within_us: int,
    keys: Sequence[str] = UNIT,
    item_tie: str = "seq",
    taker_tie: str = "seq",
    **sizes,
) -> DataFrame:
    """Pair each taker with the earliest unused item in ``[taker - within, taker)``.

    Both inputs have ``us`` and their tie column.  Takers that find an item are returned with
    ``item_us`` and ``item_no`` (the item's place in its series).
    """
    keys = list(keys)
    extra = [c for c in takers.columns if c not in keys and c not in ("us", taker_tie)]
    payload = F.struct("us", F.col(taker_tie).alias("_tie"), *extra)
    arrivals = items.select(*keys, F.col("us").alias("_at"), F.lit(1).alias("_kind"), F.col(item_tie).cast("long").alias("_tie"))
    probes = takers.select(
        *keys, F.col("us").alias("_at"), F.lit(0).alias("_kind"), F.col(taker_tie).cast("long").alias("_tie"), payload.alias("taker")
    )
    expiries = takers.select(
        *keys,
        (F.col("us") - within_us).alias("_at"),
        F.lit(-1).alias("_kind"),
        F.col(taker_tie).cast("long").alias("_tie"),
    )
    stream = ordered_pieces(
        probes.unionByName(arrivals, allowMissingColumns=True).unionByName(expiries, allowMissingColumns=True),
        keys,
        ("_at", "_kind", "_tie"),
        "takers",
    )
    counted = running(
        stream.withColumn("_is_item", (F.col("_kind") == 1).cast("long")).withColumn(
            "_is_taker", (F.col("_kind") == 0).cast("long")
        ),
        {"_items": ("sum", "_is_item"), "_takers": ("sum", "_is_taker")},
        keys=keys,
        inclusive=False,
        pieces=True,
    )
    counted = counted.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("_items", "_takers")})
    arrived = counted.filter("_kind = 0").select(
        *keys, F.col("_at").alias("us"), F.col("_tie").alias("tie"), "taker", F.col("_items").alias("arrived"), F.col("_takers").alias("no")
    )
    expired = counted.filter("_kind = -1").select(
        *keys, (F.col("_at") + within_us).alias("us"), F.col("_tie").alias("tie"), F.col("_items").alias("expired")
    )
    served = greedy(arrived.join(expired, [*keys, "us", "tie"]), ServeInTurn(), "no", keys, **sizes)
    numbered = counted.filter("_kind = 1").select(
        *keys, F.col("_items").alias("item_no"), F.col("_at").alias("item_us")
    )
    return (
        served.filter(F.col("outcome").isNotNull())
        .withColumn("item_no", F.col("outcome").cast("long"))
        .join(numbered, [*keys, "item_no"])
        .select(
            *keys,
            "us",
            F.col("taker._tie").alias(taker_tie),
            *[F.col(f"taker.{c}").alias(c) for c in extra],
            "item_us",
            "item_no",
        )
    )
