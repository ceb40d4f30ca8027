"""Balanced label propagation: linked rows gather in one shard, shards stay equally long.

Rows are linked when they share a group (for documents: equal texts). Linked rows are bundled in
units of bounded size; each round counts every group's rows per shard, and each unit wants the
shard where most of its group is. Per pair of shards and gain, as many units move as the target's
quota allows. Rows without links are ballast: they fill the shards up, so that the numbers of rows
differ by one at most (the law ``rows``). Ids, sizes and hashes are all that is moved.

Defined cases: a null text has size 1 and is linked with nothing; empty texts are equal texts;
repeated rows are linked rows; a group larger than a shard is spread over as few as the quotas
allow; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import BROADCAST_ROWS, numbered, pick, stored

SHARDS = 8
ROUNDS = 5
#: How far above its share of rows a shard may go while labels are propagated.
SLACK = 1.1
#: A unit holds at most this part of a shard, and at most so many rows.
UNIT_PART = 64
UNIT_ROWS = 4096
GAIN_BINS = 41


def documents(docs: DataFrame) -> DataFrame:
    """node, doc_id, size, text_crc32, grp (null: linked with nothing)."""
    text = F.col("text")
    blank = F.coalesce(text, F.lit(""))
    group = F.when(text.isNotNull(), F.concat_ws("-", F.xxhash64(text), F.crc32(text), F.octet_length(text)))
    plain = pick(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("node"),
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(blank.cast("binary")).alias("text_crc32"),
        group.alias("grp"),
    )
    return stored(plain, "shard-nodes")  # written once, so a node keeps its number


def _pick_flows(wishes: list, load: list[int], quota: list[int]) -> dict:
    """(from, to, bin) -> the part of those units that may move; best gains first.

    As many rows as wish to go the opposite way may be swapped; beyond that a shard takes rows up
    to ``SLACK`` above its quota. What is above it in the end goes with the rows that fill up.
    """
    n = len(quota)
    wished = [[0] * n for _ in range(n)]
    for source, to, _, rows in wishes:
        wished[source][to] += rows
    allowed = [[min(wished[i][j], wished[j][i]) for j in range(n)] for i in range(n)]
    free = [int(q * SLACK) - rows for q, rows in zip(quota, load, strict=True)]
    for source, to in sorted(((i, j) for i in range(n) for j in range(n)), key=lambda x: allowed[x[0]][x[1]] - wished[x[0]][x[1]]):
        more = max(0, min(wished[source][to] - allowed[source][to], free[to]))
        allowed[source][to] += more
        free[to] -= more
        free[source] += more
    parts = {}
    for source, to, gain, rows in sorted(wishes, key=lambda w: (-w[2], w[0], w[1])):
        take = min(rows, allowed[source][to])
        allowed[source][to] -= take
        if take:
            parts[source, to, gain] = take / rows
    return parts


def _hash_part(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))


def propagate(units: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """unit, grp, rows, shard -> the same with the shards after ``rounds`` rounds.

    What reaches the driver in a round is one number per shard, and one per pair of shards and
    gain: bounded by the number of shards, not by the data.
    """
    n = len(quota)
    for turn in range(rounds):
        held = stored(units, f"shard-round{turn}")
        load = [0] * n
        for shard, rows in held.groupBy("shard").agg(F.sum("rows")).collect():
            load[shard] = rows
        open_shards = [s for s in range(n) if load[s] < quota[s] * SLACK]
        tally = held.groupBy("grp", "shard").agg(F.sum("rows").alias("here"))
        full = F.when(F.col("shard").isin(open_shards), 0).otherwise(1)
        rank = F.struct(F.lit(0) - full, F.col("here"), F.xxhash64("grp", "shard"), F.col("shard"))
        best = tally.groupBy("grp").agg(
            F.max(F.struct(F.col("here"), F.xxhash64("grp", "shard"), F.col("shard"))).alias("top"),
            F.max(rank).alias("open"),
            F.map_from_entries(F.collect_list(F.struct("shard", "here"))).alias("at"),  # one per shard
        )
        at_home = F.element_at("at", F.col("shard"))
        # A group's largest part stays; the others go to the largest that has room.
        target = F.when(F.col("shard") == F.col("top.shard"), F.col("shard")).otherwise(F.col("open.shard"))
        gain = F.element_at("at", F.col("to")) - (at_home - F.col("rows"))
        wishes = (
            held.join(best, "grp")
            .withColumn("to", target)
            .withColumn("gain", gain)
            .withColumn("moving", (F.col("to") != F.col("shard")) & (F.col("gain") > 0))
            .withColumn("bin", F.when(F.col("moving"), F.least(F.floor(F.log2("gain")), F.lit(GAIN_BINS - 1)).cast("int")))
            .select("unit", "grp", "rows", "shard", "to", "bin", "moving")
        )
        wished = stored(wishes, f"shard-wish{turn}")
        flows = wished.where("moving").groupBy("shard", "to", "bin").agg(F.sum("rows")).collect()
        allowed = _pick_flows([tuple(f) for f in flows], load, quota)
        if not allowed:
            return held
        rules = held.sparkSession.createDataFrame(
            [(*key, part) for key, part in allowed.items()], "shard int, to int, bin int, part double"
        )
        goes = F.col("moving") & (_hash_part(F.col("unit"), F.lit(turn)) < F.coalesce("part", F.lit(0.0)))
        units = wished.join(F.broadcast(rules), ["shard", "to", "bin"], "left").select(
            "unit", "grp", "rows", F.when(goes, F.col("to")).otherwise(F.col("shard")).alias("shard")
        )
    return stored(units, "shard-rounds")


def assign(nodes: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Nodes (node, grp and more) with shard and slot; the slots of a shard run from 0."""
    total = nodes.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    sizes = nodes.where("grp is not null").groupBy("grp").agg(F.count("*").alias("rows_in"))
    linked = stored(sizes.where("rows_in > 1"), "shard-groups")
    unit_rows = max(1, min(UNIT_ROWS, total // (shards * UNIT_PART)))
    if linked.count() <= BROADCAST_ROWS:
        linked = F.broadcast(linked)
    marked = nodes.join(linked, "grp", "left")
    pieces = F.ceil(F.col("rows_in") / unit_rows)
    unit = F.when(
        F.col("rows_in").isNotNull(),
        F.concat_ws("/", "grp", F.pmod(F.xxhash64("node"), pieces)),
    )
    members = stored(marked.withColumn("unit", unit).drop("rows_in"), "shard-members")
    start = F.pmod(F.xxhash64("unit"), F.lit(shards)).cast("int").alias("shard")
    units = members.where("unit is not null").groupBy("unit", "grp").agg(F.count("*").alias("rows"))
    settled = propagate(units.select("unit", "grp", "rows", start), quota, rounds)
    homes = settled.select("unit", F.col("shard").alias("_home"))
    if homes.count() <= BROADCAST_ROWS:
        homes = F.broadcast(homes)
    alone = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    placed = (
        members.join(homes, "unit", "left")
        .withColumn("_single", F.col("_home").isNull())
        .withColumn("_home", F.coalesce("_home", alone))
    )
    return _level(placed, quota)


def _level(placed: DataFrame, quota: list[int]) -> DataFrame:
    """Equal numbers of rows: each shard keeps its first rows, linked ones before single ones; the
    rest fill the free slots of the others in order."""
    keys = [F.col(c) for c in ("_home", "_single", "grp", "node")]
    lined = stored(numbered(placed, keys, "shard-order", "_place"), "shard-lined")
    counts = dict(lined.groupBy("_home").count().collect())
    first, surplus, free, rows = 0, 0, 0, []
    gaps = []
    for shard, limit in enumerate(quota):
        n = counts.get(shard, 0)
        rows.append((shard, first, limit, surplus))
        gaps.append((shard, free, n))
        first += n
        surplus += max(0, n - limit)
        free += max(0, limit - n)
    spark = placed.sparkSession
    info = spark.createDataFrame(rows, "_home int, _first long, _limit long, _over long")
    within = lined.join(F.broadcast(info), "_home").withColumn("_pos", F.col("_place") - F.col("_first"))
    over = F.col("_over") + F.col("_pos") - F.col("_limit")  # place among all surplus rows
    to, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for shard, before, n in gaps:
        to = F.when(over >= before, shard).otherwise(to) if quota[shard] > n else to
        slot = F.when(over >= before, over - before + n).otherwise(slot) if quota[shard] > n else slot
    stays = F.col("_pos") < F.col("_limit")
    return within.select(
        *[c for c in placed.columns if c not in ("unit", "_home", "_single")],
        F.when(stays, F.col("_home")).otherwise(to).alias("shard"),
        F.when(stays, F.col("_pos")).otherwise(slot).alias("slot"),
    )


def documents_sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The query's rows: shard and slot of each document."""
    return assign(documents(docs), shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
