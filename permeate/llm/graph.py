"""Distributed union-find: the component of each node, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import gathered, stored

MOST_ROUNDS = 60
#: Nodes of a key that others are held against in a round.
HUBS = 4
#: Where rounds go on as long as they pay, one pays if so large a share of all links is new.
PAYS = 0.1


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.a", "e.b")


def components(edges: DataFrame) -> DataFrame:
    """Links (a, b) of any type that orders -> (node, component): the smallest node of each
    component, for every node but that smallest one.

    Every round hangs all larger neighbours of a node on its smallest neighbour, then all smaller
    ones; minima are combined before the shuffle, and a node of many links is split by the
    engine's skew join. Each round is written, so a lost executor repeats one round at most.
    """
    given = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rows = given.count()
    links = stored(gathered(given.distinct(), rows), "links")
    last = None
    for turn in range(MOST_ROUNDS):
        least = links.groupBy("b").agg(F.lit(1)).select(F.col("b").alias("a"))  # nodes that others hang on
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        # Every node hangs on one other, and nothing hangs on a node that hangs: every component is a star.
        if not turn and not links.join(least, "a", "left_semi").limit(1).count():
            if not links.groupBy("a").count().where("count > 1").limit(1).count():
                break
        last = tuple(state)
        near = _both_ways(links)
        smallest = near.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = near.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(gathered(large.where("a <> b").distinct(), 2 * rows), f"large{turn}")
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(lowest.select("a", F.col("m").alias("b")))
        links = stored(gathered(small.distinct(), 2 * rows), f"links{turn}")
    else:
        raise RuntimeError("components did not settle")
    return links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")


def linked(meeting: DataFrame, verify, could=None, rounds: int = 2, near=None, small: str | None = None, met: bool = False) -> DataFrame:
    """Links (a, b) that connect all that ``verify`` would link of the nodes that meet in a key.

    ``meeting`` has key, node and what ``could`` looks at. In each round every node is held against
    one hub, and the links found are contracted; what is then
    still apart is paired in full. ``verify`` gets pairs (a, b) and gives those that link; ``could(x, y)`` may rule pairs out.
    The hub is that of the key where most meet. If ``near(x, y)`` is given, a key has ``HUBS``, and a node's is the one where
    that is least; rounds go on as long as they pay. One hub of a key is that of the least ``small``, a column of ``meeting``, where it is given.
    ``met`` tells that every key has two nodes or more.
    """
    known, rows, links, last = None, meeting.count(), 0, False

    def allowed(x: str, y: str):
        return could(x, y) if could else F.lit(True)

    for turn in range(MOST_ROUNDS):
        at = meeting.withColumn("label", F.col("node"))
        if known is not None:
            labels = components(known)
            at = meeting.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
        if turn or not met:
            spread = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
            at = stored(gathered(at.join(spread, "key"), rows), f"meeting{turn}")
        if not last:
            draws = range(turn * HUBS, turn * HUBS + (HUBS if near else 1))
            ranks = [F.struct(F.xxhash64("node", F.lit(draw)), F.col("node")) for draw in draws]
            if small:
                ranks[0] = F.struct(F.col(small), F.xxhash64("node", F.lit(turn)), F.col("node"))
            hubs = [F.min_by(F.struct(*at.columns), rank) for rank in ranks]
            hubs = at.groupBy("key").agg(F.count("*").alias("met"), F.array_distinct(F.array(*hubs)).alias("hubs"))
            other = hubs.select("met", F.explode("hubs").alias("hub")).select("hub.*", "met")
        else:
            other = at
        pairs = at.alias("x").join(other.alias("y"), F.col("x.key") == F.col("y.key"))
        pairs = pairs.where("x.label <> y.label").where(allowed("x", "y"))
        if not last:
            # One pair per node and round.
            best = near("x", "y") if near else -F.col("y.met")
            best = F.struct(best, F.xxhash64("y.key", F.lit(turn)), F.col("y.node").alias("hub"))
            pairs = pairs.groupBy(F.col("x.node").alias("node")).agg(F.min(best).alias("best"))
            pairs = pairs.select("node", F.col("best.hub").alias("hub"))
        else:
            pairs = pairs.where("x.node < y.node").select(F.col("x.node").alias("node"), F.col("y.node").alias("hub"))
        pairs = pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        if not last:
            pairs = gathered(pairs, rows)
        new = verify(stored(pairs, f"pairs{turn}")).select("a", "b")
        known = stored(new if known is None else known.unionByName(new), f"known{turn}")
        if last:
            break
        before, links = links, known.count()
        last = turn + 1 >= rounds and (not near or links - before <= PAYS * links) or turn + 2 == MOST_ROUNDS
    return known
