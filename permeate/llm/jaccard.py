"""N-gram Jaccard join by vertical partitioning: fragments of the n-gram order, counts summed per pair.

Two documents link when their sets of 5-word runs have a Jaccard similarity of 0.8 or more. Links
are found exactly, in five steps.

1. Every document's set is cut by ranges of the n-gram hash into fragments; a fragment meets all
   documents that hold one of its n-grams, counts the documents of each n-gram, and gives back
   to each document the n-grams that others hold too, with their counts. Equal sets are one.
2. A document of n n-grams needs ceil(0.8 n) shared ones to link with a different set; the others
   are out. The global order is (count, hash): rare n-grams first. Two sets that link share an
   n-gram among the first n - ceil(0.8 n) + 1 of either, so only those meet.
3. In each of a few rounds a document is paired with one hub, that of the n-gram where most meet,
   and the links found are contracted. What is still apart and could link by size and position is
   then paired in full, unless n-grams of one set alone and a parity of n-grams by class show that
   too many differ.
   Copies are thus not expanded into all pairs, and no link between components is lost.
4. A pair's overlap is counted in each fragment of the global order on its own and summed.
5. Components by union-find; all documents of a set take part with their smallest id.

Defined cases: a text of fewer than five words is one run; a null text, or one without words, has
an empty set and links with nothing; a row without an id takes no part in links (its component is
null); repeated rows are copies; other columns are ignored by ``classes`` and kept by
``one_of_each``; an empty table gives an empty result. Sets are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.graph import components
from permeate.llm.tables import BROADCAST_ROWS, gathered, groups_for, pick, stored
from permeate.llm.words import SPACED, flat, pieces, sets_of_runs, words

RUN = 5
#: Link when SHARE_OF * intersection >= SHARE * union, that is from a similarity of 0.8.
SHARE, SHARE_OF = 80, 100
#: Bytes of text per fragment; a fragment's n-grams are held by one task.
FRAGMENT_BYTES = 14 << 20
EMIT_BYTES = 8 << 20
HUB_ROUNDS = 2
PARITY_WORDS = 8
#: Cuts of the global order for the counts of step 4: by count, the rarest further by hash.
RARE_CUTS = 4

_PACKED = pa.schema(
    [("key", pa.int32()), ("ids", pa.binary()), ("sets", pa.binary()), ("sizes", pa.binary()), ("grams", pa.binary()), ("counts", pa.binary())]
)
_SQL_PACKED = "key int, ids binary, sets binary, sizes binary, grams binary, counts binary"


def _least(n):
    """The n-grams that a set of n must share with a set that it links with."""
    return (n * SHARE + SHARE_OF - 1) // SHARE_OF


def _set_hash(grams: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(grams * np.uint64(0x9E3779B97F4A7C15) + (grams >> np.uint64(29)))) ^ len(grams) * 0x2545F4914F6CDD1D % (1 << 64)


def _row(key, ids=b"", sets=b"", sizes=b"", grams=b"", counts=b""):
    return (key, *[x if isinstance(x, bytes) else x.tobytes() for x in (ids, sets, sizes, grams, counts)])


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PACKED, strict=True)], schema=_PACKED)


def _cut(fragments: int, buckets: int):
    """Documents -> packed rows: key < fragments: parts of sets; then sets and sizes; then documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = flat(batch.column(1))
            for i, j in pieces(offsets, EMIT_BYTES):
                rows = [r for r in _segments(data, offsets[i : j + 1], numbers[i:j], known[i:j], fragments, buckets)]
                if rows:
                    yield _batch(rows)
            pa.default_memory_pool().release_unused()

    return cut


def _segments(data, offsets, numbers, known, fragments, buckets) -> Iterator[tuple]:
    sets: list[np.ndarray] = []
    for a, b in pieces(offsets):
        sets.extend(sets_of_runs(*words(data, offsets[a : b + 1], SPACED), RUN))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    names = np.fromiter(map(_set_hash, sets), np.uint64, len(sets))
    # Rows without an id are written with size -1 - n: they are counted, but never linked.
    spread = fragments + buckets + int(names[0] % np.uint64(buckets))
    yield _row(spread, numbers, names, np.where(known, sizes, -1 - sizes))
    # A set that occurs more than once here is sent once.
    linked = np.flatnonzero(known & (sizes > 0))
    _, first = np.unique(names[linked], return_index=True)
    first = linked[first]
    if not len(first):
        return
    bucket = (names[first] % np.uint64(buckets)).astype(np.int64)
    for k in np.unique(bucket):
        of = first[bucket == k]
        yield _row(fragments + int(k), sets=names[of], sizes=sizes[of])
    grams = np.concatenate([sets[i] for i in first])
    sets.clear()
    owner = np.repeat(np.arange(len(first), dtype=np.int32), sizes[first])
    fragment = ((grams >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.uint16 if fragments < 65536 else np.int64)
    order = np.argsort(fragment, kind="stable")
    grams, owner, fragment = grams[order], owner[order], fragment[order]
    bounds = np.searchsorted(fragment, np.arange(fragments + 1))
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        a, b = bounds[k], bounds[k + 1]
        held, counts = np.unique(owner[a:b], return_counts=True)  # owners are in order, so are their n-grams
        yield _row(k, sets=names[first][held], sizes=counts.astype(np.uint32), grams=grams[a:b])


def _shared(fragments: int, buckets: int):
    """A fragment -> per bucket of sets, their n-grams that are in other sets too, and in how many."""

    def shared(key, group):
        k = key[0].as_py()
        if k >= fragments:
            return group
        names = np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("sets").to_pylist()])
        sizes = np.concatenate([np.frombuffer(x, np.uint32) for x in group.column("sizes").to_pylist()]).astype(np.int64)
        grams = np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()])
        # A set comes once from each batch that holds a copy of it.
        begins = np.cumsum(sizes) - sizes
        names, first = np.unique(names, return_index=True)
        sizes, begins = sizes[first], begins[first]
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        grams, owner = grams[at], np.repeat(np.arange(len(names)), sizes)
        order = np.argsort(grams)
        sorted_ = grams[order]
        new = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        counts = np.empty(len(grams), np.uint32)
        counts[order] = np.repeat(np.diff(np.append(new, len(grams))), np.diff(np.append(new, len(grams))))
        keep = counts > 1
        grams, owner, counts = grams[keep], owner[keep], counts[keep]
        bucket = (names[owner] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(bounds)).tolist():
            of = order[bounds[b] : bounds[b + 1]]
            held, n = np.unique(owner[of], return_counts=True)
            rows.append(_row(fragments + b, sets=names[held], sizes=n.astype(np.uint32), grams=grams[of], counts=counts[of]))
        return pa.Table.from_batches([_batch(rows)] if rows else [], schema=_PACKED)

    return shared


_FOUND = pa.schema([("kind", pa.string()), ("doc_id", pa.int64()), ("set", pa.int64()), ("n", pa.int64()), ("grams", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32())), ("bits", pa.list_(pa.int64()))])
_SQL_FOUND = "kind string, doc_id long, set long, n long, grams array<long>, counts array<int>, bits array<long>"


def _parities(grams: np.ndarray) -> np.ndarray:
    """A bit per class of n-grams: whether their number is odd. Two sets differ in at least as many
    n-grams as in bits."""
    odd = np.bincount((grams & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _documents(row: dict) -> pa.RecordBatch:
    ids, sets, sizes = (np.frombuffer(row[c], t) for c, t in (("ids", np.int64), ("sets", np.int64), ("sizes", np.int64)))
    known = sizes >= 0
    columns = [
        pa.array(["doc"] * len(ids)),
        pa.array(ids, mask=~known),
        pa.array(sets),
        pa.array(np.where(known, sizes, -1 - sizes)),
        pa.nulls(len(ids), _FOUND.field("grams").type),
        pa.nulls(len(ids), _FOUND.field("counts").type),
        pa.nulls(len(ids), _FOUND.field("bits").type),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_FOUND)


def _gathered(key, group):
    """Rows of documents; of a bucket of sets, a row per set that may link with another one, with
    its shared n-grams in the global order."""
    docs, sets, sizes, names, lengths, grams, counts = [], [], [], [], [], [], []
    for row in group.to_pylist():
        if row["ids"]:
            docs.append(_documents(row))
        elif row["grams"]:
            names.append(np.frombuffer(row["sets"], np.uint64))
            lengths.append(np.frombuffer(row["sizes"], np.uint32))
            grams.append(np.frombuffer(row["grams"], np.uint64))
            counts.append(np.frombuffer(row["counts"], np.uint32))
        else:
            sets.append(np.frombuffer(row["sets"], np.uint64))
            sizes.append(np.frombuffer(row["sizes"], np.int64))
    out = docs
    if names:
        n_of = dict(zip(np.concatenate(sets).tolist(), np.concatenate(sizes).tolist(), strict=True))
        owner = np.repeat(np.concatenate(names), np.concatenate(lengths))
        grams, counts = np.concatenate(grams), np.concatenate(counts)
        order = np.lexsort((grams, counts, owner))
        owner, grams, counts = owner[order], grams[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        rows = []
        for a, b in zip(new.tolist(), np.append(new[1:], len(owner)).tolist(), strict=True):
            n = n_of[int(owner[a])]
            if b - a >= _least(n):
                rows.append((int(owner[a].view(np.int64)), n, grams[a:b].view(np.int64), counts[a:b].astype(np.int32), _parities(grams[a:b])))
        if rows:
            s, n, g, c, w = zip(*rows, strict=True)
            out.append(
                pa.RecordBatch.from_arrays(
                    [pa.array(["set"] * len(s)), pa.nulls(len(s), pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(g, pa.list_(pa.int64())), pa.array(c, pa.list_(pa.int32())), pa.array(w, pa.list_(pa.int64()))],
                    schema=_FOUND,
                )
            )
    return pa.Table.from_batches(out, schema=_FOUND)


def fragments_of(docs: DataFrame) -> DataFrame:
    """Rows of kind ``doc`` (doc_id, set, n) and of kind ``set`` (set, n, grams, counts)."""
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    total = int(plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = groups_for(total, FRAGMENT_BYTES, 4)
    packed = plain.mapInArrow(_cut(n, n), _SQL_PACKED)
    shared = packed.groupBy("key").applyInArrow(_shared(n, n), _SQL_PACKED)
    return stored(shared.groupBy("key").applyInArrow(_gathered, _SQL_FOUND), "ngrams")


def _could_link(n: Column, m: Column) -> Column:
    return F.least(n, m) * SHARE_OF >= F.greatest(n, m) * SHARE


def _fragment(grams: Column, counts: Column) -> Column:
    """Each set's n-grams cut at fixed places of the global order: (fragment, its n-grams)."""
    both = F.arrays_zip(grams.alias("g"), counts.alias("c"))

    def place(x):
        rare = F.shiftright(x["g"], 62) + (RARE_CUTS // 2)
        return F.when(x["c"] == 2, rare).when(x["c"] <= 4, RARE_CUTS).otherwise(RARE_CUTS + 1)

    def part(k: int) -> Column:
        return F.transform(F.filter(both, lambda x: place(x) == k), lambda x: x["g"])

    cuts = [F.struct(F.lit(k).alias("fragment"), part(k).alias("part")) for k in range(RARE_CUTS + 2)]
    return F.filter(F.array(*cuts), lambda s: F.size(s["part"]) > 0)


def verified(pairs: DataFrame, parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted per fragment, then summed per pair."""
    left = parts.select(F.col("set").alias("a"), "fragment", F.col("part").alias("part_a"))
    right = parts.select(F.col("set").alias("b"), "fragment", F.col("part").alias("part_b"))
    counted = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "n", "m", F.size(F.array_intersect("part_a", "part_b")).alias("both"))
    )
    both = F.sum("both")
    summed = counted.groupBy("a", "b", "n", "m").agg(both.alias("both"))
    union = F.col("n") + F.col("m") - F.col("both")
    return summed.where(F.col("both") * SHARE_OF >= union * SHARE).select("a", "b")


def links(found: DataFrame) -> DataFrame:
    """Enough links (a, b) between sets that every component of linked sets is connected."""
    sets = found.where("kind = 'set'").select("set", "n", "grams", "counts")
    parts = stored(
        sets.select("set", F.explode(_fragment(F.col("grams"), F.col("counts"))).alias("f")).select("set", "f.fragment", "f.part"),
        "ngram-parts",
    )
    n, shared = F.col("n"), F.size("grams")
    least = F.floor((n * SHARE + SHARE_OF - 1) / SHARE_OF)
    alone = n - shared  # n-grams of no other set come first in the global order
    front = F.slice("grams", 1, (n - least + 1 - alone).cast("int"))
    meeting = stored(
        sets.select("set", "n", alone.alias("alone"), F.posexplode(front).alias("place", "gram"))
        .withColumn("rest", F.col("n") - F.col("alone") - F.col("place"))
        .select("gram", "set", "n", "rest"),
        "ngram-front",
    )
    known, rows = None, meeting.count()
    for turn in range(HUB_ROUNDS):
        at = _labelled(meeting, known, rows)
        rank = F.struct(F.xxhash64("set", F.lit(turn)).alias("h"), F.col("set").alias("b"), F.col("n").alias("m"), F.col("label").alias("hub_label"))
        hubs = at.groupBy("gram").agg(F.min(rank).alias("hub"), F.count("*").alias("met"), F.min("label").alias("lo"), F.max("label").alias("hi"))
        hubs = hubs.where("lo <> hi").select("gram", "met", "hub.b", "hub.m", "hub.hub_label")
        # One pair per set and round: the hub of the n-gram at which most sets meet.
        most = F.struct("met", F.xxhash64("gram", F.lit(turn)), "b", "m")
        pairs = (
            at.join(hubs, "gram")
            .where(F.col("label") != F.col("hub_label"))
            .where(_could_link(F.col("n"), F.col("m")))
            .groupBy("set", "n")
            .agg(F.max(most).alias("hub"))
            .select(F.col("set").alias("a"), "hub.b", "n", "hub.m")
        )
        pairs = stored(gathered(pairs, rows), f"hub-pairs{turn}")
        known = _joined(known, verified(pairs, parts, sets), turn)
    at = _labelled(meeting, known, rows)
    apart = at.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("gram")
    words = [F.get("bits", F.lit(i)).alias(f"w{i}") for i in range(PARITY_WORDS)]
    known_of = found.where("kind = 'set'").select("set", (n - shared).alias("alone"), *words)
    at = stored(gathered(at.join(apart, "gram").join(known_of, "set"), rows), "ngram-apart")
    one, two = at.alias("x"), at.alias("y")
    need = F.ceil((F.col("x.n") + F.col("y.n")) * SHARE / (SHARE + SHARE_OF))
    # N-grams of no other set, and odd classes, tell how many n-grams differ at least.
    differ = F.col("x.alone") + F.col("y.alone")
    for i in range(PARITY_WORDS):
        differ = differ + F.bit_count(F.col(f"x.w{i}").bitwiseXOR(F.col(f"y.w{i}")))
    pairs = (
        one.join(two, F.col("x.gram") == F.col("y.gram"))
        .where("x.set < y.set and x.label <> y.label")
        .where(_could_link(F.col("x.n"), F.col("y.n")))
        .where(F.least("x.rest", "y.rest") >= need)
        .where(differ * (SHARE_OF + SHARE) <= (F.col("x.n") + F.col("y.n")) * (SHARE_OF - SHARE))
        .selectExpr("x.set as a", "y.set as b", "x.n as n", "y.n as m")
        .distinct()
    )
    return _joined(known, verified(stored(pairs, "ngram-pairs"), parts, sets), HUB_ROUNDS)


def _labelled(meeting: DataFrame, known: DataFrame | None, rows: int) -> DataFrame:
    if known is None:
        return meeting.withColumn("label", F.col("set"))
    labels = components(known).withColumnRenamed("node", "set")
    labelled = meeting.join(labels, "set", "left").withColumn("label", F.coalesce("component", "set"))
    return stored(gathered(labelled.drop("component"), rows), "ngram-labels")


def _joined(known: DataFrame | None, new: DataFrame, turn: int) -> DataFrame:
    return stored(new if known is None else known.unionByName(new), f"ngram-links{turn}")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    found = fragments_of(docs)
    members = found.where("kind = 'doc'").select("doc_id", "set", "n")
    labels = components(links(found)).withColumnRenamed("node", "set")
    sets = members.where("n > 0 and doc_id is not null").groupBy("set").agg(F.min("doc_id").alias("least"))
    labelled = stored(
        sets.join(labels, "set", "left").select("set", "least", F.coalesce("component", "set").alias("component")),
        "set-labels",
    )
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    final = labelled.join(least, "component").select("set", "component_id")
    linked = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return members.join(final, "set", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without those that link, over any steps, with one of smaller id; all columns.

    Rows of one id are told apart by nothing but their columns; of those, one is kept. Rows
    without an id all stay.
    """
    columns = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(columns))])
    key = f"_{columns.index('doc_id')}"
    found = stored(classes(docs), "ngram-classes")
    gone = stored(found.where("component_id <> doc_id").select("doc_id").distinct(), "ngram-gone")
    twice = stored(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "ngram-twice")

    def of(ids: DataFrame) -> DataFrame:
        side = ids.withColumnRenamed("doc_id", key)
        return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side

    kept = plain.join(of(gone), key, "left_anti")
    if twice.limit(1).count():
        again = kept.join(of(twice), key, "left_semi").dropDuplicates([key])
        kept = kept.join(of(twice), key, "left_anti").unionByName(again)
    return kept.toDF(*columns)


#: The same rows in SQL.
SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as k
  from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id group by 1, 2),
linked as (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * k >= 80 * (p.n + q.n - k)),
ways as (select a, b from linked union all select b, a from linked),
reach as (
  select doc_id, doc_id as node from w
  union select reach.doc_id, ways.b from reach join ways on ways.a = reach.node)
select w.doc_id, coalesce(n, 0)::bigint as n_shingles, r.component_id
from w left join sizes using (doc_id)
  join (select doc_id, min(node) as component_id from reach group by doc_id) r using (doc_id)
"""
