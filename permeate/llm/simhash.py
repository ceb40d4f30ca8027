"""SimHash near-duplicates: 64-bit fingerprints of word 3-shingles, linked at a Hamming radius.

Fingerprint of a text: A-Z lower-cased, words are runs of bytes other than blanks and controls
9 to 13, shingles are 3 consecutive words joined by one space (repeats included; fewer than
3 words: the whole sequence as one shingle; no words or a null text: no shingle, fingerprint 0).
Each shingle's XXH64 (UTF-8, seed 42) votes for its bits; a fingerprint bit is 1 where more than
half of the shingles set it.  Ties (exactly half) give 0.

Links: two fingerprints link when they differ in at most ``RADIUS`` bits.  They are found by
tiled exact comparison: the distinct fingerprints are numbered in the order of (population
count, value) and cut into tiles of ``TILE`` fingerprints; a tile is compared only with the tiles
whose population counts lie within the radius of its own (two fingerprints at distance d differ
in population count by at most d), each pair of tiles in one task with numpy exclusive-or and
bit counts.  Every pair within the radius is found; only pairs that link leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.llm.graph import components
from permeate.llm.tables import BROADCAST_ROWS, numbered, pick, stored

RADIUS = 3
SEED = 42
SHINGLE = 3
#: Distinct fingerprints in one tile; a task compares two tiles, TILE * TILE pairs.
TILE = 8192
#: Bytes of a text read at once; longer texts are read piece by piece, whole.
PIECE = 1 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BLANKS = b" \t\n\x0b\x0c\r"
_ROWS_AT_ONCE = 512


def _word_pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of ``data`` in order, in lists of about PIECE bytes; no word is cut."""
    start, n = 0, len(data)
    while start < n:
        end = min(n, start + PIECE)
        while end < n and data[end] not in _BLANKS:
            end += 1
        yield data[start:end].translate(_LOWER).split()
        start = end


def fingerprint(text: str | None) -> tuple[int, int]:
    """(fingerprint as an unsigned 64-bit number, number of shingles) of one text."""
    votes, n = np.zeros(64, np.int64), 0
    tail: list[bytes] = []
    for words in _word_pieces((text or "").encode("utf-8")):
        words = tail + words
        if len(words) >= SHINGLE:
            hashes = np.fromiter(
                (xxhash.xxh64_intdigest(b" ".join(words[i : i + SHINGLE]), SEED) for i in range(len(words) - SHINGLE + 1)),
                np.uint64,
            )
            votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(hashes)
            tail = words[-(SHINGLE - 1) :]
        else:
            tail = words
    if n == 0 and tail:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)
        votes += np.unpackbits(h.view(np.uint8), bitorder="little")
        n = 1
    bits = (2 * votes > n).astype(np.uint8)
    value = int(np.packbits(bits, bitorder="little").view("<u8")[0])
    return value, n


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        made = [fingerprint(t) for t in batch["text"]]
        yield pd.DataFrame(
            {
                "doc_id": batch["doc_id"],
                "fp": [_signed(v) for v, _ in made],
                "n_shingles": [n for _, n in made],
            }
        ).astype({"doc_id": "Int64", "fp": "int64", "n_shingles": "int64"})


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long), n_shingles: one row per row of ``docs``."""
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(
        _fingerprints, "doc_id long, fp long, n_shingles long"
    )


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of all pairs a[i], b[j] within ``radius`` bits; i < j where a and b are one tile.

    Both tiles are sorted by population count, so for a run of rows of ``a`` only the columns of
    ``b`` whose counts lie within the radius of the run's are compared.
    """
    ua, ub = a.view(np.uint64), b.view(np.uint64)
    ca, cb = np.bitwise_count(ua), np.bitwise_count(ub)
    found_i, found_j = [], []
    for s in range(0, len(ua), _ROWS_AT_ONCE):
        rows = ua[s : s + _ROWS_AT_ONCE]
        lo = int(np.searchsorted(cb, int(ca[s : s + _ROWS_AT_ONCE].min()) - radius, "left"))
        hi = int(np.searchsorted(cb, int(ca[s : s + _ROWS_AT_ONCE].max()) + radius, "right"))
        if same:
            lo = max(lo, s + 1)
        if lo >= hi:
            continue
        near = np.bitwise_count(rows[:, None] ^ ub[None, lo:hi]) <= radius
        i, j = np.nonzero(near)
        i, j = i + s, j + lo
        if same:
            keep = j > i
            i, j = i[keep], j[keep]
        found_i.append(i)
        found_j.append(j)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for ta, tb, fa, fb in zip(batch["ta"], batch["tb"], batch["fa"], batch["fb"], strict=True):
            a, b = np.asarray(fa, np.int64), np.asarray(fb, np.int64)
            i, j = near_pairs(a, b, ta == tb)
            if len(i):
                yield pd.DataFrame({"a": a[i], "b": b[j]})


def links(prints: DataFrame, tile: int = TILE, radius: int = RADIUS) -> DataFrame:
    """All pairs (a, b) of distinct fingerprints within ``radius`` bits."""
    distinct = prints.select("fp").distinct().withColumn("pc", F.bit_count("fp"))
    placed = numbered(distinct, [F.col("pc"), F.col("fp")], "simhash-order", "_pos")
    tiles = stored(
        placed.groupBy(F.floor(F.col("_pos") / tile).cast("long").alias("tile")).agg(
            F.min("pc").alias("lo"),
            F.max("pc").alias("hi"),
            F.sort_array(F.collect_list(F.struct("pc", "fp"))).alias("members"),
        ).select("tile", "lo", "hi", F.col("members.fp").alias("fps")),
        "simhash-tiles",
    )
    # The last tile whose smallest count is at most p, for every count p (65 rows): tiles are in
    # the order of counts, so the tiles a tile meets are a run from itself on.
    reach = {int(r.lo): int(r.last) for r in tiles.groupBy("lo").agg(F.max("tile").alias("last")).collect()}
    last, upto = -1, []
    for p in range(65):
        last = max(last, reach.get(p, -1))
        upto.append(last)
    bound = F.element_at(F.array(*[F.lit(x) for x in upto]), F.least(F.col("hi") + radius, F.lit(64)) + 1)
    pairs = tiles.select(F.col("tile").alias("ta"), F.explode(F.sequence(F.col("tile"), F.greatest(bound, F.col("tile")))).alias("tb"))
    side_a = tiles.select(F.col("tile").alias("ta"), F.col("fps").alias("fa"))
    side_b = tiles.select(F.col("tile").alias("tb"), F.col("fps").alias("fb"))
    met = pairs.join(side_a, "ta").join(side_b, "tb").repartition("ta", "tb")
    return met.mapInPandas(_compare, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id, n_shingles: one row per row.

    ``component_id`` is the smallest doc_id of the rows whose fingerprints are reachable by links,
    its own row's included; equal fingerprints are one node.  Rows without an id keep their
    fingerprint and carry links like any other; a component holding no id at all gets NULL.
    Repeated rows give repeated result rows.
    """
    prints = stored(fingerprinted(docs), "simhash-prints")
    labels = components(stored(links(prints), "simhash-links")).withColumnRenamed("node", "fp")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labelled = stored(
        least.join(labels, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")),
        "simhash-labels",
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    per_print = stored(labelled.join(smallest, "component").select("fp", "component_id"), "simhash-classes")
    side = F.broadcast(per_print) if per_print.count() <= BROADCAST_ROWS else per_print
    return prints.join(side, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "n_shingles",
    )
