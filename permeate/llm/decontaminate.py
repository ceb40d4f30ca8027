"""Benchmark decontamination: a Wu-Manber search for the word windows of all test items.

Documents and items become words of letters and digits between single blanks; a window of 13
words (or a shorter item as a whole) is a pattern from blank to blank, so a match is a run of
whole words. All patterns of a length class are searched together: the shift table tells, for the
last block of the place looked at, how far no pattern can end; where the shift is 0, the
block's bucket lists patterns by their first bytes, and those are compared with the text.

Defined cases: a null or empty text has no words and is clean; an item without words has no
windows; an item without an id marks words but is not listed; repeated items count once; an empty
benchmark leaves all documents clean. Other columns are ignored by ``report`` and kept by
``clean``. A benchmark beyond ``part_bytes`` is searched in parts, one pass each, the documents
being written in between; so no executor holds more patterns than that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import pick, stored
from permeate.llm.words import ALNUM

WINDOW = 13
#: A document is contaminated if ``SHARE`` times its hit words are at least all its words.
SHARE = 20
#: A task holds some 150 bytes per byte of these.
PART_BYTES = 1 << 20
#: Patterns are searched by classes of length, so that a short one does not shorten all shifts.
CLASSES = (3, 12, 24, 40)
BLOCK = 12

_TABLE = ALNUM.tobytes()


def normal(text: bytes | None) -> bytes:
    """Words between single blanks, one before the first and one after the last."""
    found = text.translate(_TABLE).split() if text else []
    return b" " + b" ".join(found) + b" " if found else b""


def windows(text: bytes, size: int = WINDOW) -> Iterator[bytes]:
    found = text.split()
    for i in range(max(1, len(found) - size + 1) if found else 0):
        yield b" " + b" ".join(found[i : i + size]) + b" "


class Searcher:
    """Patterns of one length class, ready to be searched."""

    def __init__(self, patterns: dict[bytes, set]):
        self.items = patterns
        self.least = min(map(len, patterns))
        self.block = min(BLOCK, self.least)
        self.shift: dict[bytes, int] = {}
        self.heads: dict[bytes, dict[bytes, list[bytes]]] = {}
        b, m = self.block, self.least
        for p in patterns:
            for end in range(b, m + 1):
                piece = p[end - b : end]
                if m - end < self.shift.get(piece, m):
                    self.shift[piece] = m - end
            self.heads.setdefault(p[m - b : m], {}).setdefault(p[:m], []).append(p)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(begin, pattern) of every occurrence."""
        b, m, n = self.block, self.least, len(text)
        shift, far, heads = self.shift.get, self.least - self.block + 1, self.heads
        end = m
        while end <= n:
            piece = text[end - b : end]
            step = shift(piece, far)
            if step:
                end += step
                continue
            begin = end - m
            for p in heads[piece].get(text[begin:end], ()):
                if text.startswith(p, begin):
                    yield begin, p
            end += 1


def searchers(pieces: list[tuple[str | None, bytes]]) -> list[Searcher]:
    """``pieces``: item id as text, normal text of the item or of a part of it."""
    classes: dict[int, dict[bytes, set]] = {}
    for item, text in pieces:
        for p in windows(text):
            least = max(c for c in CLASSES if c <= len(p))
            classes.setdefault(least, {}).setdefault(p, set()).add(item)
    return [Searcher(c) for c in classes.values()]


def hits(text: bytes, found: list[Searcher]) -> tuple[list[tuple[int, int]], set]:
    """Spans of words hit (from word, to word, merged) and the items whose windows occur."""
    spans, items = [], set()
    for s in found:
        for begin, p in s.find(text):
            spans.append((begin, begin + len(p) - 1))
            items |= s.items[p]
    if not spans:
        return [], items
    blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    merged: list[list[int]] = []
    for a, b in sorted(spans):
        first, last = int(np.searchsorted(blanks, a)), int(np.searchsorted(blanks, b))
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return [(a, b) for a, b in merged], items


def _parts(benchmark: DataFrame, part_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in lists of bounded size; a very long item is cut in overlapping pieces."""
    rows = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    held, size, piece = [], 0, 4096
    for item, text in rows.toLocalIterator(prefetchPartitions=False):
        found = normal(bytes(text) if text is not None else None).split()
        for i in range(0, max(1, len(found) - WINDOW + 1) if found else 0, piece):
            part = b" " + b" ".join(found[i : i + piece + WINDOW - 1]) + b" "
            held.append((item, part))
            size += len(part)
            if size >= part_bytes:
                yield held
                held, size = [], 0
    if held:
        yield held


def _pass(pieces, before: bool) -> Callable:
    """A mapInArrow function that adds what these pieces hit to what was hit ``before``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = searchers(pieces.value)
        for batch in batches:
            n_words, spans, items = [], [], []
            old_spans = batch.column("_spans").to_pylist() if before else None
            old_items = batch.column("_items").to_pylist() if before else None
            texts = batch.column("_text").cast(pa.binary())
            for i, value in enumerate(texts):
                text = normal(value.as_py())
                n_words.append(max(0, text.count(b" ") - 1))
                s, k = hits(text, found) if text else ([], set())
                if before:
                    s, k = s + [tuple(x) for x in old_spans[i]], k | set(old_items[i])
                spans.append(_merged(s))
                items.append(sorted(x for x in k if x is not None))
            kept = [batch.column(c) for c in batch.schema.names if c not in ("_spans", "_items", "_words")]
            names = [c for c in batch.schema.names if c not in ("_spans", "_items", "_words")]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(n_words, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*names, "_words", "_spans", "_items"],
            )

    return search


def _merged(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def search(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` (with a column ``_text``) and _words, _spans and _items of each row."""
    spark, before, out = docs.sparkSession, False, docs
    for part in _parts(benchmark, part_bytes):
        if before:
            out = stored(out, "decontaminate-part")
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
        schema = ", ".join([*fields, "_words long, _spans array<array<long>>, _items array<string>"])
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast(part), before), schema)
        before = True
    if not before:
        none = [F.array().cast("array<array<long>>").alias("_spans"), F.array().cast("array<string>").alias("_items")]
        counted = F.coalesce(F.regexp_count("_text", F.lit(WORD)), F.lit(0)).cast("long").alias("_words")
        out = docs.select("*", counted, *none)
    return out


#: Fixed value: what a word is, as a pattern.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _hit():
    lengths = F.transform("_spans", lambda s: s[1] - s[0])
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def report(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: words, words hit, items found and whether it counts as contaminated."""
    found = search(pick(docs, "doc_id", "text").withColumnRenamed("text", "_text"), benchmark, part_bytes)
    n_hit = F.col("n_hit")
    return found.select(
        "doc_id", F.col("_words").alias("n_words"), _hit().alias("n_hit"), F.array_distinct("_items").alias("_items")
    ).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    columns = docs.columns
    plain = docs.toDF(*[f"_{i}" for i in range(len(columns))])
    found = search(plain.withColumn("_text", F.col(f"_{columns.index('text')}")), benchmark, part_bytes)
    kept = found.where(~((_hit() > 0) & (_hit() * SHARE >= F.col("_words"))))
    return kept.select([F.col(f"_{i}").alias(name) for i, name in enumerate(columns)])


def digest(items: list[str]) -> str:
    """What ``items_sha256`` holds for these items."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


#: The same rows in SQL: windows and runs of words meet by their joined words.
SQL = r"""
with doc_words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
item_windows as (
  select distinct item_id, least(13, len(w)) as size,
    array_to_string(w[i : i + least(13, len(w)) - 1], ' ') as run
  from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from item_words where len(w) > 0)),
sizes as (select distinct size from item_windows),
doc_runs as (
  select doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') as run
  from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from doc_words, sizes where len(w) >= size)),
found as (
  select doc_id, i, doc_runs.size as size, item_id
  from doc_runs join item_windows on doc_runs.run = item_windows.run and doc_runs.size = item_windows.size),
hit as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as p from found) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by encode(item)) as listed
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc_words d left join hit using (doc_id) left join items using (doc_id)
"""
