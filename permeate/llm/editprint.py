"""Document fingerprints by randomised edit embedding.

All texts share random walks: at each step the walk writes the character under it and, by a coin
that depends on step and character alone, goes on or stays. Two texts that differ by few edits
fall into step again after each of them, so edit distance becomes Hamming distance of what was
written. ``WALKS`` walks, each with its own coins, go through the whole text until it is read, about
two steps a character; the fingerprint is a sample of ``SLOTS`` written characters, as many of each
walk. Which place a slot takes depends on its walk's number of steps by consistent hashing, so walks
of nearly one length take nearly the same places. The likeness of two fingerprints is the share of
slots with equal place and character.

``near_links`` bands the samples: texts that agree in all slots of a band meet, and are linked if
their whole fingerprints are alike enough.

Defined cases: a null text is an empty one; two empty texts are alike (1), an empty and another
text are not (0); rows without an id come last in order; rows of one id are ordered by their text;
a single row is its own next one; an empty table gives an empty result; other columns are ignored.
Characters are code points, told apart by 255 classes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.llm.graph import linked
from permeate.llm.tables import parts, pick, stored

SLOTS = 256
WALK_CHARS = 4 << 20
#: How soon texts fall into step again is luck; more walks even it out.
WALKS = 4
#: Coins repeat after so many steps, far more than two texts are apart when they fall into step again.
COINS = 4096
#: Steps between two looks at which walks have ended.
BLOCK = 256
#: So few walks are made one by one.
FEW = 16
#: Bands of so many slots each; texts of likeness 0.7 meet in one of them in 994 of 1,000 cases.
BAND = 6
ALIKE = 0.7
_LONGEST = 1 << 44


def _places() -> np.ndarray:
    """Per slot the places it moves to as texts get longer (jump consistent hashing)."""
    draw = np.random.default_rng(20)
    at, rows = np.zeros(SLOTS), []
    while (at < _LONGEST).any():
        rows.append(np.minimum(at, _LONGEST))
        at = np.floor((at + 1) / draw.random(SLOTS))
    return np.array(rows, np.float64).T.astype(np.int64).copy()


_PLACES = _places()
_COINS = np.random.default_rng(21).integers(0, 2, (WALKS, COINS, 256)).transpose(1, 0, 2).copy()  # step, walk, character
_COINS[:, :, 0] = 0  # behind the end the walk stays


def classes(text: str) -> np.ndarray:
    """A number from 1 to 255 for each code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return (points % 255 + 1).astype(np.uint8)


def _sampled(lengths: np.ndarray) -> np.ndarray:
    """Texts x slots: the place of each slot in what its walk writes, from the steps of each walk; -1: none."""
    n = np.repeat(lengths, SLOTS // WALKS, 1)
    at = np.stack([row[np.maximum(np.searchsorted(row, n[:, i]) - 1, 0)] for i, row in enumerate(_PLACES)], 1)
    return at * (n > 0) - (n == 0)


def _walk(texts: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Per walk and text what the walk writes, from its first step until the text is read.

    Walks go side by side; what is read drops out at the end of a block. The last ``FEW`` go on one
    by one, so that a text much longer than the others costs its own length only.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    text = np.concatenate([x for t in texts for x in (t, np.zeros(1, np.uint8))])
    ends = np.tile(np.cumsum(sizes + 1) - 1, WALKS)
    at = ends - np.tile(sizes, WALKS)
    lanes = np.flatnonzero(at < ends)
    coins = _COINS.reshape(COINS, -1)
    step, wrote = 0, [[] for _ in ends]
    while len(lanes) > FEW:
        block, here, table = np.empty((BLOCK, len(lanes)), np.uint8), at[lanes], lanes // len(texts) * 256
        for row in block:
            np.take(text, here, out=row, mode="clip")
            here += coins[step % COINS].take(table + row)
            step += 1
        at[lanes] = here
        for lane, column in zip(lanes.tolist(), np.ascontiguousarray(block.T), strict=True):
            wrote[lane].append(column)
        lanes = lanes[here < ends[lanes]]
    moves = _COINS.transpose(1, 0, 2).astype(np.uint8)
    for lane in lanes.tolist():
        own = text[int(at[lane]) : int(ends[lane]) + 1].tobytes()
        move = moves[lane // len(texts)].tobytes()
        k, coin, out = 0, step % COINS << 8, bytearray()
        while symbol := own[k]:
            out.append(symbol)
            k += move[coin | symbol]
            coin += 256
            if coin == COINS << 8:
                coin = 0
        wrote[lane].append(np.frombuffer(bytes(out), np.uint8))
    done = []
    for columns in wrote:
        whole = np.concatenate(columns) if columns else np.empty(0, np.uint8)
        done.append(whole[: np.count_nonzero(whole)])  # behind the end a walk writes 0
    return [done[w * len(texts) : (w + 1) * len(texts)] for w in range(WALKS)]


class Prints:
    """Fingerprints of some texts: symbols (texts x slots) and the lengths of their walks."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        self.symbols, self.lengths = symbols, lengths

    def take(self, at) -> Prints:
        return Prints(self.symbols[at], self.lengths[at])

    def strings(self) -> list[str]:
        return [f"{','.join(map(str, n))}:{base64.b64encode(s.tobytes()).decode()}" for n, s in zip(self.lengths.tolist(), self.symbols, strict=True)]


def likeness(one: Prints, two: Prints) -> np.ndarray:
    same = (_sampled(one.lengths) == _sampled(two.lengths)) & (one.symbols == two.symbols)
    return same.mean(1)


def read_prints(strings: list[str]) -> Prints:
    pairs = [s.split(":") for s in strings]
    symbols = [np.frombuffer(base64.b64decode(p[1]), np.uint8) for p in pairs]
    return Prints(np.stack(symbols) if symbols else np.zeros((0, SLOTS), np.uint8), np.array([p[0].split(",") for p in pairs], np.int64).reshape(-1, WALKS))


def prints(texts: list[np.ndarray]) -> Prints:
    """Fingerprints of texts given as classes."""
    wrote = _walk(texts) if texts else [[]] * WALKS
    lengths = np.array([list(map(len, w)) for w in wrote], np.int64).T
    places = _sampled(lengths).reshape(len(texts), WALKS, -1)
    symbols = np.zeros(places.shape, np.uint8)
    for w, i in zip(*np.nonzero(lengths.T), strict=True):
        symbols[i, w] = wrote[w][i][places[i, w]]
    return Prints(symbols.reshape(len(texts), SLOTS), lengths)


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the first characters, as many, of the next text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


_DONE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_SQL_DONE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_EDGE = pa.schema([("part", pa.int32()), ("first_text", pa.string()), ("last_id", pa.int64()), ("last_text", pa.string())])
_SQL_EDGE = "part int, first_text string, last_id long, last_text string"


def _judged(ids: list, texts: list[str], nexts: list[str]) -> pa.RecordBatch:
    """Rows of ``texts``, each with the text that follows it."""
    own, changed = list(map(classes, texts)), [edited(a, b) for a, b in zip(texts, nexts, strict=True)]
    n = len(texts)
    # Mostly a text's next one is the next row's; only others are walked for their own sake.
    alone = [b for i, b in enumerate(nexts) if i + 1 == n or b is not texts[i + 1]]
    at, k = [], 2 * n
    for i, b in enumerate(nexts):
        own_row = i + 1 < n and b is texts[i + 1]
        at.append(i + 1 if own_row else k)
        k += not own_row
    made = prints([*own, *map(classes, changed), *map(classes, alone)])
    mine, theirs = made.take(slice(0, n)), made.take(slice(n, 2 * n))
    columns = [
        pa.array(ids, pa.int64()),
        pa.array(list(map(len, texts)), pa.int64()),
        pa.array([hashlib.sha256(c.encode("utf-8", "surrogatepass")).hexdigest() for c in changed]),
        pa.array(mine.strings()),
        pa.array(theirs.strings()),
        pa.array(likeness(mine, theirs)),
        pa.array(likeness(mine, made.take(np.array(at, np.int64)))),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=_DONE)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range of ids: all but the last one's results, and the range's two edges."""
    part = TaskContext.get().partitionId()
    ids: list = []
    texts: list[str] = []
    first, size = None, 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            first = text if first is None else first
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= WALK_CHARS and len(ids) > 1:
                yield _with_edge(_judged(ids[:-1], texts[:-1], texts[1:]), None)
                ids, texts, size = ids[-1:], texts[-1:], len(text)
    if len(ids) > 1:
        yield _with_edge(_judged(ids[:-1], texts[:-1], texts[1:]), None)
    if ids:
        edge = pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, first, ids[-1], texts[-1]), _EDGE, strict=True)], schema=_EDGE)
        yield _with_edge(None, edge)


def _with_edge(done, edge) -> pa.RecordBatch:
    n = len(done) if done is not None else len(edge)
    left = list(done.columns) if done is not None else [pa.nulls(n, f.type) for f in _DONE]
    right = list(edge.columns) if edge is not None else [pa.nulls(n, f.type) for f in _EDGE]
    return pa.RecordBatch.from_arrays([*left, *right], names=[*_DONE.names, *_EDGE.names])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            yield _judged(*(batch.column(c).to_pylist() for c in ("last_id", "last_text", "next_text")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The query's rows: fingerprints of every text and its edited text, and their likeness.

    Rows are dealt by ranges of ids once; only the last row of a range needs another range's
    first text. Those edges are one row per range.
    """
    spark = docs.sparkSession
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = [F.col("doc_id").asc_nulls_last()]
    lined = plain.repartitionByRange(parts(spark), *keys).sortWithinPartitions(*keys, "text")
    held = stored(lined.mapInArrow(_in_order, f"{_SQL_DONE}, {_SQL_EDGE}"), "fingerprints")
    edges = held.where("part is not null").select(_EDGE.names)
    numbers = sorted(r.part for r in edges.select("part").collect())  # one per range
    after = spark.createDataFrame(list(zip(numbers, numbers[1:] + numbers[:1], strict=True)), "part int, after int")
    firsts = edges.select(F.col("part").alias("after"), F.col("first_text").alias("next_text"))
    pairs = edges.join(F.broadcast(after), "part").join(firsts, "after").select("last_id", "last_text", "next_text")
    inner = held.where("part is null").select(_DONE.names)
    return inner.unionByName(pairs.mapInArrow(_across, _SQL_DONE))


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = read_prints(batch.column(1).to_pylist())
        used = SLOTS // BAND * BAND
        both = np.stack([_sampled(found.lengths), found.symbols.astype(np.int64)], 2)[:, :used]
        both = both.reshape(len(found.lengths), -1, BAND * 2)
        keys = [hashlib.blake2b(row.tobytes() + bytes([b]), digest_size=8).digest() for doc in both for b, row in enumerate(doc)]
        nodes = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), both.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(keys), np.int64)), pa.array(nodes, pa.int64())], names=["key", "node"])


def near_links(found: DataFrame, alike: float = ALIKE) -> DataFrame:
    """fingerprint rows (doc_id, fingerprint) -> links (a, b) that connect all texts whose
    fingerprints meet in a band and are ``alike``; equal fingerprints are one node, its smallest id."""
    nodes = found.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    nodes = stored(nodes, "print-nodes")
    meeting = stored(nodes.select("node", "fingerprint").mapInArrow(_banded, "key long, node long"), "print-bands")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (read_prints(batch.column(c).to_pylist()) for c in ("one", "two"))
            yield batch.filter(pa.array(likeness(one, two) >= alike)).select(["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        left = nodes.select(F.col("node").alias("a"), F.col("fingerprint").alias("one"))
        right = nodes.select(F.col("node").alias("b"), F.col("fingerprint").alias("two"))
        return pairs.join(left, "a").join(right, "b").mapInArrow(close, "a long, b long")

    return linked(meeting, verify)
