"""Language-model scoring by deleted interpolation of word bigrams.

The probability of a token after another mixes three estimates: how often it follows that token,
how often it occurs, and an equal share for each known token and the unknown one. The weights
depend on the bucket (by powers of two) of the context's frequency and are learned by
expectation-maximisation on held-out counts: each training token is judged by the counts without
itself.

Counts cover all training documents and grow with them. Documents are dealt in blocks; a block
sends its distinct words and bigrams once, with their counts in the block, to fragments of the
hash order; a fragment sums them and sends the totals back to the blocks that asked, in the same
order; a block then has the counts of all its tokens. No table of counts is held whole anywhere.
To the driver come the number of tokens and of distinct tokens, and a histogram of held-out
counts whose bins are bounded (``BINS_AN_OCTAVE``); the EM runs on that.

Tokens: lower-cased words between blanks, then one end per document. Training documents are those
whose crc32(doc_id) mod 10 is not 0. Defined cases: a null text is an empty one (its end only); a
row without an id is scored and never learned from; repeated rows count and are scored each; with
no training document all counts are 0; an empty table gives an empty result; other columns are
ignored. Words and bigrams are known by 63-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import groups_for, pick, stored
from permeate.llm.words import SPACED, flat, pieces, words

BLOCK_BYTES = 6 << 20
FRAGMENT_BYTES = 8 << 20
ADDED = 0.1
BUCKETS = 20
BINS_AN_OCTAVE = 4
EM_ROUNDS = 50
LEAST_SHARE = 1e-6

_END, _START = np.uint64(0x9D39247E33776D41), np.uint64(0x2AF7398005AAA5C7)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers, their bytes by place, compressed."""
    planes = numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.copy()
    return zstandard.ZstdCompressor(1).compress(planes.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return planes.reshape(size, -1).T.copy().view(kind).ravel() if len(planes) else np.zeros(0, kind)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the n + 1 places where the rows' tokens begin."""
    data, offsets = flat(column)
    parts, sizes = [], []
    for i, j in pieces(offsets):
        found, at = words(data, offsets[i : j + 1], SPACED)
        parts.append(np.insert(found, at[1:], _END))
        sizes.append(np.diff(at) + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _asked(tokens: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct words and bigrams (odd numbers), and the place among them of each
    token's word, then of each token's bigram."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[at[:-1]] = _START
    pair = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (tokens + (before >> np.uint64(31)))
    pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    pair = pair ^ (pair >> np.uint64(32))
    one = np.uint64(1)
    return np.unique(np.concatenate([tokens & ~one, pair | one]), return_inverse=True)


def _bounds(items: np.ndarray, fragments: int) -> np.ndarray:
    of = (items >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)
    return np.searchsorted(of, np.arange(fragments + 1, dtype=np.uint64))


def _ask(fragments: int):
    """A block of documents -> per fragment its words and bigrams, with their training counts."""

    def ask(key, group):
        tokens, at = _tokens(group.column("text"))
        train = np.repeat(np.asarray(group.column("train").combine_chunks()).astype(np.int64), np.diff(at))
        items, where = _asked(tokens, at)
        counts = np.bincount(where, weights=np.concatenate([train, train]), minlength=len(items)).astype(np.uint32)
        bounds = _bounds(items, fragments)
        rows = []
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            part = items[bounds[k] : bounds[k + 1]]
            gaps = np.diff(part, prepend=np.uint64(0))
            rows.append((k, _pack(gaps), _pack(counts[bounds[k] : bounds[k + 1]])))
        k, gaps, counted = zip(*rows, strict=True)
        return pa.table(
            {
                "fragment": pa.array(k, pa.int32()),
                "block": pa.array([key[0].as_py()] * len(k), pa.int32()),
                "items": pa.array(gaps, pa.binary()),
                "counts": pa.array(counted, pa.binary()),
            }
        )

    return ask


def _answer(key, group):
    """A fragment -> per block the training counts of what it asked for; the first row also tells
    how many distinct words of the fragment occur in training."""
    asked = [np.cumsum(_unpack(x, np.uint64), dtype=np.uint64) for x in group.column("items").to_pylist()]
    counts = np.concatenate([_unpack(x, np.uint32) for x in group.column("counts").to_pylist()])
    every = np.concatenate(asked)
    order = np.argsort(every)
    ranked = every[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    total = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
    known = int(((total > 0) & ((ranked[new] & np.uint64(1)) == 0)).sum())
    answer = np.empty(len(every), np.int64)
    answer[order] = total[np.cumsum(new) - 1]
    ends = np.cumsum([len(x) for x in asked])
    packed = [_pack(x.astype(np.uint64)) for x in np.split(answer, ends[:-1])]
    return pa.table(
        {
            "block": group.column("block").combine_chunks(),
            "fragment": group.column("fragment").combine_chunks(),
            "totals": pa.array(packed, pa.binary()),
            "known": pa.array([known] + [0] * (len(packed) - 1), pa.int64()),
        }
    )


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("train", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("logs", pa.float64()),
        ("words", pa.binary()),
        ("pairs", pa.binary()),
        ("known", pa.int64()),
    ]
)
_SQL_SCORED = "doc_id long, held_out boolean, train boolean, n_tokens long, n_known long, logs double, words binary, pairs binary, known long"


def _read_back(key, docs, answers):
    """A block and its answers -> per document the counts of its words and bigrams, packed; and one
    row without tokens for the distinct words that the answers tell of."""
    order = np.argsort(np.asarray(answers.column("fragment").combine_chunks()))
    parts = answers.column("totals").to_pylist()
    totals = np.concatenate([_unpack(parts[i], np.uint64) for i in order.tolist()]).astype(np.int64)
    tokens, at = _tokens(docs.column("text"))
    _, where = _asked(tokens, at)
    of_words, of_pairs = totals[where[: len(tokens)]], totals[where[len(tokens) :]]
    logs = np.add.reduceat(np.log10(of_words + ADDED), at[:-1])
    seen = np.add.reduceat((of_words > 0).astype(np.int64), at[:-1])
    rows = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    n = len(rows)
    known = int(np.asarray(answers.column("known").combine_chunks()).sum())
    columns = {
        "doc_id": docs.column("doc_id").to_pylist() + [None],
        "held_out": docs.column("held_out").to_pylist() + [None],
        "train": docs.column("train").to_pylist() + [None],
        "n_tokens": np.append(np.diff(at), 0),
        "n_known": np.append(seen, 0),
        "logs": np.append(logs, 0.0),
        "words": [_pack(of_words[a:b].astype(np.uint64)) for a, b in rows] + [None],
        "pairs": [_pack(of_pairs[a:b].astype(np.uint64)) for a, b in rows] + [None],
        "known": np.append(np.zeros(n, np.int64), known),
    }
    return pa.table({k: pa.array(v, _SCORED.field(k).type) for k, v in columns.items()}, schema=_SCORED)


def counted(docs: DataFrame) -> DataFrame:
    """Per document the training counts of its tokens (see ``_SCORED``); written once."""
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = int(plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    blocks, fragments = groups_for(total, BLOCK_BYTES, 4), groups_for(total, FRAGMENT_BYTES, 4)
    out = held_out(F.col("doc_id"))
    dealt = plain.select(
        "doc_id",
        "text",
        out.alias("held_out"),
        (F.col("doc_id").isNotNull() & ~out).alias("train"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
    )
    asked = dealt.groupBy("block").applyInArrow(_ask(fragments), "fragment int, block int, items binary, counts binary")
    answers = asked.groupBy("fragment").applyInArrow(_answer, "block int, fragment int, totals binary, known long")
    both = dealt.groupBy("block").cogroup(answers.groupBy("block"))
    return stored(both.applyInArrow(_read_back, _SQL_SCORED), "lm-counts")


def _estimates(of_words, of_pairs, begins, tokens, known, less: int):
    """Bucket of the context and the two estimates of each token, ``less`` counts being deleted."""
    context = np.empty_like(of_words)
    context[1:] = of_words[:-1]
    context[begins] = of_words[np.append(begins[1:], len(of_words)) - 1]  # a start for each end
    context, pair, word = context - less, of_pairs - less, of_words - less
    first = np.where(context > 0, pair / np.maximum(context, 1), 0.0)
    bucket = np.minimum(np.log2(np.maximum(context, 0) + 1).astype(np.int64), BUCKETS - 1)
    return bucket, first, word / max(tokens - less, 1)


def _lanes(batch: pa.RecordBatch):
    of_words = [_unpack(x, np.uint64).astype(np.int64) for x in batch.column("words").to_pylist()]
    of_pairs = [_unpack(x, np.uint64).astype(np.int64) for x in batch.column("pairs").to_pylist()]
    ends = np.cumsum([len(x) for x in of_words])
    return np.concatenate(of_words), np.concatenate(of_pairs), np.concatenate([[0], ends[:-1]])


def _bin(p: np.ndarray) -> np.ndarray:
    """A probability's bin by size; 1 for 0."""
    return np.where(p > 0, np.round(np.log2(np.where(p > 0, p, 1.0)) * BINS_AN_OCTAVE), 1).astype(np.int64)


def _histogram(tokens: int, known: int):
    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bucket, first, second = _estimates(*_lanes(batch), tokens, known, 1)
                key = (bucket << 40) | ((_bin(first) + 1024) << 20) | (_bin(second) + 1024)
                keys, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["bin", "n"])

    return bins


def learn_weights(bins: list[tuple[int, int]], known: int) -> np.ndarray:
    """Bucket x (bigram, word, equal share): mixture weights by expectation-maximisation."""
    weights = np.tile([0.6, 0.35, 0.05], (BUCKETS, 1))
    weights[0] = [0.0, 0.9, 0.1]
    if not bins:
        return weights
    keys, n = (np.array(x, np.int64) for x in zip(*bins, strict=True))
    bucket, first, second = keys >> 40, ((keys >> 20) & 0xFFFFF) - 1024, (keys & 0xFFFFF) - 1024
    p = np.stack([np.where(x > 0, 0.0, 2.0 ** (x / BINS_AN_OCTAVE)) for x in (first, second)] + [np.full(len(keys), 1.0 / (known + 1))], 1)
    filled = np.bincount(bucket, weights=n, minlength=BUCKETS)
    for _ in range(EM_ROUNDS):
        share = weights[bucket] * p
        share *= (n / share.sum(1))[:, None]
        for k in range(3):
            weights[:, k] = np.where(filled > 0, np.bincount(bucket, weights=share[:, k], minlength=BUCKETS) / np.maximum(filled, 1), weights[:, k])
        weights[:, 2] = np.maximum(weights[:, 2], LEAST_SHARE)
        weights /= weights.sum(1, keepdims=True)
    for k in range(2, BUCKETS):  # a bucket without data is like the next lower one
        if not filled[k]:
            weights[k] = weights[k - 1]
    return weights


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    held = counted(docs)
    tokens, known = held.agg(F.sum(F.when(F.col("train"), F.col("n_tokens"))), F.sum("known")).first()
    tokens, known = int(tokens or 0), int(known or 0)
    packed = held.where("train").select("words", "pairs")
    bins = packed.mapInArrow(_histogram(tokens, known), "bin long, n long").groupBy("bin").agg(F.sum("n")).collect()
    weights = spark.sparkContext.broadcast(learn_weights([tuple(b) for b in bins], known))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                of_words, of_pairs, begins = _lanes(batch)
                bucket, first, second = _estimates(of_words, of_pairs, begins, tokens, known, 0)
                w = weights.value[bucket]
                p = w[:, 0] * first + w[:, 1] * second + w[:, 2] / (known + 1)
                total = np.add.reduceat(np.log10(p), begins)
                kept = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "logs")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(total)], names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "score"])

    rows = held.where("n_tokens > 0").select("doc_id", "held_out", "n_tokens", "n_known", "logs", "words", "pairs")
    done = rows.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double")
    each = float(np.log10(tokens + ADDED * (known + 1)))
    return done.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        "score",
    )
