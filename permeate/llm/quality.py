"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut in overlapping chunks that cover all of it. In each chunk learned filters
look at windows of ``WIDTH`` embedded bytes; each filter's highest answer in the chunk is kept.
Over the chunks of the text the highest and the mean answers are combined into one probability.

Learned from labelled rows whose crc32(doc_id) mod 5 is not 0, by Adam on the weighted log loss. The
sample is bounded by documented parameters: of each label about ``SAMPLE_DOCS`` documents of least
hash, of each at most ``SAMPLE_CHARS`` characters from a place that the hash gives. Classes are
weighted by their share of all labelled rows, so scores are near probabilities. Training is
seeded and gives the same model for the same rows.

Defined cases: a null or empty text is one chunk of padding and gets a score too; rows without
an id are scored and never learned from; an id labelled more than once counts with its least
label; without labels every score is 0.5, with one label only it is the smoothed share of ones;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import pick
from permeate.llm.words import flat, pieces

CHUNK, OVERLAP = 512, 32
WIDTH, STRIDE = 8, 2
DEPTH, FILTERS = 6, 24
PREDICT_FROM = 0.3
SAMPLE_DOCS = 1200
SAMPLE_CHARS = 8192
EPOCHS, BATCH, RATE = 8, 32, 0.01
SCORE_BYTES = 1 << 19
_PAD = 256
_WINDOWS = (CHUNK - WIDTH) // STRIDE + 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks x bytes, padded, of some rows, and where each row's chunks begin."""
    step = CHUNK - OVERLAP
    sizes = np.diff(offsets)
    per_row = np.maximum(1, -(-(sizes - OVERLAP) // step))
    first = np.cumsum(per_row) - per_row
    row = np.repeat(np.arange(len(sizes)), per_row)
    begin = offsets[:-1][row] + (np.arange(len(row)) - first[row]) * step
    at = begin[:, None] + np.arange(CHUNK)
    inside = at < offsets[1:][row][:, None]
    if not len(data):
        return np.full(at.shape, _PAD, np.int16), first
    return np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.int16), np.int16(_PAD)), first


class Network:
    """The learned numbers, and what is done with them."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.bytes = draw.normal(0, 0.5, (257, DEPTH)).astype(np.float32)
        self.bytes[_PAD] = 0
        self.filters = draw.normal(0, np.sqrt(2 / (WIDTH * DEPTH)), (WIDTH * DEPTH, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    def _windows(self, found: np.ndarray) -> np.ndarray:
        embedded = self.bytes[found]
        a, b, c = embedded.strides
        shape = (len(found), _WINDOWS, WIDTH * DEPTH)
        return np.lib.stride_tricks.as_strided(embedded, shape, (a, STRIDE * b, c)).reshape(-1, WIDTH * DEPTH)

    def answers(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks x filters: the highest answer and the window that gave it."""
        every = (self._windows(found) @ self.filters).reshape(len(found), _WINDOWS, FILTERS)
        place = every.argmax(1)
        top = np.take_along_axis(every, place[:, None], 1)[:, 0]
        return np.maximum(top + self.bias, 0), place

    def highest(self, found: np.ndarray) -> np.ndarray:
        every = (self._windows(found) @ self.filters).reshape(len(found), _WINDOWS, FILTERS)
        return np.maximum(every.max(1) + self.bias, 0)

    def combine(self, top: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text the combined answers and the probability."""
        n = np.diff(np.append(first, len(top)))
        both = np.concatenate([np.maximum.reduceat(top, first), np.add.reduceat(top, first) / n[:, None]], 1)
        return both, 1 / (1 + np.exp(-np.clip(both @ self.out + self.base, -30, 30)))

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found, first = chunks(data, offsets)
        tops = [self.highest(found[i : i + 512]) for i in range(0, len(found), 512)]
        return self.combine(np.concatenate(tops), first)[1].astype(np.float64)

    def gradients(self, found: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        top, place = self.answers(found)
        both, p = self.combine(top, first)
        n = np.diff(np.append(first, len(top)))
        text = np.repeat(np.arange(len(first)), n)
        fault = ((p - label) * weight / weight.sum()).astype(np.float32)
        back = fault[:, None] * self.out
        of_max = (top == both[text, :FILTERS]) * back[text, :FILTERS]
        d_top = (of_max + back[text, FILTERS:] / n[text][:, None]) * (top > 0)
        chunk, which = np.nonzero(d_top)
        d = d_top[chunk, which].astype(np.float32)
        at = place[chunk, which][:, None] * STRIDE + np.arange(WIDTH)
        seen = found[chunk[:, None], at]
        windows = self.bytes[seen].reshape(-1, WIDTH * DEPTH)
        d_filters = np.zeros_like(self.filters)
        for f in range(FILTERS):
            of = which == f
            d_filters[:, f] = d[of] @ windows[of]
        d_bytes = np.zeros_like(self.bytes)
        np.add.at(d_bytes, seen, (d[:, None] * self.filters.T[which]).reshape(-1, WIDTH, DEPTH))
        d_bytes[_PAD] = 0
        return [d_bytes, d_filters, d_top.sum(0), fault @ both, fault.sum(keepdims=True)]

    def train(self, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 8) -> None:
        parts = []
        for t in texts:
            data = np.frombuffer(t, np.uint8)
            parts.append(chunks(data, np.array([0, len(data)]))[0])
        draw, step = np.random.default_rng(seed), 0
        held = [self.bytes, self.filters, self.bias, self.out, self.base]
        mean, square = [np.zeros_like(x) for x in held], [np.zeros_like(x) for x in held]
        for epoch in range(EPOCHS):
            order = draw.permutation(len(texts))
            rate = RATE * (1 - epoch / EPOCHS)
            for i in range(0, len(order), BATCH):
                of = order[i : i + BATCH]
                found = np.concatenate([parts[k] for k in of])
                first = np.cumsum([0, *(len(parts[k]) for k in of[:-1])])
                step += 1
                for x, m, v, g in zip(held, mean, square, self.gradients(found, first, labels[of], weights[of]), strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    x -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list, dict[int, int]]:
    """Rows (label, text) of the bounded sample, in a fixed order, and the rows of each label."""
    marked = pick(labels, "doc_id", "quality").where("doc_id is not null and quality in (0, 1)")
    marked = marked.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {int(k): n for k, n in marked.groupBy("quality").count().collect()}
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    limit = F.lit(0)
    for k, n in counts.items():
        limit = F.when(F.col("quality") == k, int((1 << 30) * min(1.0, SAMPLE_DOCS / n))).otherwise(limit)
    drawn = marked.where(h <= limit)  # about SAMPLE_DOCS of each label, so small enough to broadcast
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), room).cast("int") + 1
    texts = pick(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = texts.select("doc_id", "quality", F.coalesce(F.col("text"), F.lit("")).substr(place, F.lit(SAMPLE_CHARS)).alias("part")).collect()
    return sorted((r.doc_id, r.quality, r.part or "") for r in rows), counts


def learn(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The trained network; a constant score where the labels do not differ."""
    rows, counts = sample(docs, labels)
    every = sum(counts.values())
    if len({q for _, q, _ in rows}) < 2:
        return (counts.get(1, 0) + 1) / (every + 2)
    label = np.array([q for _, q, _ in rows], np.float32)
    drawn = np.bincount(label.astype(int), minlength=2)
    weight = np.array([counts[q] / every / drawn[q] for _, q, _ in rows], np.float32) * len(rows)
    network = Network()
    network.train([t.encode("utf-8", "surrogatepass") for _, _, t in rows], label, weight)
    return network


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))  # some thousand numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.full(batch.num_rows, 0.5)
            if isinstance(model.value, float):
                p[:] = model.value
            else:
                data, offsets = flat(batch.column(2))
                for i, j in pieces(offsets, SCORE_BYTES):
                    p[i:j] = model.value.score(data, offsets[i : j + 1])
            guess = (p >= PREDICT_FROM).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array(guess)], names=["doc_id", "held_out", "score", "predicted"])

    rows = pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {id_type}, held_out boolean, score double, predicted int")
