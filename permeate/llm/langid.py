"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of labelled text. A text is parsed against it greedily: a
phrase is the longest match at the place reached, and the byte after it. Texts of the language
need few, long phrases. The number of phrases times the bits of an address in the labelled text,
per symbol, is the cross entropy; the language needing least wins, ties going to the first name.

Text becomes symbols first: ASCII letters in lower case, bytes of 128 and above as they are,
everything else a blank, blanks in a row as one. Parsing starts anew every ``STRETCH`` symbols, so
that all stretches of many texts are walked side by side in one table look-up per symbol.

Labelled rows are those whose crc32(doc_id) mod 4 is not 2, with a language. What is learned from
is bounded by documented parameters: per language, of about ``SAMPLE_DOCS`` documents of least
hash, the ``DOC_BYTES`` bytes from a place that the hash gives, ``LANG_BYTES`` together at most.

Defined cases: a null text, or one without letters, is ``und`` with score 0; so is every text when
no language was learned; rows without an id are scored and never learned from; other columns are
ignored by ``predictions`` and kept by ``known``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import pick
from permeate.llm.words import flat, pieces

UNKNOWN = "und"
STRETCH = 1024
SAMPLE_DOCS = 128
DOC_BYTES = 512
LANG_BYTES = 32 << 10
#: Bytes of text parsed, and rows handed on, at once; a longer text is a piece of its own.
PARSE_BYTES = 2 << 20

_SYMBOL = np.full(256, 32, np.uint8)
_SYMBOL[128:] = np.arange(128, 256)
for _c in range(26):
    _SYMBOL[65 + _c] = _SYMBOL[97 + _c] = 97 + _c
_LETTER = re.compile(r"[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some rows, blanks in a row as one, and the n + 1 places where rows begin."""
    begin = int(offsets[0])
    out = _SYMBOL[data[begin : int(offsets[-1])]]
    rows = offsets - begin
    keep = out != 32
    if len(out):
        keep[1:] |= out[:-1] != 32
        firsts = rows[:-1][rows[:-1] < len(out)]
        keep[firsts] = out[firsts] != 32  # no blank at the beginning of a row
    at = np.zeros(len(out) + 1, np.int32 if len(out) < 1 << 31 else np.int64)
    np.cumsum(keep, out=at[1:])
    return out[keep], at[rows].astype(np.int64)


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """The transitions of the smallest automaton of all substrings of ``text``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            onward = moves[state][symbol]
            if length[onward] == length[state] + 1:
                link[new] = onward
            else:
                split = len(moves)
                moves.append(dict(moves[onward]))
                length.append(length[state] + 1)
                link.append(link[onward])
                link[onward] = link[new] = split
                while state >= 0 and moves[state].get(symbol) == onward:
                    moves[state][symbol] = split
                    state = link[state]
        last = new
    return moves


class Parser:
    """The automata of all languages in one table: (state, symbol class) -> state and phrase end.

    A move that the automaton lacks leads to its start and ends a phrase (the lowest bit).
    """

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts, key=str.encode)
        used = sorted({b for t in texts.values() for b in t})
        self.classes = np.zeros(256, np.uint8)  # 0: a symbol that no language has
        self.classes[used] = np.arange(1, len(used) + 1)
        self.width = len(used) + 1
        tables, self.starts, first = [], [], 0
        for name in self.languages:
            moves = suffix_automaton(texts[name])
            start = first * self.width
            filled = np.full((len(moves), self.width), (start << 1) | 1, np.int32)
            for state, out in enumerate(moves):
                for symbol, to in out.items():
                    filled[state, self.classes[symbol]] = ((first + to) * self.width) << 1
            tables.append(filled.ravel())
            self.starts.append(start)
            first += len(moves)
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        # Bits to name a place of the labelled text.
        self.bits = np.array([math.log2(len(texts[n]) + 1) for n in self.languages])

    def phrases(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows x languages: phrases needed; the last, unfinished phrase of a stretch counts as one."""
        sizes = np.diff(at)
        per_row = -(-sizes // STRETCH)
        row = np.repeat(np.arange(len(sizes)), per_row)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        begin = at[:-1][row] + nth * STRETCH
        length = np.minimum(STRETCH, at[1:][row] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length, row = begin[order], length[order], row[order]
        classes = self.classes[found]
        total = np.zeros((len(sizes), len(self.languages)))
        # Of all lanes, those of at least k + 1 symbols walk step k.
        lanes = np.searchsorted(-length, -np.arange(1, (int(length[0]) if len(length) else 0) + 1), side="right")
        for k, start in enumerate(self.starts):
            state = np.full(len(row), start, np.int32)
            count = np.zeros(len(row), np.int32)
            value = np.empty(len(row), np.int32)
            for step, n in enumerate(lanes.tolist()):
                v = np.take(self.table, state[:n] + classes[begin[:n] + step], out=value[:n])
                count[:n] += v & 1
                np.right_shift(v, 1, out=state[:n])
            count += state != start
            total[:, k] = np.bincount(row, weights=count, minlength=len(sizes))
        return total

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the language's index (-1: none) and the score: how much fewer bits it needs
        than the next best."""
        n = len(offsets) - 1
        best, score = np.full(n, -1), np.zeros(n)
        if not self.languages:
            return best, score
        found, at = symbols(data, offsets)
        sizes = np.diff(at)
        bits = self.phrases(found, at) * self.bits / np.maximum(sizes, 1)[:, None]
        some = sizes > 0
        best[some] = np.argmin(bits[some], axis=1)
        if len(self.languages) == 1:
            score[some] = 1.0
        else:
            two = np.sort(bits[some], axis=1)[:, :2]
            score[some] = 1.0 - two[:, 0] / np.maximum(two[:, 1], 1e-12)
        return best, np.clip(score, 0.0, 1.0)


def learn(docs: DataFrame) -> Parser:
    """Automata of the labelled rows' languages, from a sample bounded per language."""
    rows = pick(docs, "doc_id", "lang", "text").where("doc_id is not null and lang is not null")
    rows = rows.where(~held_out(F.col("doc_id")))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    counts = dict(rows.groupBy("lang").count().collect())  # one row per language
    if not counts:
        return Parser({})
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int((1 << 30) * min(1.0, SAMPLE_DOCS / n)))])
    drawn = rows.where(spread <= F.element_at(limits, F.col("lang"))).where("length(text) > 0")
    # From a place that the hash gives, whole if the text is short.
    room = F.greatest(F.length("text") - DOC_BYTES, F.lit(0)) + 1
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), room).cast("int") + 1
    part = F.col("text").substr(place, F.lit(DOC_BYTES))
    sample = drawn.select("lang", spread.alias("h"), "doc_id", part.alias("part"))
    texts: dict[str, bytearray] = {}
    for row in sorted(sample.collect(), key=lambda r: (r.h, r.doc_id)):
        data = np.frombuffer(row.part.encode(), np.uint8)
        found, _ = symbols(data, np.array([0, len(data)]))
        held = texts.setdefault(row.lang, bytearray())
        if len(held) < LANG_BYTES:
            held += found.tobytes()[: LANG_BYTES - len(held)]
    return Parser({k: bytes(v) for k, v in texts.items() if v})


def _judged(batch: pa.Array, parser: Parser) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    data, offsets = flat(batch)
    best, score = np.full(len(batch), -1), np.zeros(len(batch))
    for i, j in pieces(offsets, PARSE_BYTES):
        best[i:j], score[i:j] = parser.predict(data, offsets[i : j + 1])
        # Symbols of 128 and above need not be letters; look at texts that have no ASCII letter.
        found = _SYMBOL[data[offsets[i] : offsets[j]]] - np.uint8(97) < 26
        letters = np.concatenate([[0], np.cumsum(found, dtype=np.int32)])[offsets[i : j + 1] - offsets[i]]
        for k in (i + np.flatnonzero((np.diff(letters) == 0) & (best[i:j] >= 0))).tolist():
            if not _LETTER.search(data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")):
                best[k], score[k] = -1, 0.0
    names = [*parser.languages, UNKNOWN]
    return [names[k] for k in best.tolist()], score


def _parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about PARSE_BYTES of text in column ``at``: what is made of them stays small."""
    sizes = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
    for i, j in pieces(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), PARSE_BYTES):
        yield batch.slice(i, j - i)
    pa.default_memory_pool().release_unused()


def _broadcast(docs: DataFrame):
    return docs.sparkSession.sparkContext.broadcast(learn(docs))  # bounded by the sample


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    parser = _broadcast(docs)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole, 2)):
            names, score = _judged(batch.column(2), parser.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def known(docs: DataFrame) -> DataFrame:
    """The documents whose language is told; those without text or letters go. All columns stay."""
    parser = _broadcast(docs)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole, at)):
            names, _ = _judged(batch.column(at), parser.value)
            yield batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    plain = docs.toDF(*[f"_{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
