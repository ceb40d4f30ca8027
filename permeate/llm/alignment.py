"""Cross-tokenizer alignment: which tokens of one vocabulary cover which of another.

Tokenizer A (a byte-level BPE, ``A_FILE``) encodes a space followed by the text; tokenizer B (a
sentencepiece BPE with byte fallback, ``B_FILE``, which adds the space itself) encodes the text.
Special tokens are never added, and their strings inside texts are plain text.  A token's bytes
are, for A, its vocabulary entry decoded from the byte-level alphabet, and for B its piece in
UTF-8 with U+2581 read as a space, or the byte HH of a ``<0xHH>`` fallback piece.  Where the
joined bytes of either side are not exactly those of space + text, and for null and empty texts,
a document has no tokens and all its figures are 0 (``groups_sha256`` is then '').

Byte offsets where an A token and a B token both end cut both sequences into groups; a link is a
pair of an A and a B token occurrence whose byte ranges overlap.  Links and cuts come from
lockstep vectorised merging: one NumPy state vector holds the A and B pointers of every document
of a batch (long documents are several lanes, begun where tokens of both sides end); each step
emits the link of every lane still running, records a cut where both tokens end together,
advances the pointer(s) whose token ends first, and compacts away the lanes that have finished.  An (A id, B id) pair's count is the number of documents (rows)
in the whole table that hold it linked; ``n_best`` counts the links whose pair count is the
highest of their A id's pairs (ties included), ``count_sum`` sums the pair counts over links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
import os
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.llm.tables import BROADCAST_ROWS, pick, stored

#: Where the vocabulary files are; a parameter, the files are read once on the driver and shipped.
TOKENIZERS = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.json"
#: Least code points of a segment; texts are cut at the next word start. 1: a segment is one word.
PIECE = 1
#: Different segments encoded in one call.
CALL = 512
#: Segments seen twice in a slice whose tokens a worker keeps for its next slices; when more, it starts anew.
KEPT = 1 << 17
#: Tokens of A that a lane of the lockstep holds, to the next place where tokens of both sides end.
LANE = 1024
#: Code points of text merged in one lockstep; the steps of a slice are those of its longest text.
SLICE = 1 << 22
B_FILE = "piece_bpe_32k.model"

_WORD_START = re.compile(r"(?<=\S) (?=\S)")

_SHAPE = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair_a array<int>, pair_b array<int>, pair_m array<long>"
)


def _byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 + n in byte order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, extra = {}, 0
    for b in range(256):
        if b in shown:
            letters[chr(b)] = b
        else:
            letters[chr(256 + extra)] = b
            extra += 1
    return letters


class Vocabularies:
    """Both tokenizers and the byte length of every token id, built once per process."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = _byte_alphabet()
        self.a_bytes = []
        for i in range(self.a.get_vocab_size()):
            token = self.a.id_to_token(i) or ""
            self.a_bytes.append(bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode())
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.b_bytes.append(b"")  # never equal to text: such a document has no tokens
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode("utf-8"))
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.a_blob = np.frombuffer(b"".join(self.a_bytes), np.uint8)
        self.b_blob = np.frombuffer(b"".join(self.b_bytes), np.uint8)
        self.a_start = np.cumsum(self.a_len) - self.a_len
        self.b_start = np.cumsum(self.b_len) - self.b_len
        self._forget()

    def _forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.laid = tuple((np.zeros(0, np.int64),) * 3 for _ in "ab")

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Per text, the A ids and the B ids, or None where the text has no tokens.

        A text is encoded in segments cut before a blank that follows a non-blank and precedes a
        non-blank: both tokenizers start a token there (A's pre-tokens begin with such a blank,
        B splits at it), so the tokens are those of the whole text; the joined bytes are checked.
        A segment that comes again in these texts is encoded once.
        """
        out: list = [None] * len(texts)
        parts = {i: cut(t) for i, t in enumerate(texts) if t}
        if not parts:
            return out
        number, different = pd.factorize(np.array([x for p in parts.values() for x in p], dtype=object))
        place, (a_ids, a_from, a_many), (b_ids, b_from, b_many) = self._looked_up(different, np.bincount(number) > 1)
        number, end = place[number], 0
        for i, p in parts.items():
            begin, end = end, end + len(p)
            own = number[begin:end]
            a, b = _spelled(a_ids, a_from, a_many, own), _spelled(b_ids, b_from, b_many, own)
            target = (" " + texts[i]).encode("utf-8")
            if int(self.a_len[a].sum()) != len(target) or int(self.b_len[b].sum()) != len(target):
                continue
            wanted = np.frombuffer(target, np.uint8)
            if not (np.array_equal(_spelled(self.a_blob, self.a_start, self.a_len, a), wanted)
                    and np.array_equal(_spelled(self.b_blob, self.b_start, self.b_len, b), wanted)):
                continue
            out[i] = (a, b)
        return out

    def _looked_up(self, segments: np.ndarray, again: np.ndarray) -> tuple:
        """The place of each segment, and for A and for B: the ids of all places one after another,
        where each begins, how many it has. Segments that come ``again`` are kept, up to ``KEPT``."""
        place = np.array([self.kept.get(x, -1) for x in segments.tolist()], np.int64)
        new = np.flatnonzero(place < 0)
        new = np.concatenate([new[again[new]], new[~again[new]]])  # those to keep come first
        first = len(self.laid[0][1])
        place[new] = np.arange(first, first + len(new))
        names = segments[new].tolist()
        joined = tuple(_appended(old, more) for old, more in zip(self.laid, self._segments(names), strict=True))
        keep = int(again[new].sum())
        if first + keep > KEPT:
            self._forget()
        else:
            self.kept.update(zip(names[:keep], range(first, first + keep), strict=True))
            self.laid = tuple(_first_of(side, first + keep) for side in joined)
        return (place, *joined)

    def _segments(self, segments: list[str]) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """For A and for B: the ids of ``segments`` one after another, where each begins, how many it has.

        Segments without blanks at their ends are encoded ``CALL`` at a time, joined by the blanks
        that segments stand for, and told apart by their byte lengths.
        """
        size = np.fromiter(map(len, map(str.encode, segments)), np.int64, len(segments)) + 1
        firm = np.fromiter(map(str.__eq__, segments, map(str.strip, segments)), bool, len(segments))
        held = np.flatnonzero(firm)
        runs = [held[at : at + CALL] for at in range(0, len(held), CALL)] + list(np.flatnonzero(~firm)[:, None])

        def laid(encode, length: np.ndarray) -> tuple[np.ndarray, ...]:
            begin, many, found, before = np.zeros_like(size), np.zeros_like(size), [np.zeros(0, np.int64)], 0
            for run in runs:
                some = [segments[i] for i in run.tolist()]
                ids = encode(" ".join(some))
                ends, wanted = np.cumsum(length[ids]), np.cumsum(size[run])
                last = np.searchsorted(ends, wanted)
                if len(ends) and ends[-1] == wanted[-1] and np.array_equal(ends[last], wanted):
                    many[run] = np.diff(last, prepend=-1)
                else:  # bytes that the tokens do not give back; such texts have no tokens
                    each = [encode(x) for x in some]
                    many[run] = [len(x) for x in each]
                    ids = np.concatenate(each)
                begin[run] = before + np.cumsum(many[run]) - many[run]
                before += len(ids)
                found.append(ids)
            return np.concatenate(found), begin, many

        return (
            laid(lambda x: np.array(self.a.encode(" " + x, add_special_tokens=False).ids, np.int64), self.a_len),
            laid(lambda x: np.array(self.b.encode(x), np.int64), self.b_len),
        )


def _appended(old: tuple[np.ndarray, ...], more: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Both tables of segments (ids, begin, how many) as one."""
    begin = np.concatenate([old[1], more[1] + len(old[0])])
    return np.concatenate([old[0], more[0]]), begin, np.concatenate([old[2], more[2]])


def _first_of(side: tuple[np.ndarray, ...], n: int) -> tuple[np.ndarray, ...]:
    """A table of the first ``n`` segments alone."""
    ids, begin, many = side[0], side[1][:n], side[2][:n]
    return _spelled(ids, begin, many, np.arange(n)), np.cumsum(many) - many, many.copy()


def _spelled(blob: np.ndarray, start: np.ndarray, length: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """What ``blob`` holds for ``ids`` one after another: bytes of tokens, or tokens of segments."""
    lens = length[ids]
    before = np.cumsum(lens) - lens
    return blob[np.arange(int(lens.sum())) - np.repeat(before - start[ids], lens)]


def cut(text: str, piece: int | None = None) -> list[str]:
    """``text`` in segments of about ``piece`` code points; from the second on, each stands for
    the blank before it, which is left out (both tokenizers put it back as a word start)."""
    piece = piece or PIECE
    if piece == 1:
        found = text.split(" ")
        plain = all(found) and all(map(str.__eq__, found, map(str.strip, found)))
        return found if plain else _WORD_START.split(text)
    out, start = [], 0
    while len(text) - start > piece:
        found = _WORD_START.search(text, start + piece)
        if found is None:
            break
        out.append(text[start : found.start()])
        start = found.start() + 1
    out.append(text[start:])
    return out


@lru_cache(maxsize=2)
def _vocabularies(a_json: str, b_model: bytes) -> Vocabularies:
    return Vocabularies(a_json, b_model)


def _lanes(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places (of an A and a B token) where lanes of a document begin: after ends that both sides
    share, so no link crosses them."""
    out, at = [(0, 0)] if len(a) else [], LANE
    while at < len(a):
        near = a[at - 1 : at - 1 + LANE]
        place = np.searchsorted(b, near)
        shared = np.flatnonzero(b[np.minimum(place, len(b) - 1)] == near)
        if shared.size and at + shared[0] < len(a):
            at += int(shared[0])
            out.append((at, int(place[shared[0]]) + 1))
        at += LANE
    return out


def lockstep(a_ends: list[np.ndarray], b_ends: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Links and cuts of many documents at once.

    ``a_ends``/``b_ends`` hold per document the byte offsets where its tokens end (both ending at
    the same length).  Returns (link_doc, link_a, link_b, cut_doc, cut_a, cut_b): token places
    within their document, for every link, and for every cut the last A and B token before it.
    """
    na = np.array([len(x) for x in a_ends], np.int64)
    nb = np.array([len(x) for x in b_ends], np.int64)
    oa, ob = np.concatenate([[0], np.cumsum(na)]), np.concatenate([[0], np.cumsum(nb)])
    fa = np.concatenate(a_ends) if a_ends else np.zeros(0, np.int64)
    fb = np.concatenate(b_ends) if b_ends else np.zeros(0, np.int64)
    begun = [(k, oa[k] + i, ob[k] + j) for k, (a, b) in enumerate(zip(a_ends, b_ends, strict=True)) for i, j in _lanes(a, b)]
    lane_doc, pa, pb = (np.array(x, np.int64) for x in zip(*begun, strict=True)) if begun else (np.zeros(0, np.int64),) * 3
    stop = np.append(pa[1:], len(fa))  # lanes lie one after another
    act = np.arange(len(pa))
    links, cuts = [], []
    while act.size:
        ea, eb = fa[pa], fb[pb]
        links.append((act, pa, pb))
        same = ea == eb
        if same.any():
            cuts.append((act[same], pa[same], pb[same]))
        pa, pb = pa + (ea <= eb), pb + (eb <= ea)
        live = pa < stop[act]
        if not live.all():
            act, pa, pb = act[live], pa[live], pb[live]

    def flat(parts):
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        d, x, y = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(d, kind="stable")  # by lane, in step order within one
        d, x, y = lane_doc[d[order]], x[order], y[order]
        return d, x - oa[d], y - ob[d]

    return (*flat(links), *flat(cuts))


_KNOWN = 1 << 17
#: Ids below _KNOWN in decimal, followed by ",", by "|" and by ";".
_NAMES = np.array([f"{i}{mark}" for mark in ",|;" for i in range(_KNOWN)], dtype=object)


def groups_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: the ids of every group, groups in order (laid out by place, not by loops)."""
    if not len(a):
        return ""
    many_a, many_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    # Before an A token lie the B tokens of earlier groups, before a B token the A tokens up to its group.
    place_a = np.arange(len(a)) + np.repeat(np.cumsum(many_b) - many_b, many_a)
    place_b = np.arange(len(b)) + np.repeat(np.cumsum(many_a), many_b)
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    mark_a[cut_a], mark_b[cut_b] = 1, 2
    ids, marks = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
    ids[place_a], ids[place_b] = a, b
    marks[place_a], marks[place_b] = mark_a, mark_b
    if int(ids.max()) < _KNOWN:
        return "".join(_NAMES[marks * _KNOWN + ids].tolist())[:-1]
    return "".join(f"{i}{',|;'[m]}" for i, m in zip(ids.tolist(), marks.tolist(), strict=True))[:-1]


def _aligner(a_json, b_model):
    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        vocab = _vocabularies(a_json.value, b_model.value)
        for whole in batches:
            for batch in _slices(whole):
                yield _aligned_slice(vocab, batch)

    return align


def _slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of about SLICE code points of text together; a longer text is a slice of its own."""
    sizes = np.array([len(t) if isinstance(t, str) else 0 for t in batch["text"]], np.int64)
    start, n = 0, len(batch)
    while start < n:
        end, held = start + 1, sizes[start]
        while end < n and held + sizes[end] <= SLICE:
            held += sizes[end]
            end += 1
        yield batch.iloc[start:end].reset_index(drop=True)
        start = end


def _aligned_slice(vocab: Vocabularies, batch: pd.DataFrame) -> pd.DataFrame:
    """The figures and linked id pairs of the rows of one slice, merged in lockstep."""
    texts = [None if t is None or (isinstance(t, float)) else t for t in batch["text"]]
    encoded = vocab.encode(texts)
    seen = [i for i, e in enumerate(encoded) if e is not None]
    a_ends = [np.cumsum(vocab.a_len[encoded[i][0]]) for i in seen]
    b_ends = [np.cumsum(vocab.b_len[encoded[i][1]]) for i in seen]
    ld, la, lb, cd, ca, cb = lockstep(a_ends, b_ends)
    rows = len(texts)
    n_a, n_b, n_groups, n_links = (np.zeros(rows, np.int64) for _ in range(4))
    sha = [""] * rows
    pair_a, pair_b, pair_m = [[] for _ in range(rows)], [[] for _ in range(rows)], [[] for _ in range(rows)]
    link_at = np.searchsorted(ld, np.arange(len(seen) + 1))
    cut_at = np.searchsorted(cd, np.arange(len(seen) + 1))
    for k, i in enumerate(seen):
        a, b = encoded[i]
        n_a[i], n_b[i] = len(a), len(b)
        ks, ke, cs, ce = link_at[k], link_at[k + 1], cut_at[k], cut_at[k + 1]
        n_links[i], n_groups[i] = ke - ks, ce - cs
        sha[i] = hashlib.sha256(groups_text(a, b, ca[cs:ce], cb[cs:ce]).encode()).hexdigest()
        ids = a[la[ks:ke]] * (1 << 32) + b[lb[ks:ke]]
        pairs, m = np.unique(ids, return_counts=True)
        pair_a[i], pair_b[i], pair_m[i] = (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), m.astype(np.int64)
    return pd.DataFrame(
        {
            "doc_id": batch["doc_id"].astype("Int64"),
            "n_a": n_a,
            "n_b": n_b,
            "n_groups": n_groups,
            "n_links": n_links,
            "groups_sha256": sha,
            "pair_a": pair_a,
            "pair_b": pair_b,
            "pair_m": pair_m,
        }
    )


def aligned(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the linked id pairs (with how often
    each is linked) of every row; ``_row`` tells rows apart."""
    spark = docs.sparkSession
    with open(f"{folder}/{A_FILE}", encoding="utf-8") as f:
        a_json = spark.sparkContext.broadcast(f.read())
    with open(f"{folder}/{B_FILE}", "rb") as f:
        b_model = spark.sparkContext.broadcast(f.read())
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(plain.mapInPandas(_aligner(a_json, b_model), _SHAPE).withColumn("_row", F.monotonically_increasing_id()), "alignment")


def alignment_report(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per row."""
    per_doc = aligned(docs, folder)
    links = per_doc.select("_row", F.explode(F.arrays_zip("pair_a", "pair_b", "pair_m")).alias("p")).select(
        "_row", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"), F.col("p.pair_m").alias("m")
    )
    counts = links.groupBy("a", "b").agg(F.count("*").alias("docs"))
    rated = stored(counts.join(counts.groupBy("a").agg(F.max("docs").alias("top")), "a"), "alignment-pairs")
    side = F.broadcast(rated) if rated.count() <= BROADCAST_ROWS else rated
    sums = links.join(side, ["a", "b"]).groupBy("_row").agg(
        F.sum(F.col("m") * F.col("docs")).alias("count_sum"),
        F.sum(F.when(F.col("docs") == F.col("top"), F.col("m")).otherwise(0)).alias("n_best"),
    )
    return per_doc.join(sums, "_row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
