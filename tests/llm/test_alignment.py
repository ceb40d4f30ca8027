"""Alignment of two tokenizers against pairs of overlapping byte ranges found by plain loops."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from permeate.llm import alignment
from tests.llm.data import documents, empty, prose

A = f"{alignment.TOKENIZERS}/{alignment.A_FILE}"
B = f"{alignment.TOKENIZERS}/{alignment.B_FILE}"


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    """Per text (ids, links, cuts) by plain loops, or None; and the pair counts over all texts."""
    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment._byte_alphabet()
    out, docs = [], Counter()
    for t in texts:
        if not t:
            out.append(None)
            continue
        a = a_tok.encode(" " + t, add_special_tokens=False).ids
        b = b_tok.encode(t)
        a_bytes = [bytes(letters[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            out.append(None)
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        links = [(a[i], b[j]) for i, x in enumerate(sa) for j, y in enumerate(sb) if x[0] < y[1] and y[0] < x[1]]
        ends = {x[1] for x in sa} & {y[1] for y in sb}
        groups, ga, gb = [], [], []
        ia = ib = 0
        for e in sorted(ends):
            ga = [a[i] for i in range(ia, len(a)) if sa[i][1] <= e]
            gb = [b[j] for j in range(ib, len(b)) if sb[j][1] <= e]
            ia, ib = ia + len(ga), ib + len(gb)
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        out.append((a, b, links, ";".join(groups), len(ends)))
        docs.update(set(links))
    return out, docs


def want_rows(ids, texts):
    found, docs = plain(texts)
    top = {}
    for (x, _), c in docs.items():
        top[x] = max(top.get(x, 0), c)
    rows = []
    for i, f in zip(ids, found, strict=True):
        if f is None:
            rows.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, groups, n_groups = f
        rows.append((i, len(a), len(b), n_groups, len(links), sum(docs[p] == top[p[0]] for p in links),
                     sum(docs[p] for p in links), hashlib.sha256(groups.encode()).hexdigest()))
    return sorted(rows, key=repr)


TEXTS = [
    "Hello  world\t\r\nx", "été 文字 🙂 ok", "<s> </s> <unk> <|endoftext|> plain", "  leading and trailing  ",
    "tabs\tand\x0bcontrols\x01here", prose(3, 200), prose(4, 200), "a", "Hello world", "Hello world",
]


def test_report_equals_plain_loops(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(50, None, "en", "s"), (51, "", None, None)]
    got = sorted((tuple(r) for r in alignment.alignment_report(documents(spark, rows)).collect()), key=repr)
    assert got == want_rows([r[0] for r in rows], [r[1] for r in rows])


def test_lockstep_of_many_documents_at_once():
    a = [np.array([1, 3, 4, 9]), np.array([2]), np.array([5, 6])]
    b = [np.array([2, 4, 6, 9]), np.array([1, 2]), np.array([6])]
    ld, la, lb, cd, ca, cb = alignment.lockstep(a, b)
    assert list(zip(ld.tolist(), la.tolist(), lb.tolist())) == [
        (0, 0, 0), (0, 1, 0), (0, 1, 1), (0, 2, 1), (0, 3, 2), (0, 3, 3),
        (1, 0, 0), (1, 0, 1), (2, 0, 0), (2, 1, 0)]
    assert list(zip(cd.tolist(), ca.tolist(), cb.tolist())) == [(0, 2, 1), (0, 3, 3), (1, 0, 1), (2, 1, 0)]


def test_awkward_rows_and_empty_table(spark):
    out = alignment.alignment_report(documents(spark)).collect()
    assert len(out) == documents(spark).count()
    assert all(r.groups_sha256 == "" for r in out if r.doc_id in (100, 101))
    assert alignment.alignment_report(empty(spark)).count() == 0


def test_long_texts_in_segments_equal_whole_encoding(monkeypatch):
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        vocab = alignment.Vocabularies(f.read(), g.read())
    texts = [prose(8, 3000) + "  double\tspaces \n new line 's 12 34 !!", "x" * 5000, " lead " + prose(9, 500)]
    monkeypatch.setattr(alignment, "PIECE", 97)
    assert len(alignment.cut(texts[0])) > 20
    got = vocab.encode(texts)
    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    for t, g in zip(texts, got, strict=True):
        assert g is not None
        assert g[0].tolist() == a_tok.encode(" " + t, add_special_tokens=False).ids
        assert g[1].tolist() == b_tok.encode(t)


def test_segments_encoded_once_equal_whole_encoding(monkeypatch):
    """Few segments a call, a small store that starts anew, short lanes: the tokens stay those of the whole text."""
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        vocab = alignment.Vocabularies(f.read(), g.read())
    monkeypatch.setattr(alignment, "CALL", 3)
    monkeypatch.setattr(alignment, "KEPT", 40)
    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    texts = [*TEXTS, "a▁ b c", "nbsp  x  y z", "x" * 50 + " \n y  z"]
    for turn in range(3):
        got = vocab.encode(texts + [prose(20 + turn, 60)] * 2)
        assert len(vocab.kept) <= 40
        for t, g in zip(texts, got, strict=False):
            if "▁" in t:
                assert g is None
                continue
            assert g[0].tolist() == a_tok.encode(" " + t, add_special_tokens=False).ids
            assert g[1].tolist() == b_tok.encode(t)


def test_a_repeated_word_is_encoded_once():
    with open(A, encoding="utf-8") as f, open(B, "rb") as g:
        vocab = alignment.Vocabularies(f.read(), g.read())
    asked, real = [], vocab.b

    class Spy:
        def encode(self, x, **more):
            asked.append(x)
            return real.encode(x, **more)

    vocab.b = Spy()
    found = vocab.encode(["stone river " * 500 + "end"])[0]
    assert found[1].tolist() == real.encode("stone river " * 500 + "end")
    vocab.encode(["river stone"])
    assert sum(len(" ".join(x) if isinstance(x, list) else x) for x in asked) < 100


def test_lanes_do_not_change_links(monkeypatch):
    rng = np.random.default_rng(5)
    sides = [[np.append(np.flatnonzero(rng.random(900) < 0.4), 900) for _ in range(6)] for _ in "ab"]
    whole = alignment.lockstep(*sides)
    monkeypatch.setattr(alignment, "LANE", 7)
    assert len(alignment._lanes(sides[0][0], sides[1][0])) > 10
    for x, y in zip(whole, alignment.lockstep(*sides), strict=True):
        assert x.tolist() == y.tolist()
