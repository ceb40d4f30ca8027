"""Collocations against a plain count of every n-gram, and against their SQL."""

import random
import re
from collections import Counter

import duckdb
import pytest

from permeate.llm import collocations
from tests.llm.data import documents, empty, prose


def plain(rows, least, top, order=4):
    freq, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = re.sub(r"[A-Z]", lambda m: m.group(0).lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, order + 1):
                for i in range(len(ws) - k + 1):
                    freq[lang, tuple(ws[i : i + k])] += 1
    cands = {(g, p): a for (g, p), a in freq.items() if 2 <= len(p) and a >= least}
    out = []
    for (g, p), a in cands.items():
        if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (h, q), b in cands.items() if h == g):
            continue
        cut = min(((2000000 * a) // (freq[g, p[:j]] + freq[g, p[j:]]), j) for j in range(1, len(p)))
        score, j = cut
        out.append((g, " ".join(p), a, freq[g, p[:j]], freq[g, p[j:]], n[g], score))
    rows_out = []
    for g in sorted({o[0] for o in out}):
        mine = sorted((o for o in out if o[0] == g), key=lambda o: (-o[6], -o[2], o[1].encode()))
        rows_out += [(g, r + 1, *o[1:]) for r, o in enumerate(mine[:top])]
    return sorted(rows_out)


def corpus(seed, count):
    draw = random.Random(seed)
    phrases = ["New York city", "on the other hand", "big data", "the river", "x y z w"]
    rows = []
    for i in range(count):
        bits = [prose(seed * 100 + i, draw.randrange(3, 30))]
        for _ in range(draw.randrange(0, 4)):
            bits.append(draw.choice(phrases))
        draw.shuffle(bits)
        rows.append((" ".join(bits) + draw.choice([".", ",", "\n", " ; ", ""]) + prose(i, 4), draw.choice(["en", "fr", None])))
    return rows


def got_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,top", [(3, 7), (5, 2000)])
def test_equals_plain_count(spark, least, top):
    rows = corpus(1, 120) + [(None, "en"), ("", None), ("A. B, C; D: E! F? G\rH\tI", "en"), ("été Été ÉTÉ été été", "fr")]
    docs = documents(spark, [(i, t, g, "s") for i, (t, g) in enumerate(rows)])
    assert got_of(collocations.collocations(docs, least=least, top=top)) == plain(rows, least, top)


def test_equals_sql(spark, tmp_path):
    rows = corpus(2, 400)
    docs = documents(spark, [(i, t, g, "s") for i, (t, g) in enumerate(rows)])
    path = str(tmp_path / "documents.parquet")
    docs.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    want = sorted(tuple(r) for r in con.execute(collocations.SQL).fetchall())
    got = got_of(collocations.collocations(docs))
    assert got == want and len(got) > 0
    assert got == plain(rows, collocations.LEAST, collocations.TOP)


def test_awkward_and_empty_tables(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(documents(spark), least=2).count() >= 0


def test_pairs_with_rare_words_are_left_out_before_the_shuffle(spark):
    rows = [(0, "big data " * 4 + "rare1 big rare2 data", "en", "s"), (1, "\t big data\t", "en", "s")]
    pieces = collocations._words(documents(spark, rows))
    assert sorted(r.ws[0] for r in pieces.collect()) == ["big", "big"]
    _, vocabulary, salt = collocations.vocabulary_of(pieces, 3)
    assert {r.word for r in vocabulary.collect()} == {"big", "data"}
    got = collocations.frequent_pairs(pieces, vocabulary, salt, 1)
    assert got.count() == 2  # big data, data big; none with a rare word


def test_windows_with_a_rare_second_pair_are_left_out_before_the_shuffle(spark):
    rows = [(i, f"big data once{i}. on the other hand", "en", "s") for i in range(5)]
    pieces = collocations._words(documents(spark, rows))
    _, vocabulary, salt = collocations.vocabulary_of(pieces, 1)
    number = {r.word: r.no for r in vocabulary.collect()}
    assert sorted(number.values()) == list(range(len(number)))
    pairs = collocations.frequent_pairs(pieces, vocabulary, salt, 3)
    assert {(r.a_no, r.b_no, r.f) for r in pairs.collect()} == {
        (number[a], number[b], 5) for a, b in [("big", "data"), ("on", "the"), ("the", "other"), ("other", "hand")]
    }
    got = collocations.windows(pieces, pairs, salt, len(number))
    assert {tuple(r) for r in got.collect()} == {
        tuple(number.get(w) for w in window) + (5,) for window in [("on", "the", "other", "hand"), ("the", "other", "hand", None)]
    }


@pytest.mark.parametrize("order", [2, 3, 5])
def test_other_orders_without_broadcasts_equal_plain_count(spark, monkeypatch, order):
    monkeypatch.setattr(collocations, "BROADCAST_ROWS", -1)
    rows = corpus(3, 60) + [("x y z w v " * 4, None)]
    docs = documents(spark, [(i, t, g, "s") for i, (t, g) in enumerate(rows)])
    assert got_of(collocations.collocations(docs, order=order, least=3)) == plain(rows, 3, 2000, order)
