"""Duplicate operators against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from permeate.llm import editprint, graph, jaccard, lines
from tests.llm.data import documents, empty, prose


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    draw = random.Random(4)
    draw.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(edges, {x for e in edges for x in e})
    assert got == {n: c for n, c in want.items() if n != c}
    none = spark.createDataFrame([], "a long, b long")
    assert graph.components(none).count() == 0


@pytest.mark.parametrize("edges", [[(3, 1), (3, 2)], [(1, 9), (2, 9), (3, 8), (4, 8), (5, 8)], [(3, 1), (4, 1)]])
def test_components_where_no_link_follows_another(spark, edges):
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in union_find(edges, {x for e in edges for x in e}).items() if n != c}


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def changed(text, places, seed):
    w = text.split()
    for k in places:
        w[k] = f"new{seed}x{k}"
    return " ".join(w)


@pytest.fixture(scope="module")
def near(spark):
    """Copies of a few texts with one to six words changed, so that many pairs are near the limit."""
    draw, rows, base = random.Random(9), [], [prose(900 + i, 90 + 40 * i) for i in range(4)]
    for i in range(160):
        t = draw.choice(base)
        n = len(t.split())
        rows.append((i * 3 % 163, changed(t, draw.sample(range(n), draw.randrange(0, 7)), i), "en", "s"))
    rows += [(500 + i, f"short {i % 3} text", "en", "s") for i in range(6)]
    return documents(spark, rows), rows


def test_jaccard_components_are_those_of_all_pairs(near):
    docs, rows = near
    sets = {}
    for i, t, *_ in rows:
        sets[i] = shingles(t)
    ids = sorted(sets)
    pairs = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0
    ]
    want = union_find(pairs, ids)
    got = jaccard.classes(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}


def test_jaccard_awkward_rows(spark):
    docs = documents(spark)
    got = jaccard.classes(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[104].component_id == 3 and by_id[105].component_id == by_id[105].component_id
    assert [by_id[i].n_shingles for i in (100, 101, 102)] == [0, 0, 0]
    assert [by_id[i].component_id for i in (100, 101, 102)] == [100, 101, 102]
    assert by_id[None].component_id is None and by_id[None].n_shingles == by_id[3].n_shingles
    assert by_id[107].n_shingles == 1
    assert jaccard.classes(empty(spark)).count() == 0
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 104 not in ids and ids.count(None) == 1 and {100, 101, 102, 3} <= set(ids)


def test_one_row_of_a_repeated_id_stays(spark):
    docs = documents(spark, [(5, "one two three", "en", "a"), (5, "one two three", "en", "a"), (6, "other words here", "en", "a")])
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs).collect()) == [5, 6]


def line_set(norm):
    n = lines.SIZE
    return {norm[i : i + n] for i in range(len(norm) - n + 1)} if len(norm) >= n else {norm}


def test_line_dedup_finds_the_similar_lines(spark):
    draw, rows = random.Random(2), []
    base = [prose(i, 25) for i in range(30)]
    for d in range(25):
        text = []
        for _ in range(8):
            line = draw.choice(base) if draw.random() < 0.5 else prose(draw.randrange(10**6), 25)
            if draw.random() < 0.3:
                line = changed(line, [draw.randrange(25)], d)
            text.append(line)
        rows.append((d, "\n".join(text), "en", "s"))
    places = [(d, k, t.strip().lower()) for d, text, *_ in rows for k, t in enumerate(text.split("\n"))]
    sets = {norm: line_set(norm) for *_, norm in places}
    norms = sorted(sets)
    pairs = [
        (a, b) for i, a in enumerate(norms) for b in norms[i + 1 :] if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])
    ]
    label = union_find(pairs, norms)
    first = {}
    for d, k, norm in sorted(places):
        first.setdefault(label[norm], (d, k))
    kept = {(d, k) for d, k, norm in places if first[label[norm]] == (d, k)}
    got = {r.doc_id: r for r in lines.deduped(documents(spark, rows)).collect()}
    want = {d: [t for k, t in enumerate(text.split("\n")) if (d, k) in kept] for d, text, *_ in rows}
    wrong = sum(got[d].text.split("\n") != (w or [""]) for d, w in want.items())
    assert len(pairs) > 20 and wrong <= 1  # banding finds 997 of 1,000 pairs at the limit
    assert all(r.n_lines == 8 and r.n_kept == len([x for x in r.text.split("\n") if x]) for r in got.values())


def test_similar_lines_meet_whatever_was_edited(spark):
    draw, made = random.Random(6), {}

    def text(n, signs):
        return "".join(draw.choice(signs) for _ in range(n))

    letters, plain = "abcdefghijklmnopqrstuvwxyz   ", "bcdfghjklmnpqrstvwxyz"
    edits = {
        "front": lambda n: (t := text(n, letters).replace(" ", "e"), "b " + t),
        "last": lambda n: (t := text(n, letters).replace(" ", "e"), t[:-1] + "é"),
        "led in front": lambda n: (t := text(n, plain), "a" + t),
        "digits": lambda n: (
            (t := text(n - 9, plain)) + (d := text(9, "0123456789")),
            t + d[:-1] + "z",
        ),
        "digits ahead": lambda n: ("1" + (d := text(8, "0123456789")) + (t := text(n - 9, plain)), "x" + d + t),
    }
    for name, edit in edits.items():
        for n in (16, 24, 40, 90, 300):
            for _ in range(60):
                a, b = edit(n)
                x, y = line_set(a), line_set(b)
                if len(x & y) * 100 >= 80 * len(x | y):
                    made.setdefault((name, n), []).append((a, b))
    pairs = [(k, *p) for k, many in made.items() for p in many]
    rows = [(i, t, 0) for i, (_, *two) in enumerate(pairs) for t in two]
    signed = lines._signed(spark.createDataFrame([(i, k % 2, t) for k, (i, t, _) in enumerate(rows)], "doc_id long, place int, norm string"))
    keys = {}
    for r in signed.collect():
        keys.setdefault(r.doc_id, []).append({r[f"b{i}"] for i in range(lines.BANDS)})
    met = {}
    for i, (k, *_) in enumerate(pairs):
        met.setdefault(k, []).append(bool(keys[i][0] & keys[i][1]))
    short = {k: sum(v) / len(v) for k, v in met.items() if sum(v) < 0.95 * len(v)}
    assert len(met) > 12 and not short


def test_lines_that_share_a_passage_are_not_all_verified(spark, monkeypatch):
    draw = random.Random(8)
    passage = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(150))

    def own(n):
        return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    texts = [own(140) + passage + own(140) for _ in range(60)] + [passage + own(k % 9) for k in range(20)]
    asked, linked = [], graph.linked

    def counted(meeting, verify, *args, **kwargs):
        def counting(pairs):
            asked.append(pairs.count())
            return verify(pairs)

        return linked(meeting, counting, *args, **kwargs)

    monkeypatch.setattr(lines, "linked", counted)
    got = {r.doc_id: r.n_kept for r in lines.deduped(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    # The short ones are all similar; the long ones share 0.2 to 0.4 with others, and none goes.
    assert sorted(i for i, n in got.items() if n) == [*range(61)]
    assert sum(asked) < 200


def test_near_copies_about_the_limit_are_not_paired_in_full(spark, monkeypatch):
    draw = random.Random(12)
    passage = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))

    def near(n):
        at = draw.randrange(300 - n)
        return passage[:at] + "".join(draw.choice("0123456789") for _ in range(n)) + passage[at + n :]

    # Half are similar to most, half (of similarity 0.55 to 0.7 with the others) to none.
    texts = [near(draw.randrange(1, 12)) for _ in range(100)] + [near(draw.randrange(60, 70)) for _ in range(100)]
    texts = [t.strip() for t in texts]
    sets = [line_set(t) for t in texts]
    links = [
        (i, j) for i in range(200) for j in range(i + 1, 200) if len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j])
    ]
    label = union_find(links, range(200))
    asked, linked = [], graph.linked

    def counted(meeting, verify, *args, **kwargs):
        def counting(pairs):
            asked.append(pairs.count())
            return verify(pairs)

        return linked(meeting, counting, *args, **kwargs)

    monkeypatch.setattr(lines, "linked", counted)
    got = {r.doc_id: r.n_kept for r in lines.deduped(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    assert sorted(i for i, n in got.items() if n) == sorted({label[i] for i in range(200)})
    assert len(links) > 2000 and sum(asked) < 600


def test_signatures_of_repeats_are_those_of_their_sets(spark):
    rows = [(1, 0, "ab cd ef gh ij " * 40), (2, 0, "ab cd ef gh ij " * 900), (3, 0, "x" * 70000), (4, 0, "x" * 9)]
    got = {r.doc_id: [r[f"b{i}"] for i in range(lines.BANDS)] for r in lines._signed(spark.createDataFrame(rows, "doc_id long, place int, norm string")).collect()}
    assert got[1] == got[2] and got[3] == got[4] and got[1] != got[3]


def test_line_dedup_awkward_rows(spark):
    docs = documents(spark)
    got = lines.deduped(docs).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == docs.count()
    assert by_id[100].text is None and by_id[100].n_lines == 0
    assert by_id[101].text == "" and by_id[102].text == " \n\t " and by_id[102].n_kept == 0
    assert by_id[104].n_kept == 0 and by_id[3].n_kept == 1
    assert by_id[None].text == by_id[3].text
    assert by_id[107].n_kept == 1
    assert lines.deduped(empty(spark)).count() == 0


def test_near_fingerprints_are_linked(spark):
    rows = [(i, prose(i, 200), "en", "s") for i in range(12)]
    rows += [(50 + i, changed(prose(i, 200), [10, 60, 150], i), "en", "s") for i in range(12)]
    rows += [(80, prose(0, 200), "en", "s")]
    found = editprint.fingerprints(documents(spark, rows)).select("doc_id", "fingerprint")
    got = editprint.near_links(found).collect()
    rows = sorted(found.collect())
    prints = editprint.read_prints([r.fingerprint for r in rows])
    pairs = []
    for k, r in enumerate(rows):
        like = editprint.likeness(prints, prints.take([k] * len(rows)))
        pairs += [(r.doc_id, rows[j].doc_id) for j in range(k) if like[j] >= editprint.ALIKE]
    ids = [r.doc_id for r in rows]
    want, have = union_find(pairs, ids), union_find([(r.a, r.b) for r in got] + [(0, 80)], ids)
    assert len(set(want.values())) < 20 and have == want
    assert editprint.near_links(found.where(F.lit(False))).count() == 0
