"""Operators that judge each document."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest

from permeate.llm import decontaminate, editprint, langid, lm, mixing, quality, sharding
from tests.llm.data import crc, documents, empty, prose

LETTERS = {"en": "the ing shon wether", "fr": "que eau ment oux", "de": "sch ung keit ein"}


def spoken(lang, seed, n):
    import random

    draw, parts = random.Random(seed), LETTERS[lang].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(n))


def test_language(spark):
    rows = [(i, spoken(lang, i, 60), lang, "s") for i in range(90) for lang in [sorted(LETTERS)[i % 3]]]
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "12 -- 34", "en", "s"), (203, "•••", None, "s"), (None, spoken("fr", 5, 40), "fr", "s")]
    rows += [(204, spoken("de", 7, 20000), "de", "s"), (205, "文字", None, "s")]
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in langid.predictions(docs).collect()}
    want = {i: g for i, _, g, _ in rows}
    assert all(got[i].lang_pred == want[i] for i in [*range(90), 204, None])
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (200, 201, 202, 203))
    assert got[205].lang_pred in LETTERS
    assert all(0 <= r.score <= 1 and r.held_out == (i is not None and crc(i) % 4 == 2) for i, r in got.items())
    kept = langid.known(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(got) - {200, 201, 202, 203}
    assert langid.predictions(empty(spark)).count() == 0
    unlearned = documents(spark, [(1, "some words", None, "s")])
    assert [r.lang_pred for r in langid.predictions(unlearned).collect()] == ["und"]


def phrases(text, learned):
    """Greedy longest matches, counted by searching."""
    n, i = 0, 0
    while i < len(text):
        k = i + 1
        while k <= len(text) and text[i:k] in learned:
            k += 1
        n, i = n + 1, k
    return n


def test_phrases_are_longest_matches():
    parser = langid.Parser({"a": b"the water the weather", "b": b"le beau bateau"})
    texts = [b"the beau water", b"", b"weather", b"zz the", b"the wea" * 300]
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.cumsum([0, *map(len, texts)])
    got = parser.phrases(data, at)
    for i, t in enumerate(texts):
        stretches = [t[a : a + langid.STRETCH] for a in range(0, len(t), langid.STRETCH)]
        for k, learned in enumerate((b"the water the weather", b"le beau bateau")):
            assert got[i, k] == sum(phrases(s, learned) for s in stretches)


def hit_by_hand(text, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = lambda t: re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        v = words(t)
        size = min(13, len(v))
        runs = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if size and tuple(w[i : i + size]) in runs:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("part_bytes", [decontaminate.PART_BYTES, 150])
def test_decontamination(spark, part_bytes):
    items = [(1, prose(50, 30)), (2, "Under, GREEN light"), (3, None), (4, "--"), (10, prose(51, 13)), (1, prose(50, 30)), (12, "él x")]
    rows = [(i, prose(i, 40), "en", "s") for i in range(12)]
    rows += [
        (20, f"{prose(60, 20)} {prose(50, 30)} {prose(61, 200)}", "en", "s"),
        (21, prose(50, 30).upper().replace(" ", "--"), "en", "s"),
        (22, " ".join(prose(50, 30).split()[5:20]) + " Under green_light under greenlight", "en", "s"),
        (23, None, "en", "s"),
        (24, "", "en", "s"),
        (25, " ".join([prose(51, 13)] * 3), "en", "s"),
        (26, "ÉL x él x", "en", "s"),
        (27, f"{prose(62, 20000)} {prose(51, 13)}", "en", "s"),
    ]
    docs, bench = documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.report(docs, bench, part_bytes).collect()}
    for i, t, *_ in rows:
        n, hit, found = hit_by_hand(t, items)
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found)), i
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert r.contaminated == (hit > 0 and 20 * hit >= n)
    kept = decontaminate.clean(docs, bench, part_bytes)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.contaminated}


def test_decontamination_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.report(documents(spark), bench).collect()}
    assert not any(r.contaminated for r in got.values()) and got[103].n_words == 2
    assert decontaminate.report(empty(spark), bench).count() == 0


def test_language_model_counts(spark):
    docs = documents(spark)
    got = lm.scores(docs).collect()
    tokens = {}
    counts = Counter()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]
        tokens[i, t] = w
        if i is not None and crc(i) % 10:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    text = {i: t for i, t in rows}
    for r in got:
        w = tokens[r.doc_id, text[r.doc_id]]
        want = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)
        assert r.score <= 0 and r.held_out == (r.doc_id is not None and crc(r.doc_id) % 10 == 0)
    assert lm.scores(empty(spark)).count() == 0


def test_language_model_is_a_mixture(spark):
    """Scores against a model counted by hand, under the weights that were learned."""
    rows = [(i, prose(i % 7, 25), "en", "s") for i in range(30)]
    docs = documents(spark, rows)
    learned = []
    whole = lm.learn_weights
    lm.learn_weights = lambda bins, known: learned.append((bins, whole(bins, known))) or learned[-1][1]
    try:
        got = {r.doc_id: r.score for r in lm.scores(docs).collect()}
    finally:
        lm.learn_weights = whole
    bins, weights = learned[0]
    one, two, starts = Counter(), Counter(), 0
    seq = {i: [*t.split(), None] for i, t, *_ in rows}
    train = [i for i in seq if crc(i) % 10]
    for i in train:
        one.update(seq[i])
        two.update(zip(["<s>", *seq[i][:-1]], seq[i], strict=True))
        starts += 1
    n, v = sum(one.values()), len(one)
    assert sum(k for _, k in bins) == n
    assert np.allclose(weights.sum(1), 1) and (weights[:, 2] > 0).all()
    for i, w in seq.items():
        total = 0.0
        for h, x in zip(["<s>", *w[:-1]], w, strict=True):
            context = starts if h == "<s>" else one[h]
            k = weights[min(int(math.log2(context + 1)), lm.BUCKETS - 1)]
            total += math.log10(k[0] * (two[h, x] / context if context else 0) + k[1] * one[x] / n + k[2] / (v + 1))
        assert math.isclose(got[i], total, rel_tol=1e-9)


def test_em_finds_the_weights_that_made_the_counts():
    first, second = (lm._bin(np.array([p]))[0] + 1024 for p in (0.5, 0.0))
    high = (5 << 40) | (int(first) << 20) | int(lm._bin(np.array([0.25]))[0] + 1024)
    low = (5 << 40) | (int(second) << 20) | int(lm._bin(np.array([0.25]))[0] + 1024)
    weights = lm.learn_weights([(high, 600), (low, 400)], 10**6)[5]
    w = np.linspace(0, 1, 2001)
    best = w[np.argmax(600 * np.log(w * 0.5 + (1 - w) * 0.25) + 400 * np.log((1 - w) * 0.25 + 1e-12))]
    assert abs(weights[0] - best) < 0.02


def test_fingerprints(spark):
    docs = documents(spark)
    rows = sorted([(r.doc_id is None, r.doc_id or 0, r.text or "") for r in docs.collect()])
    got = editprint.fingerprints(docs).collect()
    assert len(got) == len(rows)
    want = Counter()
    for k, (null, i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][2]
        q = len(t) // 4
        changed = t[: len(t) - q] + following[:q]
        want[None if null else i, len(t), hashlib.sha256(changed.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    assert by_id[104].fingerprint == by_id[3].fingerprint == by_id[None].fingerprint
    assert by_id[100].fingerprint == by_id[101].fingerprint and by_id[100].near_edited == by_id[100].near_next == 1
    long = [r for r in got if r.n_chars > 100 and r.doc_id != 107]
    assert all(0.6 < r.near_edited < 0.95 for r in long if r.doc_id is not None and r.doc_id < 99)
    assert editprint.fingerprints(empty(spark)).count() == 0
    one = editprint.fingerprints(documents(spark, [(1, "abcdefgh", "en", "s")])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one[0].near_next == 1


def test_fingerprints_follow_edit_distance():
    text = prose(4, 400)
    near = []
    for edits in (0, 5, 20, 80):
        w = text.split()
        for k in range(edits):
            w.insert(k * 5 % len(w), "q")
        found = editprint.prints([editprint.classes(text), editprint.classes(" ".join(w))])
        near.append(editprint.likeness(found.take([0]), found.take([1]))[0])
    assert near[0] == 1 and near[0] > near[1] > near[2] > near[3]


@pytest.mark.parametrize("header, share", [(10, 0.8), (20, 0.7), (40, 0.3)])
def test_a_header_before_a_long_text_is_one_edit(header, share):
    texts = [prose(60 + i, 3600)[:20000] for i in range(20)]
    headed = [prose(800 + i, 20)[:header] + t for i, t in enumerate(texts)]
    found = editprint.prints([editprint.classes(t) for t in [*texts, *headed]])
    own, near = found.take(slice(0, 20)), found.take(slice(20, None))
    assert (editprint.likeness(own, near) >= editprint.ALIKE).mean() > share
    assert editprint.likeness(own.take(slice(0, 19)), near.take(slice(1, None))).max() < 0.4


def test_walks_read_whole_texts_whoever_goes_beside_them():
    draw = np.random.default_rng(5)
    texts = [editprint.classes(prose(i, int(draw.integers(1, 900)))) for i in range(20)] + [editprint.classes(""), editprint.classes("a")]
    beside = editprint._walk(texts)
    for i, t in enumerate(texts):
        alone = editprint._walk([t])
        for walk in range(editprint.WALKS):
            wrote, k = beside[walk][i], 0
            assert np.array_equal(alone[walk][0], wrote)
            for step, symbol in enumerate(wrote.tolist()):
                assert symbol == t[k]
                k += editprint._COINS[step % editprint.COINS, walk, symbol]
            assert k == len(t)


def test_quality(spark):
    rows = [(i, prose(i, 60) if i % 2 else prose(i, 60).upper().replace(" ", "!! "), "en", "s") for i in range(300)]
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (None, prose(1, 20), "en", "s"), (902, prose(2, 20000), "en", "s")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.scores(docs, labels).collect()}
    assert sum(got[i].predicted == i % 2 for i in range(300)) >= 295
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[900].score == got[901].score and got[902].predicted == 1
    assert all(r.held_out == (i is not None and crc(i) % 5 == 0) for i, r in got.items())
    again = {r.doc_id: r.score for r in quality.scores(docs, labels).collect()}
    assert again == {i: r.score for i, r in got.items()}
    none = labels.where("false")
    assert {r.score for r in quality.scores(docs, none).collect()} == {0.5}
    assert quality.scores(empty(spark), none).count() == 0


def test_chunks_cover_every_byte():
    data = np.arange(2000, dtype=np.uint64).astype(np.uint8)
    for sizes in ([0, 1, 512, 513, 974], [2000]):
        at = np.cumsum([0, *sizes])
        found, first = quality.chunks(data, at)
        assert len(first) == len(sizes) and found.shape[1] == quality.CHUNK
        step = quality.CHUNK - quality.OVERLAP
        for i, n in enumerate(sizes):
            end = first[i + 1] if i + 1 < len(first) else len(found)
            seen = np.concatenate([row[: step if k + 1 < end else None] for k, row in enumerate(found[first[i] : end], first[i])])
            assert seen[:n].tolist() == data[at[i] : at[i + 1]].tolist() and (seen[n:] == 256).all()


def test_mix(spark):
    docs = documents(spark)
    got = mixing.documents_mixed(docs).collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += len((r.text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        open_ -= over
    source = {(r.doc_id, r.text): r.source for r in docs.collect()}
    taken = Counter()
    for r in got:
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.target] += r.taken
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in target.values()}
    assert len(source) == len({(r.doc_id, r.text) for r in docs.collect()})
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in mixed.collect())
    assert words == sum(r.taken for r in got)
    assert mixing.documents_mixed(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0
    blank = documents(spark, [(1, None, "en", None), (2, "", "en", "a")])
    assert [(r.size, r.target, r.taken) for r in mixing.documents_mixed(blank).collect()] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("hot", [0, 40, 300])
def test_shards(spark, hot):
    rows = [(i, prose(i % 150, 20), "en", "s") for i in range(400)] + [(1000 + i, "hot text", "en", "s") for i in range(hot)]
    rows += [(None, None, "en", "s"), (1, prose(1, 20), "en", "s"), (1, prose(1, 20), "en", "s")]
    docs = documents(spark, rows)
    got = sharding.documents_sharded(docs).collect()
    assert len(got) == len(rows)
    per = Counter(r.shard for r in got)
    assert set(per) == set(range(8)) and max(per.values()) - min(per.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(per[s]))
    groups = {}
    for r in got:
        groups.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    small = [g for k, g in groups.items() if k[1] != 9]
    assert sum(len(g) == 1 for g in small) >= 0.8 * len(small)
    if hot:
        hot_group = next(g for k, g in groups.items() if k[1] == 9)
        assert len(hot_group) <= math.ceil(hot / (len(rows) // 8)) + 2
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_shards_of_few_rows(spark):
    assert sharding.documents_sharded(empty(spark)).count() == 0
    got = sharding.documents_sharded(documents(spark, [(1, "a", "en", "s"), (2, "a", "en", "s"), (3, None, "en", "s")])).collect()
    assert sorted(r.size for r in got) == [1, 2, 2] and all(r.slot == 0 for r in got)


def test_language_hands_rows_on_in_small_parts(monkeypatch):
    pa = pytest.importorskip("pyarrow")
    monkeypatch.setattr(langid, "PARSE_BYTES", 100)
    texts = ["a" * 40, None, "b" * 40, "", "c" * 300, "d" * 40, "e" * 40]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(langid._parts(batch, 1))
    assert [r for p in parts for r in p.column(1).to_pylist()] == texts
    assert len(parts) > 2 and all(len(p) == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 100 for p in parts)
