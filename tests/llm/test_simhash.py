"""SimHash fingerprints and their links against plain loops over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from permeate.llm import simhash
from tests.llm.data import documents, empty, prose
from tests.llm.test_pairs import changed, union_find


def plain_fingerprint(text):
    lowered = re.sub(r"[A-Z]", lambda m: m.group(0).lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize(
    "text",
    [None, "", " \t\n", "one", "One two", "a b c", "The river RIVER river the", prose(1, 300), "été ÉTÉ x\x0by\x0cz", "w " * 5000],
)
def test_fingerprint_equals_plain_loop(text):
    assert simhash.fingerprint(text)[0] == plain_fingerprint(text)


def test_long_text_read_in_pieces_is_whole(monkeypatch):
    text = prose(5, 4000)
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text) == (plain_fingerprint(text), len(text.split()) - 2)


@pytest.mark.parametrize("tile", [3, 8192])
def test_links_are_all_pairs_within_the_radius(spark, tile):
    draw = random.Random(3)
    seeds = [draw.getrandbits(64) for _ in range(6)]
    values = []
    for _ in range(150):
        v = draw.choice(seeds)
        for b in draw.sample(range(64), draw.randrange(0, 6)):
            v ^= 1 << b
        values.append(v)
    values += [0, 1, 3, 7, (1 << 64) - 1]
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    prints = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {tuple(sorted(r)) for r in simhash.links(prints, tile=tile).collect()}
    distinct = sorted(set(signed))
    want = {
        tuple(sorted((a, b)))
        for k, a in enumerate(distinct)
        for b in distinct[k + 1 :]
        if bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3
    }
    assert got == want


def test_near_pairs_inside_one_tile():
    a = np.array(sorted([0, 1, 3, 255, 1 << 40], key=lambda v: (bin(v).count("1"), v)), np.int64)
    i, j = simhash.near_pairs(a, a, True)
    assert sorted(tuple(sorted(p)) for p in zip(a[i].tolist(), a[j].tolist(), strict=True)) == [(0, 1), (0, 3), (0, 1 << 40), (1, 3), (1, 1 << 40), (3, 1 << 40)]


def test_classes_equal_all_pairs(spark):
    draw, rows, base = random.Random(9), [], [prose(700 + i, 200 + 50 * i) for i in range(3)]
    for i in range(60):
        t = draw.choice(base)
        rows.append((i * 7 % 61, changed(t, draw.sample(range(len(t.split())), draw.randrange(0, 4)), i), "en", "s"))
    docs = documents(spark, rows + [(200, None, "en", "s"), (201, "", None, None), (202, "a b", "en", "s")])
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.classes(docs).collect()}
    texts = {i: t for i, t, *_ in rows + [(200, None), (201, ""), (202, "a b")]}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if bin(prints[a] ^ prints[b]).count("1") <= 3]
    top = union_find(pairs, ids)
    least = {}
    for i in ids:
        least[top[i]] = min(least.get(top[i], i), i)
    assert got == {(i, f"{prints[i]:016x}", least[top[i]]) for i in ids}
    assert prints[200] == prints[201] == 0


def test_awkward_rows(spark):
    out = simhash.classes(documents(spark)).collect()
    assert len(out) == documents(spark).count()
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[100][0].fingerprint == by_id[101][0].fingerprint == by_id[102][0].fingerprint == "0" * 16
    assert by_id[100][0].component_id == by_id[101][0].component_id == 100
    assert len(by_id[104]) == 2 and by_id[104][0].fingerprint == by_id[3][0].fingerprint
    assert by_id[None][0].component_id == by_id[3][0].component_id <= 3
    assert simhash.classes(empty(spark)).count() == 0
