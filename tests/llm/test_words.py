import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from permeate.llm.words import ALNUM, SPACED, flat, pieces, sets_of_runs, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b\x00_-9文", max_size=40)), max_size=12)


def found_by_pattern(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes_and_different_ones_differ(texts):
    data, offsets = flat(pa.array(texts, pa.string()))
    seen = {}
    for table, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        hashes, at = words(data, offsets, table)
        for i, text in enumerate(texts):
            mine = hashes[at[i] : at[i + 1]].tolist()
            want = found_by_pattern(text, pattern)
            assert len(mine) == len(want)
            for h, w in zip(mine, want, strict=True):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_sets_of_runs(texts):
    data, offsets = flat(pa.array(texts, pa.string()))
    sets = sets_of_runs(*words(data, offsets, SPACED), 5)
    seen = {}
    for text, found in zip(texts, sets, strict=True):
        w = found_by_pattern(text, r"[^\x20\x09-\x0D]+")
        want = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        assert len(found) == len(want)
        key = frozenset(want)
        assert seen.setdefault(key, found.tolist()) == found.tolist()


def test_pieces_cover_all_rows_once():
    offsets = np.array([0, 5, 5, 40, 41, 90, 91])
    got = list(pieces(offsets, 10))
    assert [i for a, b in got for i in range(a, b)] == list(range(6))


def test_sliced_and_null_columns():
    column = pa.array(["a b", None, "c", "d e f"], pa.string())[1:]
    data, offsets = flat(column)
    hashes, at = words(data, offsets, SPACED)
    assert np.diff(at).tolist() == [0, 1, 3] and len(hashes) == 4
