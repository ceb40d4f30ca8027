"""Greedy rules cut into blocks against the plain loop over the whole series."""

import random

import pytest
from pyspark.sql import functions as F

from permeate.functions.timing import HOUR
from permeate.operators.folds import first_takers, keep_apart


def plain_keep(positions, distance):
    kept = []
    for p in sorted(positions):
        if not kept or p - kept[-1] > distance:
            kept.append(p)
    return kept


@pytest.mark.parametrize("block_rows,group", [(4096, 4096), (12, 3), (1, 2)])
@pytest.mark.parametrize("density", [0.02, 0.3, 1.0])
def test_keep_apart_equals_the_loop(spark, block_rows, group, density):
    rng = random.Random(block_rows * 100 + int(density * 10))
    units = {u: [p for p in range(900) if rng.random() < density] + [5_000] for u in ("a", "b")}
    events = spark.createDataFrame([(u, p) for u, ps in units.items() for p in ps], "unit_id string, rn long")
    got = keep_apart(events.repartition(5), 11, block_rows=block_rows, group=group)
    for u, ps in units.items():
        assert sorted(r.rn for r in got.filter(F.col("unit_id") == u).collect()) == plain_keep(ps, 11)


def test_distance_counts_from_the_last_kept_event(spark):
    events = spark.createDataFrame([("u", p) for p in (0, 60, 120, 230)], "unit_id string, rn long")
    assert sorted(r.rn for r in keep_apart(events, 100).collect()) == [0, 120, 230]


def plain_take(items, takers, within):
    used, out = set(), []
    for t in sorted(takers):
        for j, i in enumerate(sorted(items)):
            if j not in used and 0 < t - i <= within:
                used.add(j)
                out.append((t, i))
                break
    return out


def tables(spark, items, takers):
    a = spark.createDataFrame([("u", t, n) for n, t in enumerate(items)], "unit_id string, us long, seq long")
    b = spark.createDataFrame([("u", t, n) for n, t in enumerate(takers)], "unit_id string, us long, seq long")
    return a, b


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_rows,group", [(4096, 4096), (5, 2)])
def test_first_takers_equal_the_loop(spark, seed, block_rows, group):
    rng = random.Random(seed)
    items = sorted(rng.sample(range(2_000), 120))
    takers = sorted(rng.sample(range(2_000), 90))
    a, b = tables(spark, items, takers)
    got = first_takers(a, b, 40, block_rows=block_rows, group=group)
    assert sorted((r.us, r.item_us) for r in got.collect()) == plain_take(items, takers, 40)


def test_two_cleanings_before_the_first_cycle_each_get_one(spark):
    a, b = tables(spark, [9 * HOUR, int(9.5 * HOUR)], [10 * HOUR, 11 * HOUR])
    got = sorted((r.us, r.item_us) for r in first_takers(a, b, 3 * HOUR).collect())
    assert got == [(10 * HOUR, 9 * HOUR), (11 * HOUR, int(9.5 * HOUR))]


def test_the_limit_is_inclusive_and_equal_stamps_do_not_match(spark):
    a, b = tables(spark, [0, 10 * HOUR], [3 * HOUR, 10 * HOUR, 13 * HOUR + 1])
    assert [(r.us, r.item_us) for r in first_takers(a, b, 3 * HOUR).collect()] == [(3 * HOUR, 0)]
