"""Periods, cycles and rates on small logs with answers worked out by hand."""

import statistics

import pytest
from pyspark.sql import functions as F

from permeate.functions.timing import DAY, HOUR, MINUTE
from permeate.operators import cycles as c
from permeate.operators.joins import interval_join, next_after
from permeate.operators.ordering import row_index
from permeate.storage import stage

BANDS = {"tmp": (0.0, 8.0), "perm_tc": (0.0, 20.0)}


def make(spark, programs, step=MINUTE, tmp=lambda i: 1.0 + i / 100, perm=lambda i: 10.0, unit="u"):
    rows = [(unit, i * step, i, p, tmp(i), perm(i), 2.0, 80.0, 5.0) for i, p in enumerate(programs)]
    schema = ("unit_id string, us long, seq long, program int, tmp double, perm_tc double, flux double, "
              "recovery double, mem_retention double")
    return stage(row_index(spark.createDataFrame(rows, schema)), "t")


@pytest.mark.parametrize("block_rows", [2, 5, 10_000])
def test_missing_program_splits_a_run_and_an_open_run_ends_with_the_log(spark, block_rows):
    log = make(spark, [10, 10, None, 10, 21, 32, 32, 10, 10, 10])
    got = c.filtration_periods(log, block_rows=block_rows).orderBy("period").collect()
    assert [(r.period, r.start_us // MINUTE, r.end_us // MINUTE, r.n_rows) for r in got] == [
        (0, 0, 2, 2), (3, 3, 4, 1), (7, 7, 9, 3)
    ]
    assert [r.rn for r in c.chemical_cleanings(log, block_rows=block_rows).collect()] == [5]


@pytest.mark.parametrize("n,start,end", [(10, 1.0, 1.09), (11, 1.10, 1.0), (100, None, None)])
def test_start_and_end_level_of_a_cycle(spark, n, start, end):
    values = [1.0 + i / 100 for i in range(n)]
    log = make(spark, [10] * n)
    row = c.cycles_by_program(log, BANDS, min_minutes=0).first()
    if start is None:
        start, end = statistics.median(values[10:60]), statistics.median(values[-50:-10])
    assert row.tmp_start == pytest.approx(start) and row.tmp_end == pytest.approx(end)
    assert row.n_rows == n and row.cycle_id == 1
    assert row.tmp_slope == pytest.approx(0.6) and row.tmp_slope_r2 == pytest.approx(1.0)


@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_duration_comes_from_raw_rows_and_members_from_plausible_ones(spark, block_rows):
    # 40 minutes of filtration whose middle is implausible; the closing row belongs to the cycle.
    programs = [21] * 3 + [10] * 40 + [21] * 4 + [10] * 20 + [21] + [10] * 45
    log = make(spark, programs, tmp=lambda i: 99.0 if 15 <= i < 30 else 2.0)
    rows = c.label_cycles(log, BANDS, 30, block_rows=block_rows).orderBy("rn").collect()
    ids = {r.rn: r.cycle_id for r in rows}
    assert [rn for rn, i in ids.items() if i == 1] == [*range(3, 15), *range(30, 44)]
    assert [rn for rn, i in ids.items() if i == 2] == list(range(68, 113))
    assert all(ids[rn] == 0 for rn in range(44, 68)) and 20 not in ids
    first = [r for r in rows if r.cycle_id == 1]
    assert [r.k for r in first] == list(range(1, 27)) and {r.n for r in first} == {26}


def test_constant_tmp_has_no_explained_variance(spark):
    row = c.cycles_by_program(make(spark, [10] * 20, tmp=lambda i: 2.5), BANDS, min_minutes=0).first()
    assert row.tmp_slope == 0.0 and row.tmp_slope_r2 == 0.0


def test_tmp_drops_and_segments(spark):
    tmp = lambda i: 3.0 if i % 150 else 1.0
    log = make(spark, [10] * 400, tmp=tmp)
    drops = stage(c.tmp_drops(log), "d")
    assert sorted(r.rn for r in drops.collect()) == [150, 300]
    timer = drops.filter("false")
    events = c.merge_events(drops, timer)
    rows = c.label_segments(log, events, 0.5, block_rows=64)
    sizes = {r[0]: r[1] for r in rows.groupBy("cycle_id").count().collect()}
    assert sizes == {1: 150, 2: 150, 3: 100}
    close = spark.createDataFrame([("u", 5), ("u", 350)], "unit_id string, rn long")
    sizes = {r[0]: r[1] for r in c.label_segments(log, close, 0.5).groupBy("cycle_id").count().collect()}
    assert sizes == {0: 5, 1: 345, 2: 50}


def test_a_log_without_events_is_one_segment(spark):
    log = make(spark, [10] * 60)
    none = spark.createDataFrame([], "unit_id string, rn long")
    rows = c.label_segments(log, none, 0.5)
    assert rows.filter("cycle_id = 1").count() == 60
    assert rows.filter("k is not null").count() == 59


def test_timer_events(spark):
    log = make(spark, [10] * 6).withColumn("chemical_timer", F.floor(F.col("rn") / 3).cast("double"))
    assert [r.rn for r in c.timer_events(log).collect()] == [3]


def test_fouling_rates(spark):
    starts = [1.0 + d * 0.1 for d in range(10)] + [50.0]
    cycles = spark.createDataFrame(
        [("u", i + 1, i * DAY, v) for i, v in enumerate(starts)], "unit_id string, cycle_id int, start_us long, tmp_start double"
    )
    cleanings = spark.createDataFrame(
        [("u", 2 * DAY - HOUR, 0), ("u", 5 * DAY - 2 * HOUR, 1), ("u", 7 * DAY - 4 * HOUR, 2)], "unit_id string, us long, seq long"
    )
    row = c.fouling_rates(cycles, cleanings).first()
    assert (row.total_cycles, row.valid_cycles, row.outliers_removed, row.post_cleaning_cycles) == (11, 10, 1, 2)
    assert row.reversible_rate == pytest.approx(0.1) and row.irreversible_rate == pytest.approx(0.1)
    assert row.reversible_r_squared == pytest.approx(1.0)


def test_fewer_than_two_cycles_give_no_rate(spark):
    cycles = spark.createDataFrame([("u", 1, 0, 1.0)], "unit_id string, cycle_id int, start_us long, tmp_start double")
    cleanings = spark.createDataFrame([], "unit_id string, us long, seq long")
    row = c.fouling_rates(cycles, cleanings).first()
    assert row.reversible_rate is None and row.irreversible_rate is None and row.post_cleaning_cycles == 0


def test_interval_join_includes_both_ends(spark):
    points = spark.createDataFrame([("u", t, t) for t in range(12)], "unit_id string, us long, seq long")
    spans = spark.createDataFrame([("u", 2, 4, "a"), ("u", 7, 7, "b"), ("u", 9, 20, "c")],
                                  "unit_id string, start_us long, end_us long, name string")
    got = sorted((r.us, r.name) for r in interval_join(points, spans).collect())
    assert got == [(2, "a"), (3, "a"), (4, "a"), (7, "b"), (9, "c"), (10, "c"), (11, "c")]


def test_next_after_is_strict(spark):
    left = spark.createDataFrame([("u", t, i) for i, t in enumerate((1, 5, 9))], "unit_id string, us long, seq long")
    right = spark.createDataFrame([("u", t, i) for i, t in enumerate((5, 8))], "unit_id string, us long, seq long")
    assert [r.next_us for r in next_after(left, right).orderBy("us").collect()] == [5, 8, None]


@pytest.mark.parametrize("block_rows", [4, 10_000])
def test_cycles_carry_the_period_and_the_place_in_one_pass(spark, block_rows, monkeypatch):
    made, through = [], c.running

    def counted(df, aggregates, **more):
        made.append(set(aggregates))
        return through(df, aggregates, **more)

    monkeypatch.setattr(c, "running", counted)
    log = make(spark, [10] * 12 + [21, None] + [10] * 15, tmp=lambda i: None if i == 4 else 99.0 if i == 20 else 2.0)
    rows = c.label_cycles(log, BANDS, 5, block_rows=block_rows).orderBy("rn").collect()
    assert made == [{"period", "_good_no"}]
    want = [(rn, 1, k) for k, rn in enumerate([*range(4), *range(5, 13)], 1)] + [(13, 0, None)]
    want += [(rn, 2, k) for k, rn in enumerate([*range(14, 20), *range(21, 29)], 1)]
    assert [(r.rn, r.cycle_id, r.k) for r in rows] == want
