"""Moving statistics against pandas and against Spark's own frames."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from permeate.functions.timing import HOUR, MINUTE
from permeate.operators import prepare, rolling
from permeate.operators.ordering import row_index
from permeate.storage import stage


def make(spark, rows, schema="unit_id string, us long, seq long, v double"):
    return stage(row_index(spark.createDataFrame(rows, schema)), "t")


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(11)
    rows, us = [], 0
    for i in range(600):
        us += rng.choice([1, 5, 30, 60, 240]) * MINUTE
        rows.append(("u", us, i, None if rng.random() < 0.15 else round(rng.uniform(0, 9), 3)))
    return make(spark, rows)


def frame_of(df, columns):
    return df.select("us", *columns).orderBy("us", "seq").toPandas()


def series_of(log):
    pdf = log.orderBy("us").toPandas()
    return pd.Series(pdf["v"].to_numpy(dtype=float), index=pd.to_datetime(pdf["us"], unit="us")), pdf


def test_time_windows_equal_pandas(log):
    s, _ = series_of(log)
    got = frame_of(rolling.time_statistics(log, ["v"], ("6h", "24h")), ["v_mean_6h", "v_std_6h", "v_mean_24h", "v_std_24h"])
    for w in ("6h", "24h"):
        np.testing.assert_allclose(got[f"v_mean_{w}"], s.rolling(w, min_periods=1).mean(), rtol=1e-9)
        np.testing.assert_allclose(got[f"v_std_{w}"], s.rolling(w, min_periods=1).std(), rtol=1e-6, atol=1e-7)


def test_row_exactly_one_width_ago_is_outside(spark):
    log = make(spark, [("u", 0, 0, 10.0), ("u", 6 * HOUR, 1, 2.0), ("u", 6 * HOUR + 1, 2, 4.0)])
    got = [r.v_mean_6h for r in rolling.time_statistics(log, ["v"], ("6h",), ("mean",)).orderBy("us").collect()]
    assert got == [10.0, 2.0, 3.0]


def test_single_row_has_no_deviation(spark):
    log = make(spark, [("u", 0, 0, 10.0)])
    row = rolling.time_statistics(log, ["v"], ("6h",)).first()
    assert row.v_mean_6h == 10.0 and row.v_std_6h is None


def test_constant_readings_have_zero_deviation(spark):
    log = make(spark, [("u", i * MINUTE, i, 3.7) for i in range(200)])
    out = rolling.time_statistics(log, ["v"], ("6h",)).filter("rn > 0")
    assert out.agg(F.max("v_std_6h")).first()[0] < 1e-6


def test_large_totals_infinite_and_far_readings(spark):
    """Infinite readings are missing; every finite one counts, however far it lies (no cut)."""
    def reading(i):
        return float("inf") if i % 50 == 7 else 1e150 if i % 50 == 9 else 1.0

    rows = [("u", i * MINUTE, i, 1e6 + (i % 2) * 1e-3, 1234567.8, reading(i)) for i in range(400)]
    log = make(spark, rows, "unit_id string, us long, seq long, toggling double, constant double, faulty double")
    names = ["toggling", "constant", "faulty"]
    step = (1e6 + 1e-3) - 1e6  # as far as doubles tell the readings apart
    last = rolling.time_statistics(log, names, ("6h",)).filter("rn = 399").first()
    assert abs(last.toggling_std_6h / np.std([0, step] * 180, ddof=1) - 1) < 1e-8
    assert last.constant_std_6h == 0 and last.constant_mean_6h == 1234567.8
    kept = [reading(i) for i in range(40, 400) if i % 50 != 7]
    assert abs(last.faulty_mean_6h / np.mean(kept) - 1) < 1e-12
    assert abs(last.faulty_std_6h / np.std(kept, ddof=1) - 1) < 1e-9
    by_row = rolling.row_statistics(log, "toggling", (72,)).filter("rn = 399").first()
    assert abs(by_row.toggling_roll_std_72 / np.std([0, step] * 36, ddof=1) - 1) < 1e-8


def test_counter_beyond_a_trillion_and_two_levels(spark):
    """A counter far from its median and a reading that jumps between 0 and 9e7 every second."""
    rows = [("u", i * 1_000_000, i, 1e12 + 977.0 * i, 0.0 if i % 2 else 9e7) for i in range(3000)]
    log = make(spark, rows, "unit_id string, us long, seq long, counter double, level double")
    got = frame_of(rolling.time_statistics(log, ["counter", "level"], ("1000s",)), ["counter_mean_1000s", "counter_std_1000s", "level_mean_1000s", "level_std_1000s"])
    by_row = frame_of(rolling.row_statistics(log, "level", (288,), ("mean", "std")), ["level_roll_mean_288", "level_roll_std_288"])
    sma = frame_of(rolling.moving_average(log, ["counter"], 50), ["counter_sma"])
    for i in (0, 1, 999, 1000, 1777, 2999):
        window = rows[max(0, i - 999) : i + 1]
        for name, at in (("counter", 3), ("level", 4)):
            values = np.array([r[at] for r in window])
            assert abs(got[f"{name}_mean_1000s"][i] / values.mean() - 1) < 1e-12
            if i:
                assert abs(got[f"{name}_std_1000s"][i] / values.std(ddof=1) - 1) < 1e-9
        levels = np.array([r[4] for r in rows[max(0, i - 287) : i + 1]])
        assert abs(by_row["level_roll_mean_288"][i] - levels.mean()) < 1e-6
        if i:
            assert abs(by_row["level_roll_std_288"][i] / levels.std(ddof=1) - 1) < 1e-9
        counters = np.array([r[3] for r in rows[max(0, i - 49) : i + 1]])
        assert abs(sma["counter_sma"][i] / counters.mean() - 1) < 1e-14


@pytest.mark.parametrize("block_rows", [20, 10_000])
def test_dropped_rows_leave_no_holes(log, block_rows):
    s, _ = series_of(log)
    dropped = prepare.fill_gaps(log, ["v"], "drop", gated=False)
    got = frame_of(rolling.moving_average(dropped, ["v"], 50, block_rows=block_rows), ["v_sma"])
    np.testing.assert_allclose(got["v_sma"], s.dropna().rolling(50, min_periods=1).mean(), rtol=1e-9)


@pytest.mark.parametrize("block_rows", [20, 10_000])
def test_row_windows_equal_pandas(log, block_rows):
    s, _ = series_of(log)
    got = frame_of(rolling.row_statistics(log, "v", (1, 5, 12, 17), block_rows=block_rows),
                   [f"v_roll_{n}_{k}" for k in (1, 5, 12, 17) for n in ("mean", "std", "min", "max")])
    for k in (1, 5, 12, 17):
        r = s.rolling(k, min_periods=1)
        for n in ("mean", "std", "min", "max"):
            np.testing.assert_allclose(got[f"v_roll_{n}_{k}"].astype(float), getattr(r, n)(), rtol=1e-7, atol=1e-7)


@pytest.mark.parametrize("block_rows", [7, 10_000])
def test_moving_average_equals_pandas(log, block_rows):
    s, _ = series_of(log)
    got = frame_of(rolling.moving_average(log, ["v"], 6, block_rows=block_rows), ["v_sma"])
    np.testing.assert_allclose(got["v_sma"].astype(float), s.rolling(6, min_periods=1).mean(), rtol=1e-9)


def test_decline_from_window_start_equals_pandas(log):
    s, _ = series_of(log)
    first = s.rolling("7d").apply(lambda x: x.iloc[0], raw=False)
    want = ((first - s) / first * 100).replace([np.inf, -np.inf], np.nan)
    got = frame_of(rolling.decline_from_window_start(log, "v", "7d"), ["v_decline_7d"])
    known = ~want.isna().to_numpy()
    np.testing.assert_allclose(got["v_decline_7d"].astype(float)[known], want[known], rtol=1e-9)


def test_zero_time_step_gives_no_derivative(spark):
    log = make(spark, [("u", 0, 0, 1.0), ("u", 0, 1, 2.0), ("u", HOUR, 2, 5.0)])
    got = [r.v_derivative for r in rolling.derivatives(log, ["v"]).orderBy("rn").collect()]
    assert got == [None, None, 3.0]


def test_forward_fill_stops_after_ten_rows(spark):
    rows = [("u", i, i, 1.0 if i == 0 else None) for i in range(12)] + [("u", 12, 12, 5.0)]
    got = [r.v for r in prepare.forward_fill(make(spark, rows), ["v"], block_rows=10).orderBy("rn").collect()]
    assert got == [1.0] * 11 + [None, 5.0]


@pytest.mark.parametrize("block_rows", [10, 10_000])
def test_interpolation_equals_pandas(spark, block_rows):
    rng = random.Random(5)
    values = [None, None] + [None if rng.random() < 0.75 else float(rng.randrange(50)) for _ in range(150)] + [3.0] + [None] * 14
    log = make(spark, [("u", i, i, v) for i, v in enumerate(values)])
    want = pd.Series(values, dtype=float).interpolate(method="linear", limit=10)
    got = prepare.interpolate(log, ["v"], block_rows=block_rows).orderBy("rn").toPandas()["v"].astype(float)
    np.testing.assert_allclose(got, want)


def test_gate_leaves_units_without_a_gap_alone(spark):
    rows = [("gap", 0, 0, 1.0), ("gap", 6 * MINUTE, 1, None), ("even", 0, 2, 1.0), ("even", MINUTE, 3, None)]
    got = {(r.unit_id, r.rn): r.v for r in prepare.fill_gaps(make(spark, rows), ["v"]).collect()}
    assert got == {("gap", 0): 1.0, ("gap", 1): 1.0, ("even", 0): 1.0, ("even", 1): None}
    with pytest.raises(ValueError):
        prepare.fill_gaps(make(spark, rows), ["v"], "guess")


@pytest.mark.parametrize("n,limit", [(10, 10), (11, 10), (25, 10), (100, 7)])
def test_stride_sample(spark, n, limit):
    log = make(spark, [("u", i, i, float(i)) for i in range(n)])
    got = prepare.stride_sample(log, limit).orderBy("rn").collect()
    step = max(n // limit, 1) if n > limit else 1
    want = sorted({*range(0, n, step), n - 1})
    assert [r.seq for r in got] == want
    assert [r.rn for r in got] == list(range(len(want)))


def test_edges_treat_missing_as_off(spark):
    rows = [("u", i, i, v) for i, v in enumerate([10.0, None, 10.0, 10.0, 3.0])]
    got = rolling.edges(make(spark, rows), F.col("v") == 10).orderBy("rn").collect()
    assert [r.rising for r in got] == [True, False, True, False, False]
    assert [r.falling for r in got] == [False, True, False, False, True]


def test_increments_and_seconds(spark):
    log = make(spark, [("u", i * 1_500_000, i, v) for i, v in enumerate([0.0, 0.0, 2.0, 1.0, 4.0])])
    assert [(r.rn, r.increment) for r in rolling.increments(log, "v").orderBy("rn").collect()] == [(2, 2.0), (4, 3.0)]
    assert [r.time_numeric for r in rolling.seconds_since_start(log).orderBy("rn").collect()] == [0.0, 1.5, 3.0, 4.5, 6.0]


def test_two_units_together_equal_each_alone(spark, log):
    other = log.withColumn("unit_id", F.lit("x")).withColumn("v", F.col("v") * 2)
    both = rolling.time_statistics(log.unionByName(other), ["v"], ("6h",), ("mean",))
    alone = rolling.time_statistics(log, ["v"], ("6h",), ("mean",))
    assert both.filter("unit_id = 'u'").exceptAll(alone).count() == 0
    w = Window.partitionBy("unit_id").orderBy("us")
    assert both.select(F.count("*").over(w)).count() == 1200


def test_a_span_cut_into_pieces_equals_pandas(spark, monkeypatch):
    """One hot day, many rows on one stamp: the memory of a task must not grow with a span's rows."""
    rng = random.Random(5)
    stamps = sorted([rng.randrange(0, 40 * HOUR) for _ in range(1500)] + [20 * HOUR] * 500)
    rows = [("u", us, i, None if i % 9 == 0 else 1e6 + rng.uniform(0, 9)) for i, us in enumerate(stamps)]
    rows += [("v", us, i, 4.25) for i, us in enumerate(stamps)]
    log, made = make(spark, rows), []
    monkeypatch.setattr(rolling, "task_count", lambda session, n, per_task=0: 30)
    pieces_of = rolling.ordered_pieces
    monkeypatch.setattr(rolling, "ordered_pieces", lambda *a: made.append(pieces_of(*a)) or made[-1])
    got = rolling.time_statistics(log, ["v"], ("6h", "24h")).orderBy("unit_id", "us", "seq").toPandas()
    assert made[0].groupBy("unit_id", "_w", "_b", "_piece").count().agg(F.max("count")).first()[0] < 1500
    assert made[0].groupBy("unit_id", "_w", "_b").agg(F.count_distinct("_piece").alias("n")).agg(F.max("n")).first()[0] > 2
    for w in ("6h", "24h"):
        u, v = (got[got.unit_id == k] for k in "uv")
        wide = int(w[:-1]) * HOUR
        values = u["v"].to_numpy(dtype=float)
        us = u["us"].to_numpy()
        for i in range(0, len(u), 37):
            part = values[: i + 1][us[: i + 1] > us[i] - wide]
            part = part[~np.isnan(part)]
            if len(part):
                np.testing.assert_allclose(u[f"v_mean_{w}"].iloc[i], part.mean(), rtol=1e-12)
            if len(part) > 1:
                np.testing.assert_allclose(u[f"v_std_{w}"].iloc[i], part.std(ddof=1), rtol=1e-7)
        assert (v[f"v_mean_{w}"] == 4.25).all() and (v[f"v_std_{w}"].dropna() == 0).all()


@pytest.mark.parametrize("statistic", ["row_statistics", "moving_average"])
def test_row_windows_get_tasks_by_their_rows(spark, monkeypatch, statistic):
    """Blocks must not be put together into few tasks, however few the session's shuffles have."""
    log = make(spark, [("u", i * MINUTE, i, float(i % 7)) for i in range(9000)])
    monkeypatch.setattr(rolling, "task_count", lambda session, n, per_task=0: -(-n // 1000))
    if statistic == "row_statistics":
        out = rolling.row_statistics(log, "v", (12, 72))
    else:
        out = rolling.moving_average(log, ["v"], 50)
    assert out.rdd.getNumPartitions() == 9 and out.count() == 9000


def test_tasks_grow_with_the_rows(spark):
    from permeate.operators.ordering import TASK_ROWS, task_count

    assert task_count(spark, 0) == 1 and task_count(spark, 100) == 1
    assert task_count(spark, 20_000) == 4  # the session's shuffles
    assert task_count(spark, 36_000_000) == -(-36_000_000 // TASK_ROWS)
