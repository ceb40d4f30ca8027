"""The ordered-series primitives against plain single-window answers."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from permeate.operators.ordering import frames, ordered_pieces, own_rows, row_index, running
from permeate.storage import stage


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        # One unit holds most rows, and a third of them share one stamp.
        unit = "hot" if rng.random() < 0.8 else rng.choice("abc")
        us = 5_000 if rng.random() < 0.33 else rng.randrange(100_000)
        rows.append((unit, us, i, None if rng.random() < 0.2 else rng.randrange(100)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "unit_id string, us long, seq long, v long").repartition(7)
    return stage(row_index(df), "series")


def whole():
    return Window.partitionBy("unit_id").orderBy("us", "seq")


def test_row_index_is_the_global_position(series):
    wrong = series.withColumn("want", F.row_number().over(whole()) - 1).filter("rn <> want")
    assert wrong.count() == 0
    assert series.count() == 3000


def test_one_hot_unit_is_cut_into_several_pieces(spark, series):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = ordered_pieces(series.select("unit_id", "us", "seq"), ["unit_id"], ["us", "seq"])
        assert cut.filter("unit_id = 'hot'").select("_piece").distinct().count() > 1
        # Running values carried from piece to piece are the same as over the whole series.
        got = running(cut, {"s": ("sum", "us"), "m": ("max", "seq")}, pieces=True)
        so_far = whole().rowsBetween(Window.unboundedPreceding, 0)
        bad = got.withColumns({"ws": F.sum("us").over(so_far), "wm": F.max("seq").over(so_far)})
        assert bad.filter("s <> ws or m <> wm").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("block_rows", [3, 64, 10_000])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_over_blocks(series, block_rows, reverse, inclusive):
    got = running(
        series, {"s": ("sum", "v"), "l": ("last", "v"), "m": ("max", "v"), "n": ("min", "v")},
        reverse=reverse, inclusive=inclusive, block_rows=block_rows,
    )
    order = F.desc("rn") if reverse else F.asc("rn")
    w = Window.partitionBy("unit_id").orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    both = got.withColumns(
        {"ws": F.sum("v").over(w), "wl": F.last("v", True).over(w), "wm": F.max("v").over(w), "wn": F.min("v").over(w)}
    )
    assert both.filter("not (s <=> ws and l <=> wl and m <=> wm and n <=> wn)").count() == 0
    assert both.count() == 3000


@pytest.mark.parametrize("block_rows", [4, 50, 10_000])
def test_frames_reach_into_neighbouring_blocks(series, block_rows):
    near, w = frames(series, 4, 2, block_rows=block_rows)
    got = own_rows(
        near.withColumns({"lag3": F.lag("v", 3).over(w), "lead2": F.lead("v", 2).over(w),
                          "s": F.sum("v").over(w.rowsBetween(-4, 2))})
    )
    both = got.withColumns({"wlag": F.lag("v", 3).over(whole()), "wlead": F.lead("v", 2).over(whole()),
                            "ws": F.sum("v").over(whole().rowsBetween(-4, 2))})
    assert both.filter("not (lag3 <=> wlag and lead2 <=> wlead and s <=> ws)").count() == 0
    assert both.count() == 3000


def test_shuffled_input_gives_the_same_index(spark, series):
    again = row_index(series.drop("rn").orderBy(F.rand(3)))
    assert again.exceptAll(series.select(*again.columns)).count() == 0
