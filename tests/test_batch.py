"""A whole run over a small log, and tree models."""

import math

import pytest
from pyspark.sql import functions as F

from permeate.functions.timing import MINUTE, to_stamp
from permeate.operators import learning as ml
from permeate.operators.ordering import row_index
from permeate.plans.batch import Settings, run
from permeate.storage import stage


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for u in ("a", "b"):
        for i in range(1500):
            phase = i % 100
            program = 10 if phase < 80 else 32 if phase >= 96 and i % 300 > 250 else 21
            rows.append(
                (u, i * 10 * MINUTE, i, program, 2 + phase / 100 + i / 3000, 9 - i / 1000 + math.sin(i) / 10,
                 15.0 + math.cos(i), 12.0, 88.0, 0.12, 3.0, 7.0)
            )
    df = spark.createDataFrame(
        rows, "unit_id string, us long, seq long, program int, tmp double, perm_tc double, flux double, temp_c double, "
        "recovery double, specific_power double, v_crossflow double, mem_retention double"
    )
    return df.withColumn("ts", to_stamp(F.col("us")))


def test_a_run_writes_every_table(log, tmp_path):
    tables = run(log, str(tmp_path), Settings(max_points=400))
    counts = {name: df.count() for name, df in tables.items()}
    assert counts["raw"] == counts["valid"] == counts["features"] == counts["fouling"] == 3000
    assert counts["cycles"] == 30 and counts["validation_report"] == 2
    assert counts["forecasts"] == 4 and counts["kpis"] >= 14
    assert counts["forecast_path"] == 40 and counts["tmp_note"] == 2
    empty = [name for name, n in counts.items() if n == 0]
    assert empty in ([], ["alerts"])
    features = tables["features"].columns
    for name in ("tmp_derivative", "flux_mean_6h", "recovery_std_24h", "hydraulic_efficiency", "flux_normalized", "perm_tc_sma"):
        assert name in features
    assert {"tmp_slope_6h", "permeability_baseline", "permeability_decline_baseline"} <= set(tables["fouling"].columns)


def test_start_reaches_cycles_and_a_unit_may_lack_a_sensor(spark, log, tmp_path):
    start = "1970-01-06 00:00:00"
    lacking = log.withColumn("recovery", F.when(F.col("unit_id") == "a", F.col("recovery")))
    tables = run(lacking, str(tmp_path), Settings(start=start, max_points=400))
    assert tables["valid"].groupBy("unit_id").count().count() == 2
    cycles = tables["cycles"]
    assert 0 < cycles.count() < 30 and cycles.filter(F.col("start_time") < F.lit(start).cast("timestamp_ntz")).count() == 0
    shares = tables["validation_report"].filter("unit_id = 'b'").first().missing_percent
    assert shares["recovery"] == 100.0 and "program" in shares


def test_a_run_without_program_numbers(log, tmp_path):
    tables = run(log.drop("program"), str(tmp_path), Settings(forecast_model="exponential"))
    assert tables["cycles"].count() > 0 and tables["cleanings"].count() == 0
    assert {r.model_type for r in tables["forecasts"].select("model_type").distinct().collect()} == {"exponential"}


@pytest.mark.parametrize("kind,parameters", [("random_forest", {"numTrees": 5, "maxDepth": 4}), ("gradient_boosting", {"maxIter": 3}), ("xgboost", {"maxIter": 2})])
def test_tree_forecast(log, kind, parameters):
    ordered = stage(row_index(log), "t")
    out = ml.tree_forecast(ordered, "tmp", kind, lags=(1, 12), sizes=(12,), parameters=parameters).collect()
    assert len(out) == 2
    for r in out:
        assert r.model_type == f"ml_{kind}" and r.lower_bound < r.predicted_value < r.upper_bound


def test_features_leave_the_target_out_and_split_by_time(log):
    ordered = stage(row_index(log), "t")
    names = ml.feature_names("perm_tc", ordered.columns)
    assert "perm_tc" not in names and "flux" in names
    rows = ml.split(ml.features(ordered, "perm_tc", (1, 5), (3,)))
    n = rows.filter("unit_id = 'a'").count()
    assert n == 1495
    edge = rows.groupBy("unit_id", "is_train").agg(F.min("us").alias("lo"), F.max("us").alias("hi"), F.count("*").alias("n")).collect()
    by = {(r.unit_id, r.is_train): r for r in edge}
    assert by["a", True].n == math.floor(n * 0.8) and by["a", True].hi < by["a", False].lo


def test_too_few_rows_give_no_forecast(log):
    short = stage(row_index(log.filter("seq < 100")), "t")
    out = ml.tree_forecast(short)
    assert out.count() == 0 and "predicted_value" in out.columns


def test_unknown_model():
    with pytest.raises(ValueError):
        ml.regressor("svm", "tmp")


def test_training_reads_stored_rows(log, monkeypatch):
    """The rows are read several times by training; no pass may number and sort them again."""
    seen = []
    train = ml.train
    monkeypatch.setattr(ml, "train", lambda rows, *a, **k: seen.append(rows) or train(rows, *a, **k))
    ordered = row_index(log)
    assert ml.tree_forecast(ordered, "tmp", "random_forest", lags=(1, 12), sizes=(12,), parameters={"numTrees": 2, "maxDepth": 2}).count() > 0
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
