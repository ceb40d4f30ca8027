"""Tree-model forecasts with Spark ML: features, training, evaluation, point forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.functions.missing import ratio
from permeate.functions.timing import DAY, calendar_features, to_stamp
from permeate.operators.forecast import Z
from permeate.operators.ordering import UNIT, running, series_length, task_count
from permeate.operators.rolling import lag_features, row_statistics, seconds_since_start
from permeate.storage import attach, stage

LAGS = (1, 12, 72, 144, 288)
SIZES = (12, 72, 288)
COVARIATES = ("perm_tc", "flux", "recovery", "specific_power")
CALENDAR = ("hour", "day_of_week", "day_of_month", "is_weekend", "hour_sin", "hour_cos", "time_numeric")


def feature_names(
    target: str, columns: Sequence[str], lags: Sequence[int] = LAGS, sizes: Sequence[int] = SIZES, covariates: bool = True
) -> list[str]:
    """Calendar, lags, moving statistics and other readings; never the target itself."""
    names = [*CALENDAR, *[f"{target}_lag_{k}" for k in lags]]
    names += [f"{target}_roll_{s}_{k}" for k in sizes for s in ("mean", "std", "min", "max")]
    if covariates:
        names += [c for c in COVARIATES if c in columns and c != target]
    return names


def features(
    ordered: DataFrame,
    target: str = "tmp",
    lags: Sequence[int] = LAGS,
    sizes: Sequence[int] = SIZES,
    covariates: bool = True,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Rows with all features present, numbered anew per unit (``rn``)."""
    keys = list(keys)
    extra = [c for c in COVARIATES if c in ordered.columns and c != target] if covariates else []
    base = ordered.select(*keys, "us", "seq", "rn", target, *extra)
    rolled = row_statistics(lag_features(base, target, lags, keys, **blocks), target, sizes, keys=keys, **blocks)
    timed = seconds_since_start(rolled, keys).withColumns(calendar_features(to_stamp(F.col("us"))))
    names = feature_names(target, ordered.columns, lags, sizes, covariates)
    complete = stage(timed.dropna("any", subset=[target, *names]), "features")
    one, tasks = complete.withColumn("_one", F.lit(1).cast("long")), task_count(complete.sparkSession, complete.count())
    numbered = running(one, {"_no": ("sum", "_one")}, keys, tasks=tasks, **blocks)
    return numbered.withColumn("rn", F.col("_no") - 1).drop("_one", "_no")


def split(feature_rows: DataFrame, test_share: float = 0.2, keys: Sequence[str] = UNIT) -> DataFrame:
    """Mark the earlier part of each unit for training (``is_train``), the rest for testing."""
    sized = attach(feature_rows, series_length(feature_rows, keys, "_n"), keys)
    return sized.withColumn("is_train", F.col("rn") < F.floor(F.col("_n") * (1.0 - test_share))).drop("_n")


def regressor(kind: str, target: str, **parameters):
    """Untrained model; ``xgboost`` is served by Spark's own boosted trees."""
    shared = {"featuresCol": "features", "labelCol": target, "predictionCol": "predicted", "seed": 42}
    if kind == "random_forest":
        chosen = {"numTrees": 100, "maxDepth": 15, "minInstancesPerNode": 2}
        return RandomForestRegressor(**{**shared, **chosen, **parameters})
    if kind in ("gradient_boosting", "xgboost"):
        chosen = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8}
        return GBTRegressor(**{**shared, **chosen, **parameters})
    raise ValueError(f"unknown model: {kind}")


def train(rows: DataFrame, names: Sequence[str], target: str, kind: str = "random_forest", **parameters):
    """Fit on the marked training rows; returns (model, rows with ``features``)."""
    vectors = VectorAssembler(inputCols=list(names), outputCol="features").transform(rows)
    return regressor(kind, target, **parameters).fit(vectors.filter("is_train")), vectors


def evaluate(model, vectors: DataFrame, target: str) -> dict[str, float]:
    tested = model.transform(vectors.filter("NOT is_train"))
    return {
        metric: RegressionEvaluator(labelCol=target, predictionCol="predicted", metricName=metric).evaluate(tested)
        for metric in ("r2", "rmse", "mae")
    }


def evaluation_table(model, vectors: DataFrame, target: str, keys: Sequence[str] = UNIT) -> DataFrame:
    """R², RMSE, MAE and residual deviation on the test rows, per unit, in one aggregation."""
    error = F.col(target) - F.col("predicted")
    tested = model.transform(vectors.filter("NOT is_train"))
    spread = F.var_pop(target) * F.count("*")
    return tested.groupBy(*keys).agg(
        F.count("*").alias("n_test"),
        F.when(spread > 0, 1.0 - F.sum(error * error) / spread).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.stddev_samp(error).alias("residual_std"),
    )


def importance(spark, model, names: Sequence[str], top: int = 5) -> DataFrame:
    """The strongest features of a trained tree model."""
    values = [(name, float(v)) for name, v in zip(names, model.featureImportances.toArray())]
    return spark.createDataFrame(values, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    ).limit(top)


def tree_forecast(
    ordered: DataFrame,
    target: str = "tmp",
    kind: str = "random_forest",
    horizon_days: float = 7,
    test_share: float = 0.2,
    confidence: float = 0.95,
    threshold: float = 8.0,
    covariates: bool = True,
    min_rows: int = 500,
    lags: Sequence[int] = LAGS,
    sizes: Sequence[int] = SIZES,
    parameters: dict | None = None,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """One model over all units; per unit the value expected at the horizon.

    The last feature row is moved to the horizon: calendar features change, the rest is kept.
    Units with fewer than ``min_rows`` rows are left out.  Days to the threshold are counted
    along the straight way from the current to the predicted value.
    """
    keys = list(keys)
    large = series_length(ordered, keys, "_n").filter(F.col("_n") >= min_rows).select(*keys)
    names = feature_names(target, ordered.columns, lags, sizes, covariates)
    found = features(attach(ordered, large, keys, "left_semi"), target, lags, sizes, covariates, keys, **blocks)
    # Training reads the rows several times; written once, no pass sorts and numbers them again.
    rows = stage(split(found, test_share, keys), "feature_rows")
    if rows.isEmpty():
        return _no_forecast(ordered, keys)
    model, vectors = train(rows, names, target, kind, **(parameters or {}))
    scores = evaluation_table(model, vectors, target, keys)
    return point_forecast(
        model, rows, scores, names, target, kind, horizon_days, confidence, threshold, keys
    )


def _no_forecast(ordered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The empty forecast table."""
    fields = [
        "parameter string", "model_type string", "forecast_horizon_days double", "current_value double",
        "predicted_value double", "prediction_date timestamp_ntz", "confidence_level double",
        "lower_bound double", "upper_bound double", "r_squared double", "rmse double", "mae double",
        "time_to_threshold double", "threshold_value double", "threshold_date timestamp_ntz",
    ]
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (f.split() for f in fields)]
    return ordered.filter(F.lit(False)).select(*keys, *nothing)


def point_forecast(
    model,
    rows: DataFrame,
    scores: DataFrame,
    names: Sequence[str],
    target: str = "tmp",
    kind: str = "random_forest",
    horizon_days: float = 7,
    confidence: float = 0.95,
    threshold: float = 8.0,
    keys: Sequence[str] = UNIT,
) -> DataFrame:
    """Forecast of a trained model from the last feature row of each unit."""
    keys, names = list(keys), list(names)
    horizon = int(horizon_days * DAY)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct("us", target, *names), "rn").alias("_last"))
    moved = last.select(*keys, "_last.*").withColumns(
        {
            "_last_us": F.col("us"),
            "us": F.col("us") + horizon,
            "time_numeric": F.col("time_numeric") + horizon / 1e6,
            "current_value": F.col(target),
        }
    )
    moved = moved.withColumns(calendar_features(to_stamp(F.col("us"))))
    predicted = model.transform(VectorAssembler(inputCols=names, outputCol="features").transform(moved))
    rise = (F.col("predicted") - F.col("current_value")) / float(horizon_days)
    up = target == "tmp"
    ahead = (rise > 0) if up else (rise < 0)
    days = F.when(ahead, ratio(F.lit(float(threshold)) - F.col("current_value"), rise))
    margin = F.col("residual_std") * Z[confidence]
    return (
        predicted.join(scores, keys)
        .withColumn("_days", F.when(days >= 0, days))
        .select(
            *keys,
            F.lit(target).alias("parameter"),
            F.lit(f"ml_{kind}").alias("model_type"),
            F.lit(float(horizon_days)).alias("forecast_horizon_days"),
            "current_value",
            F.col("predicted").alias("predicted_value"),
            to_stamp(F.col("us")).alias("prediction_date"),
            F.lit(float(confidence)).alias("confidence_level"),
            (F.col("predicted") - margin).alias("lower_bound"),
            (F.col("predicted") + margin).alias("upper_bound"),
            F.col("r2").alias("r_squared"),
            "rmse",
            "mae",
            F.col("_days").alias("time_to_threshold"),
            F.lit(float(threshold)).alias("threshold_value"),
            to_stamp(F.col("_last_us") + F.round(F.col("_days") * DAY).cast("long")).alias("threshold_date"),
        )
    )
