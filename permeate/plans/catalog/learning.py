"""Tree models: features with SQL to match, forecasts without."""

from pyspark.sql import functions as F

from permeate.operators import learning as ml
from permeate.plans.adapter import ORDERED_SQL, once, ordered_log, prepared
from permeate.plans.registry import query, rounded

TARGET = "tmp"

_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
_LAGS = ", ".join(f"lag(tmp, {k}) over w as tmp_lag_{k}" for k in ml.LAGS)
_ROLLS = ", ".join(
    f"{f}(tmp) over (partition by unit_id order by rn rows between {k - 1} preceding and current row) as tmp_roll_{n}_{k}"
    for k in ml.SIZES
    for n, f in _STATS.items()
)
_CHECKED = ["tmp_lag_1", "tmp_lag_288", "tmp_roll_mean_12", "tmp_roll_std_72", "tmp_roll_min_288", "tmp_roll_max_12", "hour_sin", "perm_tc"]
FEATURES = ORDERED_SQL + f""", wide as (select unit_id, seq, us, rn, tmp, perm_tc, flux, recovery, specific_power, {_LAGS}, {_ROLLS},
    sin(2 * pi() * hour(ts) / 24) as hour_sin, (us - min(us) over (partition by unit_id)) / 1e6 as time_numeric
  from ordered window w as (partition by unit_id order by rn)),
complete as (select * exclude (rn), row_number() over (partition by unit_id order by us, seq) - 1 as rn,
    count(*) over (partition by unit_id) as n
  from wide where tmp_lag_288 is not null and perm_tc is not null and tmp_roll_std_12 is not null)"""


def feature_rows(spark, sf):
    """Written once: training reads the rows several times."""
    return prepared(spark, sf, "feature_rows", lambda: ml.split(ml.features(ordered_log(spark, sf), TARGET)))


@query(
    "j13_features",
    "select unit_id, seq, rn, rn < floor(n * 0.8e0) as is_train, " + ", ".join(f"round({c}, 5) as {c}" for c in _CHECKED) + ", time_numeric from complete",
    FEATURES,
)
def features(spark, sf):
    return ml.split(ml.features(ordered_log(spark, sf), TARGET)).select(
        "unit_id", "seq", "rn", "is_train", *rounded(*_CHECKED, digits=5), "time_numeric"
    )


def _trained(spark, sf, kind, **parameters):
    """(model, feature rows, vectors, names) of one model over all units; None without rows."""

    def build():
        rows = feature_rows(spark, sf)
        if rows.isEmpty():
            return None
        names = ml.feature_names(TARGET, ordered_log(spark, sf).columns)
        model, vectors = ml.train(rows, names, TARGET, kind, **parameters)
        return model, rows, vectors, names

    return once(spark, sf, f"model_{kind}", build)


def _forecast(spark, sf, kind, **parameters):
    made = _trained(spark, sf, kind, **parameters)
    if made is None:
        return ml._no_forecast(ordered_log(spark, sf), ["unit_id"])
    model, rows, vectors, names = made
    scores = ml.evaluation_table(model, vectors, TARGET)
    return ml.point_forecast(model, rows, scores, names, TARGET, kind)


FOREST = {"numTrees": 20, "maxDepth": 8}
BOOSTED = {"maxIter": 10, "maxDepth": 4}


@query("j14_j16_random_forest_forecast")
def forest(spark, sf):
    return _forecast(spark, sf, "random_forest", **FOREST)


@query("j14_j16_gradient_boosting_forecast")
def boosted(spark, sf):
    return _forecast(spark, sf, "gradient_boosting", **BOOSTED)


@query("j15_evaluation")
def evaluation(spark, sf):
    made = _trained(spark, sf, "random_forest", **FOREST)
    if made is None:
        return ml._no_forecast(ordered_log(spark, sf), ["unit_id"]).select("unit_id", "r_squared", "rmse", "mae")
    model, _, vectors, _ = made
    return ml.evaluation_table(model, vectors, TARGET)


@query("j17_l3_top_features")
def top_features(spark, sf):
    made = _trained(spark, sf, "random_forest", **FOREST)
    if made is None:
        empty = ordered_log(spark, sf).filter(F.lit(False))
        return empty.select(F.col("unit_id").alias("feature"), F.col("tmp").alias("importance"))
    model, _, _, names = made
    return ml.importance(spark, model, names)
