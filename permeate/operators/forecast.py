"""Linear and exponential forecasts: every unit and parameter in one grouped regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.functions.missing import ratio
from permeate.functions.regression import fit_lines, line_at, residual_std
from permeate.functions.scalars import from_log, to_log
from permeate.functions.timing import micros_of, plus_days, to_stamp
from permeate.operators.ordering import UNIT

# Two-sided normal quantiles by confidence level.
Z = {0.80: 1.28, 0.90: 1.645, 0.95: 1.96, 0.99: 2.576}

# Parameter -> (display name, critical level, +1 rising / -1 falling).
PARAMETERS = {"tmp": ("TMP", 8.0, 1), "perm_tc": ("Permeability TC", None, -1)}


def _pick(values: dict[str, Column]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(F.col("parameter") == name, value).otherwise(out)
    return out


def long_readings(
    df: DataFrame, parameters: Sequence[str], keys: Sequence[str] = UNIT, start: str | None = None
) -> DataFrame:
    """(keys, us, seq, parameter, reading) without missing readings, from ``start`` on."""
    if start is not None:
        df = df.filter(F.col("us") >= micros_of(start))
    return (
        df.select(*keys, "us", "seq", *[F.col(p).cast("double").alias(p) for p in parameters])
        .unpivot([*keys, "us", "seq"], list(parameters), "parameter", "reading")
        .filter(F.col("reading").isNotNull())
    )


def forecast(
    df: DataFrame,
    model: str = "linear",
    horizon_days: float = 7,
    confidence: float = 0.95,
    start: str | None = None,
    parameters: Sequence[str] = ("tmp", "perm_tc"),
    critical: DataFrame | None = None,
    min_rows: int = 100,
    keys: Sequence[str] = UNIT,
) -> DataFrame:
    """Value expected ``horizon_days`` after the last reading, with bounds and days to the limit.

    linear: bounds are the fitted value -/+ z residual deviations.  exponential: a line through
    ln(y + 0.1), bounds 10 % either way, R² reported as 0.  The permeability limit is
    ``critical_level`` of the ``critical`` table (keys, critical_level).  Days to the limit are
    given only while the trend runs towards a limit that still lies ahead.
    """
    if model not in ("linear", "exponential"):
        raise ValueError(f"unknown forecast model: {model}")
    if confidence not in Z:
        raise ValueError(f"confidence level must be one of {sorted(Z)}")
    keys = list(keys)
    readings = long_readings(df, parameters, keys, start).withColumn(
        "y", F.col("reading") if model == "linear" else to_log(F.col("reading"))
    )
    last = F.max_by("reading", F.struct("us", "seq")).alias("current_value")
    fit = fit_lines(readings, "y", [*keys, "parameter"], extra=[last]).filter(F.col("n") >= min_rows)
    fixed = _pick({p: F.lit(PARAMETERS[p][1]).cast("double") for p in parameters})
    if critical is not None:
        fit = fit.join(critical.select(*keys, "critical_level"), keys, "left")
        fixed = F.coalesce(fixed, F.col("critical_level"))
    horizon_us = plus_days(F.col("end_us"), F.lit(float(horizon_days)))
    fitted = line_at(horizon_us)
    now = line_at(F.col("end_us"))
    if model == "linear":
        predicted, margin = fitted, residual_std(F.col("n"), F.col("ss_res")) * Z[confidence]
        lower, upper, r2 = predicted - margin, predicted + margin, F.col("r_squared")
        goal = F.col("threshold_value")
    else:
        predicted = from_log(fitted)
        lower, upper, r2 = predicted * 0.9, predicted * 1.1, F.lit(0.0)
        goal = to_log(F.col("threshold_value"))
    towards = _pick({p: F.lit(PARAMETERS[p][2]) for p in parameters}) * F.col("slope") > 0
    days = ratio(goal - now, F.col("slope")) / 86400.0
    name = _pick({p: F.lit(PARAMETERS[p][0]) for p in parameters})
    out = (
        fit.withColumn("threshold_value", fixed)
        .withColumn("predicted_value", predicted)
        .withColumn("_days", F.when(towards & (days >= 0), days))
    )
    rising = F.col("parameter") == "tmp"
    in_days = F.lit(f"{horizon_days:g}")
    return out.select(
        *keys,
        name.alias("parameter"),
        F.lit(model).alias("model_type"),
        F.lit(float(horizon_days)).alias("forecast_horizon_days"),
        "current_value",
        "predicted_value",
        to_stamp(horizon_us).alias("prediction_date"),
        F.lit(float(confidence)).alias("confidence_level"),
        lower.alias("lower_bound"),
        upper.alias("upper_bound"),
        r2.alias("r_squared"),
        F.col("_days").alias("time_to_threshold"),
        "threshold_value",
        to_stamp(plus_days(F.col("end_us"), F.col("_days"))).alias("threshold_date"),
        forecast_message(rising, F.col("predicted_value"), F.col("threshold_value"), in_days).alias("message"),
        to_stamp(F.col("end_us")).alias("last_time"),
    )


def forecast_message(rising: Column, predicted: Column, threshold: Column, in_days: Column) -> Column:
    # Message formats.
    tmp_safe = "TMP forecasted to reach %.2f bar in %s days (within safe range)"
    tmp_warn = "WARNING: TMP forecasted to exceed %s bar within %s days"
    perm_safe = "Permeability TC forecasted to reach %.1f LMH/bar in %s days (within acceptable range)"
    perm_warn = "WARNING: Permeability TC forecasted to decline to %.1f LMH/bar within %s days"
    return (
        F.when(rising & (predicted < threshold), F.format_string(tmp_safe, predicted, in_days))
        .when(rising, F.format_string(tmp_warn, threshold.cast("string"), in_days))
        .when(threshold.isNull() | (predicted > threshold), F.format_string(perm_safe, predicted, in_days))
        .otherwise(F.format_string(perm_warn, predicted, in_days))
    )


def choose_model(wanted: str, parameter: str, learning_available: bool = True) -> str:
    """The model to run: tree models fall back to a simple one where they are not available."""
    if wanted in ("linear", "exponential"):
        return wanted
    if not wanted.startswith("ml_"):
        raise ValueError(f"unknown forecast model: {wanted}")
    if learning_available:
        return wanted
    return "exponential" if parameter == "tmp" else "linear"
