"""Tables a chart can be drawn from directly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.functions.missing import ratio
from permeate.functions.regression import fit_lines, line_at, residual_std
from permeate.functions.scalars import severity
from permeate.functions.timing import micros_of, plus_days, to_stamp
from permeate.operators.ordering import UNIT
from permeate.operators.prepare import stride_sample
from permeate.operators.quantiles import fence
from permeate.operators.rolling import moving_average
from permeate.schema import CHART_SLOPE_LIMITS, DECLINE_LIMITS
from permeate.storage import stage

PATH_POINTS = 20
DAY_S = 86400.0


def series(
    ordered: DataFrame,
    columns: Sequence[str],
    max_points: int = 10_000,
    rows: int = 50,
    temperature: str = "temp_c",
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Thinned readings with their moving average and the smoothed temperature, in long form."""
    wanted = list(dict.fromkeys([*columns, temperature]))
    sample = stage(
        stride_sample(ordered.select(*keys, "us", "seq", "rn", *wanted), max_points, keys), "sample"
    )
    smooth = moving_average(sample, wanted, rows, keys, **blocks)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("parameter"), F.col(c).cast("double").alias("raw"), F.col(f"{c}_sma").alias("sma"))
            for c in columns
        ]
    )
    return smooth.select(
        *keys, to_stamp(F.col("us")).alias("ts"), F.col(f"{temperature}_sma").alias("temperature"),
        F.explode(pairs).alias("_p"),
    ).select(*keys, "ts", "_p.*", "temperature")


def trend_points(
    points: DataFrame, value: str, keys: Sequence[str] = UNIT, tie: Sequence[str] = ("us",), min_points: int = 3
) -> DataFrame:
    """Points inside the fence (from 4 points on) with the fitted line at each of them."""
    keys = list(keys)
    kept = stage(
        fence(points, value, keys, tie, at_least=4).filter("inside").drop("inside", "fence_low", "fence_high"),
        "points",
    )
    fit = fit_lines(kept, value, keys).filter(F.col("n") >= min_points)
    return kept.join(fit.select(*keys, "slope", "intercept", "start_us"), keys, "left").select(
        *keys, "us", to_stamp(F.col("us")).alias("time"), value, line_at(F.col("us")).alias("trend")
    )


def cycle_start_points(cycles: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    points = cycles.select(*keys, F.col("start_us").alias("us"), "tmp_start")
    return trend_points(points, "tmp_start", keys)


def refit(
    points: DataFrame,
    value: str,
    start: str | None = None,
    end: str | None = None,
    horizon_days: float = 7,
    threshold: float = 6.0,
    keys: Sequence[str] = UNIT,
) -> DataFrame:
    """Line through the points of a chosen time range (both ends included), its forecast from
    the last of all points, the margin at the horizon and the days to the limit."""
    keys = list(keys)
    seen = points
    if start is not None:
        seen = seen.filter(F.col("us") >= micros_of(start))
    if end is not None:
        seen = seen.filter(F.col("us") <= micros_of(end))
    fit = fit_lines(seen, value, keys).filter((F.col("n") >= 2) & F.col("slope").isNotNull())
    ends = points.groupBy(*keys).agg(F.max("us").alias("last_us"))
    at_last = line_at(F.col("last_us"))
    horizon = plus_days(F.col("last_us"), F.lit(float(horizon_days)))
    return fit.join(ends, keys).select(
        *keys,
        "n",
        (F.col("slope") * DAY_S).alias("slope_per_day"),
        "r_squared",
        "last_us",
        at_last.alias("fitted_at_last"),
        horizon.alias("horizon_us"),
        line_at(horizon).alias("predicted_value"),
        (residual_std(F.col("n"), F.col("ss_res"), at_least_one=True) * 1.96).alias("margin"),
        F.when(F.col("slope") > 0, (F.lit(threshold) - at_last) / (F.col("slope") * DAY_S)).alias(
            "days_to_threshold"
        ),
    )


def path(
    ends: DataFrame,
    start_us: Column,
    end_us: Column,
    start_value: Column,
    end_value: Column,
    lower: Column | None = None,
    upper: Column | None = None,
    keys: Sequence[str] = UNIT,
    points: int = PATH_POINTS,
) -> DataFrame:
    """Evenly spaced points on the way to a forecast, optionally with a cone that opens from the
    last point (zero width) to the bounds."""
    share = F.col("point") / F.lit(float(points - 1))
    out = ends.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    cone = []
    if lower is not None and upper is not None:
        cone = [
            (start_value + share * (lower - start_value)).alias("lower"),
            (start_value + share * (upper - start_value)).alias("upper"),
        ]
    return out.select(
        *keys,
        "point",
        to_stamp(start_us + F.round(share * (end_us - start_us)).cast("long")).alias("time"),
        (start_value + share * (end_value - start_value)).alias("value"),
        *cone,
    )


def last_points(points: DataFrame, value: str, keys: Sequence[str] = UNIT) -> DataFrame:
    return points.groupBy(*keys).agg(F.max("us").alias("last_us"), F.max_by(value, "us").alias("last_value"))


def forecast_path(points: DataFrame, value: str, forecasts: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """20 points from the last chart point to the forecast, with the confidence cone."""
    keys = list(keys)
    ends = last_points(points, value, keys).join(
        forecasts.withColumn("horizon_us", F.expr(
            "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', prediction_date)"
        )).select(*keys, "horizon_us", "predicted_value", "lower_bound", "upper_bound"),
        keys,
    )
    c = F.col
    return path(ends, c("last_us"), c("horizon_us"), c("last_value"), c("predicted_value"),
                c("lower_bound"), c("upper_bound"), keys)


def refit_path(refits: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """20 points and cone of :func:`refit`."""
    c = F.col
    return path(refits, c("last_us"), c("horizon_us"), c("fitted_at_last"), c("predicted_value"),
                c("predicted_value") - c("margin"), c("predicted_value") + c("margin"), keys)


def threshold_line(
    df: DataFrame, forecasts: DataFrame, level: Column, keys: Sequence[str] = UNIT
) -> DataFrame:
    """Two points per unit: first stamp of the log and the forecast date, at the limit."""
    keys = list(keys)
    start = df.groupBy(*keys).agg(F.min("us").alias("_from"))
    ends = start.join(forecasts, keys)
    times = F.array(to_stamp(F.col("_from")), F.col("prediction_date"))
    return ends.select(*keys, level.alias("level"), F.explode(times).alias("time"))


def value_range(points: DataFrame, value: str, keys: Sequence[str] = UNIT) -> DataFrame:
    return points.groupBy(*keys).agg(
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        (F.min(value) * 0.7).alias("axis_low"),
        (F.max(value) * 1.3).alias("axis_high"),
    )


def cleaning_markers(
    cleanings: DataFrame, points: DataFrame, value: str, keys: Sequence[str] = UNIT, otherwise: tuple[float, float] = (0.0, 6.0)
) -> DataFrame:
    """One vertical line per cleaning, over the range of the drawn points."""
    keys = list(keys)
    ranges = value_range(points, value, keys).select(*keys, "axis_low", "axis_high")
    low, high = otherwise
    return cleanings.join(ranges, keys, "left").select(
        *keys,
        "cleaning_time",
        F.coalesce("axis_low", F.lit(low)).alias("y_low"),
        F.coalesce("axis_high", F.lit(high)).alias("y_high"),
    )


def tmp_note(points: DataFrame, rates: DataFrame, threshold: float = 6.0, keys: Sequence[str] = UNIT) -> DataFrame:
    """Class, slope, R² and days to the limit of the cycle-start trend."""
    keys = list(keys)
    fit = fit_lines(points, "tmp_start", keys).filter(F.col("n") > 2)
    days = F.when(
        F.col("slope") > 0, ratio(F.lit(threshold) - line_at(F.col("end_us")), F.col("slope") * DAY_S)
    )
    return (
        fit.withColumn("_days", F.when(days > 0, days))
        .join(rates.select(*keys, "reversible_rate"), keys, "left")
        .select(
            *keys,
            severity(F.col("slope") * 3600.0, CHART_SLOPE_LIMITS).alias("fouling_class"),
            (F.col("slope") * DAY_S).alias("slope_per_day"),
            "r_squared",
            "reversible_rate",
            F.col("_days").alias("days_to_threshold"),
            F.date_format(to_stamp(plus_days(F.col("end_us"), F.col("_days"))), "yyyy-MM-dd").alias("threshold_date"),
        )
    )


def decline_note(points: DataFrame, starts: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """Class, slope, percent per day and days to the critical level of the daily baseline."""
    keys = list(keys)
    last = F.max_by("daily_value", "us").alias("_last")
    fit = fit_lines(points, "daily_value", keys, extra=[last]).filter(F.col("n") > 2)
    per_day = F.col("slope") * DAY_S
    percent = F.when(F.col("stable_start") > 0, F.abs(per_day / F.col("stable_start") * 100.0))
    days = F.when(F.col("slope") < 0, ratio(F.col("critical_level") - F.col("_last"), per_day))
    return (
        fit.join(starts, keys)
        .withColumn("_days", F.when(days > 0, days))
        .select(
            *keys,
            F.coalesce(severity(percent, DECLINE_LIMITS), F.lit("low")).alias("decline_class"),
            per_day.alias("slope_per_day"),
            "r_squared",
            percent.alias("decline_percent_per_day"),
            F.col("_days").alias("days_to_critical"),
            F.date_format(to_stamp(plus_days(F.col("end_us"), F.col("_days"))), "yyyy-MM-dd").alias("critical_date"),
        )
    )


def cycle_comparison(cycles: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    return cycles.select(*keys, "cycle_id", "tmp_slope", "duration_hours")
