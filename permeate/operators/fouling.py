"""How fast is a membrane fouling: global TMP slope, stable baseline, decline against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from permeate.functions.missing import ratio
from permeate.functions.regression import fit_lines, slope_per_second
from permeate.functions.scalars import severity
from permeate.functions.timing import DAY, micros_of
from permeate.operators.joins import append_per_unit
from permeate.operators.ordering import UNIT, row_index
from permeate.operators.quality import sample_intervals
from permeate.operators.quantiles import fence, group_quantiles
from permeate.operators.rolling import decline_from_window_start
from permeate.schema import SLOPE_LIMITS
from permeate.storage import attach, stage


def tmp_slopes(
    df: DataFrame, keys: Sequence[str] = UNIT, limits: tuple[float, float, float] = SLOPE_LIMITS
) -> DataFrame:
    """TMP slope per hour and per day, its R² and class, per unit; NULL below two readings."""
    fit = fit_lines(df, "tmp", keys)
    slope = F.when(F.col("n") >= 2, F.col("slope"))
    return fit.select(
        *keys,
        F.col("n").alias("n_rows"),
        (slope * 3600.0).alias("slope_per_hour"),
        (slope * 86400.0).alias("slope_per_day"),
        F.when(F.col("n") >= 2, F.col("r_squared")).alias("r_squared"),
        severity(slope * 3600.0, limits).alias("fouling_class"),
    )


def baseline_week(
    ordered: DataFrame, start: str | None = None, days: float = 7, keys: Sequence[str] = UNIT
) -> DataFrame:
    """Rows of ``[start, start + 7 days)``; by default from each unit's first row on."""
    length = int(days * DAY)
    if start is not None:
        return ordered.filter((F.col("us") >= micros_of(start)) & (F.col("us") < micros_of(start) + length))
    first = ordered.filter("rn = 0").select(*keys, F.col("us").alias("_from"))
    return attach(ordered, first, keys).filter(F.col("us") < F.col("_from") + length).drop("_from")


def stable_windows(
    week: DataFrame,
    column: str = "perm_tc",
    keys: Sequence[str] = UNIT,
    hours: int = 24,
    step_hours: int = 4,
    max_missing: float = 0.1,
    **blocks,
) -> DataFrame:
    """Slope of every candidate window of ``hours`` worth of rows, starting each ``step_hours``.

    A row lies in at most ``hours / step_hours`` windows and is handed to exactly those, so the
    slopes are one grouped aggregation.
    """
    keys = list(keys)
    medians = group_quantiles(
        sample_intervals(week, keys, **blocks), "interval_s", {"_interval": 0.5}, keys
    ).drop("n")
    shape = (
        week.groupBy(*keys)
        .agg(F.count("*").alias("_n"), F.min("rn").alias("_rn0"))
        .join(medians, keys)
        .withColumn("_per_hour", F.floor(ratio(F.lit(3600.0), F.col("_interval"))))
        .filter("_per_hour > 0")
        .withColumn("_length", F.col("_per_hour") * hours)
        .withColumn("_step", F.col("_per_hour") * step_hours)
        .filter("_n > _length")
    )
    place = F.col("rn") - F.col("_rn0")
    first = F.greatest(F.lit(0), F.ceil((place - F.col("_length") + 1) / F.col("_step")))
    # Windows start before row n - length only.
    last = F.least(
        F.floor(place / F.col("_step")),
        F.ceil((F.col("_n") - F.col("_length")) / F.col("_step")) - 1,
    )
    spread = (
        attach(week, shape, keys)
        .filter(first <= last)
        .withColumn("window_no", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    )
    sma = F.avg(f"{column}_sma") if f"{column}_sma" in week.columns else F.avg(column)
    return (
        spread.groupBy(*keys, "window_no")
        .agg(
            F.count("*").alias("n_rows"),
            F.count(column).alias("n_readings"),
            slope_per_second(F.col(column), F.col("us")).alias("slope"),
            sma.alias("level"),
            F.min("us").alias("start_us"),
            F.max("us").alias("end_us"),
        )
        .filter(
            (F.col("n_rows") - F.col("n_readings") <= max_missing * F.col("n_rows"))
            & F.col("slope").isNotNull()
        )
    )


def most_stable_window(windows: DataFrame, keys: Sequence[str] = UNIT) -> DataFrame:
    """The flattest window of each unit, the earliest one on equal slopes."""
    best = windows.groupBy(*keys).agg(
        F.min_by(
            F.struct("window_no", "slope", "level", "n_rows", "start_us", "end_us"),
            F.struct(F.abs("slope"), "window_no"),
        ).alias("_best")
    )
    return best.select(*keys, "_best.*")


def permeability_baseline(
    ordered: DataFrame,
    column: str = "perm_tc",
    start: str | None = None,
    keys: Sequence[str] = UNIT,
    min_rows: int = 10,
    **blocks,
) -> DataFrame:
    """Baseline level, current level and decline in percent per unit.

    Baseline: level of the flattest day of the first week, else the week's mean.  Units with
    fewer than ``min_rows`` rows in the week get NULL (see :func:`add_decline`).
    """
    keys = list(keys)
    level = f"{column}_sma" if f"{column}_sma" in ordered.columns else column
    week = stage(
        baseline_week(ordered, start, keys=keys).select(
            *dict.fromkeys([*keys, "us", "seq", "rn", column, level])
        ),
        "week",
    )
    best = most_stable_window(stable_windows(week, column, keys, **blocks), keys)
    means = week.groupBy(*keys).agg(F.count("*").alias("_rows"), F.avg(level).alias("_mean"))
    current = ordered.groupBy(*keys).agg(F.max_by(level, "rn").alias("current_level"))
    base = F.when(F.col("_rows") >= min_rows, F.coalesce("level", "_mean"))
    return (
        current.join(means, keys, "left")
        .join(best.select(*keys, "level"), keys, "left")
        .select(
            *keys,
            base.alias("permeability_baseline"),
            "current_level",
            F.when(base > 0, ratio(base - F.col("current_level"), base) * 100.0)
            .when(base.isNotNull(), F.lit(0.0))
            .alias("permeability_decline_baseline"),
        )
    )


def add_decline(
    ordered: DataFrame,
    column: str = "perm_tc",
    window: str = "7d",
    start: str | None = None,
    keys: Sequence[str] = UNIT,
    **blocks,
) -> DataFrame:
    """Append baseline and decline to every row; units without a usable baseline week get the
    decline since the start of the trailing window instead."""
    base = permeability_baseline(ordered, column, start, keys, **blocks).drop("current_level")
    rolled = decline_from_window_start(ordered, column, window, keys, **blocks)
    fallback = f"{column}_decline_{window}"
    return append_per_unit(rolled, base, keys).withColumn(
        fallback, F.when(F.col("permeability_baseline").isNull(), F.col(fallback))
    )


def daily_low(df: DataFrame, column: str = "perm_tc", keys: Sequence[str] = UNIT) -> DataFrame:
    """10th percentile of each day, or the minimum on days with fewer than 10 readings."""
    days = df.filter(F.col(column).isNotNull()).withColumn("day", F.floor(F.col("us") / DAY).cast("long"))
    return (
        group_quantiles(days, column, {"_p10": 0.1, "_low": 0.0}, [*keys, "day"])
        .select(
            *keys,
            (F.col("day") * DAY).alias("us"),
            F.when(F.col("n") >= 10, F.col("_p10")).otherwise(F.col("_low")).alias("daily_value"),
            "n",
        )
    )


def fenced_daily_low(df: DataFrame, column: str = "perm_tc", keys: Sequence[str] = UNIT) -> DataFrame:
    """Daily values inside the fence, numbered in day order (``rn`` 1, 2, …)."""
    daily = stage(daily_low(df, column, keys), "daily")
    kept = fence(daily, "daily_value", keys, tie=("us",), at_least=4).filter("inside")
    return row_index(kept.drop("inside", "fence_low", "fence_high"), keys, ["us"], name="daily")


def stable_start(points: DataFrame, keys: Sequence[str] = UNIT, first: int = 5) -> DataFrame:
    """Mean of the first five daily values (else the first one) and the critical level, 60 % of it."""
    early = F.col("rn") < first
    start = F.when(F.count("*") >= first, F.avg(F.when(early, F.col("daily_value")))).otherwise(
        F.min_by("daily_value", "rn")
    )
    return points.groupBy(*keys).agg(
        start.alias("stable_start"), (start * 0.6).alias("critical_level")
    )
