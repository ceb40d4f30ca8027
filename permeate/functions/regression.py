"""Least-squares lines as plain aggregates: map-side combined, one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permeate.functions.timing import SECOND

# Stamps are taken relative to 2020-01-01, which keeps seconds small enough for doubles.
_NEAR = 1_577_836_800 * SECOND


def seconds(us: Column) -> Column:
    return (us - F.lit(_NEAR)) / F.lit(float(SECOND))


def r_squared(y: Column, x: Column) -> Column:
    """Share of variance explained; 0 (not 1) where y does not vary."""
    return F.when(F.regr_syy(y, x) == 0, F.lit(0.0)).otherwise(F.regr_r2(y, x))


def slope_per_second(y: Column, us: Column) -> Column:
    return F.regr_slope(y, seconds(us))


def fit_lines(
    df: DataFrame,
    y: str,
    keys: Sequence[str] = ("unit_id",),
    us: str = "us",
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One line ``y = intercept + slope * seconds since the group's first reading`` per group.

    Pairs with a missing reading are left out.  Columns: n, slope (per second), intercept,
    r_squared, residual sum of squares, y_mean, start_us, end_us.
    """
    pairs = df.filter(F.col(y).isNotNull() & F.col(us).isNotNull())
    x, v = seconds(F.col(us)), F.col(y).cast("double")
    sums = pairs.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.regr_slope(v, x).alias("slope"),
        r_squared(v, x).alias("r_squared"),
        F.regr_syy(v, x).alias("_syy"),
        F.avg(x).alias("_x_mean"),
        F.avg(v).alias("y_mean"),
        F.min(us).alias("start_us"),
        F.max(us).alias("end_us"),
        *extra,
    )
    return (
        sums.withColumn(
            "intercept",
            F.col("y_mean") + F.col("slope") * (seconds(F.col("start_us")) - F.col("_x_mean")),
        )
        .withColumn("ss_res", F.col("_syy") * (1 - F.coalesce(F.col("r_squared"), F.lit(0.0))))
        .drop("_syy", "_x_mean")
    )


def line_at(us: Column) -> Column:
    """Value at ``us`` of the line fitted by :func:`fit_lines`."""
    return F.col("intercept") + F.col("slope") * (us - F.col("start_us")) / F.lit(float(SECOND))


def residual_std(n: Column, ss_res: Column, at_least_one: bool = False) -> Column:
    """sqrt(SSres / (n - 2)); NULL for n <= 2 unless the divisor is kept at 1 or more."""
    free = F.greatest(n - 2, F.lit(1)) if at_least_one else F.when(n > 2, n - 2)
    return F.sqrt(F.greatest(ss_res, F.lit(0.0)) / free)


def moments(df: DataFrame, y: str, keys: Sequence[str], us: str = "us") -> DataFrame:
    """Centred sums per group, from which lines over any union of groups can be fitted."""
    x, v = seconds(F.col(us)), F.col(y).cast("double")
    return df.filter(F.col(y).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.regr_avgx(v, x).alias("x_mean"),
        F.regr_avgy(v, x).alias("y_mean"),
        F.regr_sxx(v, x).alias("sxx"),
        F.regr_sxy(v, x).alias("sxy"),
        F.regr_syy(v, x).alias("syy"),
    )


def fit_from_moments(parts: DataFrame, keys: Sequence[str] = ("unit_id",)) -> DataFrame:
    """Line over all parts of each group: n, slope (per second) and r_squared."""
    keys = list(keys)
    c = F.col
    centre = parts.groupBy(*keys).agg(
        (F.sum(c("x_mean") * c("n")) / F.sum("n")).alias("_x"),
        (F.sum(c("y_mean") * c("n")) / F.sum("n")).alias("_y"),
    )
    dx, dy = c("x_mean") - c("_x"), c("y_mean") - c("_y")
    total = parts.join(centre, keys).groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum(c("sxx") + c("n") * dx * dx).alias("_sxx"),
        F.sum(c("sxy") + c("n") * dx * dy).alias("_sxy"),
        F.sum(c("syy") + c("n") * dy * dy).alias("_syy"),
    )
    slope = F.try_divide("_sxy", "_sxx")
    return total.select(
        *keys,
        "n",
        slope.alias("slope"),
        F.when(c("_syy") == 0, F.lit(0.0)).otherwise(slope * F.try_divide("_sxy", "_syy")).alias("r_squared"),
    )
