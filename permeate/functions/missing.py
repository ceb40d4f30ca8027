"""Missing readings are NULL; NaN must not reach an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def finite(value: Column) -> Column:
    """The reading, NULL where it is NaN or infinite."""
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Readings that are no numbers, or infinite, are missing."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: finite(F.col(c)) for c in floats})


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, NULL where the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a missing value in ``columns`` (default: in any column)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def enough(n: Column, at_least: int, value: Column) -> Column:
    """``value`` where it rests on enough rows, else NULL."""
    return F.when(n >= at_least, value)
