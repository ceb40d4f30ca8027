"""Queries by name, each with the SQL that must give the same rows (where SQL can)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from permeate.plans.adapter import ORDERED_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ORDERED_SQL):
    """Register a query; ``sql`` follows the common table expressions ``ctes``."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = f"with {ctes} {sql}" if ctes else sql
        return function

    return add


def rounded(*columns: str, digits: int = 6) -> list[Column]:
    return [F.round(F.col(c).cast("double"), digits).alias(c) for c in columns]


def stamp_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)
