"""Filters, frequency tables, shapes and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_rows(rows: DataFrame, column: str, value: object) -> DataFrame:
    """Rows where ``column`` equals ``value``, with all columns."""
    return rows.filter(F.col(column) == F.lit(value))


def value_counts(rows: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """``(name, count)`` per non-missing value, most frequent first, ties by value."""
    name = name or column
    return (
        rows.filter(F.col(column).isNotNull() & (F.col(column).cast("string") != ""))
        .groupBy(F.col(column).alias(name))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), name)
    )


def top_values(rows: DataFrame, column: str, n: int = 20, name: str | None = None) -> DataFrame:
    """The ``n`` most frequent values; sort and limit merge into one top-n step."""
    return value_counts(rows, column, name).limit(n)


def first_rows(rows: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return rows.orderBy(*order_by).limit(n)


def shape(rows: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(rows.columns)).cast("bigint").alias("n_columns"))


def point_summary(points: DataFrame) -> DataFrame:
    """Rows, distinct journals, and the ranges of date, count and coordinates."""
    ranges = [
        aggregate(name).alias(f"{prefix}_{name}")
        for name in ("date", "citation_count", "x", "y")
        for prefix, aggregate in (("min", F.min), ("max", F.max))
    ]
    return points.agg(
        F.count(F.lit(1)).alias("n_points"), F.count_distinct("journal").alias("n_journals"), *ranges
    )
