"""Planning and tracking of a paged harvest by fiscal year and state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SIZE = 500

# First and last fiscal year of a full harvest.
FISCAL_YEARS = (1985, 2025)

# State and territory codes, in request order.
ORG_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME",
    "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA",
    "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "PR", "VI", "GU", "AS", "MP",
)


def fiscal_years(spark: SparkSession, first: int = FISCAL_YEARS[0], last: int = FISCAL_YEARS[1]) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("fiscal_year"))


def request_grid(years: DataFrame, states: Sequence[str] = ORG_STATES) -> DataFrame:
    """Every (fiscal year, state); each year row is exploded over the state list."""
    return years.select("fiscal_year", F.explode(F.array(*[F.lit(state) for state in states])).alias("org_state"))


def page_plan(totals: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """The pages each combination needs, from its ``total``: none for a total of 0."""
    pages = F.ceil(F.col("total") / F.lit(page_size)).cast("int")
    batches = F.when(F.col("total") > 0, F.sequence(F.lit(0), pages - 1)).otherwise(F.array().cast("array<int>"))
    return totals.select("fiscal_year", "org_state", F.explode(batches).alias("batch")).select(
        "*",
        (F.col("batch").cast("bigint") * F.lit(page_size)).alias("offset"),
        F.lit(page_size).alias("limit"),
    )


def missing_pages(plan: DataFrame, cached: DataFrame) -> DataFrame:
    """Planned pages that are not cached yet."""
    key = ["fiscal_year", "org_state", "batch"]
    return plan.join(cached.select(*key), key, "left_anti")


def combination_totals(page_rows: DataFrame) -> DataFrame:
    """``total`` per combination as told by its page 0."""
    return page_rows.filter("batch = 0").select(
        "fiscal_year", "org_state", F.coalesce("total", F.lit(0)).alias("total")
    )


def records_per_combination(page_rows: DataFrame) -> DataFrame:
    """Records cached per combination, and overall in the row without a combination."""
    return page_rows.rollup("fiscal_year", "org_state").agg(
        F.sum("n_results").alias("n_records"), F.grouping_id().alias("level")
    ).filter("level in (0, 3)").drop("level")


def harvest_stats(grid: DataFrame, page_rows: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Combinations, those with a page 0, their projects, percent done, pages missing."""
    totals = combination_totals(page_rows)
    plan = page_plan(totals, page_size)
    missing = missing_pages(plan, page_rows).groupBy("fiscal_year", "org_state").agg(F.count(F.lit(1)).alias("missing"))
    key = ["fiscal_year", "org_state"]
    counted = grid.join(totals, key, "left").join(missing, key, "left")
    return counted.agg(
        F.count(F.lit(1)).alias("total_combinations"),
        F.count("total").alias("completed_combinations"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total_projects"),
        F.round(F.count("total") * 100.0 / F.count(F.lit(1)), 1).alias("progress"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("pages_missing"),
    )
