"""Queries that plan and track a harvest, with their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.operators import harvest
from grantlens.plans import inputs, oracle

SIZE = 50


def request_grid(spark: SparkSession, folder: str) -> DataFrame:
    """J7"""
    return harvest.request_grid(inputs.order_years(spark, folder))


def page_plan(spark: SparkSession, folder: str) -> DataFrame:
    """W4"""
    return harvest.page_plan(harvest.combination_totals(inputs.page_counts(spark, folder, SIZE)), SIZE)


def missing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """J8"""
    cached = inputs.page_counts(spark, folder, SIZE)
    plan = harvest.page_plan(harvest.combination_totals(cached), SIZE)
    return harvest.missing_pages(plan, cached).select("fiscal_year", "org_state", "batch", "offset", "limit")


def harvest_stats(spark: SparkSession, folder: str) -> DataFrame:
    """A7"""
    return harvest.harvest_stats(request_grid(spark, folder), inputs.page_counts(spark, folder, SIZE), SIZE)


def combination_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The total of every combination, 0 where there is no page."""
    totals = harvest.combination_totals(inputs.page_counts(spark, folder, SIZE))
    grid = request_grid(spark, folder)
    return grid.join(totals, ["fiscal_year", "org_state"], "left").select(
        "fiscal_year", "org_state", F.coalesce("total", F.lit(0)).alias("total")
    )


def records_per_combination(spark: SparkSession, folder: str) -> DataFrame:
    """A9"""
    return harvest.records_per_combination(inputs.page_counts(spark, folder, SIZE))


QUERIES = {
    "j7_request_grid": request_grid,
    "j8_missing_pages": missing_pages,
    "w4_page_plan": page_plan,
    "a7_harvest_stats": harvest_stats,
    "a8_combination_totals": combination_totals,
    "a9_records_per_combination": records_per_combination,
}

_HARVEST = f"WITH {oracle.harvest(SIZE)}"

ORACLES = {
    "j7_request_grid": f"{_HARVEST} SELECT fiscal_year, org_state FROM grid",
    "j8_missing_pages": f"""{_HARVEST}
SELECT fiscal_year, org_state, batch, batch::BIGINT * {SIZE} AS "offset", {SIZE} AS "limit" FROM lacking""",
    "w4_page_plan": f"""{_HARVEST}
SELECT fiscal_year, org_state, batch, batch::BIGINT * {SIZE} AS "offset", {SIZE} AS "limit" FROM plan""",
    "a7_harvest_stats": f"""{_HARVEST}
SELECT count(*) AS total_combinations, count(total) AS completed_combinations, sum(total)::BIGINT AS total_projects,
  round(count(total) * 100.0 / count(*), 1)::DOUBLE AS progress, (SELECT count(*) FROM lacking) AS pages_missing
FROM grid LEFT JOIN told USING (fiscal_year, org_state)""",
    "a8_combination_totals": f"""{_HARVEST}
SELECT fiscal_year, org_state, coalesce(total, 0) AS total FROM grid LEFT JOIN told USING (fiscal_year, org_state)""",
    "a9_records_per_combination": f"""{_HARVEST}
SELECT fiscal_year, org_state, sum(n_results)::BIGINT AS n_records FROM pages GROUP BY GROUPING SETS ((fiscal_year, org_state), ())""",
}
