import pytest

from grantlens.operators import harvest, stats


@pytest.mark.parametrize("total, n_pages", [(0, 0), (1, 1), (500, 1), (501, 2), (1500, 3)])
def test_page_plan(spark, total, n_pages):
    totals = spark.createDataFrame([(2020, "CA", total)], "fiscal_year int, org_state string, total bigint")
    rows = harvest.page_plan(totals).orderBy("batch").collect()
    assert [(row["batch"], row["offset"], row["limit"]) for row in rows] == [(i, 500 * i, 500) for i in range(n_pages)]


def test_grid_size(spark):
    assert harvest.request_grid(harvest.fiscal_years(spark)).count() == 2296


def test_harvest_stats(spark):
    grid = harvest.request_grid(harvest.fiscal_years(spark, 2020, 2021), ["CA", "NY"])
    cached = spark.createDataFrame(
        [(2020, "CA", 0, 600, 500), (2020, "NY", 0, 0, 0), (2021, "CA", 0, 501, 500), (2021, "CA", 1, 501, 1), (2021, "NY", 3, 9, 9)],
        "fiscal_year int, org_state string, batch int, total bigint, n_results bigint",
    )
    assert harvest.harvest_stats(grid, cached).first().asDict() == {
        "total_combinations": 4, "completed_combinations": 3, "total_projects": 1101, "progress": 75.0, "pages_missing": 1,
    }
    plan = harvest.page_plan(harvest.combination_totals(cached))
    assert [(r["org_state"], r["batch"]) for r in harvest.missing_pages(plan, cached).collect()] == [("CA", 1)]
    counts = {(r["fiscal_year"], r["org_state"]): r["n_records"] for r in harvest.records_per_combination(cached).collect()}
    assert counts == {(2020, "CA"): 500, (2020, "NY"): 0, (2021, "CA"): 501, (2021, "NY"): 9, (None, None): 1010}


def test_frequencies(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("",), ("c",)], "k string")
    assert [tuple(row) for row in stats.value_counts(rows, "k", "agency").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [tuple(row) for row in stats.top_values(rows, "k", 1).collect()] == [("b", 2)]
    assert stats.shape(rows).first().asDict() == {"n_rows": 6, "n_columns": 1}
    assert stats.equal_rows(rows, "k", "b").count() == 2
