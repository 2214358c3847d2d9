"""From page files to a TSV, points and edges, on a hand-made corpus."""

import json

from pyspark.sql import functions as F

from grantlens.operators import extract, graph, stats
from grantlens.plans import flows, inputs
from grantlens.session import shared_folder
from grantlens.sources import pages, responses, store, tsv
from test_pages import page, project, write_page


def test_pages_to_points(spark, tmp_path):
    cache = tmp_path / "cache"
    shared = {"fiscal_year": 2021, "agency_ic_admin": {"abbreviation": "NIA"}, "organization": {"org_name": "Org"}}
    write_page(
        cache, 2021, "CA", "0.json",
        page(
            project("1R01", "R01", project_title="memory AND aging", award_amount=10000, pref_terms="brain", **shared),
            project("2R01", "R01", project_title="later year of the same grant", **shared),
            project("1R02", "R02", project_title="protein folding", spending_categories_desc="Aging", project_start_date="2021-05-06T00:00:00"),
        ),
    )
    write_page(cache, 2021, "NY", "0.json", page(project("1R03", "R03", project_title="a third\tone", award_amount=-1, **shared)))
    path = str(tmp_path / "grants.tsv")
    tsv.write_tsv(extract.written_grants(extract.convert(pages.scan_pages(spark, str(cache)))), path)

    grants = tsv.read_tsv(spark, path, tsv.GRANT_SCHEMA)
    assert {row["agency_ic_admin"]: row["count"] for row in stats.top_values(grants, "agency_ic_admin").collect()} == {"NIA": 2}
    placed = flows.grant_map(grants, item_id="core_project_num")
    assert placed.count() == 3


def test_merged_points_keep_the_id_column(spark, tmp_path):
    rows = [("R01", 2021, None, "NIA", "a title", "brain", "Aging", "Org", "444000"), ("R02", None, "", None, "b", "", None, None, "abc")]
    schema = (
        "core_project_num string, fiscal_year int, project_start_date string, agency_ic_admin string, project_title string, "
        "pref_terms string, spending_categories_desc string, org_name string, award_amount string"
    )
    grants = spark.createDataFrame(rows, schema).withColumns(
        {"abstract_text": F.lit("text"), "project_end_date": F.lit("2022-01-01")}
    )
    points = {row["pid"]: row for row in flows.grant_map(grants, item_id="core_project_num").collect()}
    first, second = points["R01"], points["R02"]
    assert (first["date"], first["mesh_terms"], first["citation_count"]) == ("2021-01-01", "brain; Aging; Org", 444000)
    assert (second["date"], second["mesh_terms"], second["citation_count"], second["size"]) == ("", "", 0, 1.0)
    assert first["x"] is not None and second["color"] == "#1f77b4"


def test_responses_to_edges(spark):
    links = responses.link_rows(
        spark.createDataFrame([('{"results":[{"coreproject":"R01","pmid":5},{"coreproject":"R02","pmid":5}]}',)], "body string")
    ).select("core_project_num", "pmid")
    body = json.dumps({"result": {"uids": ["5"], "5": {"title": "T", "authors": [{"name": "A"}, {"name": "B"}]}}})
    papers = store.open_papers(responses.paper_rows(spark.createDataFrame([(body,)], "body string")))
    stats_row = graph.edge_stats(graph.all_edges(links, papers)).first().asDict()
    assert stats_row == {"total_edges": 4, "grant_paper_edges": 2, "author_paper_edges": 2}


def test_a_written_flow_leaves_nothing_behind(spark, tmp_path):
    before = staged_tables(spark)
    folder = "/root/testdata/sf0.001"
    table = flows.written(spark, lambda: flows.grant_map(inputs.flat_grants(spark, folder)), f"file://{tmp_path}/points")
    assert table.count() == spark.read.parquet(f"{folder}/orders.parquet").count()
    assert staged_tables(spark) == before


def staged_tables(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {str(found.getPath()) for found in files.listStatus(path)} if files.exists(path) else set()
