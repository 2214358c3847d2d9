"""Graphs as one JSON document, loaded whole."""

import json

import pytest
from pyspark.sql import functions as F

from grantlens.operators import graph
from grantlens.sources import document, store


def network(spark, grants, papers, links):
    return graph.build_network(
        store.open_grants(spark.createDataFrame(grants, "core_project_num string, metadata string")),
        store.open_papers(spark.createDataFrame(papers, "pmid bigint, metadata string")),
        spark.createDataFrame(links, "core_project_num string, pmid bigint"),
    )


def test_edges_document(spark, tmp_path):
    rows = [(f'G"{k}\\', k, "grant-paper") for k in range(500)]
    edges = spark.createDataFrame(rows, "source string, target bigint, type string").repartition(7)
    for _ in range(2):  # the second replaces the first
        document.write_edges_document(edges, graph.edge_stats(edges), str(tmp_path / "edges.json"))
        found = json.loads((tmp_path / "edges.json").read_text())
        assert sorted((edge["source"], edge["target"], edge["type"]) for edge in found["edges"]) == sorted(rows)
        assert found["stats"]["total_edges"] == 500 and [path.name for path in tmp_path.iterdir() if path.suffix == ".json"] == ["edges.json"]
    document.write_edges_document(edges.limit(0), graph.edge_stats(edges.limit(0)), str(tmp_path / "edges.json"))
    assert json.loads((tmp_path / "edges.json").read_text())["edges"] == []


def test_network_document(spark, tmp_path):
    grants = [(f"G{k}", json.dumps({"project_title": f'title "{k}"\n'})) for k in range(3)]
    papers = [(k, json.dumps({"title": f"p{k}", "source": "J", "authors": [{"name": "Ada"}, {"name": f"B{k}"}]})) for k in (11, 5, 7)]
    links = [("G0", 11), ("G1", 5)]
    made = network(spark, grants, papers, links)
    document.write_network_document(made, str(tmp_path / "network.json"))
    found = json.loads((tmp_path / "network.json").read_text())
    assert list(found["nodes"]) == ["grants", "papers", "authors"] and set(found["nodes"]["grants"]) == {"G0", "G1", "G2"}
    assert found["nodes"]["grants"]["G1"]["title"] == 'title "1"\n' and set(found["nodes"]["papers"]) == {"5", "7", "11"}
    assert found["nodes"]["authors"]["Ada"]["papers"] == [5, 7, 11]
    assert len(found["edges"]) == 8 == found["stats"]["total_edges"]
    document.write_network_document(network(spark, grants[:0], papers[:0], links[:0]), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text())["nodes"] == {"grants": {}, "papers": {}, "authors": {}}


def test_a_document_that_fails_leaves_the_old_one(spark, tmp_path):
    (tmp_path / "edges.json").write_text("old")
    edges = spark.range(5).select(F.when(F.col("id") == 3, F.raise_error(F.lit("torn")).cast("string")).otherwise("x").alias("source"))
    with pytest.raises(Exception, match="torn"):
        document.write_edges_document(edges, spark.range(1), str(tmp_path / "edges.json"))
    assert (tmp_path / "edges.json").read_text() == "old" and len(list(tmp_path.iterdir())) == 1
