import hashlib
import json

import pytest
from pyspark.sql import functions as F

from grantlens.operators import graph, points
from grantlens.plans import flows
from grantlens.sources import store


@pytest.fixture(scope="module")
def stores(spark):
    papers = [
        (3, {"source": "J3", "title": "T3", "pubdate": "2021 Sep", "authors": [{"name": "B"}, "str", {"name": ""}, {"name": "B"}, {}]}),
        (1, {"source": "J1", "title": "T1", "pubdate": "2020 Winter", "authors": [{"name": "B"}, {"name": "A"}]}),
        (2, {"title": "T2", "authors": None}),
    ]
    grants = [
        ("G1", {"project_title": "one", "fiscal_year": 2020, "award_amount": 40000, "agency_ic_admin": {"abbreviation": "NIA"},
                "organization": {"org_name": "Org"}}),
        ("G2", {"project_title": "two", "agency_ic_admin": "NCI", "organization": None}),
    ]
    links = spark.createDataFrame([("G1", 3), ("G1", 1), ("G2", 1)], "core_project_num string, pmid bigint")
    as_json = lambda rows: [(key, json.dumps(value)) for key, value in rows]
    return (
        store.open_grants(spark.createDataFrame(as_json(grants), "core_project_num string, metadata string")),
        store.open_papers(spark.createDataFrame(as_json(papers), "pmid bigint, metadata string")),
        links,
    )


@pytest.fixture(scope="module")
def listed(spark):
    rows = [("G2", "term", "cat"), ("G2", "term", "cat"), (None, "x", "y"), ("G9", "t9", None)]
    return spark.createDataFrame(rows, "pid string, pref_terms string, spending_categories_desc string")


def md5_id(name):
    return hashlib.md5(name.encode()).hexdigest()[:12]


def test_edges(stores):
    _, papers, links = stores
    edges = sorted(map(tuple, graph.all_edges(links, papers).collect()), key=str)
    assert edges == sorted(
        [("G1", 3, "grant-paper"), ("G1", 1, "grant-paper"), ("G2", 1, "grant-paper"), (md5_id("B"), 3, "author-paper"),
         (md5_id("B"), 3, "author-paper"), (md5_id("B"), 1, "author-paper"), (md5_id("A"), 1, "author-paper")], key=str)
    stats = graph.edge_stats(graph.all_edges(links, papers, "name")).first().asDict()
    assert stats == {"total_edges": 7, "grant_paper_edges": 3, "author_paper_edges": 4}
    with pytest.raises(ValueError):
        graph.author_paper_edges(papers, "number")


def test_nodes_and_stats(stores):
    grants, papers, links = stores
    network = graph.build_network(grants, papers, links)
    by_id = {row["id"]: row for row in network["papers"].collect()}
    assert by_id[3]["authors"] == ["B", "", "B", ""] and by_id[2]["authors"] == [] and by_id[2]["journal"] == ""
    assert json.loads(by_id[1]["metadata"])["title"] == "T1"
    assert {row["id"]: row["title"] for row in network["grants"].collect()} == {"G1": "one", "G2": "two"}
    assert {row["id"]: row["n_papers"] for row in network["authors"].collect()} == {"A": 1, "B": 3}
    assert network["stats"].first().asDict() == {
        "total_grants": 2, "total_papers": 3, "total_authors": 2, "total_edges": 7, "grant_paper_edges": 3, "author_paper_edges": 4,
    }
    nodes = {name: network[name] for name in ("grants", "papers", "authors")}
    assert {row["type"]: row["n"] for row in graph.node_counts(nodes).collect()} == {"grant": 2, "paper": 3, "author": 2}


def test_author_papers_are_rows(stores):
    _, papers, _ = stores
    rows = {tuple(row) for row in graph.author_papers(papers).collect()}
    assert rows == {("A", 1, 1), ("B", 1, 1), ("B", 2, 3), ("B", 3, 3)}


def test_papers_of_a_much_used_name_meet_its_node_in_many_tasks(spark):
    authors = F.array(*[F.struct(name.alias("name")) for name in (F.lit("all"), F.concat(F.lit("a"), F.col("id") % 40), F.lit(""))])
    papers = spark.range(600).select(F.col("id").alias("pmid"), authors.alias("authors"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    usual = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = graph.author_node_papers(papers).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)
    tasks = [row["task"] for row in rows if row["name"] == "all"]
    assert max(tasks.count(task) for task in tasks) < 300
    expected = {("all", 600, pmid + 1, pmid) for pmid in range(600)} | {(f"a{pmid % 40}", 15, pmid // 40 + 1, pmid) for pmid in range(600)}
    assert {tuple(row[name] for name in ("id", "n_papers", "nth", "pmid")) for row in rows} == expected and len(rows) == 1200
    assert {row["type"] for row in rows} == {"author"} and all(row["id"] == row["name"] for row in rows)
    assert graph.author_node_papers(papers.limit(0)).count() == 0


def test_representative_papers(stores):
    _, papers, _ = stores
    assert {row["name"]: (row["pmid"], row["title"]) for row in graph.representative_papers(papers).collect()} == {
        "A": (1, "T1"), "B": (1, "T1"),
    }


def test_items(stores, listed):
    grants, papers, links = stores
    rows = {row["item_id"]: row for row in graph.items(listed, grants, papers).collect()}
    assert sorted(rows) == ["author:A", "author:B", "grant:G2", "grant:G9", "paper:1", "paper:2", "paper:3"]
    assert rows["grant:G2"]["text"] == "two" and rows["grant:G2"]["mesh_terms"] == "term;cat" and rows["grant:G2"]["journal"] == "NCI"
    assert rows["paper:2"]["text"] == " | T2" and rows["author:B"]["text"] == "J1 | B | T1"
    assert rows["author:B"]["pid"] == md5_id("B")
    scoped = {row["item_id"] for row in graph.items(listed, grants, papers, links, scope="listed").collect()}
    assert scoped == {"grant:G2", "grant:G9", "paper:1", "author:A", "author:B"}
    with pytest.raises(ValueError):
        graph.items(listed, grants, papers, scope="some")


def test_listed_grants_keep_repeats(stores, listed):
    grants, _, _ = stores
    titles = [(row["pid"], row["title"]) for row in graph.listed_grants(listed, grants).collect()]
    assert sorted(titles, key=str) == sorted([("G2", "two"), ("G2", "two"), (None, None), ("G9", None)], key=str)


def test_network_points(spark, stores, listed):
    grants, papers, _ = stores
    items = graph.items(listed, grants, papers)
    places = items.select("item_id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    citations = spark.createDataFrame([(3, 9, 0.0), (1, None, 2.5)], "pmid bigint, citation_count bigint, relative_citation_ratio double")
    found = points.network_points(items, places, citations)
    assert tuple(found.columns) == points.NETWORK_COLUMNS
    rows = {row["pid"]: row for row in found.collect()}
    assert (rows["3"]["citation_count"], rows["3"]["size"], rows["3"]["date"]) == (9.0, 1.0, "2021-09-01")
    assert (rows["1"]["citation_count"], rows["1"]["size"], rows["1"]["date"]) == (0.0, 2.5, "2020-01-01")
    assert (rows["2"]["citation_count"], rows["2"]["size"], rows["2"]["date"]) == (0.0, 1.0, "1900-01-01")
    assert (rows["G2"]["size"], rows["G2"]["citation_count"], rows["G2"]["color"]) == (1.0, 0.0, "#ffe100")
    author = rows[md5_id("B")]
    assert (author["size"], author["citation_count"], author["journal"], author["title"], author["color"]) == (5.0, 1.0, "Author", "B", "#1196fc")
    assert {row["size"] for row in points.network_points(items, places).filter("color = '#f84848'").collect()} == {1.0}


@pytest.mark.parametrize("row_ids, vector_ids", [([1, 2, 3], [1, 2]), ([1, 2], [1, 2, 3]), ([1], [2])])
def test_join_coordinates_fails_on_a_mismatch(spark, row_ids, vector_ids):
    rows = spark.createDataFrame([(i,) for i in row_ids], "item_id int")
    vectors = spark.createDataFrame([(i, 0.0, 0.0) for i in vector_ids], "item_id int, x double, y double")
    with pytest.raises(Exception, match="do not match at item"):
        points.join_coordinates(rows, vectors).collect()
    with pytest.raises(Exception, match="do not match at item"):
        points.join_coordinates(rows, vectors).count()


def test_flows_place_every_row(spark, stores, listed):
    grants, papers, links = stores
    found = flows.network_map(listed, grants, papers, links)
    assert found.count() == 7 and found.filter("x is null or y is null").count() == 0


def test_sinks_and_stages(spark, stores, tmp_path):
    grants, papers, links = stores
    edges = graph.all_edges(links, papers)
    store.write_edges(edges, graph.edge_stats(edges), str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e" / "edges")).count() == 7
    assert spark.read.json(str(tmp_path / "e" / "stats")).first()["total_edges"] == 7
    store.write_network(graph.build_network(grants, papers, links), str(tmp_path / "n"))
    assert spark.read.json(str(tmp_path / "n" / "papers")).count() == 3

    path = str(tmp_path / "stage")
    build = lambda value: lambda: spark.createDataFrame([(value,)], "v int")
    assert store.stage_output(spark, path, build(1)).first()["v"] == 1
    assert store.stage_output(spark, path, build(2)).first()["v"] == 1
    assert store.stage_output(spark, path, build(3), "overwrite").first()["v"] == 3
    with pytest.raises(Exception, match="already exists"):
        store.stage_output(spark, path, build(4), "error")
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert store.stage_output(spark, path, build(5)).first()["v"] == 5
    with pytest.raises(ValueError):
        store.stage_output(spark, path, build(6), "maybe")
    store.require_input(spark, path)
    with pytest.raises(FileNotFoundError):
        store.require_input(spark, str(tmp_path / "none"))
    assert store.read_citations(spark, None) is None and store.read_citations(spark, str(tmp_path / "none")) is None


def test_json_lines_take_little_room(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "JSON_FILE_ROWS", 1_000, raising=False)
    odd = 'a "b"\n\t\\ \u2028 é'
    edges = spark.range(5_000).coalesce(1).select(
        F.when(F.col("id") > 0, F.concat(F.lit("G"), "id")).alias("source"),  # a null source leaves its name out
        (F.col("id") * 7_919 % 5_003).alias("target"), F.lit(odd).alias("type"),
    )
    lines = sorted(row[0] for row in edges.select(F.to_json(F.struct("*"))).collect())
    plain_size = sum(len(line.encode()) + 1 for line in lines)

    def size(folder):
        parts = list((tmp_path / folder / "edges").glob("part-*"))
        read = spark.read.schema(edges.schema).json(str(tmp_path / folder / "edges"))
        assert read.exceptAll(edges).count() == 0 and edges.exceptAll(read).count() == 0
        assert sorted(row["value"] for row in spark.read.text(str(tmp_path / folder / "edges")).collect()) == lines
        assert spark.read.json(str(tmp_path / folder / "stats")).first()["total_edges"] == 5_000
        return sum(part.stat().st_size for part in parts), len(parts)

    network = {"edges": edges, "stats": graph.edge_stats(edges)}
    store.write_edges(*network.values(), str(tmp_path / "e"))
    store.write_network(network, str(tmp_path / "n"))
    for written, files in (size("e"), size("n")):
        assert written < plain_size / 3
        assert files == 5, "one task reads a whole compressed file, so files must be short"
    store.write_network(network, str(tmp_path / "plain"), compression="none")
    assert size("plain") == (plain_size, 5)
