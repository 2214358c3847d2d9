"""Queries over the graph and its points, with their check SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions import variants
from grantlens.operators import graph, points, stats
from grantlens.plans import inputs, oracle
from grantlens.session import stage
from grantlens.sources import store


def _grants(spark: SparkSession, folder: str) -> DataFrame:
    return store.open_grants(inputs.grants(spark, folder))


def _papers(spark: SparkSession, folder: str) -> DataFrame:
    return store.open_papers(inputs.papers(spark, folder))


def _place(c: Column) -> list[Column]:
    """Two test coordinates from the md5 of an id."""
    digits = F.md5(c)
    return [
        (F.conv(F.substring(digits, start, 6), 16, 10).cast("double") / 1000.0).alias(name)
        for start, name in ((1, "x"), (7, "y"))
    ]


def grant_paper_edges(spark: SparkSession, folder: str) -> DataFrame:
    """G1"""
    return graph.grant_paper_edges(inputs.links(spark, folder))


def author_paper_edges(spark: SparkSession, folder: str) -> DataFrame:
    """G2, P7"""
    return graph.author_paper_edges(_papers(spark, folder), "hash")


def author_paper_edges_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """G3"""
    return graph.author_paper_edges(_papers(spark, folder), "name")


def all_edges(spark: SparkSession, folder: str) -> DataFrame:
    """U2"""
    return graph.all_edges(inputs.links(spark, folder), _papers(spark, folder))


def edge_stats(spark: SparkSession, folder: str) -> DataFrame:
    """A4"""
    return graph.edge_stats(all_edges(spark, folder))


def grant_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """G4"""
    core = variants.text(variants.parse(F.col("metadata")), "$.core_project_num")
    return graph.grant_nodes(_grants(spark, folder)).withColumn("metadata", core)


def paper_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """G5"""
    uid = variants.text(variants.parse(F.col("metadata")), "$.uid")
    nodes = graph.paper_nodes(_papers(spark, folder)).withColumn("metadata", uid)
    return nodes.withColumn("authors", F.array_join("authors", "|"))


def author_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """G6, A11"""
    papers = stage(_papers(spark, folder).select("pmid", "authors"), "papers")  # parsed once for both
    return graph.author_node_papers(papers)


def node_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A5"""
    papers = _papers(spark, folder)
    return graph.node_counts(
        {
            "grants": graph.grant_nodes(_grants(spark, folder)),
            "papers": graph.paper_nodes(papers),
            "authors": graph.author_nodes(papers),
        }
    )


def network_stats(spark: SparkSession, folder: str) -> DataFrame:
    """G7"""
    return graph.network_stats(_grants(spark, folder), _papers(spark, folder), inputs.links(spark, folder))


def distinct_pmids(spark: SparkSession, folder: str) -> DataFrame:
    """A10"""
    return graph.distinct_pmids(inputs.raw_links(spark, folder))


def representative_papers(spark: SparkSession, folder: str) -> DataFrame:
    """W2"""
    return graph.representative_papers(_papers(spark, folder))


def listed_grants(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats, missing ids and unknown grants of the list stay."""
    joined = graph.listed_grants(inputs.grant_rows(spark, folder), _grants(spark, folder))
    return joined.select("pid", "pref_terms", "title")


def _items(spark: SparkSession, folder: str, scope: str = "all", **options: str) -> DataFrame:
    return graph.items(
        inputs.grant_rows(spark, folder), _grants(spark, folder), _papers(spark, folder),
        inputs.links(spark, folder), scope=scope, **options,
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """G8, U1, W1, P11-P13"""
    return _items(spark, folder).drop("type_rank")


def listed_items(spark: SparkSession, folder: str) -> DataFrame:
    """G8 for the papers of listed grants only, with the longer grant text."""
    template = "{fiscal_year} | {agency_ic_admin} | {project_title}"
    return _items(spark, folder, "listed", grant_template=template).select("item_id", "type", "pid", "text", "mesh_terms")


def item_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """P26"""
    return graph.item_metadata(_items(spark, folder))


def paper_citations(spark: SparkSession, folder: str) -> DataFrame:
    """J5, S10"""
    papers = inputs.table(spark, folder, "orders").select(F.col("o_orderkey").alias("pmid"))
    return points.with_citations(papers, inputs.citations(spark, folder))


def paper_citations_absent(spark: SparkSession, folder: str) -> DataFrame:
    """J5, S10 where there is no citation table."""
    papers = inputs.table(spark, folder, "orders").select(F.col("o_orderkey").alias("pmid"))
    return points.with_citations(papers, store.read_citations(spark, f"{folder}/no-such-table.parquet"))


def join_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    """Rows matched to separately made coordinates; one id on either side is missing."""
    vectors = inputs.table(spark, folder, "embeddings").select(
        F.when(F.col("vec_id") != 7, F.col("vec_id")).alias("item_id"), "label", "embedding"
    )
    x, y = (F.aggregate("embedding", F.lit(0.0), lambda total, value: total + value.cast("double") * F.lit(sign)) for sign in (1.0, 0.5))
    return points.join_coordinates(vectors.select("item_id", "label"), vectors.select("item_id", F.round(x, 6).alias("x"), F.round(y, 6).alias("y")))


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.flat_grants(spark, folder)
    placed = rows.select("item_id", *_place(F.col("item_id").cast("string")))
    return points.merged_points(rows, placed)


def merged_points(spark: SparkSession, folder: str) -> DataFrame:
    """P24, P15-P19"""
    return _merged(spark, folder).withColumn("size", F.round("size", 9))


def point_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A6"""
    return stats.point_summary(_merged(spark, folder))


def network_points(spark: SparkSession, folder: str) -> DataFrame:
    """P25, P20"""
    rows = stage(_items(spark, folder), "items")
    placed = rows.select("item_id", *_place(F.col("item_id")))
    return points.network_points(rows, placed, inputs.citations(spark, folder)).withColumn("size", F.round("size", 9))


QUERIES = {
    "g1_grant_paper_edges": grant_paper_edges,
    "g2_author_paper_edges": author_paper_edges,
    "g3_author_paper_edges_by_name": author_paper_edges_by_name,
    "g4_grant_nodes": grant_nodes,
    "g5_paper_nodes": paper_nodes,
    "g6_a11_author_nodes": author_nodes,
    "g7_network_stats": network_stats,
    "g8_items": items,
    "g8_listed_items": listed_items,
    "u2_all_edges": all_edges,
    "a4_edge_stats": edge_stats,
    "a5_node_counts": node_counts,
    "a6_point_summary": point_summary,
    "a10_distinct_pmids": distinct_pmids,
    "w2_representative_papers": representative_papers,
    "j4_listed_grants": listed_grants,
    "j5_paper_citations": paper_citations,
    "j5_paper_citations_absent": paper_citations_absent,
    "j6_join_coordinates": join_coordinates,
    "p24_merged_points": merged_points,
    "p25_network_points": network_points,
    "p26_item_metadata": item_metadata,
}

_STORES = f"WITH {oracle.GRANTS}, {oracle.GRANT_ROWS}, {oracle.LINKS}, {oracle.PAPERS}"
_G1 = "SELECT core_project_num AS source, pmid AS target, 'grant-paper' AS type FROM links"
_G2 = "SELECT substr(md5(name), 1, 12) AS source, pmid AS target, 'author-paper' AS type FROM authors"
_LISTED = (
    "SELECT * FROM papers WHERE pmid IN (SELECT pmid FROM links WHERE core_project_num IN (SELECT pid FROM grant_rows))"
)
_X, _Y = oracle.place("item_id::VARCHAR")
_MERGED = f"""WITH {oracle.PROJECTS},
points AS (
  SELECT core_project_num AS pid, coalesce(project_start_date, fiscal_year || '-01-01') AS date, agency_ic_admin AS journal,
    project_title AS title, {oracle.terms(['pref_terms', 'spending_categories_desc', 'org_name'], '; ')} AS mesh_terms,
    {_X} AS x, {_Y} AS y, round({oracle.size('award_amount')}, 9) AS size, trunc(award_amount)::BIGINT AS citation_count,
    {oracle.colour('spending_categories_desc')} AS color
  FROM (SELECT o_orderkey AS item_id, * FROM projects)
)"""

ORACLES = {
    "g1_grant_paper_edges": f"WITH {oracle.LINKS} {_G1}",
    "g2_author_paper_edges": f"WITH {oracle.PAPERS} {_G2}",
    "g3_author_paper_edges_by_name": f"""WITH {oracle.PAPERS}
SELECT name AS source, pmid AS target, 'author-paper' AS type FROM authors""",
    "g4_grant_nodes": f"""WITH {oracle.GRANTS}
SELECT core_project_num AS id, 'grant' AS type, project_title AS title, core_project_num AS metadata FROM grants""",
    "g5_paper_nodes": f"""WITH {oracle.PAPERS}
SELECT pmid AS id, 'paper' AS type, title, source AS journal, pubdate,
  c_name || '||' || source || '|Group ' || c_mktsegment AS authors, pmid::VARCHAR AS metadata FROM papers""",
    "g6_a11_author_nodes": f"""WITH {oracle.PAPERS},
numbered AS (SELECT name, pmid, row_number() OVER (PARTITION BY name ORDER BY pmid, pos) AS nth,
  count(*) OVER (PARTITION BY name) AS n_papers FROM authors)
SELECT name AS id, 'author' AS type, name, n_papers, nth, pmid FROM numbered""",
    "g7_network_stats": f"""{_STORES}
SELECT (SELECT count(*) FROM grants) AS total_grants, (SELECT count(*) FROM papers) AS total_papers,
  (SELECT count(DISTINCT name) FROM authors) AS total_authors,
  (SELECT count(*) FROM links) + (SELECT count(*) FROM authors) AS total_edges,
  (SELECT count(*) FROM links) AS grant_paper_edges, (SELECT count(*) FROM authors) AS author_paper_edges""",
    "g8_items": f"{_STORES}, {oracle.items()} SELECT * FROM items",
    "g8_listed_items": f"""{_STORES}, {oracle.items(f'({_LISTED})')}
SELECT item_id, type, pid, mesh_terms, CASE WHEN type = 'grant' THEN
  coalesce(fiscal_year::VARCHAR, '') || ' | ' || journal || ' | ' || title ELSE text END AS text FROM items""",
    "u2_all_edges": f"WITH {oracle.LINKS}, {oracle.PAPERS} {_G1} UNION ALL {_G2}",
    "a4_edge_stats": f"""WITH {oracle.LINKS}, {oracle.PAPERS}, n AS (
  SELECT (SELECT count(*) FROM links) AS a, (SELECT count(*) FROM authors) AS b)
SELECT a + b AS total_edges, a AS grant_paper_edges, b AS author_paper_edges FROM n""",
    "a5_node_counts": f"""{_STORES}
SELECT 'grant' AS type, count(*) AS n FROM grants UNION ALL SELECT 'paper', count(*) FROM papers
UNION ALL SELECT 'author', count(DISTINCT name) FROM authors""",
    "a6_point_summary": f"""{_MERGED}
SELECT count(*) AS n_points, count(DISTINCT journal) AS n_journals, min(date) AS min_date, max(date) AS max_date,
  min(citation_count) AS min_citation_count, max(citation_count) AS max_citation_count,
  min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM points""",
    "a10_distinct_pmids": "SELECT DISTINCT l_orderkey AS pmid FROM lineitem",
    "w2_representative_papers": f"""WITH {oracle.PAPERS},
firsts AS (SELECT name, min(pmid) AS pmid FROM authors GROUP BY name)
SELECT name, pmid, source, title, pubdate FROM firsts JOIN papers USING (pmid)""",
    "j4_listed_grants": f"""{_STORES}
SELECT pid, pref_terms, project_title AS title FROM grant_rows LEFT JOIN grants ON core_project_num = pid""",
    "j5_paper_citations": f"""WITH {oracle.CITATIONS}
SELECT o_orderkey AS pmid, coalesce(citation_count, 0) AS citation_count,
  coalesce(nullif(relative_citation_ratio, 0), 1.0)::DOUBLE AS relative_citation_ratio
FROM orders LEFT JOIN citations ON pmid = o_orderkey""",
    "j5_paper_citations_absent": """
SELECT o_orderkey AS pmid, 0::BIGINT AS citation_count, 1.0::DOUBLE AS relative_citation_ratio FROM orders""",
    "j6_join_coordinates": """
SELECT nullif(vec_id, 7) AS item_id, label, round(list_sum(embedding::DOUBLE[]), 6) AS x,
  round(list_sum(embedding::DOUBLE[]) * 0.5::DOUBLE, 6) AS y FROM embeddings""",
    "p24_merged_points": f"{_MERGED} SELECT * FROM points",
    "p25_network_points": f"""{_STORES}, {oracle.CITATIONS}, {oracle.items()}
SELECT i.pid, {_X} AS x, {_Y} AS y, {oracle.parsed_date('date_text', 'fiscal_year')} AS date, journal, title, mesh_terms,
  CASE type WHEN 'paper' THEN coalesce(citation_count, 0) WHEN 'grant' THEN coalesce(award_amount, 0) ELSE 1 END::DOUBLE AS citation_count,
  round(CASE type WHEN 'paper' THEN coalesce(nullif(relative_citation_ratio, 0), 1.0)
    WHEN 'grant' THEN {oracle.size('award_amount')} ELSE 5.0 END::DOUBLE, 9) AS size,
  CASE type WHEN 'grant' THEN '#ffe100' WHEN 'paper' THEN '#f84848' ELSE '#1196fc' END AS color
FROM items i LEFT JOIN citations c ON i.type = 'paper' AND c.pmid = i.pmid""",
    "p26_item_metadata": f"{_STORES}, {oracle.items()} SELECT pid, type, text AS text_representation FROM items",
}
