"""Queries that make and place vectors, and the two flows that end in maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.operators import dedupe, graph, layout, semantic, vectors
from grantlens.plans import flows, inputs, oracle
from grantlens.sources import responses, store


def embed_text(spark: SparkSession, folder: str) -> DataFrame:
    """V1 on whole documents: every number of the vectors that is not zero."""
    rows = inputs.table(spark, folder, "documents").select(F.col("doc_id").alias("item_id"), "text")
    numbers = vectors.embed_text(rows).select("item_id", F.posexplode("embedding").alias("pos", "value"))
    return numbers.filter("value <> 0").withColumn("value", F.round(F.col("value").cast("double"), 6))


def learnt_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """V1, learnt from whole documents; tests compare with a singular value decomposition."""
    rows = inputs.table(spark, folder, "documents").select(F.col("doc_id").alias("item_id"), "text")
    return semantic.learn_vectors(rows)


def learnt_axes(spark: SparkSession, folder: str) -> DataFrame:
    """V1, learnt: whole documents along the two main directions of 64 places."""
    rows = inputs.table(spark, folder, "documents").select(F.col("doc_id").alias("item_id"), "text")
    sparse = semantic.sparse_texts(rows, dimensions=64)
    axes, _ = semantic.main_directions(sparse, 64, 2, residue=1e-10)
    placed = semantic.projected(sparse, axes, kind="double")
    return placed.select("item_id", *[F.round(F.coalesce(F.get("embedding", k), F.lit(0.0)), 4).alias(name) for k, name in ((0, "x"), (1, "y"))])


def project_2d(spark: SparkSession, folder: str) -> DataFrame:
    """V2"""
    rows = inputs.table(spark, folder, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    placed = vectors.project_2d(rows, scale=5.5)
    return placed.select("item_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def neighbour_map(spark: SparkSession, folder: str) -> DataFrame:
    """V2, non-linear; tests compare neighbours on the map with those of the vectors."""
    rows = inputs.table(spark, folder, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    return layout.neighbour_map(rows, scale=5.5)


def _landmarks(spark: SparkSession, folder: str) -> DataFrame:
    """One landmark per label: the mean vector of its rows, on a diagonal."""
    long = inputs.table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("pos", "value"))
    means = long.groupBy("label", "pos").agg(F.avg(F.col("value").cast("double")).alias("value"))
    vector = F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda pair: pair["value"])
    return means.groupBy("label").agg(vector.alias("embedding")).select(
        "embedding", F.col("label").cast("double").alias("x"), (F.col("label") * -2.0).alias("y")
    )


def place_by_landmarks(spark: SparkSession, folder: str) -> DataFrame:
    """V3: every vector among the means of the labels."""
    rows = inputs.table(spark, folder, "embeddings").select(F.col("vec_id").alias("item_id"), "embedding")
    placed = vectors.place_by_landmarks(rows, _landmarks(spark, folder), k=3)
    return placed.select("item_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def grant_map(spark: SparkSession, folder: str) -> DataFrame:
    """Flat grants to texts, vectors, 2-D places and merged points."""
    return flows.grant_map(inputs.flat_grants(spark, folder))


def network_map(spark: SparkSession, folder: str) -> DataFrame:
    """Stores to items, vectors, 2-D places and network points."""
    return flows.network_map(
        inputs.grant_rows(spark, folder),
        store.open_grants(inputs.grants(spark, folder)),
        store.open_papers(inputs.papers(spark, folder)),
        inputs.links(spark, folder),
        inputs.citations(spark, folder),
    )


def response_network(spark: SparkSession, folder: str) -> DataFrame:
    """E3 from its start: responses (S15-S17) into stores (D2, D3, A10) and their network's statistics."""
    incoming = responses.grant_rows(inputs.grant_responses(spark, folder), carry=["seq"])
    no_grants = spark.createDataFrame([], "core_project_num string, metadata string")
    grants = dedupe.upsert(no_grants, incoming, "core_project_num", ["seq", "pos"])
    no_links = spark.createDataFrame([], "core_project_num string, pmid bigint")
    links = dedupe.insert_ignore(no_links, responses.link_rows(inputs.link_responses(spark, folder)), ["core_project_num", "pmid"])
    found = responses.paper_rows(inputs.summary_responses(spark, folder)).select("pmid", "metadata")
    papers = dedupe.existing_keys(found, graph.distinct_pmids(links), "pmid")
    return graph.network_stats(store.open_grants(grants), store.open_papers(papers), links)


QUERIES = {
    "v1_embed_text": embed_text,
    "v1_learnt_vectors": learnt_vectors,
    "v1_learnt_axes": learnt_axes,
    "v2_project_2d": project_2d,
    "v2_neighbour_map": neighbour_map,
    "v3_place_by_landmarks": place_by_landmarks,
    "e2_grant_map": grant_map,
    "e3_network_map": network_map,
    "e3_response_network": response_network,
}

def _axis(number: int, matrix: str, squarings: int = 17) -> str:
    """``axis<number>(i, v)``: the main axis of a symmetric matrix (i, j, v), by squaring it again and again."""
    steps = [f"m{number}_0 AS MATERIALIZED (SELECT * FROM {matrix})"]
    for k in range(squarings):
        steps.append(
            f"m{number}_{k + 1} AS MATERIALIZED (SELECT i, j, v / max(abs(v)) OVER () AS v FROM "
            f"(SELECT a.i, b.j, sum(a.v * b.v) AS v FROM m{number}_{k} a JOIN m{number}_{k} b ON a.j = b.i GROUP BY a.i, b.j))"
        )
    last = f"m{number}_{squarings}"
    steps.append(
        f"raw{number} AS (SELECT i, v FROM {last} WHERE j = (SELECT j FROM {last} GROUP BY j ORDER BY sum(v * v) DESC LIMIT 1))"
    )
    steps.append(
        f"axis{number} AS MATERIALIZED (SELECT i, v * (SELECT sign(arg_max(v, abs(v))) FROM raw{number}) / "
        f"(SELECT sqrt(sum(v * v)) FROM raw{number}) AS v FROM raw{number})"
    )
    return ",\n".join(steps)


def _weighted_tokens(dimensions: int) -> str:
    """Token counts times the weights of their places."""
    return f"""tokens AS (
  SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS token FROM documents
),
counts AS (
  SELECT doc_id, ((('0x' || substr(md5(token), 1, 8))::BIGINT) % {dimensions})::INTEGER AS pos, count(*) AS n FROM tokens GROUP BY ALL
),
weights AS (
  SELECT pos, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) AS weight FROM counts GROUP BY pos
),
weighted AS (SELECT doc_id, pos, n * weight AS value FROM counts JOIN weights USING (pos))"""


ORACLES = {
    "v2_project_2d": f"""WITH long AS MATERIALIZED (
  SELECT vec_id, unnest(range(0, len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings
),
centred AS MATERIALIZED (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY i) AS v FROM long),
covariance AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(a.v * b.v) / ((SELECT count(*) FROM embeddings) - 1) AS v FROM centred a JOIN centred b USING (vec_id) GROUP BY a.i, b.i
),
{_axis(1, 'covariance')},
spread AS (SELECT sum(a.v * c.v * b.v) AS v FROM covariance c JOIN axis1 a ON a.i = c.i JOIN axis1 b ON b.i = c.j),
deflated AS MATERIALIZED (
  SELECT c.i, c.j, c.v - (SELECT v FROM spread) * a.v * b.v AS v FROM covariance c JOIN axis1 a ON a.i = c.i JOIN axis1 b ON b.i = c.j
),
{_axis(2, 'deflated')}
SELECT vec_id AS item_id, round(sum(long.v * axis1.v) * 5.5::DOUBLE, 4) AS x, round(sum(long.v * axis2.v) * 5.5::DOUBLE, 4) AS y
FROM long JOIN axis1 USING (i) JOIN axis2 USING (i) GROUP BY vec_id""",
    "v1_learnt_axes": f"""WITH {_weighted_tokens(64)},
long AS MATERIALIZED (
  SELECT doc_id, pos AS i, value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)) AS v FROM weighted WHERE value <> 0
),
gram AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM long a JOIN long b USING (doc_id) GROUP BY a.i, b.i),
{_axis(1, 'gram')},
size AS (SELECT sum(a.v * g.v * b.v) AS v FROM gram g JOIN axis1 a ON a.i = g.i JOIN axis1 b ON b.i = g.j),
deflated AS MATERIALIZED (
  SELECT g.i, g.j, g.v - (SELECT v FROM size) * a.v * b.v AS v FROM gram g JOIN axis1 a ON a.i = g.i JOIN axis1 b ON b.i = g.j
),
{_axis(2, 'deflated')}
SELECT doc_id AS item_id, round(coalesce(sum(long.v * axis1.v), 0), 4) AS x, round(coalesce(sum(long.v * axis2.v), 0), 4) AS y
FROM documents LEFT JOIN long USING (doc_id) LEFT JOIN axis1 USING (i) LEFT JOIN axis2 USING (i) GROUP BY doc_id""",
    "v1_embed_text": f"""WITH {_weighted_tokens(256)}
SELECT doc_id AS item_id, pos, round((value / sqrt(sum(value * value) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE, 6) AS value
FROM weighted WHERE value <> 0""",
    "e3_response_network": f"""WITH {oracle.PROJECTS}, {oracle.PAPERS},
found AS (
  SELECT DISTINCT 'G' || l_suppkey AS core_project_num, l_orderkey AS pmid FROM lineitem
  WHERE l_returnflag <> 'A' AND (l_returnflag <> 'R' OR l_linestatus <> 'O') AND l_orderkey <> 0
),
named AS (SELECT * FROM authors WHERE pmid IN (SELECT pmid FROM found))
SELECT (SELECT count(DISTINCT core_project_num) FROM projects WHERE core_project_num <> '') AS total_grants,
  (SELECT count(*) FROM papers WHERE pmid IN (SELECT pmid FROM found)) AS total_papers,
  (SELECT count(DISTINCT name) FROM named) AS total_authors,
  (SELECT count(*) FROM found) + (SELECT count(*) FROM named) AS total_edges,
  (SELECT count(*) FROM found) AS grant_paper_edges, (SELECT count(*) FROM named) AS author_paper_edges""",
    "v3_place_by_landmarks": """WITH long AS (
  SELECT label, unnest(embedding)::DOUBLE AS value, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings
),
means AS (SELECT label, pos, avg(value) AS value FROM long GROUP BY label, pos),
landmarks AS (SELECT label, list(value ORDER BY pos) AS axis FROM means GROUP BY label),
ranked AS (
  SELECT vec_id, label, similarity, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, label) AS nth
  FROM (SELECT vec_id, l.label, list_cosine_similarity(e.embedding::DOUBLE[], l.axis) AS similarity FROM embeddings e, landmarks l)
),
weighted AS (SELECT vec_id, label, greatest(similarity, 0) AS weight FROM ranked WHERE nth <= 3),
settled AS (
  SELECT vec_id, label, CASE WHEN sum(weight) OVER (PARTITION BY vec_id) = 0 THEN 1 ELSE weight END AS weight FROM weighted
)
SELECT vec_id AS item_id, round(sum(weight * label) / sum(weight), 6) AS x, round(sum(weight * label * -2.0::DOUBLE) / sum(weight), 6) AS y
FROM settled GROUP BY vec_id""",
}
