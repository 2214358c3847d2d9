"""Stored tables: entity stores, citations, vectors, stage outputs, JSON sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions import variants
from grantlens.sources.pages import path_exists

CITATION_SCHEMA = "pmid bigint, citation_count bigint, relative_citation_ratio double"


# The fields taken from a grant's and a paper's metadata.
GRANT_TYPE = (
    "struct<project_title string, fiscal_year int, award_amount double, project_start_date string, "
    "organization variant, agency_ic_admin variant>"
)
PAPER_TYPE = "struct<source string, title string, pubdate string, authors variant>"


def _filled(path: str) -> Column:
    return F.coalesce(path, F.lit(""))


def open_grants(store: DataFrame) -> DataFrame:
    """A grant store ``(core_project_num, metadata JSON)`` with its fields as columns."""
    read = store.withColumn("m", variants.typed(variants.parse(F.col("metadata")), GRANT_TYPE))
    return read.select(
        "core_project_num",
        _filled("m.project_title").alias("title"),
        F.col("m.fiscal_year").alias("fiscal_year"),
        variants.named_text(F.col("m.agency_ic_admin")).alias("agency"),
        F.coalesce(variants.text(F.col("m.organization"), "$.org_name"), F.lit("")).alias("org_name"),
        F.col("m.project_start_date").alias("start_date"),
        F.col("m.award_amount").alias("award_amount"),
        "metadata",
    )


def open_papers(store: DataFrame) -> DataFrame:
    """A paper store ``(pmid, metadata JSON)`` with its fields as columns.

    ``authors`` keeps every entry: NULL for one that is no object.
    """
    read = store.withColumn("m", variants.typed(variants.parse(F.col("metadata")), PAPER_TYPE))
    return read.select(
        "pmid",
        _filled("m.source").alias("source"),
        _filled("m.title").alias("title"),
        _filled("m.pubdate").alias("pubdate"),
        variants.typed(F.col("m.authors"), "array<struct<name string>>").alias("authors"),
        "metadata",
    )


def read_citations(spark: SparkSession, path: str | None) -> DataFrame | None:
    """The citation table, or None where there is none, so that defaults apply."""
    if path is None or not path_exists(spark, path):
        return None
    return spark.read.schema(CITATION_SCHEMA).parquet(path)


def write_vectors(rows: DataFrame, path: str, item_id: str = "item_id", vector: str = "embedding") -> None:
    """Vectors keyed by item, as ``(item_id, embedding array<float>)``."""
    rows.select(
        F.col(item_id).alias("item_id"), F.col(vector).cast("array<float>").alias("embedding")
    ).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("item_id string, embedding array<float>").parquet(path)


def stage_output(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], if_exists: str = "reuse"
) -> DataFrame:
    """The stage output at ``path``, built and written unless it is to be reused.

    ``if_exists`` is ``reuse``, ``overwrite`` or ``error``. Only an output whose write
    finished counts as existing for reuse; a half-written one is replaced.
    """
    if if_exists not in ("reuse", "overwrite", "error"):
        raise ValueError(f"if_exists must be reuse, overwrite or error, not {if_exists!r}")
    finished = path_exists(spark, f"{path}/_SUCCESS")
    if if_exists == "error" or not (finished and if_exists == "reuse"):
        build().write.mode("errorifexists" if if_exists == "error" else "overwrite").parquet(path)
    return spark.read.parquet(path)


def require_input(spark: SparkSession, path: str) -> None:
    """Fail before any work where an input is missing."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)


#: Rows to a file of JSON lines. One task reads a compressed file, so none is to be long.
JSON_FILE_ROWS = 250_000


def _write_json(rows: DataFrame, path: str, compression: str) -> None:
    # the fastest level takes half the time of the usual one, and half as much room again at most on our rows
    options = {"maxRecordsPerFile": JSON_FILE_ROWS, "zlib.compress.level": "BEST_SPEED"}
    rows.write.mode("overwrite").options(**options).json(path, compression=compression)


def write_edges(edges: DataFrame, stats: DataFrame, path: str, compression: str = "gzip") -> None:
    """Edges and their statistics as JSON lines below ``path``.

    Every line repeats the field names, so the lines are compressed; Spark's readers take them as
    they are. ``compression`` is any codec of the JSON writer, ``none`` for plain text.
    """
    _write_json(edges, f"{path}/edges", compression)
    _write_json(stats, f"{path}/stats", compression)


def write_network(network: dict[str, DataFrame], path: str, compression: str = "gzip") -> None:
    """Every table of a network (node kinds, edges, stats) as JSON lines below ``path``, like :func:`write_edges`."""
    for name, table in network.items():
        _write_json(table, f"{path}/{name}", compression)
