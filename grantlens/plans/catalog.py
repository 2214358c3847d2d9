"""All queries by name, and the check SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grantlens.plans import catalog_graph, catalog_harvest, catalog_keys, catalog_pages, catalog_text, catalog_vectors

GROUPS = (catalog_pages, catalog_text, catalog_keys, catalog_graph, catalog_harvest, catalog_vectors)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: query for group in GROUPS for name, query in group.QUERIES.items()
}
ORACLES: dict[str, str] = {name: sql for group in GROUPS for name, sql in group.ORACLES.items()}
