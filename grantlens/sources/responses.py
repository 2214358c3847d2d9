"""Rows for the grant, link and paper stores, from the bodies of service responses.

Each function takes a DataFrame with a JSON text column and keeps the columns named
in ``carry`` (for instance an arrival number, by which an upsert picks the last).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.functions import variants


def _results(responses: DataFrame, body: str, carry: Sequence[str]) -> DataFrame:
    items = variants.elements(variants.parse(F.col(body)), "$.results")
    return responses.select(*carry, F.posexplode(items).alias("pos", "record"))


def grant_rows(responses: DataFrame, body: str = "body", carry: Sequence[str] = ()) -> DataFrame:
    """``(core_project_num, metadata)`` of every record that has a core number."""
    core = variants.text(F.col("record"), "$.core_project_num")
    return (
        _results(responses, body, carry)
        .select(*carry, "pos", core.alias("core_project_num"), F.to_json("record").alias("metadata"))
        .filter("core_project_num <> ''")
    )


def link_rows(responses: DataFrame, body: str = "body", carry: Sequence[str] = ()) -> DataFrame:
    """``(core_project_num, pmid)`` of every record that has both; repeats stay."""
    record = F.col("record")
    return (
        _results(responses, body, carry)
        .select(
            *carry, "pos",
            variants.text(record, "$.coreproject").alias("core_project_num"),
            variants.number(record, "$.pmid", "bigint").alias("pmid"),
        )
        .filter("core_project_num <> '' and pmid <> 0")
    )


def paper_rows(responses: DataFrame, body: str = "body", carry: Sequence[str] = ()) -> DataFrame:
    """``(pmid, metadata)`` of every all-digit key of the ``result`` object."""
    entries = variants.entries(variants.parse(F.col(body)), "$.result")
    return (
        responses.select(*carry, F.explode(entries).alias("key", "record"))
        .filter(F.col("key").rlike("^[0-9]+$"))
        .select(*carry, F.col("key").try_cast("bigint").alias("pmid"), F.to_json("record").alias("metadata"))
    )
