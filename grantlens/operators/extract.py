"""Flat grant rows from page records, and conversion statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.functions import variants
from grantlens.functions.text import clean_text, date_prefix
from grantlens.operators.dedupe import two_key_flag, two_key_label
from grantlens.session import stage
from grantlens.sources.pages import PAGE_ORDER, flatten_results

# The grant columns, in output order.
GRANT_COLUMNS = (
    "project_num", "core_project_num", "fiscal_year", "org_name", "award_amount",
    "principal_investigators", "agency_ic_admin", "pref_terms", "abstract_text",
    "project_title", "spending_categories_desc", "date_added", "project_start_date",
    "project_end_date", "award_type", "activity_code",
)
CLEANED = ("pref_terms", "abstract_text", "project_title", "spending_categories_desc")
DATES = ("date_added", "project_start_date", "project_end_date")


# The fields taken from a record. Those whose kind varies stay VARIANT.
RECORD_TYPE = (
    "struct<project_num variant, core_project_num variant, fiscal_year int, award_amount double, "
    "organization variant, principal_investigators variant, agency_ic_admin variant, pref_terms string, "
    "abstract_text string, project_title string, spending_categories_desc string, date_added string, "
    "project_start_date string, project_end_date string, award_type string, activity_code string>"
)


def _wrong_kind(given: str, cast: str) -> Column:
    """A field that holds something, but not what it was cast to."""
    return F.col(cast).isNull() & ~variants.is_falsy(F.col(f"r.{given}"))


def extract_projects(records: DataFrame, record: str = "record") -> DataFrame:
    """The 16 grant columns of each record, its place (``PAGE_ORDER``) and its kind.

    ``is_record`` is false for an element that is no object; it claims no keys.
    ``is_bad`` marks a record that claims its keys but is not written, because a nested
    field has the wrong kind.
    """
    read = records.select(*PAGE_ORDER, variants.typed(F.col(record), RECORD_TYPE).alias("r"))
    read = read.select(
        *PAGE_ORDER,
        "r",
        variants.typed(F.col("r.organization"), "struct<org_name string>").alias("organization"),
        variants.typed(F.col("r.agency_ic_admin"), "struct<abbreviation string>").alias("agency"),
        variants.typed(F.col("r.principal_investigators"), "array<struct<full_name string>>").alias("people"),
    )
    fields: dict[str, Column] = {name: F.coalesce(F.col(f"r.{name}"), F.lit("")) for name in ("award_type", "activity_code")}
    fields.update({name: clean_text(F.col(f"r.{name}")) for name in CLEANED})
    fields.update({name: date_prefix(F.col(f"r.{name}")) for name in DATES})
    fields.update({name: variants.text_or_absent(F.col(f"r.{name}")) for name in ("project_num", "core_project_num")})
    fields.update({name: F.col(f"r.{name}") for name in ("fiscal_year", "award_amount")})
    fields["org_name"] = F.coalesce("organization.org_name", F.lit(""))
    fields["agency_ic_admin"] = F.coalesce("agency.abbreviation", F.lit(""))
    fields["principal_investigators"] = variants.joined_names(F.col("people"), "full_name")
    is_bad = (
        _wrong_kind("organization", "organization")
        | _wrong_kind("agency_ic_admin", "agency")
        | _wrong_kind("principal_investigators", "people")
        | F.coalesce(F.exists("people", lambda person: person.isNull()), F.lit(False))
    )
    return read.select(
        *PAGE_ORDER,
        *[fields[name].alias(name) for name in GRANT_COLUMNS],
        F.col("r").isNotNull().alias("is_record"),
        is_bad.alias("is_bad"),
    )


def convert(pages: DataFrame, skip_duplicates: bool = True) -> DataFrame:
    """Every record of the pages as a grant row with its fate.

    Adds ``skipped_project``, ``skipped_core`` and ``written``. With
    ``skip_duplicates`` off, duplicates are flagged but written all the same.
    Records are parsed once: the flat rows are staged, and the rounds read only keys.
    """
    flat = extract_projects(flatten_results(pages)).withColumn("row_id", F.monotonically_increasing_id())
    rows = stage(flat, "grant-rows")  # from here on a row's number stands
    records = rows.filter("is_record")
    label = two_key_label if skip_duplicates else two_key_flag
    labelled = label(records, "project_num", "core_project_num", list(PAGE_ORDER), "row_id")
    no_record = rows.filter(~F.col("is_record")).withColumns(
        {"skipped_project": F.lit(False), "skipped_core": F.lit(False)}
    )
    fates = labelled.unionByName(no_record).drop("row_id")
    kept = F.lit(True) if not skip_duplicates else ~F.col("skipped_project") & ~F.col("skipped_core")
    return fates.withColumn("written", F.col("is_record") & ~F.col("is_bad") & kept)


def written_grants(fates: DataFrame) -> DataFrame:
    """The rows of the converted table, in its column order."""
    return fates.filter("written").select(*GRANT_COLUMNS)


def conversion_stats(fates: DataFrame) -> DataFrame:
    """Records processed, written, and skipped by either key, in one pass."""
    by_project = F.count_if("skipped_project")
    by_core = F.count_if("skipped_core")
    return fates.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if("written").alias("written"),
        by_project.alias("skipped_project_num"),
        by_core.alias("skipped_core_project_num"),
        (by_project + by_core).alias("skipped_total"),
    )


def total_records(totals: DataFrame) -> DataFrame:
    """Records over all pages, from the per-page counts."""
    return totals.agg(F.coalesce(F.sum("n_results"), F.lit(0)).alias("total_records"))
