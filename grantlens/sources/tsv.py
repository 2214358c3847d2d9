"""Tab-separated files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GRANT_SCHEMA = (
    "project_num string, core_project_num string, fiscal_year int, org_name string, award_amount double, "
    "principal_investigators string, agency_ic_admin string, pref_terms string, abstract_text string, "
    "project_title string, spending_categories_desc string, date_added string, project_start_date string, "
    "project_end_date string, award_type string, activity_code string"
)

# Words read as missing.
MISSING_WORDS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_tsv(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    missing_words: Sequence[str] = MISSING_WORDS,
    multi_line: bool = True,
) -> DataFrame:
    """A TSV file, or a folder of them, with a header line.

    Without a schema all columns are text, named by the header. Fields that hold a
    line break need ``multi_line``; switch it off for files known to have none, so that
    Spark can split them.
    """
    reader = spark.read.options(
        sep="\t", header=True, quote='"', escape='"', multiLine=multi_line, mode="PERMISSIVE"
    )
    if schema:
        reader = reader.schema(schema)
    return without_missing_words(reader.csv(path), missing_words)


def without_missing_words(rows: DataFrame, missing_words: Sequence[str]) -> DataFrame:
    """Text columns with the words read as missing made NULL."""
    words = [word for word in missing_words]
    if not words:
        return rows
    texts = {name for name, kind in rows.dtypes if kind == "string"}
    return rows.select(
        *[
            F.when(~F.col(name).isin(words), F.col(name)).alias(name) if name in texts else F.col(name)
            for name in rows.columns
        ]
    )


def write_tsv(rows: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """A folder of TSV files: minimal quoting, doubled quotes, missing as empty."""
    rows.write.mode(mode).options(
        sep="\t", header=header, quote='"', escape='"', emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_skipped(
    labelled: DataFrame, project_path: str, core_path: str, project: str = "project_num", core: str = "core_project_num"
) -> None:
    """The keys of dropped rows: one project per line, and ``project<TAB>core`` lines."""
    by_project = labelled.filter("skipped_project").select(F.coalesce(project, F.lit("")).alias("value"))
    by_core = labelled.filter("skipped_core").select(
        F.concat(F.coalesce(project, F.lit("")), F.lit("\t"), F.coalesce(core, F.lit(""))).alias("value")
    )
    by_project.write.mode("overwrite").text(project_path)
    by_core.write.mode("overwrite").text(core_path)


def grant_list(rows: DataFrame, pid_column: str = "pid") -> DataFrame:
    """The distinct, non-missing ids of ``pid_column``; an error if there is no such column."""
    if pid_column not in rows.columns:
        raise ValueError(f"Column '{pid_column}' not found; available columns: {rows.columns}")
    return rows.select(F.col(pid_column).alias("pid")).dropna().distinct()


def read_grant_list(spark: SparkSession, path: str, pid_column: str = "pid") -> DataFrame:
    return grant_list(read_tsv(spark, path), pid_column)
