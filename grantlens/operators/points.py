"""Citation look-up, 2-D placement of rows, and point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.functions.text import (
    amount_count,
    amount_size,
    category_colour,
    joined_terms,
    or_default,
    parse_date,
    start_date_or_year,
)

# Colours by item type; size and count of an author.
TYPE_COLOURS = {"grant": "#ffe100", "paper": "#f84848", "author": "#1196fc"}
AUTHOR_SIZE = 5.0
AUTHOR_COUNT = 1.0

# Citation figures of papers that have none.
DEFAULT_CITATIONS = 0
DEFAULT_RATIO = 1.0

MERGED_COLUMNS = ("pid", "date", "journal", "title", "mesh_terms", "x", "y", "size", "citation_count", "color")
NETWORK_COLUMNS = ("pid", "x", "y", "date", "journal", "title", "mesh_terms", "citation_count", "size", "color")


def with_citations(papers: DataFrame, citations: DataFrame | None) -> DataFrame:
    """Papers with citation count and ratio; a missing or zero ratio becomes 1."""
    if citations is None:
        return papers.withColumns(
            {
                "citation_count": F.lit(DEFAULT_CITATIONS).cast("bigint"),
                "relative_citation_ratio": F.lit(DEFAULT_RATIO),
            }
        )
    figures = citations.select("pmid", "citation_count", "relative_citation_ratio")
    return papers.join(figures, "pmid", "left").withColumns(
        {
            "citation_count": F.coalesce("citation_count", F.lit(DEFAULT_CITATIONS).cast("bigint")),
            "relative_citation_ratio": or_default(F.col("relative_citation_ratio"), 0.0, DEFAULT_RATIO),
        }
    )


def join_coordinates(rows: DataFrame, vectors: DataFrame, item_id: str = "item_id") -> DataFrame:
    """Rows with ``x`` and ``y``, matched one to one by id; NULL is an id like any other.

    Ids are counted over both sides in the plan itself, which fails on the first that is not
    once in either. Only ids take part in that; the rows meet the vectors in a plain join.
    """
    ids = rows.select(F.col(item_id).alias("_id"), F.lit(1).alias("_row"), F.lit(0).alias("_vector")).unionByName(
        vectors.select(F.col(item_id).alias("_id"), F.lit(0).alias("_row"), F.lit(1).alias("_vector"))
    )
    counts = ids.groupBy("_id").agg(F.sum("_row").alias("_row"), F.sum("_vector").alias("_vector"))
    problem = F.raise_error(
        F.concat(F.lit("rows and vectors do not match at item "), F.coalesce(F.col("_id").cast("string"), F.lit("NULL")))
    )
    once = (F.col("_row") == 1) & (F.col("_vector") == 1)
    broken = counts.filter(F.when(once, F.lit(False)).otherwise(problem.cast("boolean")))
    placed = vectors.select(F.col(item_id).alias("_vector_id"), "x", "y")
    joined = rows.join(placed, F.col(item_id).eqNullSafe(F.col("_vector_id"))).drop("_vector_id")
    nothing = broken.select(*[F.lit(None).cast(kind).alias(name) for name, kind in joined.dtypes])
    return joined.unionByName(nothing)


def merged_points(grants: DataFrame, vectors: DataFrame, item_id: str = "item_id") -> DataFrame:
    """One point per grant row, with a colour by first category."""
    amount = F.col("award_amount")
    return join_coordinates(grants, vectors, item_id).select(
        F.col("core_project_num").alias("pid"),
        start_date_or_year(F.col("project_start_date"), F.col("fiscal_year")).alias("date"),
        F.col("agency_ic_admin").alias("journal"),
        F.col("project_title").alias("title"),
        joined_terms([F.col("pref_terms"), F.col("spending_categories_desc"), F.col("org_name")]).alias("mesh_terms"),
        "x",
        "y",
        amount_size(amount).alias("size"),
        amount_count(amount).alias("citation_count"),
        category_colour(F.col("spending_categories_desc")).alias("color"),
    )


def network_points(item_rows: DataFrame, vectors: DataFrame, citations: DataFrame | None = None) -> DataFrame:
    """One point per item: values by type, papers with their citation figures.

    Citations are joined to papers only; the other items do not enter that join.
    """
    is_paper = F.col("type") == "paper"
    papers = with_citations(item_rows.filter(is_paper), citations).select(
        *item_rows.columns,
        F.col("citation_count").cast("double").alias("citation_count"),
        F.col("relative_citation_ratio").alias("size"),
    )
    is_grant = F.col("type") == "grant"
    others = item_rows.filter(~is_paper).select(
        *item_rows.columns,
        F.when(is_grant, F.coalesce("award_amount", F.lit(0.0))).otherwise(AUTHOR_COUNT).alias("citation_count"),
        F.when(is_grant, amount_size(F.col("award_amount"))).otherwise(AUTHOR_SIZE).alias("size"),
    )
    colour = F.lit(None).cast("string")
    for kind, value in TYPE_COLOURS.items():
        colour = F.when(F.col("type") == kind, F.lit(value)).otherwise(colour)
    valued = papers.unionByName(others).withColumns(
        {"date": parse_date(F.col("date_text"), F.col("fiscal_year")), "color": colour}
    )
    return join_coordinates(valued, vectors).select(*NETWORK_COLUMNS)
