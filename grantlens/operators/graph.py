"""The grant-paper-author graph: edges, nodes, items with texts, statistics.

Grants and papers are opened stores (``open_grants`` and ``open_papers`` in
``sources.store``); links are ``(core_project_num, pmid)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.functions.templates import author_text, build_text, paper_text
from grantlens.functions.text import author_id as hashed_author_id
from grantlens.functions.text import joined_terms
from grantlens.operators.numbering import number_rows
from grantlens.operators.skew import hot_values, salted_join
from grantlens.session import stage, stage_observed

GRANT_PAPER = "grant-paper"
AUTHOR_PAPER = "author-paper"


def explode_authors(papers: DataFrame) -> DataFrame:
    """``(pmid, pos, name)`` of every author entry that is an object with a name."""
    return (
        papers.select("pmid", F.posexplode_outer("authors").alias("pos", "author"))
        .select("pmid", "pos", F.col("author.name").alias("name"))
        .filter("name <> ''")
    )


def grant_paper_edges(links: DataFrame) -> DataFrame:
    return links.select(
        F.col("core_project_num").cast("string").alias("source"),
        F.col("pmid").alias("target"),
        F.lit(GRANT_PAPER).alias("type"),
    )


def author_paper_edges(papers: DataFrame, author_id: str = "hash") -> DataFrame:
    """One edge per author entry; ids are hashes or plain names. Repeats stay."""
    if author_id not in ("hash", "name"):
        raise ValueError(f"author_id must be hash or name, not {author_id!r}")
    source = hashed_author_id(F.col("name")) if author_id == "hash" else F.col("name")
    return explode_authors(papers).select(
        source.alias("source"), F.col("pmid").alias("target"), F.lit(AUTHOR_PAPER).alias("type")
    )


def all_edges(links: DataFrame, papers: DataFrame, author_id: str = "hash") -> DataFrame:
    return grant_paper_edges(links).unionByName(author_paper_edges(papers, author_id))


def edge_stats(edges: DataFrame) -> DataFrame:
    return edges.agg(
        F.count(F.lit(1)).alias("total_edges"),
        F.count_if(F.col("type") == GRANT_PAPER).alias("grant_paper_edges"),
        F.count_if(F.col("type") == AUTHOR_PAPER).alias("author_paper_edges"),
    )


def grant_nodes(grants: DataFrame) -> DataFrame:
    return grants.select(F.col("core_project_num").alias("id"), F.lit("grant").alias("type"), "title", "metadata")


def paper_nodes(papers: DataFrame) -> DataFrame:
    """Paper nodes; the author list has every author object, with '' for no name."""
    objects = F.filter("authors", lambda author: author.isNotNull())
    names = F.transform(objects, lambda author: F.coalesce(author["name"], F.lit("")))
    return papers.select(
        F.col("pmid").alias("id"),
        F.lit("paper").alias("type"),
        "title",
        F.col("source").alias("journal"),
        "pubdate",
        F.coalesce(names, F.array().cast("array<string>")).alias("authors"),
        "metadata",
    )


def author_papers(papers: DataFrame) -> DataFrame:
    """``(name, nth, pmid)``: each author's papers, numbered from 1 in ascending order, repeats kept.

    One row per paper, so no task gathers an author's whole output however many bear the name.
    """
    return number_rows(explode_authors(papers), ["pmid", "pos"], ["name"], "nth").select("name", "nth", "pmid")


def author_nodes(papers: DataFrame) -> DataFrame:
    """One node per author name with its number of papers; :func:`author_papers` lists them."""
    counts = explode_authors(papers).groupBy("name").agg(F.count(F.lit(1)).alias("n_papers"))
    return counts.select(F.col("name").alias("id"), F.lit("author").alias("type"), "name", "n_papers")


def author_node_papers(papers: DataFrame) -> DataFrame:
    """The author nodes, each repeated for its papers: ``(id, type, name, n_papers, nth, pmid)``.

    A join by name would bring all papers of a much used name into one task, and hold them there. The
    papers of such names are spread, and the other side has one node per name. ``papers`` is read more
    than once: stage it where it is costly to make.
    """
    nodes, seen = stage_observed(author_nodes(papers), "author-nodes", rows=F.sum("n_papers"))
    hot = hot_values(nodes.withColumn("n", F.col("n_papers")), "name", seen["rows"] or 0)
    joined = salted_join(author_papers(papers), nodes, "name", "inner", hot, F.struct("nth", "pmid"))
    return joined.select("id", "type", "name", "n_papers", "nth", "pmid")


def author_first_papers(papers: DataFrame) -> DataFrame:
    """``(name, pmid)``: the lowest pmid per author. Only names and pmids are shuffled."""
    return explode_authors(papers).groupBy("name").agg(F.min("pmid").alias("pmid"))


def representative_papers(papers: DataFrame) -> DataFrame:
    """Per author the source, title and date of the first paper in pmid order."""
    details = papers.select("pmid", "source", "title", "pubdate")
    return author_first_papers(papers).join(details, "pmid").select("name", "pmid", "source", "title", "pubdate")


def network_stats(grants: DataFrame, papers: DataFrame, links: DataFrame) -> DataFrame:
    """Node counts by kind and edge counts, as one row.

    Each store is read once; the names are merged before they are counted.
    """
    counts = [
        grants.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total_grants").alias("kind"), "n"),
        papers.agg(F.count(F.lit(1)).alias("n")).select(F.lit("total_papers").alias("kind"), "n"),
        links.agg(F.count(F.lit(1)).alias("n")).select(F.lit("grant_paper_edges").alias("kind"), "n"),
        explode_authors(papers).groupBy("name").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit("author").alias("kind"), "n"
        ),
    ]
    union = counts[0]
    for count in counts[1:]:
        union = union.unionByName(count)

    def total(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))

    return union.agg(
        total("total_grants").alias("total_grants"),
        total("total_papers").alias("total_papers"),
        F.count_if(F.col("kind") == "author").alias("total_authors"),
        (total("grant_paper_edges") + total("author")).alias("total_edges"),
        total("grant_paper_edges").alias("grant_paper_edges"),
        total("author").alias("author_paper_edges"),
    )


def node_counts(nodes: dict[str, DataFrame]) -> DataFrame:
    """``(type, n)`` over node tables."""
    kinds = list(nodes.values())
    union = kinds[0].select("type")
    for kind in kinds[1:]:
        union = union.unionByName(kind.select("type"))
    return union.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def distinct_pmids(links: DataFrame) -> DataFrame:
    return links.select("pmid").distinct()


def build_network(grants: DataFrame, papers: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """Node tables by kind, name-keyed edges, and statistics."""
    return {
        "grants": grant_nodes(grants),
        "papers": paper_nodes(papers),
        "authors": author_nodes(papers),
        "author_papers": author_papers(papers),
        "edges": all_edges(links, papers, author_id="name"),
        "stats": network_stats(grants, papers, links),
    }


def listed_grants(grant_rows: DataFrame, grants: DataFrame, pid_column: str = "pid") -> DataFrame:
    """The grant list left-joined to the store; list rows without a stored grant stay.

    Missing ids match nothing, so they pass by the join and cannot meet in one task.
    """
    stored = grants.withColumnRenamed("core_project_num", pid_column)
    joined = grant_rows.filter(F.col(pid_column).isNotNull()).join(stored, pid_column, "left")
    missing = grant_rows.filter(F.col(pid_column).isNull())
    return joined.unionByName(missing, allowMissingColumns=True)


def _one_per_pid(grant_rows: DataFrame, pid_column: str) -> DataFrame:
    """Distinct, non-missing ids with the terms and categories of one row, the least of theirs."""
    def extra(name: str) -> Column:
        return (F.col(name) if name in grant_rows.columns else F.lit(None)).cast("string").alias(name)

    row = F.struct(extra("pref_terms"), extra("spending_categories_desc"))
    return (
        grant_rows.filter(F.col(pid_column).isNotNull())
        .groupBy(F.col(pid_column).cast("string").alias("pid"))
        .agg(F.min(row).alias("row"))
        .select("pid", "row.*")
    )


def listed_papers(papers: DataFrame, links: DataFrame, grant_rows: DataFrame, pid_column: str = "pid") -> DataFrame:
    """Papers linked to a listed grant."""
    wanted = grant_rows.select(F.col(pid_column).alias("core_project_num")).distinct()
    linked = links.join(wanted, "core_project_num", "left_semi").select("pmid").distinct()
    return papers.join(linked, "pmid", "left_semi")


def items(
    grant_rows: DataFrame,
    grants: DataFrame,
    papers: DataFrame,
    links: DataFrame | None = None,
    pid_column: str = "pid",
    scope: str = "all",
    grant_template: str = "{project_title}",
) -> DataFrame:
    """Grants, papers and authors as one table of items with their texts.

    Every item has a unique ``item_id`` and the fields its point is made of.
    ``scope`` takes ``all`` stored papers, or only those ``listed`` grants link to.
    """
    if scope not in ("all", "listed"):
        raise ValueError(f"scope must be all or listed, not {scope!r}")
    papers = papers.drop("metadata")
    if scope == "listed":
        papers = listed_papers(papers, links, grant_rows, pid_column)
    papers = stage(papers, "item-papers")  # read three times below, parsed once
    none = F.lit(None)
    columns = {"project_title": F.col("title"), "agency_ic_admin": F.col("agency")}
    grant_items = listed_grants(_one_per_pid(grant_rows, pid_column), grants).select(
        F.concat(F.lit("grant:"), "pid").alias("item_id"),
        F.lit(0).alias("type_rank"),
        F.lit("grant").alias("type"),
        "pid",
        none.cast("bigint").alias("pmid"),
        build_text(grant_template, columns).alias("text"),
        F.col("start_date").alias("date_text"),
        "fiscal_year",
        F.coalesce("agency", F.lit("")).alias("journal"),
        F.coalesce("title", F.lit("")).alias("title"),
        joined_terms([F.col(name) for name in ("pref_terms", "spending_categories_desc", "org_name")], ";").alias("mesh_terms"),
        "award_amount",
    )
    paper_items = papers.select(
        F.concat(F.lit("paper:"), F.col("pmid")).alias("item_id"),
        F.lit(1).alias("type_rank"),
        F.lit("paper").alias("type"),
        F.col("pmid").cast("string").alias("pid"),
        "pmid",
        paper_text(F.col("source"), F.col("title")).alias("text"),
        F.col("pubdate").alias("date_text"),
        none.cast("int").alias("fiscal_year"),
        F.col("source").alias("journal"),
        "title",
        F.lit("").alias("mesh_terms"),
        none.cast("double").alias("award_amount"),
    )
    author_items = representative_papers(papers).select(
        F.concat(F.lit("author:"), "name").alias("item_id"),
        F.lit(2).alias("type_rank"),
        F.lit("author").alias("type"),
        hashed_author_id(F.col("name")).alias("pid"),
        "pmid",
        author_text(F.col("source"), F.col("name"), F.col("title")).alias("text"),
        F.col("pubdate").alias("date_text"),
        none.cast("int").alias("fiscal_year"),
        F.lit("Author").alias("journal"),
        F.col("name").alias("title"),
        F.lit("").alias("mesh_terms"),
        none.cast("double").alias("award_amount"),
    )
    return grant_items.unionByName(paper_items).unionByName(author_items)


def item_metadata(item_rows: DataFrame) -> DataFrame:
    return item_rows.select("pid", "type", F.col("text").alias("text_representation"))
