"""The grant roles (pages, stores, citations, lists) shaped from a folder of tables.

The tables are ``orders``, ``customer``, ``nation``, ``supplier``, ``lineitem``,
``events`` and ``documents`` in Parquet. Missing values and odd kinds are shaped from
the columns' own values, so that they occur at every size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.operators.harvest import ORG_STATES, PAGE_SIZE
from grantlens.operators.numbering import number_rows
from grantlens.session import staged_folder
from grantlens.sources import page_files as files
from grantlens.sources.pages import write_page_files

SUMMARY_BATCH = 200


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _priority() -> Column:
    return F.col("o_orderpriority")


def state_of_nation(nation_key: Column) -> Column:
    states = F.array(*[F.lit(state) for state in ORG_STATES])
    return F.element_at(states, (nation_key + 1).cast("int"))


def _project_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One slim row per order: its year and state, and the columns that its record is made of."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return orders.join(customers, "o_custkey").select(
        F.year("o_orderdate").cast("string").alias("page_year"),
        state_of_nation(F.col("c_nationkey")).alias("page_state"),
        "o_orderkey", *RECORD_SOURCES,
    )


#: The columns that :func:`_record` reads.
RECORD_SOURCES = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "c_name", "c_mktsegment")


def _is_odd(of: Callable[[str], Column] = F.col) -> Column:
    return (of("o_orderstatus") == "P") & (of("o_orderpriority") == "2-HIGH")


def _record(of: Callable[[str], Column] = F.col) -> Column:
    """The nested project record; ``of`` gives a source column by its name."""
    priority, segment, name = of("o_orderpriority"), of("c_mktsegment"), of("c_name")
    customer = of("o_custkey").cast("string")
    date = of("o_orderdate")
    core = (
        F.when(priority == "5-LOW", "")
        .when(priority == "3-MEDIUM", None)
        .otherwise(F.concat(F.lit("C"), customer, F.lit("-"), F.substring(priority, 1, 1)))
    )
    return F.struct(
        F.concat(F.lit("P"), customer, F.lit("-"), F.month(date)).alias("project_num"),
        core.alias("core_project_num"),
        F.year(date).alias("fiscal_year"),
        F.struct(F.when(segment != "MACHINERY", name).alias("org_name")).alias("organization"),
        of("o_totalprice").alias("award_amount"),
        F.array(
            F.struct(name.alias("full_name")),
            F.struct(F.lit("").alias("full_name")),
            F.struct(F.lit(None).cast("string").alias("full_name")),
            F.struct(segment.alias("full_name")),
        ).alias("principal_investigators"),
        F.struct(F.when(segment != "FURNITURE", segment).alias("abbreviation")).alias("agency_ic_admin"),
        F.concat(F.lit(" "), priority, F.lit("\t;\r\n"), segment).alias("pref_terms"),
        F.concat(name, F.lit("\n\n "), priority, F.lit(" \t"), of("o_orderstatus")).alias("abstract_text"),
        F.concat(segment, F.lit("  "), priority).alias("project_title"),
        F.when(priority != "1-URGENT", F.concat(priority, F.lit("; "), segment)).alias("spending_categories_desc"),
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss").alias("date_added"),
        F.when(priority != "4-NOT SPECIFIED", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss")).alias("project_start_date"),
        F.date_format(F.date_add(date.cast("date"), 365), "yyyy-MM-dd").alias("project_end_date"),
        F.substring(priority, 1, 1).alias("award_type"),
        F.lit("R01").alias("activity_code"),
    )


def projects(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order with its year, state and the nested project ``record``."""
    return _project_rows(spark, folder).select(
        "page_year", "page_state", "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        _is_odd().alias("is_odd"),
        _record().alias("record"),
    )


def _record_json(record: Column, is_odd: Column) -> Column:
    """A project as JSON text; where ``is_odd``, its agency is a plain text."""
    # cut at its end without its length: in a lambda a text that is named twice is made twice
    common = F.regexp_replace(F.to_json(record.dropFields("agency_ic_admin"), {"ignoreNullFields": "false"}), r"\}$", "")
    agency = F.when(is_odd, F.lit('"plain"')).otherwise(F.to_json(record["agency_ic_admin"]))
    return F.concat(common, F.lit(',"agency_ic_admin":'), agency, F.lit("}"))


def numbered_projects(spark: SparkSession, folder: str) -> DataFrame:
    """The slim project rows, numbered within their year and state; they are staged and may be read often."""
    return number_rows(_project_rows(spark, folder), ["o_orderkey"], ["page_year", "page_state"], "nth")


def project_pages(
    spark: SparkSession, folder: str, page_size: int = PAGE_SIZE, numbered: DataFrame | None = None
) -> DataFrame:
    """Result pages ``(page_year, page_state, page_file, body)`` of at most ``page_size`` records.

    Rows are numbered and gathered by their slim columns; the records, many times as long, are made
    where a page's rows have met. ``numbered`` are the :func:`numbered_projects` where pages of more
    than one size are made of them.
    """
    numbered = numbered_projects(spark, folder) if numbered is None else numbered
    batch = F.floor((F.col("nth") - 1) / F.lit(page_size)).cast("int")
    totals = numbered.groupBy("page_year", "page_state").agg(F.count(F.lit(1)).alias("total"))
    bodies = numbered.groupBy("page_year", "page_state", batch.alias("batch")).agg(
        F.sort_array(F.collect_list(F.struct("nth", *RECORD_SOURCES))).alias("rows")
    )

    def json(row: Column) -> Column:
        return _record_json(_record(lambda name: row[name]), _is_odd(lambda name: row[name]))

    body = F.concat(
        F.lit('{"meta":{"total":'), F.col("total"),
        F.lit(',"offset":'), F.col("batch") * page_size,
        F.lit(f',"limit":{page_size}}},"results":['), F.array_join(F.transform("rows", json), ","), F.lit("]}"),
    )
    # one row for each year and state
    return bodies.join(F.broadcast(totals), ["page_year", "page_state"]).select(
        "page_year", "page_state", F.concat(F.col("batch"), F.lit(".json")).alias("page_file"), body.alias("body")
    )


def damaged_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The same pages with some bodies cut short, made a bare list, without results, or with repeated names."""
    half = F.substring(F.col("body"), F.lit(1), (F.length("body") / 2).cast("int"))
    body = (
        F.when(F.col("page_state") == "CT", half)
        .when(F.col("page_state") == "DE", F.lit("[1, 2]"))
        .when(F.col("page_state") == "FL", F.lit('{"meta":{"total":0}}'))
        .when(F.col("page_state") == "GA", F.lit('{"results":{"a":1}}'))
        .when(F.col("page_state") == "AL", F.regexp_replace("body", r'^\{"meta"', '{"results":[],"meta":{},"meta"'))
        .otherwise(F.col("body"))
    )
    return project_pages(spark, folder).withColumn("body", body)


def page_files(spark: SparkSession, pages: DataFrame) -> str:
    """The folder of a cache that holds one file for each page."""
    root = staged_folder(spark, "cache")
    write = files.write_cache if files.knows(root) else write_page_files
    write(pages, root)
    return root


def page_counts(spark: SparkSession, folder: str, page_size: int = 50) -> DataFrame:
    """A partly harvested cache: per page its key, promised ``total`` and ``n_results``.

    The totals count all orders; pages hold only orders that are not open.
    """
    rows = projects(spark, folder).select("page_year", "page_state", "o_orderkey", "status")
    totals = rows.groupBy("page_year", "page_state").agg(F.count(F.lit(1)).alias("total"))
    held = number_rows(rows.filter("status <> 'O'"), ["o_orderkey"], ["page_year", "page_state"], "nth")
    batch = F.floor((F.col("nth") - 1) / F.lit(page_size)).cast("int")
    pages = held.groupBy("page_year", "page_state", batch.alias("batch")).agg(F.count(F.lit(1)).alias("n_results"))
    return pages.join(totals, ["page_year", "page_state"]).select(
        F.col("page_year").cast("int").alias("fiscal_year"),
        F.col("page_state").alias("org_state"),
        "batch", "total", "n_results",
    )


def order_years(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.year("o_orderdate").alias("fiscal_year")).distinct()


def grants(spark: SparkSession, folder: str) -> DataFrame:
    """The grant store ``(core_project_num, metadata JSON)``, one per supplier."""
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey")
    rows = table(spark, folder, "supplier").join(nation, "s_nationkey")
    name = F.col("n_name")
    fields = F.struct(
        F.concat(F.lit("G"), "s_suppkey").alias("core_project_num"),
        F.col("s_name").alias("project_title"),
        (F.col("s_nationkey") + 1990).alias("fiscal_year"),
        F.col("s_acctbal").alias("award_amount"),
        F.when(F.col("n_regionkey") != 2, F.concat(F.lit("2001-02-"), F.lpad(F.col("s_nationkey") + 1, 2, "0"), F.lit("T00:00:00")))
        .alias("project_start_date"),
        F.when(F.col("n_regionkey") != 3, F.struct(F.concat(F.lit("Org "), name).alias("org_name"))).alias("organization"),
    )
    as_object = fields.withField("agency_ic_admin", F.struct(name.alias("abbreviation")))
    as_text = fields.withField("agency_ic_admin", name)
    as_number = fields.withField("agency_ic_admin", F.lit(5))
    region = F.col("n_regionkey")
    metadata = F.when(region == 0, F.to_json(as_text)).when(region == 1, F.to_json(as_number)).otherwise(F.to_json(as_object))
    return rows.select(fields["core_project_num"].alias("core_project_num"), metadata.alias("metadata"))


def grant_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A grant list ``(pid, pref_terms, spending_categories_desc)`` from the links.

    It has repeats, missing ids, and ids the store lacks.
    """
    lines = table(spark, folder, "lineitem")
    pid = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("G"), F.col("l_suppkey") * 2)).otherwise(
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("G"), "l_suppkey"))
    )
    categories = F.concat(F.lit("Area "), F.lit(9) - F.col("l_linenumber"))
    return lines.select(
        pid.alias("pid"),
        F.concat(F.lit("term "), pid, F.lit("/"), F.col("l_linenumber")).alias("pref_terms"),
        F.when(~pid.endswith("0"), categories).alias("spending_categories_desc"),
    )


def raw_links(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("G"), "l_suppkey").alias("core_project_num"), F.col("l_orderkey").alias("pmid")
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """The link store: distinct (core, pmid)."""
    return raw_links(spark, folder).distinct()


def pubdate(date: Column) -> Column:
    """Publication dates in every shape the parser takes, and some it does not."""
    priority, status, odd = _priority(), F.col("o_orderstatus"), F.dayofmonth(date) % 2 == 1
    return (
        F.when((priority == "1-URGENT") & (status == "P"), F.date_format(date, "yyyy 'Winter'"))
        .when((priority == "2-HIGH") & (status == "P"), F.lit(""))
        .when((priority == "3-MEDIUM") & (status == "P"), F.date_format(date, "yyyy MMM'-Dec'"))
        .when((priority == "4-NOT SPECIFIED") & (status == "P"), F.date_format(date, "yyyy-MM"))
        .when((priority == "5-LOW") & (status == "P"), F.date_format(date, "MM-dd-yyyy"))
        .when((priority == "1-URGENT") & (status == "F") & odd, F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when((priority == "1-URGENT") & (status == "F"), F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss"))
        .when((priority == "1-URGENT") & odd, F.date_format(date, "yyyy MMMM d"))
        .when(priority == "1-URGENT", F.date_format(date, "yyyy MMM d"))
        .when((priority == "2-HIGH") & odd, F.date_format(date, "yyyy MMMM"))
        .when(priority == "2-HIGH", F.date_format(date, "yyyy MMM"))
        .when(priority == "3-MEDIUM", F.date_format(date, "yyyy"))
        .when(priority == "4-NOT SPECIFIED", F.date_format(date, "yyyy-MM-dd"))
        .otherwise(F.date_format(date, "MM/dd/yyyy"))
    )


def papers(spark: SparkSession, folder: str) -> DataFrame:
    """The paper store ``(pmid, metadata JSON)``, one per order.

    The author lists hold a customer, a nameless entry, a plain text and a name
    shared by a fifth of all papers.
    """
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    rows = table(spark, folder, "orders").join(customers, "o_custkey")

    def author(name: Column) -> Column:
        return F.to_json(F.struct(name.alias("name"), F.lit("Author").alias("authtype")))

    authors = F.array_join(
        F.array(author(F.col("c_name")), F.lit('"plain text"'), author(F.lit("")), author(_priority()),
                author(F.concat(F.lit("Group "), F.col("c_mktsegment")))),
        ",",
    )
    plain = F.struct(
        F.col("o_orderkey").cast("string").alias("uid"),
        pubdate(F.col("o_orderdate")).alias("pubdate"),
        _priority().alias("source"),
        F.concat(F.lit("Title of "), "o_orderkey").alias("title"),
    )
    head = F.regexp_replace(F.to_json(plain), r"\}$", "")
    return rows.select(
        F.col("o_orderkey").alias("pmid"),
        F.concat(head, F.lit(',"authors":['), authors, F.lit("]}")).alias("metadata"),
    )


def citations(spark: SparkSession, folder: str) -> DataFrame:
    """Citation figures for some of the papers, with missing and zero values."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("pmid"),
        F.when(kind != "error", F.col("user_id")).alias("citation_count"),
        F.when(kind == "click", 0.0).when(kind != "view", F.col("value")).alias("relative_citation_ratio"),
    )


def summary_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Paper summary responses: an object keyed by pmid, with the key list ``uids``."""
    batch = F.floor(F.col("pmid") / F.lit(SUMMARY_BATCH)).alias("batch")
    entries = papers(spark, folder).select(
        batch, "pmid", F.concat(F.lit('"'), "pmid", F.lit('":'), "metadata").alias("entry")
    )
    return entries.groupBy("batch").agg(
        F.concat(
            F.lit('{"result":{"uids":["'), F.array_join(F.array_sort(F.collect_list(F.col("pmid").cast("string"))), '","'),
            F.lit('"],'), F.array_join(F.array_sort(F.collect_list("entry")), ","), F.lit("}}"),
        ).alias("body")
    )


def link_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Publication responses: one per line item, with records that lack a key or a paper."""
    lines = table(spark, folder, "lineitem")
    record = F.to_json(
        F.struct(
            F.when(F.col("l_returnflag") != "A", F.concat(F.lit("G"), "l_suppkey")).alias("coreproject"),
            F.when((F.col("l_returnflag") != "R") | (F.col("l_linestatus") != "O"), F.col("l_orderkey")).otherwise(0).alias("pmid"),
            F.col("l_partkey").alias("applid"),
        )
    )
    return lines.select(
        F.concat(F.lit('{"meta":{"total":1},"results":['), record, F.lit("]}")).alias("body")
    )


def grant_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Project responses, one per order, by arrival number; most cores come many times."""
    rows = projects(spark, folder)
    return rows.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit('{"results":['), _record_json(F.col("record"), F.col("is_odd")), F.lit("]}")).alias("body"),
    )


def flat_grants(spark: SparkSession, folder: str) -> DataFrame:
    """The flat grant table of :mod:`grantlens.operators.extract`, one row per order."""
    record = F.col("record")
    rows = projects(spark, folder)
    names = (
        "project_num", "core_project_num", "fiscal_year", "award_amount", "pref_terms", "abstract_text",
        "project_title", "spending_categories_desc", "project_start_date", "project_end_date", "activity_code",
    )
    return rows.select(
        F.col("o_orderkey").alias("item_id"),
        *[record[name].alias(name) for name in names],
        record["organization"]["org_name"].alias("org_name"),
        record["agency_ic_admin"]["abbreviation"].alias("agency_ic_admin"),
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, with tabs, information separators and wide spaces put in."""
    messy = F.concat(F.lit(" \u3000"), F.regexp_replace("text", r"\.", F.lit("\t.\u001c ")), F.lit("\u2003 "))
    return table(spark, folder, "documents").select("doc_id", messy.alias("text"), "lang", "source")
