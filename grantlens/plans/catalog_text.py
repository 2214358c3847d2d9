"""Queries over texts, dates, amounts and colours, with their check SQL."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions import templates, text
from grantlens.operators import stats
from grantlens.plans import inputs, oracle
from grantlens.sources import store


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    """P4 on whole documents."""
    return inputs.texts(spark, folder).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


def capitalise_words(spark: SparkSession, folder: str) -> DataFrame:
    """P9 on whole documents."""
    return inputs.texts(spark, folder).select("doc_id", text.capitalise_words(F.col("text")).alias("words"))


def equal_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of one agency."""
    rows = stats.equal_rows(inputs.flat_grants(spark, folder), "agency_ic_admin", "BUILDING")
    return rows.select("item_id", "project_num", "core_project_num", "fiscal_year", "award_amount", "agency_ic_admin")


def present_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with a core number, and whether the whole key, without its letter, is digits."""
    rows = inputs.flat_grants(spark, folder).filter(text.present(F.col("core_project_num")).isNotNull())
    whole = F.when(F.col("fiscal_year") % 2 == 0, F.col("item_id").cast("string")).otherwise(F.col("project_num"))
    return rows.select("item_id", "core_project_num", whole.rlike("^[0-9]+$").alias("is_digits"))


def grant_text(spark: SparkSession, folder: str) -> DataFrame:
    """P8"""
    return inputs.flat_grants(spark, folder).select("item_id", templates.grant_text().alias("text"))


def text_templates(spark: SparkSession, folder: str) -> DataFrame:
    """P10: every text version of every grant."""
    versions = F.array(
        *[
            F.struct(F.lit(name).alias("version"), templates.grant_text(name).alias("text"))
            for name in templates.GRANT_TEMPLATES
        ]
    )
    return inputs.flat_grants(spark, folder).select("item_id", F.inline(versions))


def parse_date(spark: SparkSession, folder: str) -> DataFrame:
    """P14 with and without a fiscal year."""
    pubdate = inputs.pubdate(F.col("o_orderdate"))
    year = F.year("o_orderdate")
    return inputs.table(spark, folder, "orders").select(
        "o_orderkey",
        text.parse_date(pubdate).alias("date"),
        text.parse_date(pubdate, year).alias("date_or_year"),
    )


#: Ways to write a day, or only a month, beyond the fixed shapes.
FREE_DAYS = (
    "d MMMM yyyy", "MMMM d, yyyy", "d. MMM yyyy", "MMM d yyyy", "EEEE, d MMMM yyyy", "EEE MMM d yyyy", "yyyy, MMMM d", "yyyy/MM/dd", "yyyy.MM.dd",
    "d'th of' MMMM yyyy", "MMMM 'the' d'rd', yyyy", "d-MMM-yyyy", "dd/MMM/yyyy", "yyyy MMM. d", "MM.dd.yyyy", "MM/dd/yy", "d MMM yy",
)
FREE_MONTHS = ("MMMM yyyy", "MMM. yyyy", "MM/yyyy", "'in' MMMM, yyyy")


def free_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days and months written in other ways."""
    ways = [F.date_format("o_orderdate", way) for way in (*FREE_DAYS, *FREE_MONTHS)]
    nth = (F.col("o_orderkey") % len(ways)).cast("int")
    return inputs.table(spark, folder, "orders").select("o_orderkey", text.parse_date(F.get(F.array(*ways), nth)).alias("date"))


def start_or_year(spark: SparkSession, folder: str) -> DataFrame:
    """P5, P15"""
    rows = inputs.flat_grants(spark, folder)
    return rows.select(
        "item_id",
        text.date_prefix(F.col("project_start_date")).alias("prefix"),
        text.start_date_or_year(F.col("project_start_date"), F.col("fiscal_year")).alias("date"),
    )


def joined_terms(spark: SparkSession, folder: str) -> DataFrame:
    """P16 with both separators."""
    parts = [F.col(name) for name in ("pref_terms", "spending_categories_desc", "org_name")]
    return inputs.flat_grants(spark, folder).select(
        "item_id", text.joined_terms(parts).alias("merged"), text.joined_terms(parts, ";").alias("network")
    )


def _amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts as text: positive, negative, missing, zero and no number at all."""
    nation = F.col("c_nationkey")
    amount = (
        F.when(nation == 1, None)
        .when(nation == 2, F.lit("abc"))
        .when(nation == 3, F.lit("0"))
        .when(nation == 4, F.lit("-5"))
        .when(nation == 5, F.lit(""))
        .otherwise(F.col("c_acctbal").cast("string"))
    )
    return inputs.table(spark, folder, "customer").select("c_custkey", amount.alias("amount"))


def amount_size(spark: SparkSession, folder: str) -> DataFrame:
    """P17"""
    rows = _amounts(spark, folder)
    return rows.select("c_custkey", F.round(text.amount_size(F.col("amount")), 9).alias("size"))


def amount_count(spark: SparkSession, folder: str) -> DataFrame:
    """P18"""
    return _amounts(spark, folder).select("c_custkey", text.amount_count(F.col("amount")).alias("citation_count"))


def category_colour(spark: SparkSession, folder: str) -> DataFrame:
    """P19 on grant categories and on document texts."""
    grants = inputs.flat_grants(spark, folder).select(
        F.concat(F.lit("g"), "item_id").alias("id"), text.category_colour(F.col("spending_categories_desc")).alias("color")
    )
    documents = inputs.table(spark, folder, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"),
        text.category_colour(F.concat(F.lit(" "), F.col("text"), F.lit(" ; rest"))).alias("color"),
    )
    return grants.unionByName(documents)


def agency_name(spark: SparkSession, folder: str) -> DataFrame:
    """A field that is an object, a text or a number."""
    return store.open_grants(inputs.grants(spark, folder)).select("core_project_num", "agency", "org_name")


def author_id(spark: SparkSession, folder: str) -> DataFrame:
    """P22 on customer and document texts."""
    customers = inputs.table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    documents = inputs.table(spark, folder, "documents").select(F.col("text").alias("name"))
    return customers.unionByName(documents).select("name", text.author_id(F.col("name")).alias("id"))


def rescale(spark: SparkSession, folder: str) -> DataFrame:
    """P23 on all numbers of the vectors."""
    rows = inputs.table(spark, folder, "embeddings")
    numbers = rows.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return numbers.select("vec_id", "pos", F.round(text.rescale(F.col("value").cast("double")), 9).alias("value"))


def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole frequency table, renamed."""
    return stats.value_counts(inputs.flat_grants(spark, folder), "core_project_num", "core")


def top_values(spark: SparkSession, folder: str) -> DataFrame:
    """L2"""
    return stats.top_values(inputs.table(spark, folder, "lineitem"), "l_partkey", 20, "part")


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """L3"""
    rows = inputs.flat_grants(spark, folder).select("item_id", "project_num", "fiscal_year", "award_amount")
    return stats.first_rows(rows, 5, ["award_amount", "item_id"])


def shapes(spark: SparkSession, folder: str) -> DataFrame:
    """A12"""
    rows = inputs.flat_grants(spark, folder)
    kept = stats.equal_rows(rows, "agency_ic_admin", "BUILDING")
    return (
        stats.shape(rows).withColumn("name", F.lit("all"))
        .unionByName(stats.shape(kept).withColumn("name", F.lit("one agency")))
    )


QUERIES = {
    "p4_clean_text": clean_text,
    "p5_p15_start_or_year": start_or_year,
    "p6_equal_rows": equal_rows,
    "p7_present_keys": present_keys,
    "p8_grant_text": grant_text,
    "p9_capitalise_words": capitalise_words,
    "p10_text_templates": text_templates,
    "p14_parse_date": parse_date,
    "p14_free_dates": free_dates,
    "p16_joined_terms": joined_terms,
    "p17_amount_size": amount_size,
    "p18_amount_count": amount_count,
    "p19_category_colour": category_colour,
    "p21_agency_name": agency_name,
    "p22_author_id": author_id,
    "p23_rescale": rescale,
    "a1_value_counts": value_counts,
    "l2_top_values": top_values,
    "l3_first_rows": first_rows,
    "a12_shapes": shapes,
}

_MESSY = "' ' || chr(12288) || replace(text, '.', chr(9) || '.' || chr(28) || ' ') || chr(8195) || ' '"
_AMOUNTS = """amounts AS (
  SELECT c_custkey, CASE c_nationkey WHEN 1 THEN NULL WHEN 2 THEN 'abc' WHEN 3 THEN '0' WHEN 4 THEN '-5' WHEN 5 THEN ''
    ELSE c_acctbal::VARCHAR END AS amount FROM customer)"""


def _filled(template: str) -> str:
    """A template as a SQL concatenation."""
    parts = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(f"'{literal}'")
        if field:
            value = oracle.capitalised("project_title") if field == "project_title" else f"{field}::VARCHAR"
            parts.append(f"coalesce({value}, '')")
    return " || ".join(parts)


_VERSIONS = " UNION ALL ".join(
    f"SELECT o_orderkey AS item_id, '{name}' AS version, {_filled(template)} AS text FROM projects"
    for name, template in templates.GRANT_TEMPLATES.items()
)
_PARTS = ["pref_terms", "spending_categories_desc", "org_name"]

ORACLES = {
    "p4_clean_text": f"SELECT doc_id, {oracle.clean(_MESSY)} AS cleaned FROM documents",
    "p5_p15_start_or_year": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, coalesce(substr(project_start_date, 1, 10), '') AS prefix,
  coalesce(project_start_date, fiscal_year || '-01-01') AS date FROM projects""",
    "p6_equal_rows": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, project_num, core_project_num, fiscal_year, award_amount, agency_ic_admin FROM projects
WHERE agency_ic_admin = 'BUILDING'""",
    "p7_present_keys": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, core_project_num, regexp_full_match(CASE WHEN fiscal_year % 2 = 0 THEN o_orderkey::VARCHAR ELSE project_num END, '[0-9]+') AS is_digits
FROM projects WHERE core_project_num <> ''""",
    "p8_grant_text": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, {_filled(templates.GRANT_TEMPLATES['abstract'])} AS text FROM projects""",
    "p9_capitalise_words": f"SELECT doc_id, {oracle.capitalised(_MESSY)} AS words FROM documents",
    "p10_text_templates": f"WITH {oracle.PROJECTS} {_VERSIONS}",
    "p14_free_dates": f"""SELECT o_orderkey, strftime(CASE WHEN o_orderkey % {len(FREE_DAYS) + len(FREE_MONTHS)} < {len(FREE_DAYS)}
  THEN o_orderdate::DATE ELSE date_trunc('month', o_orderdate)::DATE END, '%Y-%m-%d') AS date FROM orders""",
    "p14_parse_date": f"""WITH {oracle.PAPERS}
SELECT pmid AS o_orderkey, {oracle.parsed_date('pubdate')} AS date,
  {oracle.parsed_date('pubdate', 'year(o_orderdate)')} AS date_or_year FROM papers""",
    "p16_joined_terms": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, {oracle.terms(_PARTS, '; ')} AS merged, {oracle.terms(_PARTS, ';')} AS network FROM projects""",
    "p17_amount_size": f"WITH {_AMOUNTS} SELECT c_custkey, round({oracle.size('amount')}, 9) AS size FROM amounts",
    "p18_amount_count": f"""WITH {_AMOUNTS}
SELECT c_custkey, greatest(coalesce(trunc(TRY_CAST(amount AS DOUBLE))::BIGINT, 0), 0) AS citation_count FROM amounts""",
    "p19_category_colour": f"""WITH {oracle.PROJECTS}
SELECT 'g' || o_orderkey AS id, {oracle.colour('spending_categories_desc')} AS color FROM projects
UNION ALL SELECT 'd' || doc_id, {oracle.colour("(' ' || text || ' ; rest')")} FROM documents""",
    "p21_agency_name": f"""WITH {oracle.GRANTS}
SELECT core_project_num, agency, coalesce(org_name, '') AS org_name FROM grants""",
    "p22_author_id": """SELECT name, substr(md5(name), 1, 12) AS id
FROM (SELECT c_name AS name FROM customer UNION ALL SELECT text FROM documents)""",
    "p23_rescale": """SELECT vec_id, pos, round(value * 5.5::DOUBLE, 9) AS value
FROM (SELECT vec_id, unnest(range(0, len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings)""",
    "a1_value_counts": f"""WITH {oracle.PROJECTS}
SELECT core_project_num AS core, count(*) AS count FROM projects WHERE core_project_num <> '' GROUP BY core""",
    "l2_top_values": """SELECT l_partkey AS part, count(*) AS count FROM lineitem GROUP BY part ORDER BY count DESC, part LIMIT 20""",
    "l3_first_rows": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, project_num, fiscal_year, award_amount FROM projects ORDER BY award_amount, item_id LIMIT 5""",
    "a12_shapes": f"""WITH {oracle.PROJECTS}
SELECT 'all' AS name, count(*) AS n_rows, 14::BIGINT AS n_columns FROM projects
UNION ALL SELECT 'one agency', count(*), 14 FROM projects WHERE agency_ic_admin = 'BUILDING'""",
}
