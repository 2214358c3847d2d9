"""Queries over duplicate keys, upserts, key look-ups and numbering, with their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions import variants
from grantlens.operators import dedupe
from grantlens.operators.numbering import number_batches
from grantlens.plans import inputs, oracle
from grantlens.session import staged_folder
from grantlens.sources import responses
from grantlens.streaming import arrivals

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.table(spark, folder, "lineitem").select(*ORDER).distinct()


def _gappy(rows: DataFrame) -> DataFrame:
    """Line keys as texts, with missing and empty numbers of both kinds."""
    size = F.length(F.col("l_partkey").cast("string"))
    project = F.when(F.col("l_linenumber") == 7, None).when(size == 1, "").otherwise(F.concat(F.lit("p"), "l_orderkey"))
    core = F.when(F.col("l_linenumber") == 3, None).when(F.col("l_linenumber") == 4, "").otherwise(
        F.concat(F.lit("c"), "l_suppkey")
    )
    return rows.select(*ORDER, project.alias("project"), core.alias("core"))


def two_key_status(spark: SparkSession, folder: str) -> DataFrame:
    """The fate of every line with the part as its core."""
    return dedupe.two_key_status(_lines(spark, folder), "l_orderkey", "l_partkey", ORDER)


def two_key_status_few_cores(spark: SparkSession, folder: str) -> DataFrame:
    """D1 with few, large core groups."""
    return dedupe.two_key_status(_lines(spark, folder), "l_orderkey", "l_suppkey", ORDER)


def two_key_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """D1 kept up to date: three quarters of the lines, then the rest, then lines that come late."""
    lines = _lines(spark, folder).select(*ORDER)
    most = inputs.table(spark, folder, "lineitem").agg(F.max("l_orderkey").alias("most")).first()["most"]
    late = (F.pmod(F.xxhash64(*ORDER), F.lit(50)) == 0) & (F.col("l_orderkey") > most * 0.6)
    arrival = F.when(late, 2).when(F.col("l_orderkey") > most * 0.75, 1).otherwise(0)
    log = arrivals.DedupeLog(spark, staged_folder(spark, "arrivals"), lines.schema, "l_orderkey", "l_suppkey", ORDER)
    for batch in range(3):
        log.take(lines.where(arrival == batch), batch)
    return log.fates().select(*ORDER, "status")


def _hot(rows: DataFrame) -> DataFrame:
    """Line keys of which one project has every second line and one core every third."""
    project = F.when(F.col("l_orderkey") % 2 == 0, "hot").otherwise(F.concat(F.lit("p"), "l_orderkey"))
    core = F.when(F.col("l_partkey") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "l_partkey"))
    return rows.select(*ORDER, project.alias("project"), core.alias("core"))


def two_key_status_hot(spark: SparkSession, folder: str) -> DataFrame:
    """D1 with keys so common that their joins are salted."""
    return dedupe.two_key_status(_hot(_lines(spark, folder)), "project", "core", ORDER)


def two_key_dedupe_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """D1 with missing and empty keys: the kept rows."""
    return dedupe.two_key_dedupe(_gappy(_lines(spark, folder)), "project", "core", ORDER)


def two_key_flag(spark: SparkSession, folder: str) -> DataFrame:
    """D1b"""
    rows = _gappy(_lines(spark, folder))
    return dedupe.two_key_flag(rows, "project", "core", ORDER).select(*ORDER, "skipped_project", "skipped_core")


def upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Project responses put over a store with one old grant per customer."""
    store = inputs.table(spark, folder, "customer").select(
        F.concat(F.lit("C"), "c_custkey", F.lit("-1")).alias("core_project_num"),
        F.to_json(F.struct(F.lit("old").alias("project_num"))).alias("metadata"),
    )
    incoming = responses.grant_rows(inputs.grant_responses(spark, folder), carry=["seq"])
    merged = dedupe.upsert(store, incoming, "core_project_num", ["seq", "pos"])
    v = variants.parse(F.col("metadata"))
    return merged.select(
        "core_project_num", variants.text(v, "$.project_num").alias("project_num"),
        variants.number(v, "$.award_amount").alias("award_amount"),
    )


def _n_links(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem").filter("l_returnflag = 'N'")
    return lines.select(F.concat(F.lit("G"), "l_suppkey").alias("core_project_num"), F.col("l_orderkey").alias("pmid")).distinct()


def insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    """D3: link rows added to a link store."""
    incoming = responses.link_rows(inputs.link_responses(spark, folder))
    return dedupe.insert_ignore(_n_links(spark, folder), incoming, ["core_project_num", "pmid"])


def first_papers(spark: SparkSession, folder: str) -> DataFrame:
    """One paper per pmid, the first to arrive, where every line brings its order's paper."""
    arrivals = inputs.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("pmid"), F.struct("l_partkey", "l_suppkey", "l_linenumber").alias("nth"),
        F.concat(F.lit("line "), "l_partkey").alias("title"),
    )
    return dedupe.first_per_key(arrivals, "pmid", "nth").select("pmid", "title")


def _wanted(spark: SparkSession, folder: str) -> DataFrame:
    lines = inputs.table(spark, folder, "lineitem")
    return lines.select(F.col("l_orderkey").alias("pmid"), F.concat(F.lit("G"), F.col("l_suppkey") * 2).alias("core_project_num"))


def missing_grants(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted grants the store lacks; repeats stay."""
    return dedupe.missing_keys(_wanted(spark, folder), inputs.grants(spark, folder), "core_project_num").select("core_project_num")


def _fetched(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.table(spark, folder, "events").select(F.col("event_id").alias("pmid"))


def missing_papers(spark: SparkSession, folder: str) -> DataFrame:
    """J2, U3"""
    return dedupe.missing_keys(_wanted(spark, folder), _fetched(spark, folder), "pmid").select("pmid")


def existing_grants(spark: SparkSession, folder: str) -> DataFrame:
    """J3"""
    return dedupe.existing_keys(_wanted(spark, folder), inputs.grants(spark, folder), "core_project_num").select("core_project_num")


def existing_papers(spark: SparkSession, folder: str) -> DataFrame:
    """J3"""
    return dedupe.existing_keys(_wanted(spark, folder), _fetched(spark, folder), "pmid").select("pmid")


def number_all(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of 200 over the whole list."""
    rows = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return number_batches(rows, 200, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "batch")


def number_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of 32 per group, in few and large groups."""
    lines = _lines(spark, folder).join(
        inputs.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), "l_orderkey"
    )
    return number_batches(lines, 32, ORDER, ["o_orderpriority"])


QUERIES = {
    "d1_two_key_status": two_key_status,
    "d1_two_key_status_few_cores": two_key_status_few_cores,
    "d1_two_key_status_hot": two_key_status_hot,
    "d1_two_key_arrivals": two_key_arrivals,
    "d1_two_key_dedupe_gaps": two_key_dedupe_gaps,
    "d1b_two_key_flag": two_key_flag,
    "d2_upsert": upsert,
    "d3_insert_ignore": insert_ignore,
    "w1_first_papers": first_papers,
    "w3_number_all": number_all,
    "w3_number_groups": number_groups,
    "j1_missing_grants": missing_grants,
    "j2_missing_papers": missing_papers,
    "j3_existing_grants": existing_grants,
    "j3_existing_papers": existing_papers,
}

_LINES = f"lines AS (SELECT DISTINCT {', '.join(ORDER)} FROM lineitem)"
_ORDER = ", ".join(ORDER)
_GAPPY = f"""{_LINES},
gappy AS (
  SELECT *, CASE WHEN l_linenumber = 7 THEN NULL WHEN length(l_partkey::VARCHAR) = 1 THEN '' ELSE 'p' || l_orderkey END AS project,
    CASE l_linenumber WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'c' || l_suppkey END AS core FROM lines
)"""
_WANTED = "wanted AS (SELECT l_orderkey AS pmid, 'G' || (l_suppkey * 2) AS core_project_num FROM lineitem)"


def _status(core: str) -> str:
    return f"""WITH {_LINES}, {oracle.slim_keys('lines', _ORDER, 'l_orderkey', core)}, {oracle.two_key_rounds()}
SELECT {_ORDER}, status FROM placed JOIN fates USING (ord)"""


ORACLES = {
    "d1_two_key_status": _status("l_partkey"),
    "d1_two_key_status_few_cores": _status("l_suppkey"),
    "d1_two_key_arrivals": _status("l_suppkey"),
    "d1_two_key_status_hot": f"""WITH {_LINES},
hot AS (SELECT *, CASE WHEN l_orderkey % 2 = 0 THEN 'hot' ELSE 'p' || l_orderkey END AS project,
  CASE WHEN l_partkey % 3 = 0 THEN 'hot' ELSE 'c' || l_partkey END AS core FROM lines),
{oracle.slim_keys('hot', _ORDER, 'project', 'core')}, {oracle.two_key_rounds()}
SELECT {_ORDER}, status FROM placed JOIN fates USING (ord)""",
    "d1_two_key_dedupe_gaps": f"""WITH {_GAPPY}, {oracle.slim_keys('gappy', _ORDER, 'project', 'core')}, {oracle.two_key_rounds()}
SELECT {_ORDER}, project, core FROM placed JOIN fates USING (ord) WHERE status = 'keep'""",
    "d1b_two_key_flag": f"""WITH {_GAPPY}, {oracle.slim_keys('gappy', _ORDER, 'project', 'core')}
SELECT {_ORDER}, row_number() OVER (PARTITION BY p ORDER BY ord) > 1 AS skipped_project,
  row_number() OVER (PARTITION BY c ORDER BY ord) > 1 AS skipped_core
FROM placed JOIN slim USING (ord)""",
    "d2_upsert": f"""WITH {oracle.PROJECTS},
incoming AS (
  SELECT core_project_num, arg_max(project_num, o_orderkey) AS project_num, arg_max(award_amount, o_orderkey) AS award_amount
  FROM projects WHERE core_project_num <> '' GROUP BY core_project_num
)
SELECT * FROM incoming UNION ALL
SELECT core_project_num, 'old', NULL FROM (SELECT 'C' || c_custkey || '-1' AS core_project_num FROM customer)
WHERE core_project_num NOT IN (SELECT core_project_num FROM incoming)""",
    "d3_insert_ignore": """
SELECT DISTINCT 'G' || l_suppkey AS core_project_num, l_orderkey AS pmid FROM lineitem WHERE l_returnflag = 'N'
UNION SELECT 'G' || l_suppkey, l_orderkey FROM lineitem
WHERE l_returnflag <> 'A' AND (l_returnflag <> 'R' OR l_linestatus <> 'O') AND l_orderkey <> 0""",
    "w1_first_papers": """
SELECT l_orderkey AS pmid, 'line ' || min(l_partkey) AS title FROM lineitem GROUP BY l_orderkey""",
    "w3_number_all": """
SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 200)::INTEGER AS batch FROM orders""",
    "w3_number_groups": f"""WITH {_LINES}
SELECT {_ORDER}, o_orderpriority,
  ((row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_ORDER}) - 1) // 32)::INTEGER AS batch
FROM lines JOIN orders ON o_orderkey = l_orderkey""",
    "j1_missing_grants": f"""WITH {_WANTED}, {oracle.GRANTS}
SELECT core_project_num FROM wanted WHERE core_project_num NOT IN (SELECT core_project_num FROM grants)""",
    "j2_missing_papers": f"""WITH {_WANTED} SELECT pmid FROM wanted WHERE pmid NOT IN (SELECT event_id FROM events)""",
    "j3_existing_grants": f"""WITH {_WANTED}, {oracle.GRANTS}
SELECT core_project_num FROM wanted WHERE core_project_num IN (SELECT core_project_num FROM grants)""",
    "j3_existing_papers": f"""WITH {_WANTED} SELECT pmid FROM wanted WHERE pmid IN (SELECT event_id FROM events)""",
}
