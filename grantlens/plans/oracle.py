"""Building blocks of the check SQL: the roles of :mod:`grantlens.plans.inputs` in DuckDB."""

from __future__ import annotations

from grantlens.functions.text import CATEGORY_PALETTE
from grantlens.operators.harvest import ORG_STATES

WHITESPACE = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{value}'" for value in values) + "]"


def clean(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WHITESPACE}', ' ', 'g'))"


def capitalised(c: str) -> str:
    """Words with a title-case first letter; that of the sharp s is two letters."""
    words = f"string_split({clean(c)}, ' ')"
    first = "CASE w[1:1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1:1]) END"
    return f"array_to_string(list_transform({words}, lambda w: {first} || lower(w[2:])), ' ')"


def colour(c: str) -> str:
    index = f"('0x' || substr(md5(trim(split_part({c}, ';', 1))), 1, 8))::BIGINT % {len(CATEGORY_PALETTE)}"
    palette = sql_list(CATEGORY_PALETTE)
    return f"CASE WHEN coalesce({c}, '') = '' THEN '{CATEGORY_PALETTE[0]}' ELSE {palette}[{index} + 1] END"


def size(c: str) -> str:
    return f"CASE WHEN TRY_CAST({c} AS DOUBLE) > 0 THEN sqrt(TRY_CAST({c} AS DOUBLE)) / 100 ELSE 1.0 END"


def terms(parts: list[str], separator: str) -> str:
    listed = ", ".join(f"nullif({part}, '')" for part in parts)
    return f"concat_ws('{separator}', {listed})"


def place(c: str) -> tuple[str, str]:
    """Two test coordinates from the md5 of an id."""
    return (
        f"('0x' || substr(md5({c}), 1, 6))::BIGINT / 1000.0",
        f"('0x' || substr(md5({c}), 7, 6))::BIGINT / 1000.0",
    )


PROJECTS = f"""
projects AS (
  SELECT o_orderkey, year(o_orderdate)::INTEGER AS fiscal_year, year(o_orderdate)::VARCHAR AS page_year,
    {sql_list(ORG_STATES)}[c_nationkey + 1] AS page_state,
    'P' || o_custkey || '-' || month(o_orderdate) AS project_num,
    CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '3-MEDIUM' THEN NULL
      ELSE 'C' || o_custkey || '-' || substr(o_orderpriority, 1, 1) END AS core_project_num,
    o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' AS odd,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS org_name,
    o_totalprice AS award_amount,
    c_name || ', ' || c_mktsegment AS principal_investigators,
    CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS agency_ic_admin,
    ' ' || o_orderpriority || chr(9) || ';' || chr(13) || chr(10) || c_mktsegment AS pref_terms,
    c_name || chr(10) || chr(10) || ' ' || o_orderpriority || ' ' || chr(9) || o_orderstatus AS abstract_text,
    c_mktsegment || '  ' || o_orderpriority AS project_title,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority || '; ' || c_mktsegment END AS spending_categories_desc,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS date_added,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS project_start_date,
    strftime(o_orderdate::DATE + 365, '%Y-%m-%d') AS project_end_date,
    substr(o_orderpriority, 1, 1) AS award_type, 'R01' AS activity_code, o_orderstatus
  FROM orders JOIN customer ON c_custkey = o_custkey
)"""


def paged(page_size: int = 500) -> str:
    """``paged``: projects with their page file and position."""
    nth = "row_number() OVER (PARTITION BY page_year, page_state ORDER BY o_orderkey) - 1"
    return f"""{PROJECTS},
paged AS (
  SELECT *, (nth // {page_size})::VARCHAR || '.json' AS page_file, (nth % {page_size})::INTEGER AS pos
  FROM (SELECT *, {nth} AS nth FROM projects)
)"""


EXTRACTED = f"""
extracted AS (
  SELECT page_year, page_state, page_file, pos, project_num, core_project_num, fiscal_year,
    coalesce(org_name, '') AS org_name, award_amount, principal_investigators,
    CASE WHEN odd THEN '' ELSE coalesce(agency_ic_admin, '') END AS agency_ic_admin,
    {clean('pref_terms')} AS pref_terms, {clean('abstract_text')} AS abstract_text,
    {clean('project_title')} AS project_title,
    coalesce({clean('spending_categories_desc')}, '') AS spending_categories_desc,
    substr(date_added, 1, 10) AS date_added, coalesce(substr(project_start_date, 1, 10), '') AS project_start_date,
    project_end_date, award_type, activity_code, true AS is_record, odd AS is_bad
  FROM paged
)"""


def two_key_rounds(slim: str = "slim", rounds: int = 26) -> str:
    """``fates(ord, status)`` from ``slim(ord, p, c)`` with non-null keys: the rounds, unrolled."""
    steps = [f"e0 AS MATERIALIZED (SELECT p, c, min(ord) AS ord FROM {slim} GROUP BY p, c)"]
    for i in range(rounds):
        steps.append(
            f"k{i} AS MATERIALIZED (SELECT a.p, b.c, a.ord FROM (SELECT p, min(ord) AS ord FROM e{i} GROUP BY p) a "
            f"JOIN (SELECT c, min(ord) AS ord FROM e{i} GROUP BY c) b ON a.ord = b.ord)"
        )
        steps.append(
            f"e{i + 1} AS MATERIALIZED (SELECT * FROM e{i} WHERE p NOT IN (SELECT p FROM k{i}) "
            f"AND c NOT IN (SELECT c FROM k{i}))"
        )
    kept = " UNION ALL ".join(f"SELECT p, ord FROM k{i}" for i in range(rounds))
    steps.append(f"kept AS (SELECT p, ord AS kept_ord FROM ({kept}))")
    steps.append(
        f"fates AS (SELECT s.ord, CASE WHEN (SELECT count(*) FROM e{rounds}) > 0 THEN error('more rounds needed') "
        f"WHEN kept_ord = s.ord THEN 'keep' WHEN kept_ord < s.ord THEN 'project' ELSE 'core' END AS status "
        f"FROM {slim} s LEFT JOIN kept USING (p))"
    )
    return ",\n".join(steps)


def slim_keys(rows: str, order: str, project: str = "project_num", core: str = "core_project_num", name: str = "slim") -> str:
    """``slim(ord, p, c)``: reading order and non-null keys of ``rows``."""
    checked = f"CASE WHEN coalesce({core}::VARCHAR, '') = '' THEN {project}::VARCHAR ELSE {core}::VARCHAR END"
    return f"""
placed AS (SELECT *, row_number() OVER (ORDER BY {order}) AS ord FROM {rows}),
{name} AS (
  SELECT ord, coalesce('=' || {project}::VARCHAR, '') AS p, coalesce('=' || {checked}, '') AS c FROM placed
)"""


PAGE_ORDER = "page_year, page_state, page_file, pos"

CONVERTED = f"""WITH {paged()}, {EXTRACTED}, {slim_keys('extracted', PAGE_ORDER)}, {two_key_rounds()},
converted AS (SELECT placed.*, status, status = 'keep' AND NOT is_bad AS written FROM placed JOIN fates USING (ord))"""

GRANTS = """
grants AS (
  SELECT 'G' || s_suppkey AS core_project_num, s_name AS project_title, s_nationkey + 1990 AS fiscal_year,
    s_acctbal AS award_amount,
    CASE WHEN n_regionkey <> 2 THEN '2001-02-' || lpad((s_nationkey + 1)::VARCHAR, 2, '0') || 'T00:00:00' END AS project_start_date,
    CASE WHEN n_regionkey <> 3 THEN 'Org ' || n_name END AS org_name,
    CASE WHEN n_regionkey = 1 THEN '' ELSE n_name END AS agency
  FROM supplier JOIN nation ON n_nationkey = s_nationkey
)"""

GRANT_ROWS = """
grant_rows AS (
  SELECT pid, 'term ' || pid || '/' || l_linenumber AS pref_terms,
    CASE WHEN NOT ends_with(pid, '0') THEN 'Area ' || (9 - l_linenumber) END AS spending_categories_desc
  FROM (SELECT l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'G' || (l_suppkey * 2)
    WHEN l_returnflag <> 'N' THEN 'G' || l_suppkey END AS pid FROM lineitem)
)"""

LINKS = "links AS (SELECT DISTINCT 'G' || l_suppkey AS core_project_num, l_orderkey AS pmid FROM lineitem)"

PAPERS = """
papers AS (
  SELECT o_orderkey AS pmid, o_orderpriority AS source, 'Title of ' || o_orderkey AS title, c_name, c_mktsegment, o_orderdate,
    CASE
      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN year(o_orderdate) || ' Winter'
      WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN ''
      WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y %b') || '-Dec'
      WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m')
      WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN strftime(o_orderdate, '%m-%d-%Y')
      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND day(o_orderdate) % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z')
      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
      WHEN o_orderpriority = '1-URGENT' AND day(o_orderdate) % 2 = 1 THEN strftime(o_orderdate, '%Y %B %-d')
      WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y %b %-d')
      WHEN o_orderpriority = '2-HIGH' AND day(o_orderdate) % 2 = 1 THEN strftime(o_orderdate, '%Y %B')
      WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%Y %b')
      WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%Y')
      WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d')
      ELSE strftime(o_orderdate, '%m/%d/%Y') END AS pubdate
  FROM orders JOIN customer ON c_custkey = o_custkey
),
authors AS (
  SELECT pmid, unnest([c_name, source, 'Group ' || c_mktsegment]) AS name, unnest([0, 3, 4]) AS pos FROM papers
)"""

DATE_FORMATS = sql_list(
    ["%Y %b %-d", "%Y %b", "%Y %B %-d", "%Y %B", "%Y-%m-%d", "%Y-%m", "%Y", "%m/%d/%Y", "%m-%d-%Y"]
)


def parsed_date(c: str, year: str | None = None) -> str:
    day = f"CASE WHEN {c} LIKE '____-__-__T%' THEN substr({c}, 1, 10) ELSE {c} END"
    month = f"try_strptime(regexp_extract({c}, '^([0-9]{{4}} [A-Za-z]{{3}})([^A-Za-z]|$)', 1), '%Y %b')"
    start = f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}} ') THEN make_date(substr({c}, 1, 4)::INTEGER, 1, 1) END"
    parsed = f"strftime(coalesce(try_strptime({day}, {DATE_FORMATS}), {month}, {start}), '%Y-%m-%d')"
    fallback = f"CASE WHEN coalesce({c}, '') = '' THEN '1900-01-01' ELSE '2020-01-01' END"
    return f"coalesce({parsed}, {f'{year} || ' if year else 'NULL || '}'-01-01', {fallback})"


CITATIONS = """
citations AS (
  SELECT event_id AS pmid, CASE WHEN event_type <> 'error' THEN user_id END AS citation_count,
    CASE WHEN event_type = 'click' THEN 0.0 WHEN event_type <> 'view' THEN value END AS relative_citation_ratio
  FROM events
)"""


def items(papers: str = "papers") -> str:
    return f"""
one_per_pid AS (
  SELECT pid, pref_terms, spending_categories_desc FROM grant_rows WHERE pid IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY pid ORDER BY pref_terms NULLS FIRST, spending_categories_desc NULLS FIRST) = 1
),
scoped AS (SELECT * FROM {papers}),
author_first AS (SELECT name, min(pmid) AS pmid FROM authors WHERE pmid IN (SELECT pmid FROM scoped) GROUP BY name),
items AS (
  SELECT 'grant:' || pid AS item_id, 'grant' AS type, pid, NULL::BIGINT AS pmid, coalesce(project_title, '') AS text,
    project_start_date AS date_text, fiscal_year, coalesce(agency, '') AS journal, coalesce(project_title, '') AS title,
    {terms(['pref_terms', 'spending_categories_desc', 'org_name'], ';')} AS mesh_terms, award_amount
  FROM one_per_pid LEFT JOIN grants ON core_project_num = pid
  UNION ALL
  SELECT 'paper:' || pmid, 'paper', pmid::VARCHAR, pmid, source || ' | ' || title, pubdate, NULL, source, title, '', NULL
  FROM scoped
  UNION ALL
  SELECT 'author:' || name, 'author', substr(md5(name), 1, 12), pmid, source || ' | ' || name || ' | ' || title, pubdate,
    NULL, 'Author', name, '', NULL
  FROM author_first JOIN scoped USING (pmid)
)"""


def harvest(page_size: int = 50) -> str:
    """``totals``, ``pages`` and ``grid`` of the partly harvested cache."""
    return f"""{PROJECTS},
totals AS (SELECT fiscal_year, page_state AS org_state, count(*) AS total FROM projects GROUP BY ALL),
held AS (
  SELECT fiscal_year, page_state AS org_state,
    ((row_number() OVER (PARTITION BY fiscal_year, page_state ORDER BY o_orderkey) - 1) // {page_size})::INTEGER AS batch
  FROM projects WHERE o_orderstatus <> 'O'
),
pages AS (
  SELECT fiscal_year, org_state, batch, total, n_results
  FROM (SELECT fiscal_year, org_state, batch, count(*) AS n_results FROM held GROUP BY ALL) JOIN totals USING (fiscal_year, org_state)
),
told AS (SELECT fiscal_year, org_state, total FROM pages WHERE batch = 0),
plan AS (
  SELECT fiscal_year, org_state, unnest(range(0, ceil(total / {page_size})::BIGINT))::INTEGER AS batch FROM told
),
grid AS (
  SELECT fiscal_year, unnest({sql_list(ORG_STATES)}) AS org_state
  FROM (SELECT DISTINCT year(o_orderdate)::INTEGER AS fiscal_year FROM orders)
),
lacking AS (SELECT * FROM plan ANTI JOIN pages USING (fiscal_year, org_state, batch))"""
