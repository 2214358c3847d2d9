"""Queries over pages, files and responses, with their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions import variants
from grantlens.operators import extract, graph, stats
from grantlens.operators.numbering import number_rows
from grantlens.plans import inputs, oracle
from grantlens.session import stage, staged_folder
from grantlens.sources import document, page_files, pages, positions, responses, split_tsv, store, tsv
from grantlens.streaming import ingest


def _fresh_path(spark: SparkSession, label: str) -> str:
    return staged_folder(spark, label)


def page_order(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a cache, numbered in reading order."""
    root = inputs.page_files(spark, inputs.project_pages(spark, folder, page_size=50))
    found = stage(pages.scan_pages(spark, root, pages.PAGE_KEY), "found")  # a sort reads its rows twice, files are read once
    return number_rows(found, list(pages.PAGE_KEY), name="nth")


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    """Pages read from files, some of them damaged."""
    return pages.scan_pages(spark, inputs.page_files(spark, inputs.damaged_pages(spark, folder)))


def bad_pages(spark: SparkSession, folder: str) -> DataFrame:
    """S2"""
    return pages.bad_pages(_scanned(spark, folder))


def flatten_results(spark: SparkSession, folder: str) -> DataFrame:
    """S2, S3"""
    records = pages.flatten_results(_scanned(spark, folder))
    return records.select(*pages.PAGE_ORDER, variants.text(F.col("record"), "$.project_num").alias("project_num"))


def _stored(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("page_year").alias("fiscal_year"),
        F.col("page_state").alias("org_state"),
        F.regexp_extract("page_file", r"^(\d+)", 1).cast("int").alias("batch"),
        "body",
    )


def _stored_pages(spark: SparkSession, folder: str) -> DataFrame:
    path = _fresh_path(spark, "page-store")
    harvested = stage(_stored(inputs.project_pages(spark, folder, page_size=20)), "harvested")
    pages.write_pages(harvested, path)
    sizes = [_stored(inputs.project_pages(spark, folder, page_size=size)).withColumn("size", F.lit(size)) for size in (50, 20)]
    again = sizes[0].unionByName(sizes[1]).filter(F.col("org_state").isin("AL", "GA"))  # keys come twice
    pages.write_pages(stage(again, "harvested"), path, ["size"])
    return pages.read_stored_pages(spark, path)


def write_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written by key, some of them again in another size, then read back."""
    body = variants.parse(F.col("body"))
    return _stored_pages(spark, folder).select(
        "fiscal_year", "org_state", "batch",
        F.size(variants.elements(body, "$.results")).cast("bigint").alias("n_results"),
        variants.number(body, "$.meta.limit", "bigint").alias("page_limit"),
    )


def write_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same pages as files of their own, written twice and scanned."""
    root, numbered = _fresh_path(spark, "page-files"), inputs.numbered_projects(spark, folder)

    def sized(size: int) -> DataFrame:
        return _stored(inputs.project_pages(spark, folder, size, numbered))

    page_files.write_page_files(sized(20), root)
    sizes = [sized(size).withColumn("size", F.lit(size)) for size in (50, 20)]
    again = sizes[0].unionByName(sizes[1]).filter(F.col("org_state").isin("AL", "GA"))
    page_files.write_page_files(again, root, ["size"])
    body = variants.parse(F.col("body"))
    return pages.scan_pages(spark, root).select(
        F.col("page_year").alias("fiscal_year"),
        F.col("page_state").alias("org_state"),
        F.regexp_extract("page_file", r"^(.*)\.json$", 1).cast("int").alias("batch"),
        F.size(variants.elements(body, "$.results")).cast("bigint").alias("n_results"),
        variants.number(body, "$.meta.limit", "bigint").alias("page_limit"),
    )


def read_page(spark: SparkSession, folder: str) -> DataFrame:
    """The records of one stored page."""
    page = pages.read_page(_stored_pages(spark, folder), 1997, "AZ", 0)
    results = variants.elements(variants.parse(F.col("body")), "$.results")
    return page.select("fiscal_year", "org_state", "batch", F.posexplode(results).alias("pos", "record")).select(
        "fiscal_year", "org_state", "batch", "pos", variants.text(F.col("record"), "$.project_num").alias("project_num")
    )


def tsv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with line breaks, tabs and quotes through a TSV file."""
    path = _fresh_path(spark, "texts-tsv")
    quoted = F.concat(F.lit('"q" '), F.regexp_replace("text", r"\.", F.lit('\t"." ')), F.lit(" "))
    rows = inputs.table(spark, folder, "documents").select("doc_id", quoted.alias("text"), "lang")
    tsv.write_tsv(rows, path)
    return tsv.read_tsv(spark, path, "doc_id bigint, text string, lang string")


def tsv_in_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The same file read in ranges that may begin inside a text."""
    path = _fresh_path(spark, "texts-tsv")
    quoted = F.concat(F.lit('"q" '), F.regexp_replace("text", r"\.", F.lit('\t"." ')), F.lit(" "))
    rows = inputs.table(spark, folder, "documents").select("doc_id", quoted.alias("text"), "lang")
    tsv.write_tsv(rows, path)
    return split_tsv.read_split_tsv(spark, path, "doc_id bigint, text string, lang string")


def tsv_missing_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words that stand for a missing value."""
    path = _fresh_path(spark, "flat-tsv")
    rows = inputs.flat_grants(spark, folder).select(
        "item_id",
        F.coalesce("agency_ic_admin", F.lit("N/A")).alias("agency_ic_admin"),
        F.coalesce("core_project_num", F.lit("None")).alias("core_project_num"),
        "award_amount",
    )
    tsv.write_tsv(rows, path)
    return tsv.read_tsv(
        spark, path, "item_id bigint, agency_ic_admin string, core_project_num string, award_amount double"
    )


def skipped_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The skip lists of a conversion, as written."""
    by_project, by_core = _fresh_path(spark, "skipped-projects"), _fresh_path(spark, "skipped-cores")
    tsv.write_skipped(extract.convert(inputs.project_pages(spark, folder)), by_project, by_core)
    kinds = (("project", by_project), ("core", by_core))
    listed = [spark.read.text(path).select(F.lit(kind).alias("kind"), F.col("value").alias("line")) for kind, path in kinds]
    return listed[0].unionByName(listed[1])


def extract_projects(spark: SparkSession, folder: str) -> DataFrame:
    """The 16 columns of every record."""
    return extract.extract_projects(pages.flatten_results(inputs.project_pages(spark, folder)))


def convert_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page files to the deduplicated grant table."""
    root = inputs.page_files(spark, inputs.project_pages(spark, folder))
    return extract.written_grants(extract.convert(pages.scan_pages(spark, root)))


def grants_tsv(spark: SparkSession, folder: str) -> DataFrame:
    """The converted table written as TSV and read with its schema."""
    path = _fresh_path(spark, "grants-tsv")
    tsv.write_tsv(convert_pages(spark, folder), path)
    return tsv.read_tsv(spark, path, tsv.GRANT_SCHEMA, multi_line=False)


def conversion_stats(spark: SparkSession, folder: str) -> DataFrame:
    """A3"""
    return extract.conversion_stats(extract.convert(inputs.project_pages(spark, folder)))


def conversion_stats_flag_only(spark: SparkSession, folder: str) -> DataFrame:
    """A3 over D1b"""
    return extract.conversion_stats(extract.convert(inputs.project_pages(spark, folder), skip_duplicates=False))


def top_agencies(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: which agencies hold most distinct grants, from JSON pages (to A1, L2)."""
    return stats.top_values(convert_pages(spark, folder), "agency_ic_admin", 20)


def total_records(spark: SparkSession, folder: str) -> DataFrame:
    """A2"""
    return extract.total_records(pages.page_totals(inputs.damaged_pages(spark, folder)))


def scan_stores(spark: SparkSession, folder: str) -> DataFrame:
    """A paper store written as JSON text and opened again."""
    path = _fresh_path(spark, "papers")
    inputs.papers(spark, folder).write.parquet(path)
    opened = store.open_papers(spark.read.parquet(path))
    names = F.transform("authors", lambda author: F.coalesce(author["name"], F.lit("none")))
    return opened.select("pmid", "source", "title", "pubdate", F.array_join(names, ";").alias("entries"))


def vectors_by_position(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and vectors in two tables without a key, matched by place."""
    rows = inputs.table(spark, folder, "embeddings").orderBy("vec_id")
    ids, held = _fresh_path(spark, "ids"), _fresh_path(spark, "plain-vectors")
    rows.select(F.col("vec_id").cast("string").alias("item_id")).write.parquet(ids)
    rows.select("embedding").write.parquet(held)
    joined = positions.join_positions(positions.read_positions(spark, ids), positions.read_positions(spark, held))
    return joined.select("item_id", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


def vectors_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """S13"""
    path = _fresh_path(spark, "vectors")
    rows = inputs.table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("item_id"), "embedding")
    store.write_vectors(rows, path)
    read = store.read_vectors(spark, path)
    return read.select("item_id", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.col("value").cast("double"))


def stage_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """An existing stage output is reused, then overwritten when told to."""
    path = _fresh_path(spark, "stage")
    orders = inputs.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")

    def marked(mark: str):
        return lambda: orders.withColumn("mark", F.lit(mark))

    store.stage_output(spark, path, marked("first"))
    reused = store.stage_output(spark, path, marked("second")).groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    before = stage(reused.withColumn("how", F.lit("reuse")), "reused")
    again = store.stage_output(spark, path, marked("third"), "overwrite").groupBy("mark").agg(F.count(F.lit(1)).alias("n"))
    return before.unionByName(again.withColumn("how", F.lit("overwrite")))


def grant_rows(spark: SparkSession, folder: str) -> DataFrame:
    """S15"""
    rows = responses.grant_rows(inputs.grant_responses(spark, folder), carry=["seq"])
    v = variants.parse(F.col("metadata"))
    return rows.select(
        "seq", "core_project_num", variants.text(v, "$.project_num").alias("project_num"),
        variants.text(v, "$.organization.org_name").alias("org_name"),
        variants.number(v, "$.award_amount").alias("award_amount"),
    )


def link_rows(spark: SparkSession, folder: str) -> DataFrame:
    """S16"""
    return responses.link_rows(inputs.link_responses(spark, folder)).select("core_project_num", "pmid")


def paper_rows(spark: SparkSession, folder: str) -> DataFrame:
    """S17"""
    rows = responses.paper_rows(inputs.summary_responses(spark, folder))
    v = variants.parse(F.col("metadata"))
    return rows.select(
        "pmid", variants.text(v, "$.source").alias("source"), variants.text(v, "$.title").alias("title"),
        variants.joined_names(F.try_variant_get(v, "$.authors", "array<struct<name string>>"), "name", ";").alias("names"),
    )


def grant_list(spark: SparkSession, folder: str) -> DataFrame:
    """A list read from a TSV file; distinct, no missing ids."""
    path = _fresh_path(spark, "grant-list")
    tsv.write_tsv(inputs.grant_rows(spark, folder).select(F.col("pid").alias("grant_id"), "pref_terms"), path)
    return tsv.read_grant_list(spark, path, "grant_id")


def edges_json(spark: SparkSession, folder: str) -> DataFrame:
    """Edges and statistics as JSON, read back."""
    path = _fresh_path(spark, "edges")
    edges = stage(graph.all_edges(inputs.links(spark, folder), store.open_papers(inputs.papers(spark, folder))), "edges")
    store.write_edges(edges, graph.edge_stats(edges), path)
    read = spark.read.schema("source string, target bigint, type string").json(f"{path}/edges")
    stats = spark.read.schema("total_edges bigint, grant_paper_edges bigint, author_paper_edges bigint").json(f"{path}/stats")
    return read.unionByName(
        stats.select(F.concat_ws("/", "grant_paper_edges", "author_paper_edges").alias("source"), F.col("total_edges").alias("target"), F.lit("stats").alias("type"))
    )


def edges_document(spark: SparkSession, folder: str) -> DataFrame:
    """The same as one document, read by its lines."""
    path = _fresh_path(spark, "edges") + ".json"
    edges = stage(graph.all_edges(inputs.links(spark, folder), store.open_papers(inputs.papers(spark, folder))), "edges")
    document.write_edges_document(edges, graph.edge_stats(edges), path)
    lines = spark.read.text(path).select(F.regexp_replace("value", "^,", "").alias("line"))
    read = lines.where("startswith(line, '{\"source\"')").select(F.from_json("line", "source string, target bigint, type string").alias("edge")).select("edge.*")
    kinds = "total_edges bigint, grant_paper_edges bigint, author_paper_edges bigint"
    stats = lines.where("startswith(line, '{\"total_edges\"')").select(F.from_json("line", kinds).alias("stats")).select("stats.*")
    return read.unionByName(
        stats.select(F.concat_ws("/", "grant_paper_edges", "author_paper_edges").alias("source"), F.col("total_edges").alias("target"), F.lit("stats").alias("type"))
    )


#: The plain fields of each table of a network.
NETWORK_FIELDS = {
    "grants": ("id", "type", "title"),
    "papers": ("id", "type", "title", "journal", "pubdate"),
    "authors": ("id", "type", "name", "n_papers"),
    "author_papers": ("name", "nth", "pmid"),
    "edges": ("source", "target", "type"),
    "stats": ("total_grants", "total_papers", "total_authors", "total_edges"),
}


def network_json(spark: SparkSession, folder: str) -> DataFrame:
    """A whole network as JSON, read back: the digest of each row's fields, by table."""
    path = _fresh_path(spark, "network")
    network = graph.build_network(
        store.open_grants(inputs.grants(spark, folder)),
        stage(store.open_papers(inputs.papers(spark, folder)), "papers"),  # parsed once for all tables
        stage(inputs.links(spark, folder), "links"),
    )
    store.write_network(network, path)
    found = None
    for name, fields in NETWORK_FIELDS.items():
        rows = variants.parse(F.col("value"))
        values = [F.coalesce(variants.text(rows, f"$.{field}"), F.lit("none")) for field in fields]
        part = spark.read.text(f"{path}/{name}").select(F.lit(name).alias("name"), F.md5(F.concat_ws("|", *values)).alias("digest"))
        found = part if found is None else found.unionByName(part)
    return found


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Pages taken as a stream into the grant store (S15, D2): the last record per core in reading order."""
    path, root = _fresh_path(spark, "ingested"), inputs.page_files(spark, inputs.project_pages(spark, folder))
    for run in ("first", "second"):  # a run with a checkpoint of its own takes all files again and loses none
        checkpoint = _fresh_path(spark, f"{run}-checkpoint")
        ingest.ingest_grants(ingest.page_stream(spark, root), path, checkpoint).awaitTermination()
    v = variants.parse(F.col("metadata"))
    return ingest.ingested_grants(spark, path).select(
        "core_project_num", variants.text(v, "$.project_num").alias("project_num"),
        variants.number(v, "$.award_amount").alias("award_amount"),
    )


def citation_table(spark: SparkSession, folder: str) -> DataFrame:
    """A stored citation table."""
    path = _fresh_path(spark, "citations")
    inputs.citations(spark, folder).write.parquet(path)
    return store.read_citations(spark, path)


QUERIES = {
    "s1_page_order": page_order,
    "s2_bad_pages": bad_pages,
    "s3_flatten_results": flatten_results,
    "s4_read_page": read_page,
    "s5_write_pages": write_pages,
    "s5_page_files": write_page_files,
    "s6_tsv_missing_words": tsv_missing_words,
    "s7_tsv_round_trip": tsv_round_trip,
    "s6_tsv_in_ranges": tsv_in_ranges,
    "s8_skipped_keys": skipped_keys,
    "s9_scan_stores": scan_stores,
    "s10_citation_table": citation_table,
    "s11_edges_json": edges_json,
    "s11_edges_document": edges_document,
    "s12_network_json": network_json,
    "s13_vectors_round_trip": vectors_round_trip,
    "s13_vectors_by_position": vectors_by_position,
    "s14_stage_reuse": stage_reuse,
    "s15_grant_rows": grant_rows,
    "s16_link_rows": link_rows,
    "s17_paper_rows": paper_rows,
    "s18_grant_list": grant_list,
    "p1_extract_projects": extract_projects,
    "a2_total_records": total_records,
    "a3_conversion_stats": conversion_stats,
    "a3_conversion_stats_flag_only": conversion_stats_flag_only,
    "e1_convert_pages": convert_pages,
    "e1_grants_tsv": grants_tsv,
    "e1_top_agencies": top_agencies,
    "stream_ingest_grants": stream_ingest,
}

_KEYS = ", ".join(extract.GRANT_COLUMNS)
_READ_BACK = ", ".join(
    name if name in ("fiscal_year", "award_amount") else f"nullif({name}, '') AS {name}" for name in extract.GRANT_COLUMNS
)
_EDGES = """
SELECT core_project_num AS source, pmid AS target, 'grant-paper' AS type FROM links
UNION ALL SELECT substr(md5(name), 1, 12), pmid, 'author-paper' FROM authors"""

_STORED_SIZES = f"""WITH {oracle.PROJECTS},
placed AS (SELECT *, row_number() OVER (PARTITION BY page_year, page_state ORDER BY o_orderkey) - 1 AS nth FROM projects),
both_sizes AS (
  SELECT page_year, page_state, (nth // 20)::INTEGER AS batch, 20 AS page_limit, count(*) AS n FROM placed GROUP BY ALL
  UNION ALL
  SELECT page_year, page_state, (nth // 50)::INTEGER, 50, count(*) FROM placed WHERE page_state IN ('AL', 'GA') GROUP BY ALL
)
SELECT page_year AS fiscal_year, page_state AS org_state, batch, arg_max(n, page_limit) AS n_results,
  max(page_limit)::BIGINT AS page_limit
FROM both_sizes GROUP BY page_year, page_state, batch"""

_VECTOR_NUMBERS = """
SELECT vec_id::VARCHAR AS item_id, unnest(range(0, len(embedding)))::INTEGER AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings"""

_QUOTED_TEXTS = """
SELECT doc_id, '"q" ' || replace(text, '.', chr(9) || '"." ') || ' ' AS text, lang FROM documents"""

_ALL_EDGES = f"""WITH {oracle.LINKS}, {oracle.PAPERS} {_EDGES} UNION ALL
SELECT (SELECT count(*) FROM links) || '/' || (SELECT count(*) FROM authors),
  (SELECT count(*) FROM links) + (SELECT count(*) FROM authors), 'stats'"""

ORACLES = {
    "s10_citation_table": f"WITH {oracle.CITATIONS} SELECT * FROM citations",
    "stream_ingest_grants": f"""WITH {oracle.paged()},
placed AS (SELECT *, row_number() OVER (ORDER BY {oracle.PAGE_ORDER}) AS ord FROM paged WHERE core_project_num <> '')
SELECT core_project_num, arg_max(project_num, ord) AS project_num, arg_max(award_amount, ord) AS award_amount
FROM placed GROUP BY core_project_num""",
    "s1_page_order": f"""WITH {oracle.paged(50)}
SELECT page_year, page_state, page_file, row_number() OVER (ORDER BY page_year, page_state, page_file) AS nth
FROM (SELECT DISTINCT page_year, page_state, page_file FROM paged)""",
    "s2_bad_pages": f"""WITH {oracle.paged()}
SELECT DISTINCT page_year, page_state, page_file FROM paged WHERE page_state IN ('CT', 'DE', 'GA')""",
    "s3_flatten_results": f"""WITH {oracle.paged()}
SELECT page_year, page_state, page_file, pos, project_num FROM paged WHERE page_state NOT IN ('CT', 'DE', 'FL', 'GA')""",
    "s4_read_page": f"""WITH {oracle.paged(20)}
SELECT page_year AS fiscal_year, page_state AS org_state, 0 AS batch, pos, project_num FROM paged
WHERE page_year = '1997' AND page_state = 'AZ' AND page_file = '0.json'""",
    "s5_write_pages": _STORED_SIZES,
    "s5_page_files": _STORED_SIZES,
    "s6_tsv_missing_words": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS item_id, agency_ic_admin, nullif(core_project_num, '') AS core_project_num, award_amount FROM projects""",
    "s7_tsv_round_trip": _QUOTED_TEXTS,
    "s6_tsv_in_ranges": _QUOTED_TEXTS,
    "s8_skipped_keys": f"""{oracle.CONVERTED}
SELECT status AS kind, CASE status WHEN 'project' THEN coalesce(project_num, '')
  ELSE coalesce(project_num, '') || chr(9) || coalesce(core_project_num, '') END AS line
FROM converted WHERE status <> 'keep'""",
    "s9_scan_stores": f"""WITH {oracle.PAPERS} SELECT pmid, source, title, pubdate, c_name || ';none;;' || source || ';Group ' || c_mktsegment AS entries FROM papers""",
    "s11_edges_json": _ALL_EDGES,
    "s11_edges_document": _ALL_EDGES,
    "s12_network_json": f"""WITH {oracle.GRANTS}, {oracle.LINKS}, {oracle.PAPERS}
SELECT 'grants' AS name, md5(concat_ws('|', core_project_num, 'grant', project_title)) AS digest FROM grants
UNION ALL SELECT 'papers', md5(concat_ws('|', pmid, 'paper', title, source, pubdate)) FROM papers
UNION ALL SELECT 'authors', md5(concat_ws('|', name, 'author', name, count(*))) FROM authors GROUP BY name
UNION ALL SELECT 'author_papers', md5(concat_ws('|', name, row_number() OVER (PARTITION BY name ORDER BY pmid, pos), pmid)) FROM authors
UNION ALL SELECT 'edges', md5(concat_ws('|', core_project_num, pmid, 'grant-paper')) FROM links
UNION ALL SELECT 'edges', md5(concat_ws('|', name, pmid, 'author-paper')) FROM authors
UNION ALL SELECT 'stats', md5(concat_ws('|', (SELECT count(*) FROM grants), (SELECT count(*) FROM papers),
  (SELECT count(DISTINCT name) FROM authors), (SELECT count(*) FROM links) + (SELECT count(*) FROM authors)))""",
    "s13_vectors_round_trip": _VECTOR_NUMBERS,
    "s13_vectors_by_position": _VECTOR_NUMBERS,
    "s14_stage_reuse": """
SELECT 'reuse' AS how, 'first' AS mark, count(*) AS n FROM orders UNION ALL SELECT 'overwrite', 'third', count(*) FROM orders""",
    "s15_grant_rows": f"""WITH {oracle.PROJECTS}
SELECT o_orderkey AS seq, core_project_num, project_num, org_name, award_amount FROM projects WHERE core_project_num <> ''""",
    "s16_link_rows": """
SELECT 'G' || l_suppkey AS core_project_num, l_orderkey AS pmid FROM lineitem
WHERE l_returnflag <> 'A' AND (l_returnflag <> 'R' OR l_linestatus <> 'O') AND l_orderkey <> 0""",
    "s17_paper_rows": f"""WITH {oracle.PAPERS}
SELECT pmid, source, title, c_name || ';' || source || ';Group ' || c_mktsegment AS names FROM papers""",
    "s18_grant_list": f"""WITH {oracle.GRANT_ROWS} SELECT DISTINCT pid FROM grant_rows WHERE pid IS NOT NULL""",
    "p1_extract_projects": f"""WITH {oracle.paged()}, {oracle.EXTRACTED} SELECT * FROM extracted""",
    "a2_total_records": f"""WITH {oracle.paged()}
SELECT count(*) AS total_records FROM paged WHERE page_state NOT IN ('CT', 'DE', 'FL', 'GA')""",
    "a3_conversion_stats": f"""{oracle.CONVERTED}
SELECT count(*) AS processed, count_if(written)::BIGINT AS written, count_if(status = 'project')::BIGINT AS skipped_project_num,
  count_if(status = 'core')::BIGINT AS skipped_core_project_num, count_if(status <> 'keep')::BIGINT AS skipped_total
FROM converted""",
    "a3_conversion_stats_flag_only": f"""WITH {oracle.paged()}, {oracle.EXTRACTED}, {oracle.slim_keys('extracted', oracle.PAGE_ORDER)},
flags AS (SELECT ord, row_number() OVER (PARTITION BY p ORDER BY ord) > 1 AS by_p, row_number() OVER (PARTITION BY c ORDER BY ord) > 1 AS by_c FROM slim)
SELECT count(*) AS processed, count_if(NOT is_bad)::BIGINT AS written, count_if(by_p)::BIGINT AS skipped_project_num,
  count_if(by_c)::BIGINT AS skipped_core_project_num, (count_if(by_p) + count_if(by_c))::BIGINT AS skipped_total
FROM placed JOIN flags USING (ord)""",
    "e1_convert_pages": f"""{oracle.CONVERTED} SELECT {_KEYS} FROM converted WHERE written""",
    "e1_grants_tsv": f"""{oracle.CONVERTED} SELECT {_READ_BACK} FROM converted WHERE written""",
    "e1_top_agencies": f"""{oracle.CONVERTED}
SELECT agency_ic_admin, count(*) AS count FROM converted WHERE written AND agency_ic_admin <> ''
GROUP BY agency_ic_admin ORDER BY count DESC, agency_ic_admin LIMIT 20""",
}
