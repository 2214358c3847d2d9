import json

from pyspark.sql import functions as F

from grantlens.operators import extract
from grantlens.plans import inputs
from grantlens.sources import pages, responses, tsv


def write_page(root, year, state, name, body):
    folder = root / str(year) / state
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(body if isinstance(body, str) else json.dumps(body))


def project(num, core, **fields):
    return {"project_num": num, "core_project_num": core, **fields}


def page(*records, total=None):
    return {"meta": {"total": len(records) if total is None else total}, "results": list(records)}


def test_missing_folder_gives_no_pages(spark, tmp_path):
    found = pages.scan_pages(spark, str(tmp_path / "nothing"))
    assert found.count() == 0
    stats = extract.conversion_stats(extract.convert(found)).first().asDict()
    assert set(stats.values()) == {0}


def test_scan_order_and_bad_files(spark, tmp_path):
    for name in ("0", "1", "2", "10"):
        write_page(tmp_path, 2020, "CA", f"{name}.json", page(project(name, name)))
    write_page(tmp_path, 2019, "WY", "0.json", "{broken")
    write_page(tmp_path, 2019, "WY", "1.json", " ")
    write_page(tmp_path, 2019, "WY", "2.json", "[1]")
    write_page(tmp_path, 2019, "WY", "3.json", '{"results": null}')
    write_page(tmp_path, 2019, "WY", "4.json", '{"meta": {"total": 3}}')
    write_page(tmp_path, 2019, "WY", "note.txt", "no page")
    (tmp_path / "stray.json").write_text("{}")
    found = pages.scan_pages(spark, str(tmp_path))
    assert found.count() == 9
    records = pages.flatten_results(found).orderBy(*pages.PAGE_ORDER)
    assert [row["page_file"] for row in records.collect()] == ["0.json", "1.json", "10.json", "2.json"]
    bad = {(row["page_state"], row["page_file"]) for row in pages.bad_pages(found).collect()}
    assert bad == {("WY", f"{i}.json") for i in range(4)}
    totals = {row["page_file"]: (row["total"], row["n_results"]) for row in pages.page_totals(found).collect() if row["page_year"] == "2019"}
    assert totals == {"4.json": (3, 0)}
    assert extract.total_records(pages.page_totals(found)).first()[0] == 4


def test_a_page_is_parsed_once(spark, tmp_path):
    write_page(tmp_path, 2020, "CA", "0.json", page(project("p", "c")))
    plan = pages.flatten_results(pages.scan_pages(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_extract_projects(spark, tmp_path):
    full = project(
        "1R01", "R01", fiscal_year=2020, award_amount=5.5, organization={"org_name": "Org"}, agency_ic_admin={"abbreviation": "NIA"},
        principal_investigators=[{"full_name": "A"}, {"full_name": ""}, {"full_name": "B"}], abstract_text=" a\t b ",
        date_added="2020-01-02T03:04:05", award_type="1",
    )
    bad = [
        project("b1", "B1", agency_ic_admin="NIA"),
        project("b2", "B2", organization=[1]),
        project("b3", "B3", principal_investigators=["x"]),
        project("b4", "B4", principal_investigators={"full_name": "x"}),
        project("b5", "B5", principal_investigators=[None]),
    ]
    fine = [project("f1", "F1", organization=None, agency_ic_admin="", principal_investigators=None), project("f2", "F2", organization={})]
    write_page(tmp_path, 2020, "CA", "0.json", page(full, *bad, *fine, 7, {"fiscal_year": 1}, project(None, None)))
    rows = extract.extract_projects(pages.flatten_results(pages.scan_pages(spark, str(tmp_path)))).orderBy("pos").collect()
    first = rows[0].asDict()
    assert first["principal_investigators"] == "A, B"
    assert (first["org_name"], first["agency_ic_admin"], first["abstract_text"]) == ("Org", "NIA", "a b")
    assert (first["fiscal_year"], first["award_amount"], first["date_added"], first["award_type"]) == (2020, 5.5, "2020-01-02", "1")
    assert first["pref_terms"] == "" and first["activity_code"] == ""
    assert [row["is_bad"] for row in rows[:9]] == [False] + [True] * 5 + [False] * 3
    assert [row["is_record"] for row in rows] == [True] * 8 + [False, True, True]
    assert (rows[9]["project_num"], rows[10]["project_num"]) == ("", None)


def test_convert(spark, tmp_path):
    write_page(
        tmp_path, 2020, "CA", "0.json",
        page(project("p1", "A", agency_ic_admin="text"), project("p1", "A"), project("p2", "A"), project("p3", ""), project("p3", None), project("p4", "p3")),
    )
    write_page(tmp_path, 2020, "CA", "1.json", page(project("p2", "B"), 5))
    found = pages.scan_pages(spark, str(tmp_path))
    fates = extract.convert(found)
    stats = extract.conversion_stats(fates).first().asDict()
    assert stats == {
        "processed": 8, "written": 2, "skipped_project_num": 2, "skipped_core_project_num": 2, "skipped_total": 4,
    }
    assert {row["project_num"] for row in extract.written_grants(fates).collect()} == {"p2", "p3"}
    flagged = extract.convert(found, skip_duplicates=False)
    stats = extract.conversion_stats(flagged).first().asDict()
    assert (stats["written"], stats["skipped_project_num"], stats["skipped_core_project_num"]) == (6, 3, 4)

    tsv.write_skipped(fates, str(tmp_path / "by-project"), str(tmp_path / "by-core"))
    assert sorted(row[0] for row in spark.read.text(str(tmp_path / "by-project")).collect()) == ["p1", "p3"]
    assert sorted(row[0] for row in spark.read.text(str(tmp_path / "by-core")).collect()) == ["p2\tA", "p4\tp3"]


def test_write_pages_replaces_by_key(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "fiscal_year string, org_state string, batch int, body string"
    pages.write_pages(spark.createDataFrame([("2020", "CA", 0, "a"), ("2020", "CA", 1, "b"), ("2021", "NY", 0, "c")], schema), path)
    pages.write_pages(spark.createDataFrame([("2020", "CA", 1, "B"), ("2020", "CA", 2, "d")], schema), path)
    stored = pages.read_stored_pages(spark, path)
    assert {(r["org_state"], r["batch"], r["body"]) for r in stored.collect()} == {
        ("CA", 0, "a"), ("CA", 1, "B"), ("CA", 2, "d"), ("NY", 0, "c"),
    }
    page_row = pages.read_page(stored, 2020, "CA", 1)
    assert [row["body"] for row in page_row.collect()] == ["B"]
    plan = page_row._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan and "batch" in plan.split("PushedFilters")[1]


def test_responses(spark):
    bodies = spark.createDataFrame(
        [
            ('{"results":[{"core_project_num":"A","x":1},{"core_project_num":""},{"core_project_num":null},{}]}', 1),
            ("{broken", 2),
        ],
        "body string, seq int",
    )
    assert [(row["seq"], row["core_project_num"]) for row in responses.grant_rows(bodies, carry=["seq"]).collect()] == [(1, "A")]
    links = spark.createDataFrame(
        [('{"results":[{"coreproject":"A","pmid":7},{"coreproject":"A","pmid":7},{"coreproject":"","pmid":1},{"coreproject":"B","pmid":0},{"coreproject":"B"}]}',)],
        "body string",
    )
    assert [(row["core_project_num"], row["pmid"]) for row in responses.link_rows(links).collect()] == [("A", 7), ("A", 7)]
    papers = spark.createDataFrame([('{"result":{"uids":["123"],"123":{"title":"t"},"x1":{}}}',)], "body string")
    rows = responses.paper_rows(papers).collect()
    assert [(row["pmid"], json.loads(row["metadata"])) for row in rows] == [(123, {"title": "t"})]


def test_tsv(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, ' a "quoted"\tb\nc ', 1.5), (2, None, None), (3, "NA", 2.0), (4, "", 0.0)]
    frame = spark.createDataFrame(rows, "i int, t string, d double")
    tsv.write_tsv(frame, path)
    back = {row["i"]: (row["t"], row["d"]) for row in tsv.read_tsv(spark, path, "i int, t string, d double").collect()}
    assert back == {1: (' a "quoted"\tb\nc ', 1.5), 2: (None, None), 3: (None, 2.0), 4: (None, 0.0)}
    kept = tsv.read_tsv(spark, path, missing_words=())
    assert kept.filter(F.col("t") == "NA").count() == 1


def test_grant_list(spark, tmp_path):
    path = str(tmp_path / "list")
    tsv.write_tsv(spark.createDataFrame([("A",), ("A",), (None,), ("B",)], "grant string"), path)
    assert sorted(row["pid"] for row in tsv.read_grant_list(spark, path, "grant").collect()) == ["A", "B"]
    try:
        tsv.read_grant_list(spark, path, "pid")
    except ValueError as error:
        assert "'pid' not found" in str(error) and "grant" in str(error)
    else:
        raise AssertionError("no error")


def test_pages_are_gathered_by_slim_rows(spark, tmp_path):
    day = "CAST('1997-03-04' AS timestamp)"
    spark.sql(
        f"SELECT id AS o_orderkey, id % 4 AS o_custkey, 'P' AS o_orderstatus, 1.5D AS o_totalprice, {day} AS o_orderdate, "
        "IF(id % 2 = 0, '2-HIGH', '5-LOW') AS o_orderpriority FROM range(25)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(
        "SELECT id AS c_custkey, 'C' || id AS c_name, 3 AS c_nationkey, 0D AS c_acctbal, 'BUILDING' AS c_mktsegment FROM range(4)"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    made = inputs.project_pages(spark, str(tmp_path), page_size=10)
    gathered = [line for line in made._jdf.queryExecution().optimizedPlan().toString().splitlines() if "collect_list" in line]
    assert gathered and not [line for line in gathered if "json" in line]
    bodies = {row["page_file"]: json.loads(row["body"]) for row in made.collect()}
    assert {name: len(body["results"]) for name, body in bodies.items()} == {"0.json": 10, "1.json": 10, "2.json": 5}
    assert bodies["2.json"]["meta"] == {"total": 25, "offset": 20, "limit": 10}
    assert [record["agency_ic_admin"] for record in bodies["2.json"]["results"][:2]] == ["plain", {"abbreviation": "BUILDING"}]
