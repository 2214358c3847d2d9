"""Page files under their own names, and tables matched by place."""

import threading

import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from grantlens.sources import page_files, pages, positions

PAGES = "fiscal_year string, org_state string, batch int, body string"


def files_below(folder):
    return {str(path.relative_to(folder)): path.read_text() for path in folder.rglob("*") if path.is_file()}


def test_page_files_have_their_names(spark, tmp_path):
    root = f"file://{tmp_path}/cache"
    first = [("2020", "CA", 0, "{}"), ("2020", "CA", 10, '{"results":[1]}'), ("2021", "NY", 0, "old"), ("2021", "NY", 0, "olx")]
    page_files.write_page_files(spark.createDataFrame(first, PAGES).repartition(3), root)
    assert files_below(tmp_path / "cache") == {"2020/CA/0.json": "{}", "2020/CA/10.json": '{"results":[1]}', "2021/NY/0.json": "olx"}
    page_files.write_page_files(spark.createDataFrame([("2021", "NY", 0, "new é"), ("2022", "NY", 3, None)], PAGES), root)
    found = files_below(tmp_path / "cache")
    assert found["2021/NY/0.json"] == "new é" and found["2022/NY/3.json"] == "" and len(found) == 4
    assert sorted(row["page_file"] for row in pages.scan_pages(spark, root).collect()) == ["0.json", "0.json", "10.json"]


def test_a_failed_run_leaves_no_file(spark, tmp_path):
    root = f"file://{tmp_path}/cache"
    page_files.write_page_files(spark.createDataFrame([("2020", "CA", 0, "kept")], PAGES), root)
    rows = spark.createDataFrame([("2020", "CA", k, "new") for k in range(40)], PAGES).repartition(4)
    broken = rows.withColumn("body", F.when(F.col("batch") == 33, F.raise_error(F.lit("torn")).cast("string")).otherwise(F.col("body")))
    with pytest.raises(Exception, match="torn"):
        page_files.write_page_files(broken, root)
    assert files_below(tmp_path / "cache") == {"2020/CA/0.json": "kept"}
    for key in ("..", "a/b", None, "", "_x"):
        with pytest.raises(Exception, match="no file can be named"):
            page_files.write_page_files(spark.createDataFrame([("2020", key, 1, "x")], PAGES), root)
    assert files_below(tmp_path / "cache") == {"2020/CA/0.json": "kept"}


def test_a_commit_names_files_together(tmp_path, monkeypatch):
    class Slow:
        """Local files, of which a move waits for another one."""

        def __init__(self):
            self.files, self.both, self.folders = fs.LocalFileSystem(), threading.Barrier(2, timeout=20), []

        def __getattr__(self, name):
            return getattr(self.files, name)

        def create_dir(self, path, recursive):
            self.folders.append(path)
            self.files.create_dir(path, recursive=recursive)

        def move(self, old, new):
            self.both.wait()
            self.files.move(old, new)

    slow = Slow()
    monkeypatch.setattr(page_files.PageFileWriter, "_root", lambda self: (slow, str(tmp_path)))
    writer = page_files.PageFileWriter(str(tmp_path))
    held = writer.write(iter([{"fiscal_year": "2020", "org_state": "CA", "batch": k, "body": f"b{k}"} for k in range(4)]))
    assert len(slow.folders) == 1
    writer.commit([held])
    assert files_below(tmp_path) == {f"2020/CA/{k}.json": f"b{k}" for k in range(4)}


def test_abort_and_commit_of_tasks(tmp_path):
    writer = page_files.PageFileWriter(f"file://{tmp_path}")
    rows = [{"fiscal_year": "2020", "org_state": "CA", "batch": k, "body": f"b{k}"} for k in range(3)]
    lost = writer.write(iter(rows[:1]))  # an attempt whose message never came
    assert lost.files
    writer.commit([writer.write(iter(rows)), None])
    assert files_below(tmp_path) == {f"2020/CA/{k}.json": f"b{k}" for k in range(3)}
    other = page_files.PageFileWriter(f"file://{tmp_path}")
    other.abort([other.write(iter([{**rows[0], "body": "later"}])), None])
    assert files_below(tmp_path)["2020/CA/0.json"] == "b0" and not (tmp_path / page_files.STAGED).exists()


def test_positions_over_many_files(spark, tmp_path):
    spark.range(1000).orderBy("id").select((F.col("id") * 3).alias("value")).repartitionByRange(7, "value").sortWithinPartitions("value").write.parquet(str(tmp_path / "a"))
    spark.range(1000).repartitionByRange(3, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "b"))
    left, right = (positions.read_positions(spark, str(tmp_path / name)) for name in "ab")
    assert left.agg(F.min("position"), F.max("position"), F.count_distinct("position")).first()[:] == (0, 999, 1000)
    joined = positions.join_positions(left, right)
    assert joined.count() == 1000 and joined.where("value <> 3 * id or position <> id").count() == 0
    with pytest.raises(ValueError):
        positions.read_positions(spark, str(tmp_path / "a"), "value")


def test_places_that_do_not_match_are_an_error(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "a"))
    spark.range(9).select(F.col("id").alias("other")).write.parquet(str(tmp_path / "b"))
    both = positions.join_positions(positions.read_positions(spark, str(tmp_path / "a")), positions.read_positions(spark, str(tmp_path / "b")))
    with pytest.raises(Exception, match="do not match at place 9"):
        both.collect()


@pytest.mark.parametrize("kind", ["<f4", "<f8", ">f4", "<i4"])
def test_matrix_files(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(positions, "READ", 64)
    values = (np.random.default_rng(1).normal(size=(333, 6)) * 100).astype(kind)
    np.save(tmp_path / "m.npy", values)
    read = positions.read_npy(spark, str(tmp_path / "m.npy"))
    assert read.rdd.getNumPartitions() == 34
    rows = read.orderBy("position").collect()
    assert [row["position"] for row in rows] == list(range(333))
    assert np.array_equal(np.array([row["embedding"] for row in rows], np.float32), values.astype(np.float32))


def test_matrix_files_of_other_forms(spark, tmp_path):
    np.save(tmp_path / "line.npy", np.arange(5.0))
    assert [row["embedding"] for row in positions.read_npy(spark, str(tmp_path / "line.npy")).orderBy("position").collect()] == [[float(k)] for k in range(5)]
    np.save(tmp_path / "none.npy", np.zeros((0, 4)))
    assert positions.read_npy(spark, str(tmp_path / "none.npy")).count() == 0
    np.save(tmp_path / "columns.npy", np.asfortranarray(np.ones((3, 2))))
    (tmp_path / "other.npy").write_bytes(b"something else")
    for name in ("columns", "other"):
        with pytest.raises(ValueError):
            positions.read_npy(spark, str(tmp_path / f"{name}.npy"))
    assert isinstance(fs.FileSystem.from_uri(str(tmp_path))[0], fs.LocalFileSystem)


def page_rows(spark, n):
    rows = [(str(2019 + k % 2), f"S{k % 3}", f"{k}.json", f'{{"results":[{k}]}}') for k in range(n)]
    return rows, spark.createDataFrame(rows, pages.PAGE_SCHEMA).repartition(4)


def test_a_cache_has_plain_files_that_few_tasks_read(spark, tmp_path):
    rows, frame = page_rows(spark, 400)
    page_files.write_cache(frame, f"file://{tmp_path}/cache")
    found = files_below(tmp_path / "cache")  # no folder, checksum or process for each file
    assert found == {f"{year}/{state}/{name}": f"{body}\n" for year, state, name, body in rows}
    read = pages.scan_pages(spark, f"file://{tmp_path}/cache")
    assert sorted(tuple(row) for row in read.collect()) == sorted((*row[:3], f"{row[3]}\n") for row in rows)
    assert read.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
    names = pages.scan_pages(spark, f"file://{tmp_path}/cache", pages.PAGE_KEY)
    assert names.columns == list(pages.PAGE_KEY) and names.count() == 400


def test_many_files_are_listed_in_groups(spark, tmp_path, monkeypatch):
    rows, frame = page_rows(spark, 60)
    page_files.write_cache(frame, f"file://{tmp_path}/cache")
    monkeypatch.setattr(pages, "FILES_AT_ONCE", 25)
    assert [len(group) for group in pages._groups([("a", 10), ("b", 15), ("c", 40), ("d", 1)], 25)] == [2, 1, 1]
    read = pages.scan_pages(spark, f"file://{tmp_path}/cache")
    assert sorted(tuple(row) for row in read.collect()) == sorted((*row[:3], f"{row[3]}\n") for row in rows)
    assert pages.scan_pages(spark, f"file://{tmp_path}/cache", pages.PAGE_KEY).distinct().count() == 60


def test_pages_of_both_layouts_are_scanned(spark, tmp_path):
    _, frame = page_rows(spark, 9)
    pages.write_page_files(frame, f"{tmp_path}/other")
    assert {row["page_file"] for row in pages.scan_pages(spark, f"{tmp_path}/other").collect()} == {f"{k}.json" for k in range(9)}
    for name in ("2020/C[A]/0.json", "2020/C[A]/_1.json", "2020/C[A]/2.txt", "2020/C[A]/deep/3.json", "2020/N Y/é %41.json", "2020/4.json"):
        file = tmp_path / "plain" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("{}")
    (tmp_path / "plain/2020/N Y/5.json").write_text("")
    found = {tuple(row) for row in pages.scan_pages(spark, f"{tmp_path}/plain").select(*pages.PAGE_KEY).collect()}
    assert found == {("2020", "C[A]", "0.json"), ("2020", "N Y", "é %41.json")}


def test_pages_with_keys_of_their_own_are_not_moved(spark, tmp_path):
    rows = [("2020", "CA", k, f"b{k}") for k in range(50)]
    frame = spark.createDataFrame(rows, PAGES).withColumn("nth", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        alone = page_files.one_a_key(frame, ["nth"])
        assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(row) for row in alone.collect()) == rows
        more = spark.createDataFrame([("2020", "CA", 3, "a"), ("2020", None, 1, "x"), ("2020", None, 1, "y")], PAGES).withColumn("nth", F.lit(2))
        found = {tuple(row) for row in page_files.one_a_key(frame.unionByName(more), ["nth"]).collect()}
        assert found == {*rows, ("2020", "CA", 3, "a"), ("2020", None, 1, "y")} - {("2020", "CA", 3, "b3")}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_few_pages_at_a_time_go_to_python(spark, tmp_path, monkeypatch):
    frame = spark.createDataFrame([("2020", "CA", 1, "b")], PAGES)
    usual, seen = spark.conf.get(page_files.BATCH_ROWS), []
    save = type(frame.write).save
    monkeypatch.setattr(type(frame.write), "save", lambda self, path: (seen.append(spark.conf.get(page_files.BATCH_ROWS)), save(self, path)))
    page_files.write_page_files(frame, f"file://{tmp_path}/cache")
    with pytest.raises(Exception, match="no file can be named"):
        page_files.write_page_files(frame.withColumn("org_state", F.lit("..")), f"file://{tmp_path}/cache")
    assert seen == ["32", "32"] and spark.conf.get(page_files.BATCH_ROWS) == usual
    assert files_below(tmp_path / "cache") == {"2020/CA/1.json": "b"}
