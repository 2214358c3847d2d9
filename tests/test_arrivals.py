"""Two-key dedupe kept up to date, against a sequential reading of all rows."""

import random

import pytest

from grantlens.operators import dedupe
from grantlens.streaming.arrivals import DedupeLog

SCHEMA = "year string, pos int, project string, core string, title string"


def slow_fates(rows):
    projects, cores, fates = set(), set(), {}
    for year, pos, project, core, _ in sorted(rows, key=lambda row: (row[0] is not None, row[0] or "", row[1])):
        checked = core or project
        if project in projects:
            fates[year, pos] = "project"
        elif checked in cores:
            fates[year, pos] = "core"
        else:
            fates[year, pos] = "keep"
            projects.add(project)
            cores.add(checked)
    return fates


def some_rows(draw, n):
    places = draw.sample([(year, pos) for year in (None, "2001", "2002", "2003") for pos in range(n)], n)
    return [(*place, draw.choice([None, "", *"abcdefgh"]), draw.choice([None, "", *"uvwxyz"]), f"t{k}") for k, place in enumerate(places)]


def fates_of(log):
    rows = log.fates().collect()
    assert len({(row["year"], row["pos"]) for row in rows}) == len(rows)
    return {(row["year"], row["pos"]): row["status"] for row in rows}


def log_of(spark, path):
    return DedupeLog(spark, str(path), spark.createDataFrame([], SCHEMA).schema, "project", "core", ["year", "pos"])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival(spark, tmp_path, seed):
    draw = random.Random(seed)
    rows, log = some_rows(draw, 60), log_of(spark, tmp_path / "log")
    assert fates_of(log) == {}
    parts = [rows[:25], [], rows[25:32], rows[32:]]
    taken = []
    for batch, part in enumerate(parts):
        log.take(spark.createDataFrame(part, SCHEMA), batch)
        taken += part
        assert fates_of(log) == slow_fates(taken)
    full = dedupe.two_key_status(spark.createDataFrame(rows, SCHEMA), "project", "core", ["year", "pos"]).collect()
    assert fates_of(log) == {(row["year"], row["pos"]): row["status"] for row in full}


def test_a_batch_tried_again_and_rows_sent_again(spark, tmp_path):
    log = log_of(spark, tmp_path / "log")
    first = [("2001", 1, "a", "u", "x"), ("2001", 2, "a", "v", "x"), ("2002", 1, "b", "u", "x")]
    log.take(spark.createDataFrame(first, SCHEMA), 0)
    assert fates_of(log) == {("2001", 1): "keep", ("2001", 2): "project", ("2002", 1): "core"}
    # the first row comes again with other keys, so that the others are free
    again = [("2001", 1, "c", "w", "y")]
    for _ in range(2):
        log.take(spark.createDataFrame(again, SCHEMA), 1)
        assert fates_of(log) == {("2001", 1): "keep", ("2001", 2): "keep", ("2002", 1): "keep"}
    # rows that were written but never committed do not count
    spark.createDataFrame([(*first[0], "keep")], SCHEMA + ", status string").write.parquet(f"{log.path}/rows/batch=9")
    assert len(fates_of(log)) == 3


def test_only_rows_from_the_cut_on_are_read_again(spark, tmp_path):
    log = log_of(spark, tmp_path / "log")
    log.take(spark.createDataFrame([(f"{2000 + k}", 0, f"p{k}", f"c{k}", "x") for k in range(40)], SCHEMA), 0)
    log.take(spark.createDataFrame([("2035", 1, "p1", "new", "x")], SCHEMA), 1)
    assert spark.read.parquet(f"{log.path}/rows/batch=1").count() == 5
    assert fates_of(log)["2035", 1] == "project"


def test_a_stream_of_rows(spark, tmp_path):
    draw = random.Random(4)
    rows, log = some_rows(draw, 40), log_of(spark, tmp_path / "log")
    for k in range(2):
        part = rows[20 * k : 20 * k + 20]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        log.follow(stream, str(tmp_path / "checkpoint")).awaitTermination()
        assert fates_of(log) == slow_fates(rows[: 20 * k + 20])
