"""Names of the operators' own columns, and ids of other kinds, in what is given to them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grantlens.llm import ann, exact, packing, suffix, warc
from test_similar import repeated_texts, slow_repeats

CLASHING = (
    "_hash _norm _prefix _rows _first _count _least _gone _digest _nth keep_id group_size kept text_sha256 _k1 _k2 _spans n_spans n_bytes "
    "n_removed part parts rank nth held score predicted held_out c0 c1 k1 id known"
).split()


def with_clashes(frame):
    return frame.withColumns({name: F.lit(f"mine {name}") for name in CLASHING})


@pytest.mark.parametrize("heavy", [False, True])
def test_exact_dedup_of_any_ids_and_names(spark, heavy):
    rows = [(f"id{k:03d}", f"text {k % 40}  x") for k in range(120)] + [(None, "text 1 x"), ("z", None)]
    rows += [(f"h{k:04d}", "hot " * 50) for k in range(400 if heavy else 0)]
    found = exact.exact_dedup(with_clashes(spark.createDataFrame(rows, "doc_id string, text string"))).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row["_hash"] == "mine _hash" and row["c1"] == "mine c1"
    kept = {row["doc_id"]: row["keep_id"] for row in found if row["kept"]}
    assert kept == {f"id{k:03d}": f"id{k:03d}" for k in range(40)} | {"z": "z"} | ({"h0000": "h0000"} if heavy else {})
    assert exact.kept_documents(with_clashes(spark.createDataFrame(rows, "doc_id string, text string"))).columns[2:] == CLASHING


@pytest.mark.parametrize("length", [60, 290, 400, 1000])
def test_repeats_of_any_length(spark, length):
    shared = "".join(np.random.default_rng(length).choice(list("abcdefgh "), 1300))
    texts = [*repeated_texts(), "x" + shared, shared + "y", shared[:700] + "z"]
    frame = with_clashes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    rows = suffix.remove_repeats(frame, length=length).collect()
    found = {row["doc_id"]: (bytes(row["kept"]), row["n_bytes"], row["n_removed"], row["n_spans"]) for row in rows}
    assert [found[k] for k in range(len(texts))] == slow_repeats([text.encode() for text in texts], length)
    assert rows[0]["_k1"] == "mine _k1"


def test_repeats_of_lengths_that_cannot_be_found(spark):
    frame = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for length in (8, 1 << 20):
        with pytest.raises(ValueError):
            suffix.remove_repeats(frame, length=length)


def test_packing_beside_other_columns(spark):
    pieces = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 90 + 1).alias("length"))
    packed = packing.pack(with_clashes(pieces), 100).collect()
    filled = {}
    for row in packed:
        assert row["part"] == "mine part"
        filled.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for runs in filled.values():
        runs.sort()
        assert [offset for offset, _ in runs] == [sum(n for _, n in runs[:k]) for k in range(len(runs))] and sum(n for _, n in runs) <= 100


def test_nearest_of_huge_numbers(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e199]), (2, [1.0, 2.0]), (3, [-1e200, 0.0]), (100, [1.0, 1.0])]
    found = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0).collect()
    near = {(row["query_id"], row["rank"]): (row["vec_id"], row["score"]) for row in found}
    assert near[0, 1] == (1, pytest.approx(1e199)) and near[100, 1] == (2, 1.0)
    assert [near[0, k][0] for k in (2, 3, 4)] == [2, 100, 3] and near[0, 4][1] == pytest.approx(2e200)


def test_archives_are_read_file_by_file(spark, tmp_path):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("http://x.example/").alias("url"), F.concat(F.lit("<p>"), F.repeat(F.sha2(F.col("id").cast("string").cast("binary"), 256), 40)).alias("html"))
    manifest = warc.write_archive(pages, f"file://{tmp_path}/warc")
    read = warc.read_archive(manifest, f"file://{tmp_path}/warc")
    assert read.rdd.getNumPartitions() == manifest.count() and read.count() == 400


def test_stages_leave_other_columns_alone(spark):
    rows = [(k, f"text {k % 6} " + "word " * 30, 7) for k in range(24)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"))
    for name, stage in corpus_pipeline.STAGES[1:4]:
        for given in (docs, docs.drop("n_chars")):
            kept = stage(spark, given, "")
            assert kept.columns == given.columns, name
            for row in kept.collect():
                assert all(row[clash] == f"mine {clash}" for clash in CLASHING)
