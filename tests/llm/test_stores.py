"""WARC round trips, the quality classifier, and the pipeline as a whole."""

import gzip
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grantlens.llm import catalog, quality, suffix, warc
from grantlens.session import staged_folder
from test_similar import slow_fingerprint, slow_groups, slow_repeats

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def round_trip(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("clash"))
    folder = staged_folder(spark, "warc-test")
    manifest = warc.write_archive(frame, folder, **sizes)
    return folder, manifest, warc.read_archive(manifest, folder).collect()


def some_pages():
    long, short = "<p>é漢\r\n\r\n" + "x" * 200, "y" * 50
    rows = [(k, f"http://a/{k}", long if k % 3 == 0 else f"{k} " * 80) for k in range(60)]
    return [*rows, (70, None, short), (71, "bad\r\nurl: x", short), (72, "u", None), (73, "u", ""), (0, "u", long), (None, "u", long), (74, "u", "z" * 300_000)]


def test_warc_round_trip(spark):
    rows = some_pages()
    folder, manifest, found = round_trip(spark, rows, shard_bytes=4000, roll_bytes=1000)
    assert len(found) == len(rows)
    assert manifest.count() > 5 and manifest.agg(F.sum("records")).first()[0] == len(rows)
    long = rows[0][2]
    for row in found:
        if row["payload_digest"] == hashlib.sha256(long.encode()).hexdigest():
            assert row["payload_bytes"] == len(long.encode())
            if row["page_id"] is None:
                assert row["record_type"] == "response" and row["refers_to"] is None
            elif row["page_id"]:
                assert row["record_type"] == "revisit" and row["refers_to"] == 0
        else:
            assert row["record_type"] == "response" and row["refers_to"] is None
    zero = sorted(row["record_type"] for row in found if row["page_id"] == 0)
    assert zero == ["response", "revisit"]
    texts = {(k, (html or "").encode()) for k, _, html in rows}
    assert all((row["page_id"], bytes(row["payload"])) in texts for row in found if row["record_type"] == "response")


def test_warc_files_do_not_depend_on_the_split(spark):
    listed = []
    for rows in (some_pages(), some_pages()[::-1]):
        _, manifest, _ = round_trip(spark, rows, shard_bytes=4000, roll_bytes=1000)
        listed.append(sorted((r["file"], r["sha256"]) for r in manifest.collect()))
    assert listed[0] == listed[1]


def test_warc_files_are_what_the_manifest_says(spark):
    folder, manifest, _ = round_trip(spark, some_pages())
    files, path = warc.fs.FileSystem.from_uri(folder)
    for row in manifest.collect():
        data = files.open_input_stream(f"{path}/{row['file']}", compression=None).read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (row["bytes"], row["sha256"])
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == row["records"]
    assert not [f for f in files.get_file_info(warc.fs.FileSelector(path)) if f.base_name.startswith(".part")]


def test_warc_of_no_pages(spark):
    _, manifest, found = round_trip(spark, [])
    assert manifest.count() == 0 and found == []


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scores = catalog.QUERIES["op8_quality"](spark, folder)
    rows = scores.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2 for row in rows)
    assert sum(row["predicted"] == row["quality"] for row in rows) >= 0.93 * len(rows)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.7) for row in rows)


def test_quality_does_not_read_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, other)
    assert np.allclose(a.weights, b.weights) and a.prior == b.prior


def test_quality_samples_rows_of_an_id_that_many_share(spark, monkeypatch):
    monkeypatch.setattr(quality, "MOST_POSITIVE", 100)
    monkeypatch.setattr(quality, "MOST_UNLABELLED", 200)
    sizes, bands = [], quality.Model.bands
    monkeypatch.setattr(quality.Model, "bands", lambda self, rows: sizes.append(len(rows)) or bands(self, rows))
    docs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int")
    assert quality.fit(docs, labels) is not None
    assert 1 <= sizes[0] <= 100 and 100 <= sizes[1] <= 200


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (1, "", 9.0), (None, "text " * 50_000, 9.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1)], "doc_id long, quality int")
    for model in (None, quality.fit(docs, labels), quality.fit(docs, labels.limit(0)), quality.fit(docs.limit(0), labels)):
        found = quality.score(docs, model).collect()
        assert len(found) == 3 and all(0 <= row["score"] <= 1 for row in found)
    assert quality.score(docs.limit(0), None).count() == 0


def test_pipeline_against_its_steps(spark):
    """Each stage's decisions against a plain reading of what it had."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.good_quality(spark, docs, SF)
    assert 0.6 * docs.count() < kept.count() < docs.count()
    exact = corpus_pipeline.without_copies(spark, kept, SF)
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", row["text"]) for row in kept.collect()]
    assert exact.count() == len(set(texts))
    near = corpus_pipeline.without_near_copies(spark, exact, SF)
    rows = sorted(exact.select("doc_id", "text").collect())
    prints = [slow_fingerprint(row["text"]) for row in rows]
    groups = slow_groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(row["doc_id"] for row in near.collect()) == sorted({rows[k]["doc_id"] for k in groups})
    assert near.join(exact, docs.columns, "left_anti").count() == 0
    cut = corpus_pipeline.without_repeats(spark, near, SF)
    before = {row["doc_id"]: row["text"] for row in near.collect()}
    order = sorted(before)
    left = slow_repeats([before[k].encode() for k in order], suffix.LENGTH)
    spans = {k: kept.decode("utf-8", "ignore") for k, (kept, *_) in zip(order, left, strict=True)}
    assert cut.count() == sum(bool(kept) or not before[k] for k, (kept, *_) in zip(order, left, strict=True))
    for row in cut.collect():
        assert row["text"] == spans[row["doc_id"]]
        assert row["n_chars"] == len(row["text"]) or row["text"] == before[row["doc_id"]]
    for stage in (kept, exact, near, cut):
        assert stage.columns == docs.columns


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "a b c", None, None, 5), (1, "a b c", None, None, 5)]])
def test_pipeline_stages_on_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, run in corpus_pipeline.STAGES:
        found = run(spark, docs, SF)
        assert found.count() >= (0 if not rows or name == "quality" else 1)


def test_pipeline_keeps_replacement_characters_and_unscored_documents(spark, monkeypatch):
    shared = "é" + "".join(f"passage {k} " for k in range(40))
    odd = "one\ufffdtwo \x01 \x010 \x011 "
    rows = [(1, odd + "è" + shared + "\ufffd", "en", "s", 1), (2, "other " + "ê" + shared + "!", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {row["doc_id"]: row["text"] for row in corpus_pipeline.without_repeats(spark, docs, SF).collect()}
    left = slow_repeats([text.encode() for _, text, *_ in rows], suffix.LENGTH)
    assert found == {k: kept.decode("utf-8", "ignore") for k, (kept, *_) in enumerate(left, 1)} and "\ufffd" in found[1]
    monkeypatch.setattr(quality, "fit", lambda *args, **kwargs: None)
    assert corpus_pipeline.good_quality(spark, docs, SF).count() == 2


def test_pipeline_runs(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(packed.columns) and packed.count() > 0


def test_queries_read_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op1_byte_bpe", "op3_exact_dedup", "op4_line_dedup", "op8_quality", "op9_simhash", "op10_suffix_dedup"):
        assert catalog.QUERIES[name](spark, SF).count() == docs
