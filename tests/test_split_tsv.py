"""Files read in ranges against the reader that takes each file whole."""

import random

import pytest
from pyspark.sql import functions as F

from grantlens.sources import split_tsv, tsv

SCHEMA = "i int, t string, d double"


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


@pytest.fixture
def small_blocks(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before, cost = spark.conf.get(name), spark.conf.get("spark.sql.files.openCostInBytes")

    def to(size):
        spark.conf.set(name, size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield to
    spark.conf.set(name, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def odd_rows(n, seed):
    draw = random.Random(seed)
    words = ["", "a", 'say "x"', "two\nlines", "\n\n", "tab\there", '"', "NA", " pad ", "end\r\nof", "é" * 40, '",\t"\n"']
    return [(k, draw.choice([None, "".join(draw.choice(words) for _ in range(draw.randrange(6)))]), draw.choice([None, k / 4])) for k in range(n)]


@pytest.mark.parametrize("size", [64, 333, 1 << 20])
def test_any_block_size_gives_the_same_rows(spark, tmp_path, small_blocks, size):
    path = str(tmp_path / "t")
    tsv.write_tsv(spark.createDataFrame(odd_rows(250, size), SCHEMA).repartition(3), path)
    small_blocks(1 << 20)
    expected, plain = rows_of(tsv.read_tsv(spark, path, SCHEMA)), rows_of(tsv.read_tsv(spark, path, missing_words=()))
    small_blocks(size)
    assert rows_of(split_tsv.read_split_tsv(spark, path, SCHEMA)) == expected
    assert rows_of(split_tsv.read_split_tsv(spark, path, missing_words=())) == plain
    if size < 1000:
        assert split_tsv.text_lines(spark, path).rdd.getNumPartitions() > 10


def test_a_record_over_many_blocks_and_a_row_like_the_header(spark, tmp_path, small_blocks):
    path = str(tmp_path / "t")
    rows = [(1, "a\n" * 3000 + '"' * 7, 0.5), (2, "b", None), (3, "x\ny", 1.0)]
    tsv.write_tsv(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    small_blocks(200)
    assert rows_of(split_tsv.read_split_tsv(spark, path, SCHEMA)) == rows
    texts = str(tmp_path / "u")
    tsv.write_tsv(spark.createDataFrame([("t", "u"), ("v", "w")], "t string, u string").coalesce(1), texts)
    assert rows_of(split_tsv.read_split_tsv(spark, texts)) == [("t", "u"), ("v", "w")]


def test_other_line_ends_and_no_rows(spark, tmp_path, small_blocks):
    (tmp_path / "a.tsv").write_bytes(b'i\tt\r\n1\t"two\r\nlines"\r\n2\tplain\r\n\r\n3\t\r\n')
    found = split_tsv.read_split_tsv(spark, str(tmp_path / "a.tsv"), "i int, t string")
    assert rows_of(found) == [(1, "two\r\nlines"), (2, "plain"), (3, None)]
    (tmp_path / "b.tsv").write_bytes(b"i\tt\n")
    assert split_tsv.read_split_tsv(spark, str(tmp_path / "b.tsv")).columns == ["i", "t"]
    assert split_tsv.read_split_tsv(spark, str(tmp_path / "b.tsv")).count() == 0
    (tmp_path / "c.tsv").write_bytes(b"")
    assert split_tsv.read_split_tsv(spark, str(tmp_path / "c.tsv"), "i int, t string").count() == 0
    assert found.where(F.col("i") == 2).count() == 1
