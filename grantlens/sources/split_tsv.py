"""Tab-separated files with line breaks in quoted fields, read in many ranges.

Spark deals a text file out in blocks; each line belongs to the block it begins in. Whether a block
begins inside a quoted field follows from the number of quotes before it: the parities of all blocks
are one small aggregate, combined block by block. With that, each task knows which of its lines begin a
record, and puts the lines of a record together. A record that reaches over the border of blocks leaves
a piece in each; those pieces, at most two for each block, are joined by their file and number.

A quote must stand only around fields that are quoted, doubled inside, as :func:`tsv.write_tsv` and the
usual writers have it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlens.sources.tsv import MISSING_WORDS, without_missing_words

WHOLE, HEAD, TAIL = range(3)
PIECES = "file string, block bigint, kind int, record string"


class Block:
    """Puts the lines of one block together, batch by batch."""

    def __init__(self, file: str, block: int, inside: bool) -> None:
        self.file, self.block, self.inside, self.headless = file, block, inside, inside
        self.open: list[str] = []

    def records(self, lines: pa.Array) -> tuple[list[str], list[int], pa.Array]:
        """Records of several lines with their kinds, and those of one line."""
        if not len(lines):
            return [], [], lines
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        inside = (np.cumsum(quotes) + self.inside) % 2 == 1
        ends = np.flatnonzero(~inside)
        if not len(ends):
            self.open += lines.to_pylist()
            self.inside = True
            return [], [], lines.slice(0, 0)
        begins = np.r_[0, ends[:-1] + 1]
        several = (begins < ends) | ((np.arange(len(ends)) == 0) & bool(self.open or self.headless))
        found, kinds = [], []
        for begin, end in zip(begins[several].tolist(), ends[several].tolist(), strict=True):
            part = lines.slice(begin, end - begin + 1).to_pylist()
            if begin == 0:
                part = self.open + part
                self.open = []
            found.append("\n".join(part))
            kinds.append(HEAD if self.headless and begin == 0 else WHOLE)
        self.headless = False
        self.open = lines.slice(int(ends[-1]) + 1).to_pylist()
        self.inside = bool(inside[-1])
        return found, kinds, lines.take(pa.array(ends[~several]))

    def rest(self) -> tuple[list[str], list[int]]:
        """The piece of a record that goes on in the next block."""
        return (["\n".join(self.open)], [HEAD if self.headless else TAIL]) if self.open else ([], [])


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and the start of their block, in the order of the file within a task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def blocks_inside(lines: DataFrame) -> set[tuple[str, int]]:
    """The blocks that begin inside a quoted field; one entry per block at most."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    parities = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    found = parities.withColumn("before", F.coalesce(F.sum("odd").over(before), F.lit(0))).where("before % 2 = 1")
    return {(row["file"], row["block"]) for row in found.select("file", "block").collect()}


def record_pieces(lines: DataFrame, inside: set[tuple[str, int]]) -> DataFrame:
    """Whole records, and the pieces of those that reach over a border."""

    def table(block: Block, records: list[str], kinds: list[int], single: pa.Array) -> pa.RecordBatch:
        texts = pa.concat_arrays([pa.array(records, pa.string()), single.cast(pa.string())])
        n = len(texts)
        columns = [pa.repeat(block.file, n), pa.repeat(pa.scalar(block.block, pa.int64()), n), pa.array(kinds + [WHOLE] * len(single), pa.int32()), texts]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", "kind", "record"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            starts, files = batch.column(2).to_numpy(), batch.column(1)
            changed = np.ones(batch.num_rows, bool)
            changed[1:] = (starts[1:] != starts[:-1]) | pc.not_equal(files.slice(1), files.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            firsts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
            for first, last in zip(firsts, firsts[1:], strict=False):
                name = (files[first].as_py(), int(starts[first]))
                if block is None or (block.file, block.block) != name:
                    if block is not None:
                        yield table(block, *block.rest(), pa.array([], pa.string()))
                    block = Block(*name, name in inside)
                    # the header line
                    first += not name[1]
                yield table(block, *block.records(batch.column(0).slice(first, last - first)))
        if block is not None:
            yield table(block, *block.rest(), pa.array([], pa.string()))

    return lines.mapInArrow(run, PIECES)


def records_of(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record)`` of all records but the header lines."""
    lines = text_lines(spark, path)
    pieces = record_pieces(lines, blocks_inside(lines))
    torn = pieces.where(F.col("kind") != WHOLE)
    in_order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    numbered = torn.withColumn("nth", F.sum((F.col("kind") == TAIL).cast("int")).over(in_order))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))), lambda part: part["record"])
    joined = numbered.groupBy("file", "nth").agg(F.array_join(parts, "\n").alias("record"))
    every = pieces.where(F.col("kind") == WHOLE).select("file", "record").unionByName(joined.select("file", "record"))
    return every.select("file", F.regexp_replace("record", r"\r\z", "").alias("record")).where("record <> ''")


def read_split_tsv(
    spark: SparkSession, path: str, schema: str | None = None, missing_words: Sequence[str] = MISSING_WORDS
) -> DataFrame:
    """What :func:`tsv.read_tsv` reads, but a large file is read by many tasks.

    All files must have the same header line, without line breaks in it. Without a schema all columns are text.
    """
    first = text_lines(spark, path).where("block = 0").first()
    if first is None:
        return spark.createDataFrame([], schema or "value string")
    header = first["value"].removesuffix("\r")
    if schema is None:
        schema = ", ".join(f"`{name.strip(chr(34)).replace('`', '``')}` string" for name in header.split("\t"))
    # a record may hold line breaks, which must stay as they are
    options = {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    parsed = records_of(spark, path).select(F.from_csv("record", F.lit(schema), options).alias("row")).select("row.*")
    return without_missing_words(parsed, missing_words)
