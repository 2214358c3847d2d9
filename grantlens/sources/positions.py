"""Tables without a key, matched by the place of their rows.

The place of a row is its number in its file plus the rows of the files before, in the order of their
names. Both are exact and known from the files' own metadata, so nothing is sorted or numbered in one task.
"""

from __future__ import annotations

import ast
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Numbers of a matrix file that a task reads at a time.
READ = 1 << 20


def read_positions(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """A Parquet table with the place of each row, from 0 and without gaps."""
    rows = spark.read.parquet(path)
    if name in rows.columns:
        raise ValueError(f"the table has a column {name} already")
    placed = rows.select(*rows.columns, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(name))
    sizes = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("_held"), F.col("_metadata.row_index").alias("_last"))
    sizes = sizes.groupBy("_held").agg((F.max("_last") + 1).alias("_rows"))
    # one row for each file
    before = F.sum("_rows").over(Window.orderBy("_held").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("_held", F.coalesce(before, F.lit(0)).alias("_before"))
    found = placed.join(firsts, F.col(f"{name}.file") == F.col("_held"))
    return found.select(*rows.columns, (F.col(f"{name}.row") + F.col("_before")).alias(name))


def npy_header(files: fs.FileSystem, path: str) -> tuple[int, np.dtype, tuple[int, ...]]:
    """Where the numbers begin, their type, and the shape."""
    with files.open_input_file(path) as file:
        magic = file.read(8)
        if magic[:6] != b"\x93NUMPY":
            raise ValueError(f"{path} is no matrix file")
        wide = 2 if magic[6] == 1 else 4
        size = int.from_bytes(file.read(wide), "little")
        said = ast.literal_eval(file.read(size).decode("latin1"))
    kind = np.dtype(said["descr"])
    if said["fortran_order"] or kind.kind not in "fiu" or len(said["shape"]) not in (1, 2):
        raise ValueError(f"{path}: only numbers in rows can be read, not {said}")
    return 8 + wide + size, kind, said["shape"]


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """``(position, embedding array<float>)`` of a matrix file, read in ranges by many tasks."""
    files, inside = fs.FileSystem.from_uri(path)
    begin, kind, shape = npy_header(files, inside)
    count, width = shape[0], shape[1] if len(shape) == 2 else 1
    rows = max(1, READ // max(width, 1))
    ranges = -(-count // rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, inside = fs.FileSystem.from_uri(path)
        for batch in batches:
            for nth in batch.column(0).to_pylist():
                first, last = nth * rows, min(count, (nth + 1) * rows)
                with files.open_input_file(inside) as file:
                    file.seek(begin + first * width * kind.itemsize)
                    held = file.read((last - first) * width * kind.itemsize)
                values = pa.array(np.frombuffer(held, kind).astype(np.float32))
                offsets = pa.array(np.arange(last - first + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, last)), pa.ListArray.from_arrays(offsets, values)], ["position", "embedding"])

    return spark.range(0, ranges, 1, max(1, min(ranges, 10_000))).mapInArrow(run, "position bigint, embedding array<float>")


def join_positions(left: DataFrame, right: DataFrame, name: str = "position") -> DataFrame:
    """Both tables side by side; a place that only one of them has is an error."""
    both = left.withColumn("_left", F.lit(1)).join(right.withColumn("_right", F.lit(1)), name, "full")
    problem = F.raise_error(F.concat(F.lit("rows do not match at place "), F.col(name).cast("string"))).cast("boolean")
    matched = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    return both.filter(F.when(matched, F.lit(True)).otherwise(problem)).drop("_left", "_right")
