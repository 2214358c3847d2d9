"""What several of these operators share: reading tables, byte columns, partition counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def byte_values(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as empty, one value at a time."""
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for value in column:
        yield value.as_py() or b""


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, so that what a step builds for one slice stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def plain_names(frame: DataFrame, *kept: str) -> DataFrame:
    """``frame`` with its columns, but for ``kept``, named c0, c1, ...: no name that an operator adds or uses meanwhile can clash."""
    return frame.toDF(*[name if name in kept else f"c{k}" for k, name in enumerate(frame.columns)])
