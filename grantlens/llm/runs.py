"""Streams over sorted rows: runs of equal keys, and a SHA-256 per run.

The rows of one key come to one task in order and pass through it batch by batch, so that no
group is ever held. A digest is sequential by nature; nothing else is done in that task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from grantlens.llm.common import byte_values

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def run_starts(columns: Sequence[pa.Array]) -> list[int]:
    """The places at which a new run of equal values begins; NULL equals NULL."""
    n = len(columns[0])
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = False
        for column in columns:
            left, right = column.slice(1), column.slice(0, n - 1)
            differs = pc.fill_null(pc.not_equal(left, right), False).to_numpy(zero_copy_only=False)
            gaps = column.is_null().to_numpy(zero_copy_only=False)
            new[1:] |= differs | (gaps[1:] != gaps[:-1])
    return np.flatnonzero(new).tolist()


def slices_of_runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices with one value of the first ``keys`` columns each; a long run comes in several."""
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = [*run_starts(batch.columns[:keys]), batch.num_rows]
        for start, stop in zip(starts, starts[1:], strict=False):
            part = batch.slice(start, stop - start)
            yield tuple(part.column(k)[0].as_py() for k in range(keys)), part


def digest_runs(rows: DataFrame, keys: Sequence[str], value: str, separator: bytes, name: str) -> DataFrame:
    """``keys`` and the hexadecimal SHA-256 of the values of each run, joined by ``separator``.

    ``rows`` must be partitioned by the keys and sorted by them and the order wanted. A NULL
    value counts as an empty one.
    """
    slim = rows.select(*keys, value)
    schema = StructType([*slim.drop(value).schema.fields, StructField(name, StringType())])
    kinds = slim.limit(0).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, done = None, None, []

        def table() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            arrays = [pa.array(column, kinds.field(k).type) for k, column in enumerate(columns[:-1])]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[-1], pa.string())], [*keys, name])

        for found, part in slices_of_runs(batches, len(keys)):
            values = separator.join(byte_values(part.column(len(keys))))
            if digest is not None and found == key:
                digest.update(separator + values)
                continue
            if digest is not None:
                done.append((*key, digest.hexdigest()))
            key, digest = found, hashlib.sha256(values)
            if len(done) >= 10_000:
                yield table()
                done = []
        if digest is not None:
            done.append((*key, digest.hexdigest()))
        if done:
            yield table()

    return slim.mapInArrow(run, schema)
