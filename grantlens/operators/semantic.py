"""Vectors learnt from the texts at hand: the main directions of their weighted token counts.

Rows are sparse (places and values of hashed tokens). Their main directions are found by a block
Krylov method with a random start: each pass over the rows multiplies a block of directions by the rows
and by their transpose, which is a sum over rows, taken per task and then per place. What the driver holds
has the size of places times directions, however many rows there are. The directions seen so far span a
small space in which the best ones are solved for; passes end when those no longer leave a residue.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grantlens.operators.vectors import place_weights, token_counts, weighted
from grantlens.session import stage, stage_counted

#: Directions tried beyond those wanted, most passes over the rows, and the residue at which they end.
SPARE, PASSES, RESIDUE = 8, 12, 1e-4
#: Numbers of a slice of rows made dense, and places sent back by a task at once.
SLICE, ROWS_OUT = 1 << 18, 512


def sparse_texts(rows: DataFrame, text: str = "text", item_id: str = "item_id", dimensions: int = 1024) -> DataFrame:
    """``(item_id, places, values)``: normalised TF-IDF over hashed tokens, staged; see :func:`vectors.embed_text`."""
    counted, n_rows = stage_counted(token_counts(rows, text, item_id, dimensions), "token-counts")
    values = weighted(F.col("places"), F.col("counts"), place_weights(counted, n_rows, dimensions))
    return stage(counted.select(item_id, "places", values.alias("values")), "sparse-texts")


def dense_slices(batch: pa.RecordBatch, first: int, dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with the matrix of their sparse rows, which stand in two array columns."""
    size = max(16, SLICE // dimensions)
    for start in range(0, batch.num_rows, size):
        part = batch.slice(start, size)
        places, values = part.column(first), part.column(first + 1)
        matrix = np.zeros((part.num_rows, dimensions))
        row = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
        matrix[row, places.flatten().to_numpy()] = values.flatten().to_numpy()
        yield part, matrix


def multiplied(sparse: DataFrame, block: np.ndarray) -> np.ndarray:
    """The rows' transpose times the rows times ``block`` (places by directions)."""
    count, width = block.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(block)
        for batch in batches:
            for _, matrix in dense_slices(batch, 0, count):
                total += matrix.T @ (matrix @ block)
        seen = np.flatnonzero(total.any(axis=1))
        for start in range(0, len(seen), ROWS_OUT):
            part = seen[start : start + ROWS_OUT]
            sums = pa.FixedSizeListArray.from_arrays(pa.array(total[part].ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), sums], ["place", "sums"])

    parts = sparse.select("places", "values").mapInArrow(run, "place int, sums array<double>")
    long = parts.select("place", F.posexplode("sums").alias("nth", "part"))
    # places times directions rows at most
    found = long.groupBy("place", "nth").agg(F.sum("part").alias("value")).toArrow()
    out = np.zeros_like(block)
    out[found.column(0).to_numpy(), found.column(1).to_numpy()] = found.column(2).to_numpy()
    return out


def main_directions(
    sparse: DataFrame, dimensions: int, k: int, residue: float = RESIDUE, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` main right singular vectors of the rows as columns, and their singular values, largest first.

    The largest part of each is positive. Where the rows have fewer directions, so has the result.
    """
    width = min(k + SPARE, dimensions)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, width)))[0]
    basis, images = np.zeros((dimensions, 0)), np.zeros((dimensions, 0))
    for _ in range(PASSES):
        image = multiplied(sparse, block)
        basis, images = np.hstack([basis, block]), np.hstack([images, image])
        inner = basis.T @ images
        sizes, turned = np.linalg.eigh((inner + inner.T) / 2)
        sizes, turned = sizes[::-1][:k], turned[:, ::-1][:, :k]
        missed = np.linalg.norm(images @ turned - basis @ turned * sizes, axis=0)
        # what the last image adds to the space
        rest = image - basis @ (basis.T @ image)
        rest -= basis @ (basis.T @ rest)
        new, weight, _ = np.linalg.svd(rest, full_matrices=False)
        block = new[:, weight > 1e-12 * max(float(sizes[0]), 1e-300)]
        block -= basis @ (basis.T @ block)
        block = np.linalg.qr(block)[0]
        if sizes[0] <= 0 or (missed <= residue * sizes[0]).all() or not block.shape[1]:
            break
    keep = sizes > 1e-12 * max(float(sizes[0]), 1e-300)
    axes = basis @ turned[:, keep]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]) if axes.size else np.ones(0)
    return axes * signs, np.sqrt(np.maximum(sizes[keep], 0.0))


def projected(sparse: DataFrame, axes: np.ndarray, item_id: str = "item_id", kind: str = "float") -> DataFrame:
    """``(item_id, embedding array<float>)``: each row along the directions; ``kind`` may be double."""
    dimensions, width = axes.shape
    numbers = {"float": pa.float32(), "double": pa.float64()}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, matrix in dense_slices(batch, 1, dimensions):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(matrix @ axes), pa.list_(numbers))], [item_id, "embedding"])

    if not width:
        return sparse.select(item_id, F.array().cast(f"array<{kind}>").alias("embedding"))
    schema = StructType([*sparse.select(item_id).schema.fields, *StructType.fromDDL(f"embedding array<{kind}>").fields])
    return sparse.select(item_id, "places", "values").mapInArrow(run, schema)


def learn_vectors(rows: DataFrame, text: str = "text", item_id: str = "item_id", k: int = 32, dimensions: int = 1024) -> DataFrame:
    """``(item_id, embedding array<float>)`` of each text, ``k`` numbers learnt from all texts.

    Texts that use the same words, or words that are used together, come near each other. A NULL or
    empty text is at zero; where all are, vectors are empty. Repeated ids stay repeated.
    """
    sparse = sparse_texts(rows, text, item_id, dimensions)
    axes, _ = main_directions(sparse, dimensions, k)
    return projected(sparse, axes, item_id)
