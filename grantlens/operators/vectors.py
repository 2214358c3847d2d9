"""Text vectors, and their placement in two dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from grantlens.functions.dates import bound
from grantlens.session import stage, stage_counted

#: Landmarks and rows that one task compares.
LANDMARK_BLOCK, ROW_BLOCK = 1024, 8192
#: Landmarks that a pivot has on average where there are few, and the most pivots.
PIVOT_MARKS, PIVOTS = 64, 2048
ENCODER_BATCH = 32
BETWEEN_TOKENS = r"[^\p{L}\p{N}]+"


def embed_text(
    rows: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    dimensions: int = 256,
    encoder: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
    batch_size: int = ENCODER_BATCH,
) -> DataFrame:
    """``(item_id, embedding array<float>)`` of each text.

    By default a normalised TF-IDF over hashed tokens: a token's place comes from its md5, so
    it is the same in every engine. Document frequencies are one count per dimension.
    ``encoder`` is a factory that Spark calls once per task; what it returns maps a list of
    texts to a matrix. No row is shuffled: tokens are counted within their row.
    """
    if encoder is not None:
        return _encode(rows.select(item_id, text), text, item_id, encoder, batch_size)
    slim, n_rows = stage_counted(token_counts(rows, text, item_id, dimensions), "token-counts")
    values = weighted(F.col("places"), F.col("counts"), place_weights(slim, n_rows, dimensions))
    return slim.select(item_id, dense(F.col("places"), values, dimensions).alias("embedding"))


def token_counts(rows: DataFrame, text: str, item_id: str, dimensions: int) -> DataFrame:
    """``(item_id, places, counts)``: the places of the text's hashed tokens, ascending, and how often each is hit.

    All is counted within the row. A task takes the md5 of each different token of a batch of rows once.
    """
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN_TOKENS), "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1)
            words = found.flatten().dictionary_encode()
            digests = [md5(word, usedforsecurity=False).digest()[:4] for word in words.dictionary.cast(pa.binary()).to_pylist()]
            place = np.array([int.from_bytes(digest, "big") % dimensions for digest in digests], np.int64)
            row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
            hit, counts = np.unique(row * dimensions + place[words.indices.to_numpy()], return_counts=True)
            starts = pa.array(np.searchsorted(hit, np.arange(batch.num_rows + 1) * dimensions), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(part, pa.int32())) for part in (hit % dimensions, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], [item_id, "places", "counts"])

    schema = StructType([*rows.select(item_id).schema.fields, *StructType.fromDDL("places array<int>, counts array<int>").fields])
    return rows.select(item_id, tokens.alias("_tokens")).mapInArrow(run, schema)


def dense(places: Column, values: Column, dimensions: int) -> Column:
    """The whole vector of values at ascending places, zeros between them."""

    def filled(found: Column) -> Column:
        at, held = found["places"], found["values"]
        zeros = lambda count: F.array_repeat(F.lit(0.0).cast("float"), count)
        parts = F.transform(at, lambda place, k: F.concat(zeros(place - F.coalesce(F.get(at, k - 1), F.lit(-1)) - 1), F.array(held[k].cast("float"))))
        tail = zeros(dimensions - 1 - F.coalesce(F.get(at, F.size(at) - 1), F.lit(-1)))
        return F.concat(F.flatten(parts), tail)

    return bound(F.struct(places.alias("places"), values.alias("values")), filled)


def place_weights(counted: DataFrame, n_rows: int, dimensions: int) -> list[float]:
    """The weight of each place by the share of rows that hit it; one number per dimension."""
    known = counted.select(F.explode("places").alias("place")).groupBy("place").agg(F.log((n_rows + 1) / (F.count(F.lit(1)) + 1)).alias("weight"))
    weights = [0.0] * dimensions
    for row in known.collect():  # a row for each dimension at most
        weights[row["place"]] = row["weight"]
    return weights


def weighted(places: Column, counts: Column, weights: list[float]) -> Column:
    """Counts times weights, as a vector of length one (zeros where nothing has any weight)."""
    known = F.array(*map(F.lit, weights))
    found = F.zip_with(counts, places, lambda count, place: count * F.get(known, place))

    def scaled(values: Column) -> Column:
        norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, value: total + value * value))
        return bound(norm, lambda length: F.transform(values, lambda value: F.coalesce(F.try_divide(value, F.nullif(length, F.lit(0.0))), F.lit(0.0))))

    return bound(found, scaled)


def _encode(rows: DataFrame, text: str, item_id: str, encoder, batch_size: int) -> DataFrame:
    schema = rows.select(item_id).schema.add("embedding", ArrayType(FloatType()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for frame in frames:
            texts = frame[text].fillna("").tolist()
            parts = [encode(texts[start : start + batch_size]) for start in range(0, len(texts), batch_size)]
            vectors = [np.asarray(row, dtype="float32") for part in parts for row in part]
            yield pd.DataFrame({item_id: frame[item_id], "embedding": vectors})

    return rows.mapInPandas(run, schema)


def project_2d(
    rows: DataFrame, vector: str = "embedding", item_id: str = "item_id", scale: float = 1.0
) -> DataFrame:
    """``(item_id, x, y)`` on the two main axes of the vectors, times ``scale``.

    The largest loading of each axis is positive, so the map is never mirrored. Rows without
    a vector get NULL, a single vector is at zero. The fit aggregates a square matrix of the vector size and reads the
    rows twice, so stage vectors that are costly to make.
    """
    known = rows.filter(F.col(vector).isNotNull())
    prepared = known.select(item_id, array_to_vector(F.col(vector).cast("array<double>")).alias("_vector"))
    nowhere = rows.filter(F.col(vector).isNull()).select(item_id, *[F.lit(None).cast("double").alias(name) for name in ("x", "y")])
    if known.limit(2).count() < 2:
        return known.select(item_id, F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).unionByName(nowhere)
    model = PCA(k=2, inputCol="_vector", outputCol="_axes").fit(prepared)
    loadings = model.pc.toArray()
    signs = [1.0 if axis[abs(axis).argmax()] > 0 else -1.0 for axis in loadings.T]
    axes = vector_to_array("_axes")
    placed = model.transform(prepared).select(
        item_id, (axes[0] * F.lit(scale * signs[0])).alias("x"), (axes[1] * F.lit(scale * signs[1])).alias("y")
    )
    return placed.unionByName(nowhere)


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays as rows of length one; a row of zeros stays."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def angles(rows: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ axes.T, -1.0, 1.0))


def pivot_blocks(marks: DataFrame, n_marks: int) -> tuple[DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """Landmarks with the pivot nearest to each, the pivots, and each one's farthest angle and number of landmarks.

    Pivots are landmarks taken by a hash, at most ``PIVOTS``.
    """
    count = int(np.clip(-(-n_marks // PIVOT_MARKS), 1, PIVOTS))
    chosen = marks.orderBy(F.xxhash64("x", "y", "_vector", F.lit("pivot"))).limit(count).select("_vector").toArrow()["_vector"]
    width = len(chosen[0].as_py())
    pivots = unit_rows(chosen.combine_chunks(), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = angles(unit_rows(batch.column(0), width), pivots)
            near = away.argmin(axis=1)
            columns = [*batch.columns, pa.array(near, pa.int32()), pa.array(np.take_along_axis(away, near[:, None], 1)[:, 0])]
            yield pa.RecordBatch.from_arrays(columns, ["_vector", "x", "y", "_pivot", "_angle"])

    placed = stage(marks.select("_vector", "x", "y").mapInArrow(run, "_vector array<double>, x double, y double, _pivot int, _angle double"), "landmark-blocks")
    radius, held = np.zeros(count), np.zeros(count, np.int64)
    for row in placed.groupBy("_pivot").agg(F.max("_angle").alias("radius"), F.count(F.lit(1)).alias("held")).collect():
        radius[row["_pivot"]], held[row["_pivot"]] = row["radius"], row["held"]
    return placed.drop("_angle"), pivots, radius, held


def blocks_to_open(rows: DataFrame, pivots: np.ndarray, radius: np.ndarray, held: np.ndarray, k: int) -> DataFrame:
    """``(_row, _vector, _pivot)``: what each row has to be compared with.

    Without a column ``_worst`` these are its nearest pivots that hold ``k`` landmarks together. With one,
    the similarity (negative) of its k-th landmark so far, they are all other pivots of which some
    landmark may be as near: the angle to a landmark is at least that to its pivot less the pivot's radius.
    """
    width, bounded = pivots.shape[1], "_worst" in rows.columns
    columns = ["_row", "_vector", *(["_worst"] if bounded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                away = angles(unit_rows(batch.column(1), width), pivots)
                near = np.argsort(away, axis=1, kind="stable")
                before = np.cumsum(held[near], axis=1) - held[near]
                opened = np.zeros(away.shape, bool)
                np.put_along_axis(opened, near, before < k, axis=1)
                if bounded:
                    bound = -np.cos(np.maximum(away - radius, 0.0))
                    opened = ~opened & (bound <= batch.column(2).to_numpy()[:, None] + 1e-9)
                row, pivot = np.nonzero(opened & (held > 0))
                taken = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken), pa.array(pivot, pa.int32())], ["_row", "_vector", "_pivot"])

    return rows.select(*columns).mapInArrow(run, "_row bigint, _vector array<double>, _pivot int")


def compared(opened: DataFrame, marks: DataFrame, held: np.ndarray, k: int) -> DataFrame:
    """The best ``k`` landmarks of each block that a row opens.

    A task holds at most ``LANDMARK_BLOCK`` landmarks of a pivot and about ``ROW_BLOCK`` rows.
    """
    opened = stage(opened, "opened-blocks")
    asked = dict(opened.groupBy("_pivot").count().collect())  # a row for each pivot at most

    row_parts = spread(opened.sparkSession, {pivot: -(-n // ROW_BLOCK) for pivot, n in asked.items()}, "_row_parts")
    mark_parts = spread(opened.sparkSession, {pivot: -(-int(n) // LANDMARK_BLOCK) for pivot, n in enumerate(held) if n}, "_mark_parts")
    numbers = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    left = opened.join(F.broadcast(row_parts), "_pivot").join(F.broadcast(mark_parts), "_pivot").select(
        "_pivot", F.pmod(F.xxhash64("_row"), F.col("_row_parts")).cast("int").alias("_rows"), F.explode(numbers("_mark_parts")).alias("_marks"), "_row", "_vector"
    )
    right = marks.join(F.broadcast(row_parts), "_pivot").join(F.broadcast(mark_parts), "_pivot").select(
        "_pivot", F.explode(numbers("_row_parts")).alias("_rows"), F.pmod(F.xxhash64("x", "y", "_vector"), F.col("_mark_parts")).cast("int").alias("_marks"),
        "_vector", "x", "y",
    )
    keys = ["_pivot", "_rows", "_marks"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_nearest(k), "_row long, away double, x double, y double")


def spread(spark: SparkSession, counts: dict[int, int], name: str) -> DataFrame:
    """A row for each pivot, so at most ``PIVOTS``."""
    return spark.createDataFrame(sorted(counts.items()), f"_pivot int, {name} int")


def place_by_landmarks(
    rows: DataFrame, landmarks: DataFrame, k: int = 3, vector: str = "embedding", item_id: str = "item_id"
) -> DataFrame:
    """``(item_id, x, y)`` from landmarks ``(embedding, x, y)`` laid out beforehand.

    A row goes to the mean of its ``k`` nearest landmarks by cosine, weighted by their
    similarity (negative ones count nothing; if none is positive the plain mean). Ties
    go by landmark order in (x, y). Rows without a vector get NULL.

    Landmarks stand in blocks around pivots. A row is first compared with its nearest blocks,
    then with those that can still hold one as near as its ``k``-th so far. The best of each
    block are merged by an aggregate.
    """
    known, _ = stage_counted(
        rows.filter(F.col(vector).isNotNull()).select(
            F.monotonically_increasing_id().alias("_row"), item_id, F.col(vector).cast("array<double>").alias("_vector")
        ),
        "placed-rows",
    )
    marks, n_marks = stage_counted(
        landmarks.select(F.col("embedding").cast("array<double>").alias("_vector"), F.col("x").cast("double"), F.col("y").cast("double")), "landmarks"
    )
    if not n_marks:
        raise ValueError("no landmarks")
    marks, pivots, radius, held = pivot_blocks(marks, n_marks)
    first = stage(compared(blocks_to_open(known, pivots, radius, held, k), marks, held, k), "first-landmarks")
    nth = F.slice(F.sort_array(F.collect_list("away")), 1, k)
    worst = first.groupBy("_row").agg(nth.alias("near")).select("_row", F.when(F.size("near") == k, F.get("near", k - 1)).otherwise(2.0).alias("_worst"))
    further = compared(blocks_to_open(known.select("_row", "_vector").join(worst, "_row"), pivots, radius, held, k), marks, held, k)
    found = first.unionByName(further)
    best = found.groupBy("_row").agg(F.slice(F.sort_array(F.collect_list(F.struct("away", "x", "y"))), 1, k).alias("near"))
    weights = F.transform("near", lambda mark: F.greatest(-mark["away"], F.lit(0.0)))
    summed = F.aggregate("weights", F.lit(0.0), lambda total, weight: total + weight)
    settled = F.when(F.col("total") > 0, F.col("weights")).otherwise(F.transform("weights", lambda _: F.lit(1.0)))

    def mean(name: str) -> Column:
        parts = F.zip_with("settled", "near", lambda weight, mark: weight * mark[name])
        add = lambda total, value: total + value
        return (F.aggregate(parts, F.lit(0.0), add) / F.aggregate("settled", F.lit(0.0), add)).alias(name)

    placed = best.withColumn("weights", weights).withColumn("total", summed).withColumn("settled", settled)
    placed = placed.select("_row", mean("x"), mean("y"))
    nowhere = rows.filter(F.col(vector).isNull()).select(item_id, *[F.lit(None).cast("double").alias(name) for name in ("x", "y")])
    return known.select("_row", item_id).join(placed, "_row").select(item_id, "x", "y").unionByName(nowhere)


def _nearest(k: int):
    """The best ``k`` landmarks of one block for each row of another, with the negative cosine."""

    def run(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or marks.empty:
            return pd.DataFrame({"_row": [], "away": [], "x": [], "y": []})
        marks = marks.sort_values(["x", "y"], kind="stable")
        axes, vectors = (np.stack(table["_vector"].to_list()) for table in (marks, rows))
        axes = axes / np.maximum(np.linalg.norm(axes, axis=1, keepdims=True), 1e-300)
        vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
        away = -(vectors @ axes.T)
        chosen = np.argsort(away, axis=1, kind="stable")[:, :k]
        places = marks[["x", "y"]].to_numpy(dtype="float64")[chosen.ravel()]
        row = np.repeat(rows["_row"].to_numpy(), chosen.shape[1])
        return pd.DataFrame({"_row": row, "away": np.take_along_axis(away, chosen, axis=1).ravel(), "x": places[:, 0], "y": places[:, 1]})

    return run
