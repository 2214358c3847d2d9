"""Nearest neighbours by multiprobe p-stable hashing.

A table cuts space into cells: a few projections on Gaussian directions, each divided into
steps. A neighbour at distance r lies, along each direction, about a normal step of r away
from the query, which gives the chance of every cell around the query to hold it. A query
visits cells in order of that chance until enough of it is covered, in each table, and all
vectors found are ranked by exact distance.

All queries begin with one distance. The last neighbour a query finds is no nearer than its
true last one, so where it lies beyond that distance, the query probes again for its own. Where
that takes too many cells, or too few neighbours are found, it is compared with every vector.

How much to cover is measured, for either probe: some queries are compared with every vector,
and the cover is set so that ``RECALL`` of their true neighbours are found; where no cover does
it, every vector is compared. Cells are dealt to blocks of bounded size by a hash,
large cells over several, so the work of a hot cell spreads and a task returns the best few
per query and block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import erf

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.session import stage, stage_counted

TABLES, SEED = 2, 20
#: The measuring sample, and the share of its true neighbours that must be found.
MEASURED, RECALL = 200, 0.95
#: The first distance, in medians of the sample's; the most that is covered by cells.
REACH, MOST_COVER = 1.1, 0.999
#: A query that would visit more cells of a table for its own distance is compared with every vector.
MOST_CELLS = 4096
#: Vectors of a block, on average; queries compared at a time.
BLOCK, CHUNK = 8192, 128
EVERY = 0  # the key that stands for all cells


def usable(vector: str) -> Column:
    """Whether a vector takes part: not NULL, every component finite, not all zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(value.isNotNull() & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(apart: np.ndarray) -> np.ndarray:
    """The length of each row, also where its square is beyond the numbers there are."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.sqrt((apart**2).sum(1))
        if not np.isfinite(found).all():
            most = np.abs(apart).max(axis=1, initial=0.0)[:, None]
            found = np.where(np.isfinite(found), found, most[:, 0] * np.sqrt(((apart / most) ** 2).sum(1)))
    return found


def best(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, allowed: np.ndarray | None, k: int):
    """For each query the ``k`` nearest allowed vectors: (query row, vector id, distance) arrays."""
    out = []
    taken = own[:, None] != ids
    if allowed is not None:
        taken &= allowed
    with np.errstate(over="ignore", invalid="ignore"):
        rough = (queries**2).sum(1)[:, None] + (vectors**2).sum(1) - 2 * queries @ vectors.T
        scale = 1e-9 * np.maximum(1.0, np.abs(vectors).max(initial=0.0) ** 2) * vectors.shape[1]
    # where squares are beyond the numbers there are, all are compared
    whole = np.isfinite(scale) and np.isfinite(rough).all()
    rough[~taken] = np.inf
    for row, line in enumerate(rough):
        if whole and len(line) > k:
            limit = np.partition(line, k - 1)[k - 1]
            at = np.flatnonzero((line <= limit + scale) & np.isfinite(line))
        else:
            at = np.flatnonzero(taken[row])
        exact = distances(vectors[at] - queries[row])
        order = np.lexsort((ids[at], exact))[:k]
        out.append((np.full(len(order), row), ids[at][order], exact[order]))
    return [np.concatenate(part) for part in zip(*out, strict=True)]


@dataclass
class Tables:
    """Directions, offsets and step of each table; ``distance`` is that of the first probe.

    ``cover`` is the chance a query covers, ``wide_cover`` that of a query beyond ``distance``
    for its own; None stands for a comparison with every vector.
    """

    directions: np.ndarray
    offsets: np.ndarray
    step: float
    distance: float
    cover: float | None
    wide_cover: float | None

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Per vector, table and direction: where it lies, in steps."""
        return np.einsum("nd,tdk->ntk", vectors, self.directions) / self.step + self.offsets

    def cells(self, place: np.ndarray, cover: float, distance: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """Cells around one place of one table by falling chance, until ``cover`` is reached; the chances.

        The chances are those of a neighbour at ``distance``. None if more than ``most`` cells
        are needed. Cells are built direction by direction. What is left out on the way is so
        unlikely that all of it together leaves the cover within reach.
        """
        spread = distance / self.step
        if most and spread > most:
            return None
        spare = (1 - cover) / (4 * len(place))
        sides = []
        for at in place:
            low, high = int(np.floor(at - 4.5 * spread)), int(np.floor(at + 4.5 * spread))
            edges = [erf((edge - at) / spread / 2**0.5) for edge in range(low, high + 2)]
            sides.append((low, high, np.diff(edges) / 2))
        # no cell has more than the product of the greatest shares
        if most and np.log(cover) - sum(np.log(share.max()) for *_, share in sides) > np.log(most):
            return None
        codes, chances = np.zeros((1, 0), np.int64), np.ones(1)
        for low, high, share in sides:
            codes = np.column_stack((np.repeat(codes, len(share), 0), np.tile(np.arange(low, high + 1), len(codes))))
            chances = np.outer(chances, share).ravel()
            order = np.argsort(-chances, kind="stable")
            reached = np.cumsum(chances[order])
            order = order[: int(np.searchsorted(reached, reached[-1] - spare)) + 1]
            codes, chances = codes[order], chances[order]
        count = int(np.searchsorted(np.cumsum(chances), cover)) + 1
        return None if most and count > most else (codes[:count], chances[:count])

    def visited(self, place: np.ndarray, cover: float | None, distance: float | None, most: int | None = None) -> np.ndarray | None:
        """Keys of the cells of all tables that a query at ``place`` visits; None for every vector."""
        if cover is None or distance is None:
            return None
        found = [self.cells(place[t], cover, distance, most) for t in range(len(place))]
        return None if any(part is None for part in found) else np.concatenate([keys(t, part[0]) for t, part in enumerate(found)])


def keys(table: int, codes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each cell of a table; should two cells share one, they are searched together."""
    mixed = np.full(len(codes), table + 1, np.uint64)
    for column in codes.T:
        mixed = (mixed ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def nearest_of_all(vectors: DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Exact neighbours (query row, vec_id, score, vector) of a bounded set of queries."""
    own, points = queries["id"].to_numpy(), np.array(queries["vector"].tolist(), np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), matrix(batch.column(1))
            if not len(ids):
                continue
            row, found, score = best(ids, rows, points, own, None, k)
            order = np.argsort(ids, kind="stable")
            at = order[np.searchsorted(ids[order], found)]
            yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(found), pa.array(score), batch.column(1).take(pa.array(at))], ["row", "vec_id", "score", "vector"])

    kind = dict(vectors.dtypes)["vector"]
    found = vectors.select("id", "vector").mapInArrow(run, f"row long, vec_id long, score double, vector {kind}")
    # each partition gives k rows per query; the least k of all come to the driver
    top = found.groupBy("row").agg(F.slice(F.sort_array(F.collect_set(F.struct("score", "vec_id", "vector"))), 1, k).alias("near"))
    return top.select("row", F.explode("near").alias("n")).select("row", "n.vec_id", "n.score", "n.vector").toPandas()


def fit(vectors: DataFrame, count: int, k: int) -> Tables:
    """Steps and cover measured on at most ``MEASURED`` vectors against all."""
    mixed = F.xxhash64("id", F.lit("measure"))
    share = min(1.0, 3 * MEASURED / max(count, 1))
    picked = vectors.where(F.pmod(mixed, F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy(mixed).limit(MEASURED).toPandas()
    near = nearest_of_all(vectors, picked, k)
    points = np.array(picked["vector"].tolist(), np.float64)
    farthest = near.groupby("row")["score"].max()
    apart = farthest[farthest > 0]  # copies share their cells at any step
    distance = REACH * float(apart.median()) if len(apart) else 1e-6
    width = int(np.clip(round(np.log2(max(count, 64) / 32) / 2.7), 2, 12))
    draw = np.random.default_rng(SEED)
    directions, offsets = draw.standard_normal((TABLES, points.shape[1], width)), draw.uniform(0, 1, (TABLES, width))
    tables = Tables(directions, offsets, distance, distance, MOST_COVER, MOST_COVER)
    first, wide = [], []
    if len(near):
        places = tables.places(points)
        theirs = np.floor(tables.places(np.array(near["vector"].tolist(), np.float64))).astype(np.int64)
        for row, group in near.groupby("row"):
            own = float(farthest[row])
            at = near.index.get_indexer(group.index)
            needed = np.ones(len(at))
            for table in range(TABLES):
                found = tables.cells(places[int(row), table], MOST_COVER, max(own, distance), 8 * MOST_CELLS if own > distance else None)
                if found is None:  # such a query is compared with every vector
                    break
                codes, chances = found
                before = dict(zip(keys(table, codes).tolist(), np.cumsum(chances) - chances, strict=True))
                needed = np.minimum(needed, [before.get(key, 1.0) for key in keys(table, theirs[at, table]).tolist()])
            else:
                (wide if own > distance else first).append(needed)
    tables.cover = enough(first)
    tables.wide_cover = enough(wide)
    return tables


def enough(needed: list[np.ndarray]) -> float | None:
    """The cover that finds ``RECALL`` of neighbours that need so much; None if no cells do."""
    cover = float(np.quantile(np.concatenate(needed), RECALL)) + 1e-9 if needed else RECALL
    return max(cover, 0.05) if cover <= MOST_COVER else None


def dealt(rows: DataFrame, large: DataFrame, blocks: int, whole: bool) -> DataFrame:
    """``rows`` with the ``block`` of their cell: a vector's own part of it, or all parts for a query."""
    found = rows.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    if whole:
        found = found.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    else:
        found = found.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    return found.withColumn("block", F.pmod(F.xxhash64("key", "part"), F.lit(blocks)))


def compared(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each block for each query that visits it.

    ``vectors`` has block, key, id, vector; ``queries`` has block, id, vector and the cells
    ``visits`` (``EVERY`` for all). A block's vectors are held by one task, queries pass by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, held = None, [], None
        for batch in batches:
            blocks, query = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            changes = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(query) != 0)) + 1
            for begin, end in zip([0, *changes], [*changes, len(blocks)], strict=True):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if blocks[begin] != block:
                    block, parts, held = blocks[begin], [], None
                if query[begin] == 0:
                    parts.append(part)
                    continue
                if held is None and parts:
                    table = pa.Table.from_batches(parts)
                    own = table["visits"].combine_chunks().flatten().to_numpy()
                    cells, cell = np.unique(own, return_inverse=True)
                    held, parts = (table["id"].to_numpy(), matrix(table["vector"]), cells, cell), []
                if held is None:
                    continue
                for start in range(0, part.num_rows, CHUNK):
                    some = part.slice(start, CHUNK)
                    yield from block_rows(some, *held, k)

    together = vectors.select("block", F.lit(0).alias("query"), "id", "vector", F.array("key").alias("visits")).unionByName(
        queries.select("block", F.lit(1).alias("query"), "id", "vector", "visits")
    )
    placed = together.repartition("block").sortWithinPartitions("block", "query")
    return placed.mapInArrow(run, "query_id long, vec_id long, score double")


def block_rows(some: pa.RecordBatch, ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray, cell: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    visits = some.column(4)
    asked, sizes = visits.flatten().to_numpy(), np.diff(visits.offsets.to_numpy())
    who = np.repeat(np.arange(some.num_rows), sizes)
    visited = np.zeros((some.num_rows, len(cells)), bool)
    at = np.minimum(np.searchsorted(cells, asked), len(cells) - 1)
    hit = cells[at] == asked
    visited[who[hit], at[hit]] = True
    visited[who[asked == EVERY]] = True
    near = np.flatnonzero(visited.any(axis=0)[cell])
    if len(near):
        own = some.column(2).to_numpy()
        row, found, score = best(ids[near], vectors[near], matrix(some.column(3)), own, visited[:, cell[near]], k)
        yield pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query; a vector found in several tables counts once."""
    pairs = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    near = pairs.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list(F.struct("score", "vec_id"))), 1, k).alias("near"))
    return near.select("query_id", F.posexplode("near").alias("rank", "n")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "n.vec_id", "n.score"
    )


def search(table: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (Euclidean distance) of each query's neighbours.

    Queries are the rows where ``is_query`` holds, candidates all rows with another id; fewer
    than ``k`` come back only if there are fewer. Ties go to the smaller id. Rows without an
    id, with an unusable vector, or with another number of components than most, take no
    part. Rows repeated with one id are one candidate, at its nearest vector, and each is a query
    whose results merge.
    """
    rows = table.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width = sizes["n"] if sizes else 0
    rows, count = stage_counted(rows.where(F.size("vector") == width), "ann-vectors")
    if not count:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tables = fit(rows.select("id", "vector"), count, k)
    kind = dict(rows.dtypes)["vector"]

    def cell_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(1))
            if len(points):
                codes = np.floor(tables.places(points)).astype(np.int64)
                found = np.column_stack([keys(t, codes[:, t]) for t in range(TABLES)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(found), pa.list_(pa.int64()))], ["id", "vector", "keys"])

    def query_keys(cover: float | None, most: int | None = None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, 100):
                    some = batch.slice(start, 100)
                    places = tables.places(matrix(some.column(1)))
                    found = [tables.visited(*query, most) for query in zip(places, [cover] * len(places), some.column(2).to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*some.columns[:2], pa.array(found, pa.list_(pa.int64()))], ["id", "vector", "keys"])

        return run

    schema = f"id long, vector {kind}, keys array<long>"
    index = stage(rows.select("id", "vector").mapInArrow(cell_keys, schema), "ann-index")
    asked = rows.where("asks").select("id", "vector")
    placed = stage(asked.withColumn("reach", F.lit(tables.distance)).mapInArrow(query_keys(tables.cover), schema), "ann-queries")
    blocks = -(-count * TABLES // BLOCK)
    sizes = index.select(F.explode("keys").alias("key")).groupBy("key").count()
    large = sizes.where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))

    def probed(placed: DataFrame) -> DataFrame:
        vectors = dealt(index.select("id", "vector", F.explode("keys").alias("key")), large, blocks, whole=False)
        visits = dealt(placed.select("id", F.explode("keys").alias("key")), large, blocks, whole=True)
        visits = visits.groupBy("id", "block").agg(F.collect_set("key").alias("visits")).join(placed.where("keys is not null").select("id", "vector"), "id")
        return compared(vectors, visits, k)

    found = stage(ranked(probed(placed), k), "ann-found")
    last = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("reach"))
    beyond = placed.select("id", "vector").join(last, "id", "left").where(F.col("reach").isNull() | (F.col("reach") > tables.distance))
    beyond, again = stage_counted(beyond.mapInArrow(query_keys(tables.wide_cover, MOST_CELLS), schema), "ann-beyond")
    if not again:
        return found
    # exact: each query without cells meets every block of all vectors
    spread = index.select("id", "vector", F.lit(EVERY).cast("long").alias("key"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    every = beyond.where("keys is null").select("id", "vector", F.array(F.lit(EVERY).cast("long")).alias("visits"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    ids = beyond.select(F.col("id").alias("query_id")).distinct()
    before = found.join(ids, "query_id", "left_semi").select("query_id", "vec_id", "score")
    more = before.unionByName(probed(beyond)).unionByName(compared(spread, every, k))
    return found.join(ids, "query_id", "left_anti").unionByName(ranked(more, k))
