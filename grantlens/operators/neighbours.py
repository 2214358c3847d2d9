"""A graph of nearest neighbours, by neighbour descent over tables.

The first graph comes from a few orders of the vectors along a direction each: within a block of
neighbours in such an order all are compared. Then rounds follow: the neighbours of one node, in both
directions, are often neighbours of each other, so they are compared, and each keeps the best it has
seen. No node is compared with more than the members of some neighbourhoods, whatever the number
of rows, and no task holds more than a block or some neighbourhoods at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.session import drop_staged, stage_counted, staging

#: Rows of one order that are compared with each other, and neighbourhoods compared at a time.
BLOCK, GROUPS = 512, 256
#: Orders that the first graph comes from besides those given, and the most rounds after it.
ORDERS, ROUNDS = 2, 6
#: New neighbours that one neighbourhood may offer to each of its members in a round.
OFFERS = 8
#: Numbers in the vectors of the neighbourhoods that one task sorts and compares, about.
MEMBER_NUMBERS = 1 << 22
#: Rounds end when fewer than this share of all links is new.
SETTLED = 0.01
LINKS = "node bigint, other bigint, away double"


def matrix_of(column: pa.Array) -> np.ndarray:
    """A column of arrays of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def squared(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of two matrices, or of two stacks of them."""
    inner = left @ np.swapaxes(right, -1, -2)
    return np.maximum((left * left).sum(-1)[..., :, None] + (right * right).sum(-1)[..., None, :] - 2 * inner, 0.0)


def links_of(node: np.ndarray, other: np.ndarray, away: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(other, pa.int64()), pa.array(away, pa.float64())], ["node", "other", "away"])


def along(nodes: DataFrame, order: Column, k: int, count: int) -> DataFrame:
    """The nearest ``k`` of each node among those next to it in one order."""
    placed = nodes.select(order.alias("at"), "node", "vector")
    sorted_ = placed.repartitionByRange(max(1, -(-count // (8 * BLOCK))), "at", "node").sortWithinPartitions("at", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks_of(batches, BLOCK):
            node, vectors = part.column(1).to_numpy(), matrix_of(part.column(2).combine_chunks())
            away = squared(vectors, vectors)
            np.fill_diagonal(away, np.inf)
            near = np.argsort(away, axis=1, kind="stable")[:, : min(k, len(node) - 1)]
            yield links_of(np.repeat(node, near.shape[1]), node[near].ravel(), np.take_along_axis(away, near, 1).ravel())

    return sorted_.mapInArrow(run, LINKS)


def blocks_of(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of ``rows`` rows, the last with what is left."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held)
        while table.num_rows >= rows:
            yield table.slice(0, rows)
            table = table.slice(rows)
        held = table.to_batches()
    if held and sum(batch.num_rows for batch in held):
        yield pa.Table.from_batches(held)


def best(links: DataFrame, k: int) -> DataFrame:
    """The nearest ``k`` links of each node; of repeats the older one. Ties go by number."""
    once = links.groupBy("node", "other").agg(F.min("away").alias("away"), F.min("fresh").alias("fresh"))
    nth = F.row_number().over(Window.partitionBy("node").orderBy("away", "other"))
    ranked = once.withColumn("nth", nth).where(F.col("nth") <= k)
    return ranked.drop("nth")


def offered(graph: DataFrame, nodes: DataFrame, k: int, tasks: int) -> DataFrame:
    """New links between members of the same neighbourhood that are nearer than their node's farthest.

    Backward links of a node that very many have as a neighbour are thinned by a hash, so that a
    neighbourhood has about ``2 * k`` members. Each comes with its vector, so the number of ``tasks``
    that sort them must grow with the rows.
    """
    forward = graph.select(F.col("node").alias("at"), F.col("other").alias("node"), "fresh")
    asked = graph.groupBy("other").agg(F.count(F.lit(1)).alias("n"))
    parts = 1 << 30
    chance = F.pmod(F.xxhash64("node", "other", F.lit("thin")), F.lit(parts)) * F.col("n") < F.lit(parts * k)
    backward = graph.join(asked, "other").where(chance).select(F.col("other").alias("at"), "node", "fresh")
    members = forward.unionByName(backward).groupBy("at", "node").agg(F.max("fresh").alias("fresh"))
    farthest = graph.groupBy("node").agg(F.max("away").alias("worst"), F.count(F.lit(1)).alias("n"))
    known = nodes.join(farthest, "node", "left").select("node", F.when(F.col("n") >= k, F.col("worst")).otherwise(float("inf")).alias("worst"), "vector")
    rows = members.join(known, "node").select("at", "node", "fresh", "worst", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole_groups(batches):
            yield from compared(part)

    return rows.repartition(tasks, "at").sortWithinPartitions("at").mapInArrow(run, LINKS)


def whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of rows sorted by their first column, none of whose values is in two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        keys = table.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def compared(part: pa.Table) -> Iterator[pa.RecordBatch]:
    at, node, worst = (part.column(k).to_numpy() for k in (0, 1, 3))
    fresh, vectors = part.column(2).to_numpy().astype(bool), matrix_of(part.column(4).combine_chunks())
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    sizes = np.diff(np.r_[starts, len(at)])
    for first in range(0, len(starts), GROUPS):
        begin, size = starts[first : first + GROUPS], sizes[first : first + GROUPS]
        place = begin[:, None] + np.minimum(np.arange(size.max()), size[:, None] - 1)
        there = np.arange(size.max()) < size[:, None]
        away = squared(vectors[place], vectors[place])
        useful = there[:, :, None] & there[:, None, :] & (fresh[place][:, :, None] | fresh[place][:, None, :])
        useful &= (node[place][:, :, None] != node[place][:, None, :]) & (away < worst[place][:, :, None])
        away = np.where(useful, away, np.inf)
        near = np.argpartition(away, min(OFFERS, away.shape[2]) - 1, axis=2)[:, :, :OFFERS]
        found = np.take_along_axis(away, near, 2)
        group, row, nth = np.nonzero(np.isfinite(found))
        yield links_of(node[place[group, row]], node[place[group, near[group, row, nth]]], found[group, row, nth])


def neighbour_graph(nodes: DataFrame, count: int, k: int, orders: Sequence[Column] = ()) -> DataFrame:
    """``(node, other, away)``: about the ``k`` nearest others of each of ``nodes`` (``node, vector``).

    ``away`` is the squared Euclidean distance; a node has fewer than ``k`` where there are too few.
    ``nodes`` must be staged and have vectors of one length; ``orders`` are columns of it that
    keep near vectors together. The graph is a staged table.
    """
    if count < 2:
        return nodes.limit(0).select("node", F.col("node").alias("other"), F.lit(0.0).alias("away"))
    width = nodes.select(F.size("vector")).first()[0]
    tasks = -(-2 * k * count * width // MEMBER_NUMBERS) or 1
    draw = np.random.default_rng(0)
    for _ in range(ORDERS):
        axis = F.array(*[F.lit(float(value)) for value in draw.normal(size=width)])
        products = F.zip_with(F.col("vector").cast("array<double>"), axis, lambda a, b: a * b)
        orders = [*orders, F.aggregate(products, F.lit(0.0), lambda total, value: total + value)]
    links = [along(nodes, order, k, count).withColumn("fresh", F.lit(True)) for order in orders]
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    with staging() as staged:
        graph, total = stage_counted(best(every, k), "neighbours")
    for _ in range(ROUNDS):
        found = offered(graph, nodes, k, tasks).withColumn("fresh", F.lit(True))
        with staging() as after:
            graph, total = stage_counted(best(graph.withColumn("fresh", F.lit(False)).unionByName(found), k), "neighbours")
        drop_staged(nodes.sparkSession, staged)
        staged = after
        if graph.where("fresh").count() <= SETTLED * total:
            break
    return graph.select("node", "other", "away")
