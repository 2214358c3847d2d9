"""A non-linear map of vectors in two dimensions: neighbour embedding over tables.

Near vectors pull each other, all push each other, as in t-SNE. The pull is a sum over the links of a
neighbour graph, so a join and an aggregate. The push comes from sums per cell of a grid over the map:
each point lends its charge to the four corners around it, the charges are aggregated (at most
``CELLS`` by ``CELLS`` rows, whatever the number of points), a convolution with the force of one
charge gives the force at each corner, and a point takes it from its corners again. Each step is one
staged table of positions; the table before it is dropped.

A step moves a point by the sum of both forces over the sum of its pulling weights, which is where the
pull alone would end with weights held fixed. That needs some thirty steps where plain gradient steps
need hundreds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.operators.neighbours import neighbour_graph
from grantlens.operators.vectors import project_2d
from grantlens.session import drop_staged, stage, stage_counted, stage_observed, staging

#: Neighbours of each vector; their perplexity is a third of that.
NEIGHBOURS = 15
STEPS = 30
#: For the first part of the steps pulls count twofold and less momentum is kept.
EARLY, PULL, MOMENTUM_EARLY, MOMENTUM = 0.3, 2.0, 0.7, 0.8
#: Points that one task moves at least, where there are as many.
POINTS = 1 << 16
#: Corners of the grid along each side; a cell is no wider than this where they suffice.
CELLS, CELL = 512, 0.25


def pulls(graph: DataFrame) -> DataFrame:
    """``(node, other, pull)`` both ways: each node's shares of its neighbours, made symmetric.

    The shares fall with the distance such that their perplexity is a third of the number of neighbours.
    """
    near = graph.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("away", "other"))).alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            away, other = (lists.flatten().field(name).to_numpy(zero_copy_only=False) for name in ("away", "other"))
            place = np.arange(max(sizes, default=0)) < sizes[:, None]
            table = np.full(place.shape, np.inf)
            table[place] = away
            shares = shares_of(table)[place]
            node = np.repeat(batch.column(0).to_numpy(), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(other), pa.array(shares)], ["node", "other", "pull"])

    one = near.mapInArrow(run, "node bigint, other bigint, pull double")
    back = one.select(F.col("other").alias("node"), F.col("node").alias("other"), "pull")
    return one.unionByName(back).groupBy("node", "other").agg((F.sum("pull") / 2).alias("pull"))


def shares_of(away: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Shares per row by squared distance (infinite where there is none), of the perplexity wanted; found by bisection."""
    if not away.size:
        return away
    wanted = np.log(np.maximum(np.isfinite(away).sum(1) / 3, 1.0))
    beyond = away - away.min(axis=1, keepdims=True)
    low, high = np.zeros(len(away)), np.full(len(away), np.inf)
    # in units of the mean distance, so that any scale will do
    unit = np.where(np.isfinite(beyond), beyond, 0.0).sum(1) / np.maximum(np.isfinite(away).sum(1), 1)
    sharp = 1 / np.where(unit > 0, unit, 1.0)
    for _ in range(rounds):
        weights = np.exp(-sharp[:, None] * beyond)
        shares = weights / weights.sum(1, keepdims=True)
        spread = -(shares * np.log(np.maximum(shares, 1e-300))).sum(1)
        flat = spread > wanted
        low, high = np.where(flat, sharp, low), np.where(flat, high, sharp)
        sharp = np.where(np.isinf(high), sharp * 2, (low + high) / 2)
    return shares


class Grid:
    """Square cells over the map, and the push at their corners."""

    def __init__(self, bounds: tuple[float, float, float, float]) -> None:
        left, right, low, high = bounds
        span = max(right - left, high - low)
        self.cells = int(np.clip(np.ceil(span / CELL) + 2, 4, CELLS))
        self.width = max(span / (self.cells - 2), 1e-9)
        self.left, self.low = left - self.width / 2, low - self.width / 2

    def charges(self, points: DataFrame) -> np.ndarray:
        """The charge at every corner: an aggregate with at most one row for each."""
        x, y = (F.col("x") - self.left) / self.width, (F.col("y") - self.low) / self.width
        across, up = F.floor(x), F.floor(y)
        a, b = x - across, y - up

        def corner(right: int, above: int) -> Column:
            weight = (a if right else 1 - a) * (b if above else 1 - b)
            return F.struct(((across + right) * self.cells + up + above).alias("corner"), weight.alias("weight"))

        corners = F.explode(F.array(*[corner(right, above) for right in (0, 1) for above in (0, 1)])).alias("c")
        sums = points.select(corners).groupBy("c.corner").agg(F.sum("c.weight").alias("charge")).toArrow()
        found = np.zeros(self.cells * self.cells)
        found[sums.column(0).to_numpy()] = sums.column(1).to_numpy()
        return found.reshape(self.cells, self.cells)

    def forces(self, charges: np.ndarray, count: int) -> np.ndarray:
        """Push along both axes at every corner, divided by the sum of all closeness (per point)."""
        n = self.cells
        offset = np.r_[0 : n, -n:0] * self.width
        dx, dy = offset[:, None], offset[None, :]
        close = 1 / (1 + dx * dx + dy * dy)
        spread = np.fft.rfft2(charges, (2 * n, 2 * n))

        def at_corners(kernel: np.ndarray) -> np.ndarray:
            return np.fft.irfft2(spread * np.fft.rfft2(kernel), (2 * n, 2 * n))[:n, :n]

        # a point is not pushed by itself
        total = max(float((charges * at_corners(close)).sum()) - count, 1e-9)
        return np.stack([at_corners(close * close * d) for d in (dx, dy)]) * (count / total)

    def at(self, forces: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Forces at points, between their corners in proportion."""
        a, b = (x - self.left) / self.width, (y - self.low) / self.width
        across, up = (np.clip(np.floor(v).astype(np.int64), 0, self.cells - 2) for v in (a, b))
        a, b = a - across, b - up
        return sum(
            forces[:, across + right, up + above] * (a if right else 1 - a) * (b if above else 1 - b) for right in (0, 1) for above in (0, 1)
        )


def step(
    points: DataFrame, links: DataFrame, grid: Grid, forces: np.ndarray, pull: float, momentum: float, few: bool = False
) -> DataFrame:
    """Every point moved once; ``points`` are ``node, x, y`` and the last move ``u, v``.

    Where there are ``few`` (some megabytes at most) they go to the links, which then stay where they are.
    """
    here = points.select("node", F.col("x").alias("x0"), F.col("y").alias("y0"))
    there = points.select(F.col("node").alias("other"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    if few:
        here, there = F.broadcast(here), F.broadcast(there)
    near = F.col("pull") / (1 + dx * dx + dy * dy)
    pulled = links.join(there, "other").join(here, "node").groupBy("node").agg(
        F.sum(near).alias("held"), F.sum(near * dx).alias("px"), F.sum(near * dy).alias("py")
    )
    rows = points.join(pulled, "node", "left").select("node", "x", "y", "u", "v", *[F.coalesce(name, F.lit(0.0)).alias(name) for name in ("held", "px", "py")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, u, v, held, px, py = (batch.column(k).to_numpy() for k in range(1, 8))
            push = grid.at(forces, x, y)
            held = np.maximum(pull * held, 1e-6)
            u, v = momentum * u + (pull * px + push[0]) / held, momentum * v + (pull * py + push[1]) / held
            columns = [batch.column(0), *(pa.array(value) for value in (x + u, y + v, u, v))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "x", "y", "u", "v"])

    return rows.mapInArrow(run, "node bigint, x double, y double, u double, v double")


def placed_nodes(nodes: DataFrame, count: int, neighbours: int, steps: int) -> DataFrame:
    """``(node, x, y)`` of distinct vectors."""
    spark = nodes.sparkSession
    axes = project_2d(nodes, "vector", "node").join(nodes, "node")
    oriented = stage(axes.select("node", "vector", "x", "y"), "oriented")
    graph = neighbour_graph(oriented, count, neighbours, [F.col("x"), F.col("y")])
    links = stage(pulls(graph), "pulls")
    spread = oriented.agg(F.stddev_pop("x").alias("spread")).first()["spread"] or 1.0
    # vectors that fall together on the axes must be able to part
    shaken = [F.col(name) / spread + (F.pmod(F.xxhash64("node", F.lit(name)), F.lit(1000)) - 500) * 1e-6 for name in ("x", "y")]
    start = oriented.select("node", shaken[0].alias("x"), shaken[1].alias("y"), F.lit(0.0).alias("u"), F.lit(0.0).alias("v"))
    figures = {"left": F.min("x"), "right": F.max("x"), "low": F.min("y"), "high": F.max("y")}
    with staging() as held:
        points, bounds = stage_observed(start, "map", **figures)
    for turn in range(steps):
        early = turn < EARLY * steps
        grid = Grid(tuple(bounds[name] for name in figures))
        forces = grid.forces(grid.charges(points), count)
        moved = step(points, links, grid, forces, PULL if early else 1.0, MOMENTUM_EARLY if early else MOMENTUM, count <= POINTS)
        moved = moved.coalesce(-(-count // POINTS))  # few points need few tasks, however many partitions shuffles have
        with staging() as after:
            points, bounds = stage_observed(moved, "map", **figures)
        drop_staged(spark, held)
        held = after
    return points.select("node", "x", "y")


def neighbour_map(
    rows: DataFrame, vector: str = "embedding", item_id: str = "item_id", scale: float = 1.0, neighbours: int = NEIGHBOURS, steps: int = STEPS
) -> DataFrame:
    """``(item_id, x, y)`` such that rows near each other stay so; times ``scale``.

    Equal vectors share a place. Rows without a vector, or with NULL or a number that is not finite in
    it, get NULL. All vectors must have one length. The middle of the map is at zero. Sums of floats
    depend on the order of rows, so two runs may differ in small ways that grow; the picture is the
    same only in what lies near what.
    """
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    known = F.col(vector).isNotNull() & (F.size(vector) > 0) & finite
    items = rows.select(F.col(item_id).alias("item"), F.when(known, F.col(vector).cast("array<float>")).alias("vector"))
    distinct = items.where("vector is not null").select("vector").distinct()
    nodes, count = stage_counted(distinct.select(F.monotonically_increasing_id().alias("node"), "vector"), "map-nodes")
    if not count:
        return items.select(F.col("item").alias(item_id), *[F.lit(None).cast("double").alias(name) for name in ("x", "y")])
    placed = placed_nodes(nodes, count, neighbours, steps)
    middle = placed.agg(F.avg("x").alias("x"), F.avg("y").alias("y")).first()
    centred = placed.select("node", *[((F.col(name) - middle[name]) * F.lit(scale)).alias(name) for name in ("x", "y")])
    return items.join(nodes, "vector", "left").join(centred, "node", "left").select(F.col("item").alias(item_id), "x", "y")
