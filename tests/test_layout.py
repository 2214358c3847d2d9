"""Neighbour graph and non-linear map, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.operators import layout, neighbours, vectors
from grantlens.plans import flows
from grantlens.session import stage


def clusters(n=900, d=12, kinds=9, seed=4):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(kinds, d)) * 2
    return (centres[np.arange(n) % kinds] + draw.normal(size=(n, d))).astype(np.float32).astype(np.float64)


def frame(spark, values, schema="item_id long, embedding array<float>"):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(values)], schema)


def distances(values):
    away = ((values[:, None] - values[None]) ** 2).sum(-1)
    np.fill_diagonal(away, np.inf)
    return away


def trustworthiness(values, placed, k=10):
    n = len(values)
    rank = np.argsort(np.argsort(distances(values), axis=1), axis=1)
    near = np.argsort(distances(placed), axis=1)[:, :k]
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(np.take_along_axis(rank, near, 1) + 1 - k, 0).sum()


@pytest.mark.parametrize("block", [512, 64])
def test_neighbour_graph(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    values = clusters()
    nodes = stage(frame(spark, values, "node long, vector array<float>"), "test-nodes")
    links = neighbours.neighbour_graph(nodes, len(values), 8).toPandas()
    away = distances(values)
    assert np.allclose(links["away"], away[links["node"], links["other"]], rtol=1e-4, atol=1e-4)
    assert (links.groupby("node").size() == 8).all() and not links.duplicated(["node", "other"]).any()
    true = np.argsort(away, axis=1)[:, :8]
    found = links.groupby("node")["other"].apply(set)
    assert np.mean([len(found[i] & set(true[i])) / 8 for i in range(len(values))]) > 0.9


def test_neighbourhoods_are_dealt_to_tasks_by_size(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "MEMBER_NUMBERS", 1 << 14)
    dealt, whole = [], neighbours.offered
    monkeypatch.setattr(neighbours, "offered", lambda *given: dealt.append(whole(*given)) or dealt[-1])
    for n in (300, 900):  # shuffles have four partitions at any size
        nodes = stage(frame(spark, clusters(n), "node long, vector array<float>"), "nodes")
        assert neighbours.neighbour_graph(nodes, n, 8).count() == n * 8
        assert "REPARTITION_BY_NUM" in (plan := dealt[-1]._jdf.queryExecution().executedPlan().toString())
        assert "hashpartitioning(at#" in plan and f", {-(-2 * 8 * n * 12 // (1 << 14))})" in plan


def test_neighbours_of_few(spark):
    for count in (1, 2, 4):
        nodes = stage(frame(spark, clusters(count), "node long, vector array<float>"), "test-nodes")
        assert neighbours.neighbour_graph(nodes, count, 8).count() == count * (count - 1)


def test_shares_have_the_perplexity_wanted():
    away = np.sort(np.random.default_rng(1).random((50, 15)) * 1e4, axis=1)
    away[0, 3:] = np.inf
    away[1] = 7.0
    shares = layout.shares_of(away)
    assert np.allclose(shares.sum(1), 1) and (shares[0, 3:] == 0).all() and np.allclose(shares[1], 1 / 15)
    spread = -(shares * np.log(np.maximum(shares, 1e-300))).sum(1)
    assert np.allclose(np.exp(spread[2:]), 5, rtol=1e-3)


def test_pushes_equal_sums_over_all_pairs(spark):
    points = np.random.default_rng(2).normal(size=(400, 2)) * 6
    table = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    grid = layout.Grid((points[:, 0].min(), points[:, 0].max(), points[:, 1].min(), points[:, 1].max()))
    charges = grid.charges(table)
    assert charges.sum() == pytest.approx(400)
    found = grid.at(grid.forces(charges, 400), points[:, 0], points[:, 1])
    apart = points[:, None] - points[None]
    close = 1 / (1 + (apart**2).sum(-1))
    expected = ((close**2)[..., None] * apart).sum(1) * 400 / (close.sum() - 400)
    assert np.linalg.norm(found.T - expected) < 0.05 * np.linalg.norm(expected)


def test_pulls_are_symmetric_shares(spark):
    links = [(i, j, float(abs(i - j))) for i in range(30) for j in range(i - 3, i + 4) if j != i and 0 <= j < 30]
    found = layout.pulls(spark.createDataFrame(links, neighbours.LINKS)).collect()
    pull = {(row["node"], row["other"]): row["pull"] for row in found}
    assert sum(pull.values()) == pytest.approx(30)
    assert all(pull[j, i] == pytest.approx(value) for (i, j), value in pull.items())


def test_map_keeps_neighbours_better_than_axes(spark):
    values = clusters(d=24, kinds=14)
    rows = frame(spark, values)
    odd = spark.createDataFrame([(9000, None), (9001, [None] * 24), (9002, [float("nan")] * 24)], rows.schema)
    copies = rows.where("item_id < 300").withColumn("item_id", F.lit(7000) + F.col("item_id") % 3).withColumn("embedding", F.lit(None).cast("array<float>"))
    same = rows.where("item_id = 5").select(F.explode(F.sequence(F.lit(8005).cast("long"), F.lit(8405).cast("long"))).alias("item_id"), "embedding")
    every = rows.unionByName(odd).unionByName(copies).unionByName(same).withColumn("vector", F.lit("clash"))
    placed = layout.neighbour_map(every, steps=15).toPandas()
    assert len(placed) == 900 + 3 + 300 + 401
    assert placed[(placed.item_id >= 9000) | placed.item_id.between(7000, 7002)]["x"].isna().all()
    again = placed[(placed.item_id == 5) | placed.item_id.between(8005, 8405)]
    assert len(again) == 402 and again[["x", "y"]].nunique().max() == 1
    mine = placed[placed.item_id < 900].sort_values("item_id")[["x", "y"]].to_numpy()
    axes = vectors.project_2d(rows).orderBy("item_id").toPandas()[["x", "y"]].to_numpy()
    assert trustworthiness(values, mine) > trustworthiness(values, axes) + 0.05


def test_map_of_nothing_and_of_one(spark):
    rows = frame(spark, clusters(1))
    assert layout.neighbour_map(rows.limit(0)).count() == 0
    assert layout.neighbour_map(rows.withColumn("embedding", F.lit(None).cast("array<float>"))).first()["x"] is None
    assert tuple(layout.neighbour_map(rows, steps=2).first()) == (0, 0.0, 0.0)


def test_flows_know_their_methods(spark):
    rows = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    with pytest.raises(ValueError):
        flows.place_texts(rows, method="unheard")
