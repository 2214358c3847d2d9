import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.operators import vectors


def matrix(spark, n=60, d=5, seed=3):
    values = np.random.default_rng(seed).normal(size=(n, d)) * np.arange(1, d + 1)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(values.astype("float32"))]
    return values.astype("float32").astype("float64"), spark.createDataFrame(rows, "item_id int, embedding array<float>")


def test_project_2d_equals_main_axes(spark):
    values, rows = matrix(spark)
    found = vectors.project_2d(rows, scale=2.0).orderBy("item_id").toPandas()
    _, axes = np.linalg.eigh(np.cov(values.T))
    for name, axis in (("x", axes[:, -1]), ("y", axes[:, -2])):
        expected = values @ axis * 2.0
        assert np.allclose(found[name], expected * np.sign(axis[abs(axis).argmax()]))


def test_place_by_landmarks_equals_brute_force(spark, monkeypatch):
    values, rows = matrix(spark)
    marks = np.random.default_rng(5).normal(size=(7, 5))
    table = spark.createDataFrame([([float(v) for v in m], float(i), float(i * i)) for i, m in enumerate(marks)], "embedding array<double>, x double, y double")
    found = vectors.place_by_landmarks(rows, table, k=2).orderBy("item_id").toPandas()
    for i, v in enumerate(values):
        similarity = marks @ v / np.linalg.norm(marks, axis=1) / np.linalg.norm(v)
        best = np.argsort(-similarity)[:2]
        weights = np.maximum(similarity[best], 0)
        weights = weights / weights.sum() if weights.sum() else np.array([0.5, 0.5])
        assert found["x"][i] == pytest.approx(weights @ best)
        assert found["y"][i] == pytest.approx(weights @ best**2)
    for blocks in ((2, 7, 64), (3, 1000, 1), (1000, 1000, 2)):
        for name, size in zip(("LANDMARK_BLOCK", "ROW_BLOCK", "PIVOT_MARKS"), blocks, strict=True):
            monkeypatch.setattr(vectors, name, size)
        again = vectors.place_by_landmarks(rows, table, k=2).orderBy("item_id").toPandas()
        assert np.allclose(again[["x", "y"]], found[["x", "y"]])
    with pytest.raises(ValueError):
        vectors.place_by_landmarks(rows, table.limit(0))


def test_few_blocks_are_opened_where_vectors_lie_in_clusters(spark, monkeypatch):
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(24, 16))
    marks, values = (np.vstack([centres[k % 24] + 0.1 * draw.normal(size=16) for k in range(n)]) for n in (480, 400))
    values[7], marks[9] = 0, 0  # of no direction
    marks[100:104] = marks[100]
    table = spark.createDataFrame([([float(v) for v in m], float(i % 50), float(i)) for i, m in enumerate(marks)], "embedding array<double>, x double, y double")
    rows = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(values)], "item_id int, embedding array<double>")
    monkeypatch.setattr(vectors, "PIVOT_MARKS", 10)
    opened, step = [], vectors.compared
    monkeypatch.setattr(vectors, "compared", lambda found, *rest: opened.append(found.count()) or step(found, *rest))
    found = vectors.place_by_landmarks(rows, table, k=4).orderBy("item_id").toPandas()
    assert len(opened) == 2 and sum(opened) < 400 * 48 / 3
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
    alike, at = unit(values) @ unit(marks).T, np.array([[i % 50, i] for i in range(480)], float)
    for i in range(400):
        best = np.lexsort((at[:, 1], at[:, 0], -np.round(alike[i], 12)))[:4]
        weights = np.maximum(alike[i][best], 0)
        weights = weights if weights.sum() > 0 else np.ones(4)
        assert found.loc[i, ["x", "y"]].to_numpy(float) == pytest.approx(weights @ at[best] / weights.sum(), rel=1e-6)


def test_rows_without_a_vector_get_no_place(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 2.0])], "item_id int, embedding array<float>")
    table = spark.createDataFrame([([1.0, 0.0], 5.0, 6.0)], "embedding array<double>, x double, y double")
    for placed in (vectors.place_by_landmarks(rows, table), vectors.project_2d(rows)):
        assert [row["x"] is None for row in placed.orderBy("item_id").collect()] == [False, True, False]


def test_embed_text(spark):
    texts = [(0, "cancer research cancer"), (1, "aging research"), (2, "Cancer, RESEARCH cancer!"), (3, None)]
    rows = spark.createDataFrame(texts, "item_id int, text string")
    found = {row["item_id"]: np.array(row["embedding"]) for row in vectors.embed_text(rows, dimensions=64).collect()}
    assert all(len(vector) == 64 for vector in found.values())
    assert np.allclose(found[0], found[2]) and not np.allclose(found[0], found[1])
    assert np.linalg.norm(found[0]) == pytest.approx(1, abs=1e-6) and not found[3].any()
    weights = sorted(v for v in found[0] if v)
    idf = [np.log(5 / 4), 2 * np.log(5 / 3)]
    assert np.allclose(weights, np.array(idf) / np.linalg.norm(idf), atol=1e-6)


def test_embed_with_an_encoder_in_batches(spark):
    def make_encoder():
        def encode(batch):
            assert 0 < len(batch) <= 3
            return np.array([[len(text), 1.0] for text in batch])

        return encode

    rows = spark.range(20).select(F.col("id").alias("item_id"), F.repeat(F.lit("a"), F.col("id").cast("int")).alias("text"))
    found = vectors.embed_text(rows, encoder=make_encoder, batch_size=3)
    assert {row["item_id"]: row["embedding"] for row in found.collect()} == {i: [float(i), 1.0] for i in range(20)}
