"""Learnt vectors against a singular value decomposition; token counts against a plain loop."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.operators import semantic, vectors
from grantlens.plans import inputs

FOLDER = "/root/testdata/sf0.001"


def place(token, dimensions):
    return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dimensions


def slow_counts(text, dimensions):
    return Counter(place(token, dimensions) for token in re.split(r"[\W_]+", (text or "").lower()) if token)


def matrix_of(sparse, dimensions):
    rows = sparse.orderBy("item_id").collect()
    matrix = np.zeros((len(rows), dimensions))
    for k, row in enumerate(rows):
        matrix[k, row["places"]] = row["values"]
    return matrix


def documents(spark):
    return inputs.table(spark, FOLDER, "documents").selectExpr("doc_id AS item_id", "text")


def test_token_counts(spark):
    texts = ["", None, " .,", "a", "a b a", "long " * 50_000 + "end", " ".join(f"w{k % 700}" for k in range(9000))]
    rows = spark.createDataFrame([(k, text, "clash") for k, text in enumerate(texts)], "item_id int, text string, places string")
    for row in vectors.token_counts(rows, "text", "item_id", 64).collect():
        expected = slow_counts(texts[row["item_id"]], 64)
        assert row["places"] == sorted(expected) and row["counts"] == [expected[p] for p in sorted(expected)]


def test_each_token_of_a_batch_is_hashed_once(spark):
    texts = ["É é İ ǅ ß x😀y 12 ½ a_b", "a b A", "a b A"]
    rows = spark.createDataFrame([(text,) for text in texts], "item_id string").selectExpr("item_id", "item_id AS text")
    counted = vectors.token_counts(rows, "text", "item_id", 1000)
    assert "md5(" not in counted._jdf.queryExecution().optimizedPlan().toString()  # it was taken for every token of a row
    split = rows.select("text", F.array_remove(F.split(F.lower("text"), vectors.BETWEEN_TOKENS), "").alias("tokens")).collect()
    tokens = {row["text"]: row["tokens"] for row in split}
    for row in counted.collect():
        hits = [int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 1000 for token in tokens[row["item_id"]]]
        assert row["places"] == sorted(set(hits)) and row["counts"] == [hits.count(place) for place in sorted(set(hits))]


def test_no_row_is_shuffled(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(vectors, "stage_counted", lambda frame, label: (plans.append(frame) or frame, 200))
    plans.append(vectors.embed_text(documents(spark)))
    for frame in plans:
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()


def test_directions_equal_singular_vectors(spark):
    sparse = semantic.sparse_texts(documents(spark), dimensions=128)
    matrix = matrix_of(sparse, 128)
    axes, sizes = semantic.main_directions(sparse, 128, 8, residue=1e-9)
    _, expected_sizes, expected = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(sizes, expected_sizes[:8], rtol=1e-9)
    for found, other in zip(axes.T, expected, strict=False):
        assert found[np.abs(found).argmax()] > 0
        assert np.abs(found - other * np.sign(found @ other)).max() < 1e-6
    placed = semantic.projected(sparse, axes, kind="double").orderBy("item_id").collect()
    assert np.abs(np.array([row["embedding"] for row in placed]) - matrix @ axes).max() < 1e-9


def test_few_passes_capture_most(spark, monkeypatch):
    """The default residue is loose, but what 32 directions hold is held."""
    seen = []
    passes = semantic.multiplied
    monkeypatch.setattr(semantic, "multiplied", lambda *a: seen.append(1) or passes(*a))
    sparse = semantic.sparse_texts(documents(spark), dimensions=512)
    axes, _ = semantic.main_directions(sparse, 512, 32)
    matrix = matrix_of(sparse, 512)
    sizes = np.linalg.svd(matrix, compute_uv=False)
    assert len(seen) <= semantic.PASSES and ((matrix @ axes) ** 2).sum() > 0.999 * (sizes[:32] ** 2).sum()


def test_texts_with_the_same_words_are_near(spark):
    draw = np.random.default_rng(2)
    topics = [[f"t{t}w{k}" for k in range(12)] for t in range(3)]
    texts = [(i, " ".join(draw.choice(topics[i % 3], 8))) for i in range(90)] + [(90, None), (91, "")]
    rows = spark.createDataFrame(texts, "item_id int, text string")
    found = np.array([row["embedding"] for row in semantic.learn_vectors(rows, k=3, dimensions=256).orderBy("item_id").collect()])
    assert found.shape == (92, 3) and not found[90:].any()
    unit = found[:90] / np.linalg.norm(found[:90], axis=1, keepdims=True)
    alike = unit @ unit.T
    same = np.equal.outer(np.arange(90) % 3, np.arange(90) % 3)
    assert alike[same].mean() > 0.9 and np.abs(alike[~same]).mean() < 0.2


@pytest.mark.parametrize("texts", [[], [None, ""], ["one"], ["same words"] * 5])
def test_little_to_learn_from(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "item_id int, text string")
    found = semantic.learn_vectors(rows, k=4, dimensions=32).collect()
    assert len(found) == len(texts) and all(len(row["embedding"]) <= 4 for row in found)
