"""The flows from end to end.

Frames are lazy, but operators that work in steps stage tables while a frame is built. A flow
run by :func:`written` drops what it staged once its result is written.

Pages to the deduplicated grant table is :func:`grantlens.operators.extract.convert`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.functions.templates import grant_text
from grantlens.operators import graph, layout, points, vectors
from grantlens.session import drop_staged, stage, staging


def place_texts(
    rows: DataFrame, text: str = "text", encoder=None, landmarks: DataFrame | None = None, scale: float = 1.0, method: str = "axes"
) -> DataFrame:
    """``(item_id, x, y)`` of texts: among ``landmarks``, or by ``method`` on their main axes or by neighbours."""
    embedded = stage(vectors.embed_text(rows, text, encoder=encoder), "embedding")
    if landmarks is not None:
        return vectors.place_by_landmarks(embedded, landmarks)
    if method not in METHODS:
        raise ValueError(f"unknown method {method}; one of {', '.join(METHODS)}")
    return METHODS[method](embedded, scale=scale)


#: How texts are laid out in two dimensions.
METHODS = {"axes": vectors.project_2d, "neighbours": layout.neighbour_map}


def grant_map(
    grants: DataFrame, item_id: str = "item_id", template: str = "abstract", encoder=None,
    landmarks: DataFrame | None = None, scale: float = 1.0, method: str = "axes",
) -> DataFrame:
    """Flat grant rows as merged points, placed by their texts.

    ``item_id`` names a unique column.
    """
    rows = grants.withColumn("item_id", F.col(item_id))
    texts = rows.select("item_id", grant_text(template).alias("text"))
    return points.merged_points(rows, place_texts(texts, encoder=encoder, landmarks=landmarks, scale=scale, method=method))


def network_map(
    grant_rows: DataFrame, grants: DataFrame, papers: DataFrame, links: DataFrame, citations: DataFrame | None = None,
    pid_column: str = "pid", scope: str = "all", encoder=None, landmarks: DataFrame | None = None, method: str = "axes",
) -> DataFrame:
    """Stores and a grant list as network points, placed by the item texts."""
    items = stage(graph.items(grant_rows, grants, papers, links, pid_column, scope), "items")
    placed = place_texts(items.select("item_id", "text"), encoder=encoder, landmarks=landmarks, method=method)
    return points.network_points(items, placed, citations)


def written(spark: SparkSession, flow: Callable[[], DataFrame], path: str) -> DataFrame:
    """The result of ``flow`` as a table at ``path``; nothing that the flow staged is left."""
    with staging() as paths:
        try:
            flow().write.mode("overwrite").parquet(path)
        finally:
            drop_staged(spark, paths)
    return spark.read.parquet(path)
