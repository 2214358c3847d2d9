"""Connected components of a table of links, by alternating star steps.

Each step is a partial aggregate and a join, so no node's neighbours are ever gathered: in
the large-star step a node's larger neighbours move to its least neighbour, in the
small-star step its smaller ones and itself do. After O(log^2 n) steps every node hangs on the
least node of its component. Each round is written to the shared folder, which cuts the
lineage; the loop ends when a round changes no link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlens.session import stage_counted


def star(links: DataFrame) -> DataFrame:
    """``links`` (u > v), each larger end moved to the least end known at the other."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(least, "u")
    return (
        moved.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(links: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for every node with a link.

    ``links`` has the columns u and v, of one type with an order; loops, repeats and either
    direction are fine, NULL ends are not links.
    """
    links = (
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    links, count = stage_counted(links, label)
    while count:
        after, changed = stage_counted(star(links), label)
        same = changed == count and after.join(links, ["u", "v"], "left_anti").isEmpty()
        links, count = after, changed
        if same:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
