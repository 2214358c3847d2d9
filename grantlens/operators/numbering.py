"""Exact row and batch numbers without one task ever holding a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.operators.skew import null_safe_join
from grantlens.session import stage, stage_counted

ROW_BITS = 33
#: Groups and partitions up to which the counts of pieces go to every task.
BROADCAST_PIECES = 65_536


def ordered(rows: DataFrame, order_by: Sequence[str], name: str = "ord") -> DataFrame:
    """Add a bigint that grows in the order of ``order_by`` (unique, with gaps).

    Rows are range-partitioned and sorted, so partition and place give the order.
    Stage the result before using it twice: a second run may cut ranges elsewhere.
    """
    return rows.orderBy(*order_by).withColumn(name, F.monotonically_increasing_id())


def number_rows(
    rows: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "row_number"
) -> DataFrame:
    """``row_number`` from 1 per ``partition_by`` in the order of ``order_by``.

    A window would bring each group into one task. Here a range sort spreads even one
    huge group over many partitions; each (partition, group) piece is counted, and the
    counts of the pieces before it give its offset. ``order_by`` must be unique within
    a group.
    """
    placed = stage(ordered(rows, [*partition_by, *order_by], "_place"), "numbered")
    placed = placed.withColumn("_piece", F.shiftright("_place", ROW_BITS))
    pieces, n_pieces = stage_counted(
        placed.groupBy("_piece", *partition_by).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")), "pieces"
    )
    # One row per piece: a group has at most as many as there are partitions.
    before = Window.partitionBy(*partition_by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "_piece", *partition_by, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    if n_pieces <= BROADCAST_PIECES:  # else both sides are moved, which the rows are spared here
        offsets = F.broadcast(offsets)
    number = F.col("_place") - F.col("_first") + F.col("_before") + 1
    return (
        null_safe_join(placed, offsets, ["_piece", *partition_by])
        .withColumn(name, number)
        .select(*rows.columns, name)
    )


def number_batches(
    rows: DataFrame, size: int, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "batch"
) -> DataFrame:
    """Consecutive batches of ``size`` rows, numbered from 0 per ``partition_by``."""
    numbered = number_rows(rows, order_by, partition_by, "_number")
    return numbered.withColumn(name, F.floor((F.col("_number") - 1) / F.lit(size)).cast("int")).drop("_number")
