"""Equi-joins that keep NULL keys, and joins that hold when one key has very many rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SALTS = 64


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on all ``keys`` in which NULL equals NULL; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def hot_values(counts: DataFrame, key: str, total: int) -> list:
    """The keys with more rows than a mean shuffle partition, of ``total`` rows in all.

    ``counts`` has a key and ``n`` per row. There are fewer such keys than partitions,
    whatever the data size.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return [row[key] for row in counts.filter(F.col("n") * parts > total).select(key).collect()]


def key_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def salt_count(rows: DataFrame) -> int:
    """As many groups as there are shuffle partitions."""
    return max(MIN_SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def salt_of(spread_by: Column, salts: int) -> Column:
    return F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str, hot: list, spread_by: Column, salts: int | None = None
) -> DataFrame:
    """``left`` joined to ``right`` on ``key``, with the rows of hot keys spread.

    Rows of a hot key on the left go to one of ``salts`` groups by ``spread_by``, by
    default as many as there are shuffle partitions; the right side, unique in ``key``,
    is repeated once per group for those keys only.
    """
    if not hot:
        return left.join(right, key, how)
    salts = salts or salt_count(left)
    is_hot = F.col(key).isin(hot)
    left = left.withColumn("_salt", F.when(is_hot, salt_of(spread_by, salts)).otherwise(0))
    groups = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = right.withColumn("_salt", F.explode(groups))
    return left.join(right, [key, "_salt"], how).drop("_salt")
