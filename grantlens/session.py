"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "grantlens", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators expect: UTC, AQE, skew-join splitting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Where that is unset the folder is below ``spark.sql.warehouse.dir``, which all executors
    of a cluster share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def staged_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one table, noted for :func:`drop_staged`."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for flow in _FLOWS.get():
        flow.append(path)
    return path


#: Tables staged by the flows that are open, innermost last.
_FLOWS: ContextVar[tuple[list[str], ...]] = ContextVar("flows", default=())


@contextmanager
def staging() -> Iterator[list[str]]:
    """Collects what is staged inside, so that it can be dropped once the result is written."""
    paths: list[str] = []
    token = _FLOWS.set((*_FLOWS.get(), paths))
    try:
        yield paths
    finally:
        _FLOWS.reset(token)


def drop_staged(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove tables noted by :func:`staging`; nothing may read them any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, which cuts its lineage.

    Unlike a cached block the table outlives any executor, and its columns can be
    pruned when it is read again.
    """
    staged, _ = stage_observed(df, label)
    return staged


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Like :func:`stage`, with the row count taken during the write."""
    staged, seen = stage_observed(df, label, rows=F.count(F.lit(1)))
    return staged, seen["rows"]


def stage_observed(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict]:
    """Like :func:`stage`, with aggregates taken during the write."""
    spark = df.sparkSession
    path = staged_folder(spark, label)
    seen = Observation()
    watched = df.observe(seen, *[value.alias(name) for name, value in figures.items()]) if figures else df
    watched.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get if figures else {}
