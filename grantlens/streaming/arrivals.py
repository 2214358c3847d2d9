"""Two-key dedupe (D1) kept up to date while pages arrive in any order.

What a first-wins reading keeps up to some place does not depend on what comes after it. So a batch
changes nothing before its earliest row, its cut. The rows from the cut on, old and new, are read again,
after those kept rows before the cut that hold a key of theirs; the result is that of a full run.

The store is a log: a batch writes the rows it has read again, with their fates, and then its cut, which
commits it. A row of an older batch counts as long as no later batch has a cut at or before it, so
the present state is a filter over the log: the store is neither shuffled nor rewritten, and a batch that
fails and is tried again overwrites its own folder only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from grantlens.operators.dedupe import keyed_rows, two_key_status
from grantlens.operators.skew import null_safe_join
from grantlens.session import drop_staged, stage, staging


def place_of(order_by: Sequence[str]) -> Column:
    return F.struct(*order_by)


class DedupeLog:
    """The log below ``path`` of rows with ``order_by`` (unique), ``project`` and ``core``; other columns are carried."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, project: str, core: str, order_by: Sequence[str]) -> None:
        self.spark, self.path, self.project, self.core, self.order_by = spark, path.rstrip("/"), project, core, list(order_by)
        self.columns = schema.fieldNames()
        self.row_schema = StructType([*schema.fields]).add("status", "string")
        self.cut_schema = StructType([schema[name] for name in self.order_by])

    def _folder(self, kind: str, schema: StructType) -> DataFrame | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return self.spark.read.schema(StructType([*schema.fields]).add("batch", "long")).parquet(f"{self.path}/{kind}")

    def fates(self, before: int | None = None) -> DataFrame:
        """Every row taken so far (by batches before ``before``) with its ``status``: keep, project or core."""
        cuts, rows = self._folder("cuts", self.cut_schema), self._folder("rows", self.row_schema)
        if cuts is None or rows is None:
            return self.spark.createDataFrame([], self.row_schema)
        # one row for each batch
        known = sorted(cuts.collect(), key=lambda row: row["batch"])
        known = [row for row in known if before is None or row["batch"] < before]
        bounds = []
        for row in known:
            place = F.struct(*[F.lit(row[name]).cast(self.cut_schema[name].dataType).alias(name) for name in self.order_by])
            bounds.append((row["batch"], place))
        found = None
        for k, (batch, _) in enumerate(bounds):
            part = rows.where(F.col("batch") == batch)
            later = [place for _, place in bounds[k + 1 :]]
            if later:
                part = part.where(place_of(self.order_by) < (F.least(*later) if len(later) > 1 else later[0]))
            found = part if found is None else found.unionByName(part)
        return self.spark.createDataFrame([], self.row_schema) if found is None else found.drop("batch")

    def take(self, arriving: DataFrame, batch: int) -> None:
        """Add a batch of rows, numbered in the order of batches; a row with a place seen before replaces the old one."""
        with staging() as staged:
            try:
                self._take(arriving, batch)
            finally:
                drop_staged(self.spark, staged)

    def _take(self, arriving: DataFrame, batch: int) -> None:
        place = place_of(self.order_by)
        new = stage(arriving.select(*self.columns), "arriving")
        cut = new.agg(F.min(place).alias("cut")).first()["cut"]
        if cut is None:
            return
        at = F.struct(*[F.lit(cut[name]).cast(self.cut_schema[name].dataType).alias(name) for name in self.order_by])
        known = self.fates(batch)
        later = known.where(place >= at).select(*self.columns)
        replaced = new.select(*[F.col(name).alias(f"_new_{name}") for name in self.order_by])
        same = [F.col(name).eqNullSafe(F.col(f"_new_{name}")) for name in self.order_by]
        again = stage(later.join(replaced, same, "left_anti").unionByName(new), "replayed")
        held = keyed_rows(known.where((place < at) & (F.col("status") == "keep")), self.project, self.core)
        wanted = keyed_rows(again, self.project, self.core)
        # both halves are filters by distinct keys; a row that matches both comes once
        by_project = held.join(wanted.select("_p").distinct(), "_p", "left_semi").select(*self.columns, "_p", "_c")
        by_core = held.join(wanted.select("_c").distinct(), "_c", "left_semi").join(wanted.select("_p").distinct(), "_p", "left_anti")
        holders = by_project.unionByName(by_core.select(*self.columns, "_p", "_c")).select(*self.columns)
        every = holders.unionByName(again)
        status = two_key_status(every, self.project, self.core, self.order_by)
        found = null_safe_join(again, status, self.order_by).select(*self.columns, "status")
        found.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
        new.select(*[F.lit(cut[name]).cast(self.cut_schema[name].dataType).alias(name) for name in self.order_by]).limit(1).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/cuts/batch={batch}")

    def follow(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        """Start a run that takes all rows of a stream not yet taken, then stops."""
        return (
            rows.writeStream.foreachBatch(self.take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
