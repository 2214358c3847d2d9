"""Exact dedup by content sort, in DataFrame functions alone.

The normalised texts are range-partitioned by sampled splitters, sorted (spilling to disk),
and compared in full with their neighbours. What is sorted is the first bytes, then a hash,
then the whole text, so that a splitter is short however long the texts are, and texts that
begin alike still spread.

A text whose copies hold more than half of a mean partition would meet in one task. There are
at most two such texts per partition; their copies are first merged by an aggregate with
partial sums. Only their smallest row is sorted with the others; the rest already knows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from grantlens.llm.common import partitions, plain_names, text_or_empty

#: ASCII white space, each run of which counts as one space.
SPACES = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 32
#: A row counts as its text and so many bytes besides.
ROW_BYTES = 64


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(text), SPACES, " ")


def heavy_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame | None:
    """Texts with more than half of a mean partition's bytes: hash, digest, least id, rows.

    None if there are none. The result has at most two rows for each shuffle partition.
    """
    spark = docs.sparkSession
    most = 2 * partitions(spark)
    seen = Observation()
    sizes = (
        docs.select(
            F.xxhash64(normalised(text)).alias("_hash"), (F.octet_length(text_or_empty(text)) + ROW_BYTES).alias("_bytes")
        )
        .groupBy("_hash")
        .agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
        .observe(seen, F.sum("_bytes").alias("bytes"))
    )
    largest = sizes.orderBy(F.desc("_bytes")).limit(most).collect()
    least = (seen.get["bytes"] or 0) / most
    found = [(row["_hash"],) for row in largest if row["_rows"] > 1 and row["_bytes"] > least]
    if not found:
        return None
    rows = docs.select(F.col(doc_id).alias("_id"), normalised(text).alias("_norm")).withColumn("_hash", F.xxhash64("_norm"))
    return (
        rows.join(F.broadcast(spark.createDataFrame(found, "_hash long")), "_hash", "left_semi")
        .groupBy("_hash", "_norm")
        .agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_rows"))
        .select("_hash", F.sha2("_norm", 256).alias("_digest"), "_least", "_rows")
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if identical after each run of ASCII white space becomes one space; NULL
    counts as empty. The row with the smallest id stays; of rows repeated with that id, one
    does. A NULL id comes after all others: ``keep_id`` is NULL only if no copy has an id.
    Other columns are returned as they are, except that columns named like those added are
    replaced, and that rows known to go before the sort have a NULL text.
    """
    docs = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    plain = plain_names(docs)
    names = dict(zip(docs.columns, plain.columns, strict=True))
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    return _deduped(plain, names[doc_id], names[text]).select(*plain.columns, *added).toDF(*docs.columns, *added)


def _deduped(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The same for columns that are named c0, c1, ...; those of its own begin with an underscore."""
    heavy = heavy_texts(docs, doc_id, text)
    rows = docs.withColumn("_norm", normalised(text)).withColumn("_hash", F.xxhash64("_norm"))
    if heavy is None:
        rows = rows.withColumns(
            {"_gone": F.lit(False), "_digest": F.lit(None).cast("string"), "_least": F.lit(None).cast(docs.schema[doc_id].dataType), "_rows": F.lit(None).cast("long")}
        )
    else:
        others = [c for c, kind in docs.dtypes if c != text and not kind.startswith(("map", "variant"))]
        same = (rows["_hash"] == heavy["_hash"]) & (F.sha2(rows["_norm"], 256) == heavy["_digest"])
        rows = rows.join(F.broadcast(heavy), same, "left").drop(heavy["_hash"])
        rows = rows.withColumn("_gone", F.col("_digest").isNotNull() & ~F.col(doc_id).eqNullSafe(F.col("_least")))
        rows = rows.withColumn("_hash", F.when(F.col("_gone"), F.xxhash64(*others)).otherwise(F.col("_hash")))
    rows = rows.withColumns(
        {
            "_prefix": F.when(~F.col("_gone"), F.substring("_norm", 1, PREFIX_CHARS)),
            text: F.when(~F.col("_gone"), F.col(text)),
        }
    ).drop("_norm")
    placed = rows.repartitionByRange("_prefix", "_hash").withColumn("_norm", F.when(~F.col("_gone"), normalised(text)))
    copies = Window.partitionBy("_prefix", "_hash", "_norm")
    in_order = copies.orderBy(F.col(doc_id).asc_nulls_last())
    return (
        placed.withColumns(
            {
                "_nth": F.row_number().over(in_order),
                "_first": F.first(doc_id).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
                "_count": F.count(F.lit(1)).over(copies),
            }
        )
        .withColumns(
            {
                "keep_id": F.when(F.col("_digest").isNotNull(), F.col("_least")).otherwise(F.col("_first")),
                "group_size": F.coalesce("_rows", "_count"),
                "kept": ~F.col("_gone") & (F.col("_nth") == 1),
                "text_sha256": F.coalesce("_digest", F.sha2("_norm", 256)),
            }
        )
        .drop("_prefix", "_hash", "_norm", "_gone", "_digest", "_least", "_rows", "_nth", "_first", "_count")
    )


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return exact_dedup(docs, doc_id, text).where("kept").select(*docs.columns)
