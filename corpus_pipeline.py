"""From raw documents to packed sequences, in five stages.

Each stage takes the documents that the one before kept and is written as a table before the
next begins. A stage keeps the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm import catalog, exact, packing, quality, simhash, suffix
from grantlens.llm.common import plain_names, table
from grantlens.session import staged_folder


def own_names(stage):
    """``stage`` with the columns that it does not know set aside, so that none of them is taken for one of its own."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(spark, plain_names(docs, "doc_id", "text", "n_chars"), sf_dir).toDF(*docs.columns)

    return run


@own_names
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on their own texts and labels.

    Where there is nothing to fit it on, all stay.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if model is None:
        return docs
    return quality.score(docs, model).where("predicted = 1").select(*docs.columns)


@own_names
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the smallest id."""
    return exact.kept_documents(docs)


@own_names
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; a NULL id comes last.

    A row is known by its id and text, as ids may repeat. What goes is the smaller part, so it
    is that part which is joined to the texts.
    """
    known = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    groups = simhash.near_groups(docs.select(known.alias("doc_id"), "text"))
    gone = groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.id", "doc_id.hash")
    same = docs["doc_id"].eqNullSafe(gone["id"]) & (F.xxhash64(docs["text"]) == gone["hash"])
    return docs.join(gone, same, "left_anti")


@own_names
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that occur elsewhere too; a text with nothing left goes.

    Where a cut leaves part of a character, that part goes as well; U+FFFD of the text stays.
    """
    cut = suffix.remove_repeats(docs)
    # U+FFFD of the text is written as \x01 and 1 meanwhile, and \x01 as \x01 and 0
    whole = F.col("kept").cast("string")
    for old, new in (("\x01", "\x010"), ("\ufffd", "\x011")):
        whole = F.replace(whole, F.lit(old), F.lit(new))
    whole = F.call_function("make_valid_utf8", whole)
    for old, new in (("\ufffd", ""), ("\x011", "\ufffd"), ("\x010", "\x01")):
        whole = F.replace(whole, F.lit(old), F.lit(new))
    changed = F.col("n_removed") > 0
    left = cut.where("n_removed = 0 or n_removed < n_bytes").withColumn("text", F.when(changed, whole).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces in sequences."""
    return packing.pack(catalog.digest_pieces(docs))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("suffix_dedup", without_repeats),
    ("packing", packed),
]

#: No SQL says what the classifier, the fingerprints, the suffix order and the packing do.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = staged_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
