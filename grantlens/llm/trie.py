"""The trie of conversation prefixes, by collapsing whole sequences first.

Conversations that are equal from end to end become one sequence with a weight; only one of each
goes on. A prefix is known by its depth and the exclusive or of two hashes of each of its turns with
their places, so the keys of all prefixes are running aggregates. Aggregated prefixes of the
weighted sequences are the nodes; a sequence that is no proper prefix (an anti-join) is a leaf.

A node's saving is a sum over its subtree. Each distinct node below is counted at the sequence with
the smallest member that runs through it; those nodes are the end of that sequence, so per
sequence and depth the sum is a difference of running sums, and per node an aggregate.

Running aggregates go by blocks of ``BLOCK`` places, so that no task holds a whole conversation;
nodes on many paths (the root above all) are aggregated before they are shuffled. What ends at a
node is a stream of ids per sequence, as its digest is sequential.

Defined results: rows without a conversation id belong to none. NULL in role or text is an empty one.
Rows of one turn are taken by role and text digest; equal rows stand side by side. Other columns are
ignored. Without any conversation there is no node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.runs import EMPTY_SHA256, digest_runs
from grantlens.operators.numbering import number_rows
from grantlens.session import stage

#: Places that one window runs over.
BLOCK = 4096
#: At most so many turns of the first conversation of a group are shared, and so many conversations make a group.
HEADS, GROUP = 4, 20
WORD = r"[^\x20\x09-\x0D]+"
SEQUENCE = ["depth", "p1", "p2"]
ABOVE = {"depth": "depth_above", "p1": "q1", "p2": "q2"}


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv, place`` (from 1), role, text and number of words of each turn of ``conv_id, turn, role, text``."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    known = turns.where("conv_id is not null").select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("turn"), role.alias("role"), F.sha2(text.cast("binary"), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return number_rows(known, ["turn", "role", "digest"], ["conv"], "place").drop("turn")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and their turns after each took over the head of its group's first one.

    Of conversation c - c % 20 the first h turns come first, h being crc32 of c modulo 4, then the
    conversation's own turns after its first h.
    """
    convs = numbered.select("conv").distinct()
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    convs = stage(convs.withColumn("shared", shared), "trie-conversations")
    base = F.col("conv") - F.col("conv") % GROUP
    firsts = numbered.where(F.col("place") < HEADS).withColumnRenamed("conv", "base")
    wanted = convs.where("shared > 0").withColumn("base", base)
    heads = wanted.join(firsts, "base").where("place <= shared")
    found = convs.join(heads.groupBy("conv").agg(F.count(F.lit(1)).alias("found")), "conv", "left").fillna(0, ["found"])
    own = numbered.join(found, "conv").where("place > shared").withColumn("place", F.col("place") - F.col("shared") + F.col("found"))
    names = ["conv", "place", "role", "digest", "words"]
    return convs.select("conv"), own.select(*names).unionByName(heads.select(*names))


def prefixes(turns: DataFrame, weighted: DataFrame) -> DataFrame:
    """Every prefix of the weighted sequences: its key, the key above it, words so far and in its last turn."""
    rows = turns.join(weighted.select(F.col("conv_id").alias("conv")), "conv")
    rows = rows.withColumn("block", F.floor((F.col("place") - 1) / F.lit(BLOCK)))
    parts = rows.groupBy("conv", "block").agg(F.bit_xor("x1").alias("b1"), F.bit_xor("x2").alias("b2"), F.sum("words").alias("bw"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    known = parts.select(
        "conv", "block", F.coalesce(F.bit_xor("b1").over(before), zero).alias("b1"), F.coalesce(F.bit_xor("b2").over(before), zero).alias("b2"),
        F.coalesce(F.sum("bw").over(before), zero).alias("bw"),
    )
    inside = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.select(
        "conv", "block", "place", "x1", "x2", "words", F.bit_xor("x1").over(inside).alias("r1"), F.bit_xor("x2").over(inside).alias("r2"),
        F.sum("words").over(inside).alias("rw"),
    )
    p1, p2 = F.col("r1").bitwiseXOR(F.col("b1")), F.col("r2").bitwiseXOR(F.col("b2"))
    found = run.join(known, ["conv", "block"]).select(
        F.col("conv").alias("conv_id"), F.col("place").alias("depth"), p1.alias("p1"), p2.alias("p2"),
        p1.bitwiseXOR(F.col("x1")).alias("q1"), p2.bitwiseXOR(F.col("x2")).alias("q2"),
        (F.col("rw") + F.col("bw")).alias("total"), "words",
    )
    none = F.lit(None).cast("bigint")
    root = weighted.select(
        "conv_id", *[zero.alias(name) for name in SEQUENCE], none.alias("q1"), none.alias("q2"), zero.alias("total"), zero.alias("words")
    )
    return found.unionByName(root)


def collapsed(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences with a weight (by their smallest conversation), and the sequence of every conversation."""
    whole = turns.groupBy("conv").agg(
        F.count(F.lit(1)).alias("depth"), F.bit_xor("x1").alias("p1"), F.bit_xor("x2").alias("p2"), F.sum("words").alias("all_words")
    )
    members = stage(convs.join(whole, "conv", "left").fillna(0), "trie-members")
    weighted = members.groupBy(*SEQUENCE).agg(
        F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("all_words").alias("all_words")
    )
    return stage(weighted, "trie-sequences"), members


def prefix_nodes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences ``turns`` (``conv, place, role, digest, words``) of ``convs``.

    The last turn of a node is turn ``depth`` of conversation ``conv_id``.
    """
    said = ["place", "role", "digest"]
    # the constant first, so that the second hash does not follow from the first
    turns = stage(
        turns.select("conv", "place", F.xxhash64(*said).alias("x1"), F.xxhash64(F.lit("again"), *said).alias("x2"), "words"), "trie-turns"
    )
    weighted, members = collapsed(convs, turns)
    paths = stage(prefixes(turns, weighted), "trie-prefixes")
    sequences = weighted.select("conv_id", F.col("depth").alias("length"), "weight", "all_words")
    through = paths.join(sequences, "conv_id")
    nodes = stage(
        through.groupBy(*SEQUENCE).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("length").alias("longest"),
            F.min("total").alias("total"), F.min("words").alias("words"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        ),
        "trie-nodes",
    )
    inner = nodes.where("longest > depth").select(*SEQUENCE)
    leaves = weighted.join(inner, SEQUENCE, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    # a sequence's own nodes are its last ones; before them it has so many words
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("own_from"), F.min_by(F.col("total") - F.col("words"), "depth").alias("own_before"))
    facts = sequences.join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
    left = F.col("all_words") - (F.col("total") - F.col("words"))
    once = F.when(F.col("own_from").isNull(), 0).when(F.col("depth") >= F.col("own_from"), left).otherwise(F.col("all_words") - F.col("own_before"))
    sums = paths.join(facts, "conv_id").groupBy(*SEQUENCE).agg(
        F.sum(F.coalesce("leaf", F.lit(0))).cast("bigint").alias("n_leaves"), F.sum(F.col("weight") * left - once).alias("saved_tokens")
    )
    return stage(with_parents(nodes).join(sums, SEQUENCE).join(ends(members), SEQUENCE, "left"), "trie-result").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def with_parents(nodes: DataFrame) -> DataFrame:
    """Nodes with their number of children and the conversation of the node above."""
    above = nodes.where("depth > 0").withColumn("depth_above", F.col("depth") - 1)
    children = above.groupBy(*ABOVE.values()).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.withColumnsRenamed({there: here for here, there in ABOVE.items()})
    parents = nodes.select("conv_id", *SEQUENCE).withColumnsRenamed({"conv_id": "parent_conv_id", **ABOVE})
    placed = above.join(parents, list(ABOVE.values())).select(*SEQUENCE, "conv_id", "n_convs", "parent_conv_id")
    root = nodes.where("depth = 0").select(*SEQUENCE, "conv_id", "n_convs", F.lit(None).cast(nodes.schema["conv_id"].dataType).alias("parent_conv_id"))
    return placed.unionByName(root).join(children, SEQUENCE, "left").fillna(0, ["n_children"])


def ends(members: DataFrame) -> DataFrame:
    """The digest of the ids of each sequence's conversations, in ascending order."""
    ids = members.select(*SEQUENCE, "conv", F.col("conv").cast("string").alias("id"))
    return digest_runs(ids.repartition(*SEQUENCE).sortWithinPartitions(*SEQUENCE, "conv"), SEQUENCE, "id", b",", "ends_sha256")


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt conversations; ``turns`` has ``conv_id, turn, role, text``."""
    convs, built = rebuilt(numbered_turns(turns))
    return prefix_nodes(convs, built)


def node_turns(nodes: DataFrame, turns: DataFrame, names: Sequence[str] = ("role", "digest")) -> DataFrame:
    """Nodes with what their last turn says; the root says nothing."""
    last = turns.select(F.col("conv").alias("conv_id"), F.col("place").alias("depth"), *names)
    return nodes.join(last, ["conv_id", "depth"], "left")
