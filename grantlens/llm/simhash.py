"""SimHash fingerprints, and the groups that links at a few differing bits make of them.

Distinct fingerprints are put in Gray order, in which consecutive ones share masked bit
patterns: here the bits in front. Such a shared pattern is an upper node of the index. A
fingerprint visits a node only while the bits in which it differs from the patterns above add
up to at most the distance allowed, so whole groups are left out at once. Nodes with more
fingerprints than a task should hold get children of a longer pattern, until all are small
(or one fingerprint is left): how deep the index is follows the data, and it stays a table.

Within a node a task searches by the same rule over its sorted fingerprints and returns a
spanning forest of the links found, never all pairs. Components of the forests are those of
all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import byte_values, small_batches
from grantlens.llm.components import components
from grantlens.session import stage, stage_counted

BITS = 64
SHINGLE, SEED = 3, 42
MOST_BITS = 2
#: A node of the index with more fingerprints is divided by so many further bits.
NODE, STEP = 32_768, 4
#: Words taken at a time in a long text; pairs compared at a time in a node.
WORDS, PAIRS = 200_000, 2_000_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the XXH64 of all word shingles, repeats included."""
    words = text.lower().split()  # on bytes: A-Z, and ASCII white space
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - shingle + 1
    ones = np.zeros(BITS, np.int64)
    for start in range(0, total, WORDS):
        part = words[start : start + WORDS + shingle - 1]
        lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
        begins = np.concatenate(([0], np.cumsum(lengths)))
        n = len(part) - shingle + 1
        joined = b" ".join(part)
        pieces = map(joined.__getitem__, map(slice, begins[:n].tolist(), (begins[shingle:] - 1).tolist()))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED, n)), np.uint64, n)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint's 64 bits as a signed long. NULL texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            found = [fingerprint(value, shingle) for value in byte_values(batch.column(1))]
            signed = pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["doc_id", "fp"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def front(bits: Column, depth: int) -> Column:
    """The first ``depth`` bits, as a number."""
    return F.shiftrightunsigned(bits, BITS - depth) if depth else F.lit(0).cast("long")


def patterns(width: int, most: int) -> list[tuple[int, int]]:
    """All masks of ``width`` bits with at most ``most`` ones, each with its count of ones."""
    found = [(0, 0)]
    last = [(0, 0, -1)]
    for _ in range(most):
        last = [(mask | 1 << bit, ones + 1, bit) for mask, ones, top in last for bit in range(top + 1, width)]
        found += [(mask, ones) for mask, ones, _ in last]
    return found


def flipped(width: int, most: int) -> Column:
    pairs = [F.struct(F.lit(mask).cast("long").alias("mask"), F.lit(ones).alias("ones")) for mask, ones in patterns(width, most)]
    return F.array(*pairs)


def visits(fps: DataFrame, count: int, most: int) -> list[tuple[int, DataFrame]]:
    """Per depth of the index: ``node``, ``fp`` and the bits ``spent`` of who visits its leaves.

    ``fps`` is staged and holds ``count`` distinct fingerprints. A pair of nodes is visited in
    one direction only.
    """
    root = fps.select(F.lit(0).cast("long").alias("node"), "fp", F.lit(0).alias("spent"))
    if count <= NODE:
        return [(0, root)]
    leaves, depth, parents = [], 0, root
    while True:
        depth += STEP
        own = front(F.col("fp"), depth)
        # the own child of the visitor below this node, and those its remaining bits reach
        child = F.shiftleft("node", STEP).bitwiseOR(own.bitwiseAND(F.lit((1 << STEP) - 1))).bitwiseXOR(F.col("flip.mask"))
        going = (
            parents.withColumn("flip", F.explode(flipped(STEP, most)))
            .select(child.alias("node"), "fp", (F.col("spent") + F.col("flip.ones")).alias("spent"))
            .where((F.col("spent") <= most) & (F.col("node") <= own))
        )
        sizes = stage(fps.groupBy(own.alias("node")).agg(F.count(F.lit(1)).alias("held")), "gray-nodes")
        found = stage(going.join(sizes, "node"), "gray-visits")
        small = F.col("held") <= NODE
        leaves.append((depth, found.where(small).select("node", "fp", "spent")))
        if sizes.where(~small).isEmpty():
            return leaves
        parents = found.where(~small).select("node", "fp", "spent")


def ones(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def gray_rank(values: np.ndarray) -> np.ndarray:
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def forest(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """For links a-b between numbers below ``size``: the least number reachable from each."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def search_node(held: np.ndarray, comers: np.ndarray, spent: np.ndarray, depth: int, most: int) -> np.ndarray:
    """Links between visitors and the fingerprints of one node, as rows (fp, fp) of a forest.

    The node's fingerprints are in Gray order. Below the node the next bits form its children;
    a visitor looks into the children whose pattern it can still afford.
    """
    width = int(min(BITS - depth, max(0, np.ceil(np.log2(max(len(held), 1) / 8)))))
    below = np.uint64((1 << width) - 1)
    shift = np.uint64(BITS - depth - width if depth + width < BITS + 1 and width else 0)
    child = ((held >> shift) & below).astype(np.int64)
    order = np.argsort(child, kind="stable")  # children are runs in Gray order; by number they can be looked up
    begin = np.searchsorted(child[order], np.arange((1 << width) + 1))
    everyone = np.unique(np.concatenate((held, comers)))
    own = ((comers >> shift) & below).astype(np.int64)
    links = np.zeros((0, 2), np.int64)
    for mask, cost in patterns(width, most):
        who = np.flatnonzero(spent + cost <= most)
        target = own[who] ^ mask
        counts = begin[target + 1] - begin[target]
        who, target, counts = who[counts > 0], target[counts > 0], counts[counts > 0]
        ends = np.cumsum(counts)
        at = 0
        while at < len(who):
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + PAIRS, "right")))
            n = counts[at:to]
            left = np.repeat(comers[who[at:to]], n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[target[at:to]], n)
            right = held[order[place]]
            near = (ones(left ^ right) <= most) & (left != right)
            if near.any():
                new = np.searchsorted(everyone, np.stack((left[near], right[near]), 1))
                links = np.concatenate((links, new))
                if len(links) > PAIRS:
                    links = spanning(links, len(everyone))
            at = to
    return everyone[spanning(links, len(everyone))]


def spanning(links: np.ndarray, size: int) -> np.ndarray:
    label = forest(links[:, 0], links[:, 1], size)
    node = np.flatnonzero(label != np.arange(size))
    return np.stack((node, label[node]), 1)


def near_links(fps: DataFrame, count: int, most: int = MOST_BITS) -> DataFrame:
    """Links ``u``, ``v`` whose components are those of all pairs at ``most`` or fewer bits.

    ``fps`` is staged and holds ``count`` distinct fingerprints.
    """
    links = None
    for depth, going in visits(fps, count, most):
        held = fps.select(front(F.col("fp"), depth).alias("node"), "fp", F.lit(-1).alias("spent"))
        held = held.join(going.select("node").distinct(), "node", "left_semi")

        def run(batches: Iterator[pa.RecordBatch], depth: int = depth) -> Iterator[pa.RecordBatch]:
            for rows in nodes_of(batches):
                fp, spent = rows[:, 1].view(np.uint64), rows[:, 2]
                own = np.sort(gray_rank(fp[spent < 0]))
                own ^= own >> np.uint64(1)  # the fingerprints again, in Gray order
                found = search_node(own, fp[spent >= 0], spent[spent >= 0], depth, most)
                signed = found.view(np.int64)
                if len(signed):
                    yield pa.RecordBatch.from_arrays([pa.array(signed[:, 0].copy()), pa.array(signed[:, 1].copy())], ["u", "v"])

        together = held.unionByName(going).repartition("node").sortWithinPartitions("node")
        part = together.mapInArrow(run, "u long, v long")
        links = part if links is None else links.unionByName(part)
    return links


def nodes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The rows (node, fp, spent) of one node after another, from batches sorted by node."""
    kept: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], 1)
        cuts = np.flatnonzero(np.diff(rows[:, 0])) + 1
        parts = np.split(rows, cuts)
        for part in parts:
            if kept and len(part) and kept[-1][0, 0] != part[0, 0]:
                yield np.concatenate(kept)
                kept = []
            if len(part):
                kept.append(part)
    if kept:
        yield np.concatenate(kept)


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most: int = MOST_BITS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` per row of ``docs``.

    Copies share a fingerprint, so only distinct ones are searched. A text without words has
    fingerprint zero and is linked like any other. The component's id is its smallest
    ``doc_id``, NULL only if none of its rows has one.
    """
    marked = stage(fingerprints(docs, doc_id, text, shingle), "simhash")
    first, count = stage_counted(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(near_links(first.select("fp"), count, most), "simhash-links")
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(labels, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
