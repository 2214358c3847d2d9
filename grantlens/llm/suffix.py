"""Removal of every byte string of a given length that starts more than once in the corpus.

Sorting the suffixes at all positions would move each text a hundred times over. Instead each
window of that length is sorted through its anchor: the k-gram in it with the least hash, the
leftmost of them. Equal windows have equal anchors at equal places, so windows meet where
suffixes at anchors meet, and neighbouring windows mostly share one. Steps:

1. Every text's anchors, as slim rows; those whose k-gram occurs once go.
2. The text around each other anchor, that is all windows it stands for, is sent to the task
   of its k-gram. Copies of a whole text are looked at once, with their number.
3. There the anchors' suffixes, and their reversed prefixes, are put in order by deep-shallow
   sorting. A window that begins l bytes before its anchor occurs again where another anchor
   shares l bytes before and the remaining bytes after; both are runs of the two orders.
4. The spans go back to the texts.

A k-gram with more anchors than a task should hold (a sample of the slim rows tells) is dealt
out by its windows' contents instead: their 128-bit digests are counted with partial sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from grantlens.llm.common import byte_values, plain_names, small_batches
from grantlens.llm.sorting import deep_shallow
from grantlens.session import stage

LENGTH, GRAM = 200, 40
#: A k-gram with more anchors is counted by windows; one in SAMPLED slim rows is looked at for this.
HEAVY, SAMPLED = 20_000, 16
#: Bytes of text taken at a time, and anchors sorted at a time (more if one k-gram has more).
BUFFER, SORTED = 2_000_000, 20_000
#: Bits of a position in the texts taken at a time, and of a distance within a window.
POSITION_BITS, NEAR_BITS = 30, 16
NEAR = (1 << NEAR_BITS) - 1


def grams(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes at each position; ``size`` is a multiple of eight."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view("<u8")[:, 0]
    n = len(data) - size + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(0, size, 8):
        mixed ^= eight[k : k + n]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows in the texts: text number, k-gram and packed place of each anchor.

    A place is packed as position, bytes from the first window's begin, bytes from the last's.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    none = np.zeros(0, np.int64)
    if not len(texts) or ends[-1] < length:
        return none, none, none
    if ends[-1] >> POSITION_BITS:
        raise ValueError(f"a text has {int(sizes.max())} bytes; up to {BUFFER} fewer than {1 << POSITION_BITS} can be taken")
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes = grams(data, gram)
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = sliding_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    valid = np.zeros(len(least), bool)
    for begin, end in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if end - begin >= length:
            valid[begin : end - length + 1] = True
    windows = np.flatnonzero(valid)
    if not len(windows):
        return none, none, none
    place = (least[windows] & low).astype(np.int64)
    cuts = np.flatnonzero(np.diff(place)) + 1
    first, last = np.concatenate(([0], cuts)), np.concatenate((cuts - 1, [len(place) - 1]))
    at = place[first]
    text = np.searchsorted(ends, at, "right")
    packed = ((at - (ends - sizes)[text]) << 2 * NEAR_BITS) | ((at - windows[first]) << NEAR_BITS) | (at - windows[last])
    return text, hashes[at].view(np.int64), packed


def text_keys(text: str) -> list[Column]:
    """128 bits that stand for a text: two hashes from different seeds, as a constant comes first in one."""
    value = F.coalesce(F.col(text), F.lit("")) if text else None
    return [F.xxhash64(value).alias("k1"), F.xxhash64(F.lit(1), value).alias("k2")]


def anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Slim rows (gram, k1, k2, place) of every anchor; ``docs`` has k1, k2 and text."""

    def found(texts: list[bytes], keys: list[list[tuple[int, int]]]) -> pa.RecordBatch:
        text, key, place = anchors(texts, length, gram)
        of = np.array(keys, np.int64).reshape(-1, 2)[text]
        return pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(of[:, 0].copy()), pa.array(of[:, 1].copy()), pa.array(place)], ["gram", "k1", "k2", "place"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, keys, held = [], [], 0
        for batch in small_batches(batches):
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for pair, value in zip(pairs, byte_values(batch.column(2)), strict=True):
                if len(value) < length:
                    continue
                texts.append(value)
                keys.append(pair)
                held += len(value)
                if held >= BUFFER:
                    yield found(texts, keys)
                    texts, keys, held = [], [], 0
        if texts:
            yield found(texts, keys)

    return docs.select("k1", "k2", "text").mapInArrow(run, "gram long, k1 long, k2 long, place long")


CONTEXT = "gram long, around binary, k1 long, k2 long, place long, copies long"


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """The text around each place; ``texts`` has k1, k2, text, places and copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 100):
            rows: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in (0, 1, 3, 4)]
            for value, k1, k2, places, copies in zip(byte_values(batch.column(2)), *columns, strict=True):
                for entry in places:
                    place = entry["place"]
                    at, before, least = place >> 2 * NEAR_BITS, place >> NEAR_BITS & NEAR, place & NEAR
                    rows.append((entry["gram"], value[at - before : at - least + length], k1, k2, place, copies))
            if rows:
                arrays = [pa.array(list(c), pa.binary() if k == 1 else pa.int64()) for k, c in enumerate(zip(*rows, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, ["gram", "around", "k1", "k2", "place", "copies"])

    return texts.select("k1", "k2", "text", "places", "copies").mapInArrow(run, CONTEXT)


def repeated_windows(gram: np.ndarray, around: list[bytes], place: np.ndarray, copies: np.ndarray, length: int):
    """Per anchor the least and greatest distance to the begin of a repeated window; -1 for none."""
    before, least = place >> NEAR_BITS & NEAR, place & NEAR
    numbers: dict[tuple, int] = {}
    kind = np.fromiter(
        (numbers.setdefault(key, len(numbers)) for key in zip(gram.tolist(), before.tolist(), around, strict=True)), np.int64, len(gram)
    )
    total = np.bincount(kind, weights=copies).astype(np.int64)
    first = np.full(len(numbers), -1, np.int64)
    first[kind[::-1]] = np.arange(len(kind))[::-1]
    gram, before, least = gram[first], before[first], least[first]
    around = [around[k] for k in first.tolist()]
    near, far = np.where(total > 1, least, -1), np.where(total > 1, before, -1)
    group = np.unique(gram, return_inverse=True)[1]
    mixed = np.bincount(group)[group] > 1  # groups with texts that differ around the anchor
    some = np.flatnonzero(mixed)
    if len(some):
        g, b, t, n = group[some], before[some], least[some], total[some]
        strings = [around[k] for k in some.tolist()]
        after, shared = deep_shallow(g, [s[k:] for s, k in zip(strings, b.tolist(), strict=True)], 64)
        back, held = deep_shallow(g, [s[:k][::-1] for s, k in zip(strings, b.tolist(), strict=True)], 16)
        right, left = np.empty(len(some), np.int64), np.empty(len(some), np.int64)
        low, high = near[some], far[some]
        for distance in range(int(t.min()), int(b.max()) + 1):
            live = np.flatnonzero((t <= distance) & (distance <= b))
            if not len(live):
                continue
            right[after] = np.cumsum(shared < length - distance)
            left[back] = np.cumsum(held < distance)
            both = right[live] * (len(some) + 1) + left[live]
            order = np.argsort(both, kind="stable")
            ranked = both[order]
            start = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
            count = np.add.reduceat(n[live][order], start)
            again = live[order[np.repeat(count > 1, np.diff(np.append(start, len(ranked))))]]
            low[again] = np.where(low[again] < 0, distance, np.minimum(low[again], distance))
            high[again] = np.maximum(high[again], distance)
        near[some], far[some] = low, high
    return near[kind], far[kind]


def sorted_spans(rows: DataFrame, length: int) -> DataFrame:
    """Spans (k1, k2, start, stop) of the repeated windows at the anchors in ``rows``."""

    def spans(parts: list[pa.Table]) -> pa.RecordBatch:
        held = pa.concat_tables(parts)
        gram, k1, k2, place, copies = (held[c].to_numpy() for c in ("gram", "k1", "k2", "place", "copies"))
        near, far = repeated_windows(gram, held["around"].to_pylist(), place, copies, length)
        hit = np.flatnonzero(far >= 0)
        at = place[hit] >> 2 * NEAR_BITS
        return pa.RecordBatch.from_arrays(
            [pa.array(k1[hit]), pa.array(k2[hit]), pa.array(at - far[hit]), pa.array(at - near[hit] + length)],
            ["k1", "k2", "start", "stop"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        held = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            gram = table["gram"].to_numpy()
            if held >= SORTED or held + len(gram) >= 2 * SORTED:
                # cut where a k-gram ends: what waits, with the rest of its last k-gram, is whole
                last = parts[-1]["gram"][-1].as_py() if parts else gram[0]
                cut = int(np.searchsorted(gram != last, True)) if gram[0] == last else 0
                if cut < len(gram):
                    whole = [*parts, table.slice(0, cut)] if cut else parts
                    if whole:
                        yield spans(whole)
                    parts, held = [], 0
                    table = table.slice(cut)
            parts.append(table)
            held += table.num_rows
        if parts:
            yield spans(parts)

    together = rows.repartition("gram").sortWithinPartitions("gram")
    return together.mapInArrow(run, "k1 long, k2 long, start long, stop long")


def counted_spans(rows: DataFrame, length: int) -> DataFrame:
    """The same for k-grams with very many anchors: windows are counted by their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1000):
            out: list[tuple] = []
            for around, k1, k2, place, copies in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 4, 5)), strict=True):
                at, before = place >> 2 * NEAR_BITS, place >> NEAR_BITS & NEAR
                for k in range(len(around) - length + 1):
                    digest = hashlib.blake2b(around[k : k + length], digest_size=16).digest()
                    out.append((digest, k1, k2, at - before + k, copies))
            if out:
                arrays = [pa.array(list(c), pa.binary() if k == 0 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, ["digest", "k1", "k2", "start", "copies"])

    kind = "digest binary, k1 long, k2 long, start long, copies long"
    windows = stage(rows.mapInArrow(run, kind), "suffix-windows")
    again = windows.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1").select("digest")
    return windows.join(again, "digest", "left_semi").select("k1", "k2", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(docs: DataFrame, doc_id: str, text: str, length: int, gram: int = GRAM) -> DataFrame:
    """``k1``, ``k2`` and ``spans``: where each text holds windows that start elsewhere too."""
    keyed = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"), *text_keys(text))
    slim = stage(anchor_rows(keyed, length, gram), "suffix-anchors")
    sample = slim.where(F.pmod(F.xxhash64("k1", "k2", "place"), F.lit(SAMPLED)) == 0).groupBy("gram").count()
    heavy = stage(sample.where(F.col("count") > HEAVY // SAMPLED).select("gram"), "suffix-heavy")
    has_heavy = not heavy.isEmpty()
    usual = slim.join(heavy, "gram", "left_anti") if has_heavy else slim
    counted = usual.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("n > 1").drop("n")
    if has_heavy:
        counted = counted.unionByName(slim.join(heavy, "gram", "left_semi"))
    places = counted.groupBy("k1", "k2").agg(F.collect_set(F.struct("gram", "place")).alias("places"))
    copies = keyed.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    wanted = places.join(copies, ["k1", "k2"])
    same = (keyed["k1"] == wanted["k1"]) & (keyed["k2"] == wanted["k2"]) & keyed["id"].eqNullSafe(wanted["first"])
    texts = keyed.join(wanted, same).select(keyed["k1"], keyed["k2"], "text", "places", "copies")
    around = contexts(texts, length)
    if has_heavy:
        around = stage(around, "suffix-contexts")
        spans = sorted_spans(around.join(heavy, "gram", "left_anti").select("gram", "around", "k1", "k2", "place", "copies"), length)
        heavy_rows = around.join(heavy, "gram", "left_semi").select("gram", "around", "k1", "k2", "place", "copies")
        spans = spans.unionByName(counted_spans(heavy_rows, length))
    else:
        spans = sorted_spans(around, length)
    return spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    runs: list[list[int]] = []
    for start, stop in sorted((span["start"], span["stop"]) for span in spans or ()):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], stop)
        else:
            runs.append([start, stop])
    return [(start, stop) for start, stop in runs]


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Each row of ``docs`` with ``kept`` (the bytes that stay), ``n_bytes``, ``n_removed``, ``n_spans``.

    Removed is each byte covered by a string of ``length`` bytes that also starts anywhere
    else, in the same text or another; repeats are judged on the input, overlaps count, and
    every occurrence goes. A NULL text is empty; texts shorter than ``length`` stay whole.
    Rows with one id and different texts are different texts. Columns named like those added
    are replaced.
    """
    if not gram <= length <= NEAR:
        raise ValueError(f"strings of {length} bytes; from {gram} to {NEAR} can be found")
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    plain = plain_names(docs)
    names = dict(zip(docs.columns, plain.columns, strict=True))
    return _without(plain, names[doc_id], names[text], length, gram).toDF(*docs.columns, "kept", "n_bytes", "n_removed", "n_spans")


def _without(docs: DataFrame, doc_id: str, text: str, length: int, gram: int) -> DataFrame:
    """The same for columns that are named c0, c1, ...; those of its own begin with an underscore."""
    spans = stage(repeated_spans(docs, doc_id, text, length, gram), "suffix-spans")
    k1, k2 = text_keys(text)
    joined = docs.withColumns({"_k1": k1, "_k2": k2})
    joined = joined.join(spans.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_spans")), ["_k1", "_k2"], "left")
    joined = joined.select(*docs.columns, "_spans")
    place, width = docs.columns.index(text), len(docs.columns)
    added = [StructField("kept", BinaryType())] + [StructField(c, LongType()) for c in ("n_bytes", "n_removed", "n_spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 200):
            kept, counts = [], []
            for value, found in zip(byte_values(batch.column(place)), batch.column(width).to_pylist(), strict=True):
                runs = merged(found)
                edges = [0, *(edge for run in runs for edge in run), len(value)]
                kept.append(b"".join(value[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                counts.append((len(value), len(value) - len(kept[-1]), len(runs)))
            numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            names = [*batch.schema.names[:width], "kept", "n_bytes", "n_removed", "n_spans"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(kept, pa.binary()), *numbers], names)

    return joined.mapInArrow(run, StructType([*docs.schema.fields, *added]))
