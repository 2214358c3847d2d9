"""Packing of token pieces into sequences, shortest pack first, over the histogram of lengths.

A text of more ids than a sequence holds is cut into full pieces and one rest. Only the
histogram of piece lengths, one entry per possible length, comes to the driver. There lengths
are placed longest first, each into the packs with most room left; packs that look alike are
one pattern with a count. A length changes few patterns, so there are at most three patterns
for each possible length, whatever the number of pieces. Pieces then take the places of their
length by rank, and ranks are counted per length and part, so that a length which a third of
all pieces share is numbered in many tasks.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from grantlens.llm.common import partitions, plain_names, small_batches

CAPACITY = 2048
END = 1
#: From so many white-space characters on, a run is encoded by itself: the library's pattern overflows its stack near a million.
LONG_RUN = 100_000
#: White space as the library's pattern has it (Python's \s has four more).
RUNS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> tiktoken.Encoding:
    """The rank file's encoding; one per worker process."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def encoded(text: str, path: str, pattern: str, special: tuple[tuple[str, int], ...]) -> list[int]:
    """The ids of a text, with white-space runs of any length.

    ``pattern`` takes a run of white space as one piece: whole at the end of a text, else
    without its last character, which may begin the next piece. Long runs are cut there.
    """
    own, known = tokenizer(path, pattern, special), dict(special)
    names = [name for name in known if name in text]
    if len(text) < LONG_RUN or all(run.end() - run.start() < LONG_RUN for run in RUNS.finditer(text)):
        return own.encode(text, allowed_special=set(known)) if names else own.encode_ordinary(text)
    whole, ids = tokenizer(path, r"[\s\S]+", ()), []
    for part in re.split("(" + "|".join(map(re.escape, names)) + ")", text) if names else [text]:
        if part in known:
            ids.append(known[part])
            continue
        begin = 0
        for run in RUNS.finditer(part):
            end = run.end() - (run.end() < len(part))
            if run.end() - run.start() >= LONG_RUN:
                ids += own.encode_ordinary(part[begin : run.start()]) + whole.encode_ordinary(part[run.start() : end])
                begin = end
        ids += own.encode_ordinary(part[begin:])
    return ids


PIECE = "doc_id {}, start long, length long, doc_tokens long, ids binary"


def token_pieces(
    docs: DataFrame,
    path: str,
    pattern: str,
    special: dict[str, int] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each text followed by ``end``.

    ``ids`` are little-endian unsigned 32-bit integers. Strings in ``special`` have their own
    id. A NULL text is empty and has one id, the end.
    """
    known = tuple(sorted((special or {}).items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 200):
            rows: list[tuple] = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encoded(value or "", path, pattern, known)
                ids.append(end)
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    rows.append((key, start, len(piece), len(ids), array("I", piece).tobytes()))
            if rows:
                kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "doc_tokens", "ids"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, PIECE.format(kind))


class Pattern:
    """``count`` packs that hold the same lengths: runs of (length, how often)."""

    def __init__(self, count: int, runs: tuple[tuple[int, int], ...]) -> None:
        self.count, self.runs = count, runs


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold each length as often as the histogram says."""
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        room = capacity
        while left and room >= length:
            while room >= length and not by_room.get(room):
                room -= 1
            if room < length:
                break
            pattern = by_room[room].pop()
            taken = min(left, pattern.count)
            if taken < pattern.count:
                by_room[room].append(Pattern(pattern.count - taken, pattern.runs))
            runs = pattern.runs
            if runs and runs[-1][0] == length:
                runs = (*runs[:-1], (length, runs[-1][1] + 1))
            else:
                runs = (*runs, (length, 1))
            by_room[room - length].append(Pattern(taken, runs))
            left -= taken
        each = capacity // length
        full, rest = divmod(left, each)
        if full:
            by_room[capacity - each * length].append(Pattern(full, ((length, each),)))
        if rest:
            by_room[capacity - rest * length].append(Pattern(1, ((length, rest),)))
    return [pattern for room in sorted(by_room) for pattern in by_room[room]]


def places(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, first sequence, packs, first offset) in order of length and rank."""
    found, ranks, sequence = [], defaultdict(int), 0
    for pattern in patterns:
        offset = 0
        for length, times in pattern.runs:
            found.append((length, ranks[length], sequence, pattern.count, offset))
            ranks[length] += times * pattern.count
            offset += times * length
        sequence += pattern.count
    rows = np.array(sorted(found), np.int64).reshape(-1, 5)
    return rows


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``, from 0 without gaps within each length."""
    spark = pieces.sparkSession
    mean = max(1, sum(histogram.values()) // partitions(spark))
    # a length is dealt out in parts of a mean partition: in all, one part per length and per partition at most
    parts = spark.createDataFrame([(n, -(-count // mean)) for n, count in histogram.items()], "length long, parts long")
    others = [c for c, kind in pieces.dtypes if not kind.startswith(("map", "variant"))]
    dealt = pieces.join(F.broadcast(parts), "length").withColumn("part", F.pmod(F.xxhash64(*others), F.col("parts")))
    counts = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy(*others)
    numbered = dealt.withColumn("nth", F.row_number().over(within))
    return numbered.join(F.broadcast(firsts), ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth") - 1).select(*pieces.columns, "rank")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; their ``length`` is from 1 to ``capacity``.

    ``pieces`` is read three times, so it should be a written table. Repeated rows each get a
    place; which of them gets which is not told apart.
    """
    given = pieces.drop("sequence_id", "offset")
    pieces = plain_names(given, "length")
    # one row per length, so at most ``capacity`` of them
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    table = places(pack_histogram(histogram, capacity))
    wide = 1 << 48
    keys = table[:, 0] * wide + table[:, 1]
    names = pieces.columns
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(len(names)).to_numpy()
            row = table[np.searchsorted(keys, batch.column(at).to_numpy() * wide + rank, "right") - 1]
            times, copy = np.divmod(rank - row[:, 1], row[:, 3]) if len(row) else (rank, rank)
            arrays = [pa.array(row[:, 2] + copy), pa.array(row[:, 4] + times * row[:, 0])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *arrays], [*names, "sequence_id", "offset"])

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked(pieces, histogram).mapInArrow(run, schema).toDF(*given.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids``, the pieces of each sequence joined in order; ``packed`` has ``ids``."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"]))
    return held.select("sequence_id", joined.alias("ids"))
