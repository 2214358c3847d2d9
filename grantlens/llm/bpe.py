"""Byte-level BPE encoding and decoding by a rank file.

A text is cut by the tokenizer's pattern and each piece is merged on its own. Adjacent pairs
wait in one bucket per merge rank, which holds the positions of their left parts in a linked
list of parts. A hierarchical bitmap tells the least rank with a bucket in a few
find-first-set steps, and entries whose parts have since been merged are skipped when they
come up. A piece of n bytes takes O(n log n) steps, so that one of a megabyte is no trouble.
Pieces seen before are taken from a table of bounded size.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from grantlens.llm.common import small_batches

#: A word of the bitmap has 2**SHIFT bits.
SHIFT, MASK = 8, 255
BIT = [1 << k for k in range(1 << 11)]
#: Pieces of at most so many characters are remembered, and at most so many of them.
REMEMBERED_CHARS, REMEMBERED = 48, 600_000


class Encoder(dict):
    """Piece to packed ids; a piece that is missing is merged, then remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.ranks = ranks
        self.size = max(ranks.values(), default=0) + 1
        self.bytes_of = [b""] * self.size
        self.two = {(piece[0], piece[1]): rank for piece, rank in ranks.items() if len(piece) == 2}
        self.buckets: list[list[int]] = [[] for _ in range(self.size)]
        self.words = [0] * ((self.size >> SHIFT) + 1)
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        # White space by the Unicode property, as the rank files' own libraries read it.
        self.pieces = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", self.merge(piece.encode("utf-8"))).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece.

        The queue: ``buckets`` has the positions that wait at a rank, as a heap, so that the
        leftmost comes first; a bit of ``words`` says that a rank has a bucket, a bit of
        ``top`` that a word has bits. It is empty before and after.
        """
        ranks, buckets, words, bit = self.ranks, self.buckets, self.words, BIT
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n, get, top = len(piece), ranks.get, 0
        end, before = list(range(1, n + 2)), list(range(-1, n))
        at = list(map(self.two.get, zip(piece, piece[1:], strict=False)))  # rank of the pair that begins here
        at.append(None)
        for i, rank in enumerate(at):
            if rank is not None:
                if not buckets[rank]:
                    words[rank >> SHIFT] |= bit[rank & MASK]
                    top |= bit[rank >> SHIFT]
                buckets[rank].append(i)
        while top:
            place = (top & -top).bit_length() - 1
            bits = words[place]
            lowest = bits & -bits
            rank = (place << SHIFT) + lowest.bit_length() - 1
            bucket = buckets[rank]
            i = heappop(bucket)
            if not bucket:
                bits ^= lowest
                words[place] = bits
                if not bits:
                    top ^= bit[place]
            if at[i] != rank:
                continue  # stale: one of its parts has been merged since
            middle = end[i]
            after = end[i] = end[middle]
            at[middle] = None
            if after < n:
                before[after] = i
                at[i] = rank = get(piece[i : end[after]])
                if rank is not None:
                    bucket = buckets[rank]
                    if not bucket:
                        words[rank >> SHIFT] |= bit[rank & MASK]
                        top |= bit[rank >> SHIFT]
                    heappush(bucket, i)
            else:
                at[i] = None
            if i:
                i = before[i]
                at[i] = rank = get(piece[i:after])
                if rank is not None:
                    bucket = buckets[rank]
                    if not bucket:
                        words[rank >> SHIFT] |= bit[rank & MASK]
                        top |= bit[rank >> SHIFT]
                    heappush(bucket, i)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.pieces(text)))

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file; each worker process reads the file once."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())}
    return Encoder(ranks, pattern)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (binary, little-endian unsigned 32-bit) of each row's whole text.

    A NULL text is empty and has no ids. Rows are neither joined nor shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = encoder(path, pattern).encode
        for batch in small_batches(batches):
            ids = [encode_text(value.as_py() or "") for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``decoded`` bytes of each row; NULL ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_ids = encoder(path, pattern).decode
        for batch in small_batches(batches):
            decoded = [decode_ids(value.as_py() or b"") for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")
