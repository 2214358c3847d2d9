"""Byte-level BPE and packing, against the public tokenizer libraries."""

import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from grantlens.llm import bpe, catalog, packing

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(1)
    return [
        "", " ", "a", "  \n\n x ", "\x1c\x1d \x85z", "don't WE'LL 12345 été 漢字 😀", "a" * 100_000, "ab" * 30_000,
        "".join(draw.choice("abc") for _ in range(50_000)), "<|endoftext|>", " " * 3000,
    ]


def test_merges_equal_the_library(reference):
    own = bpe.encoder(PATH, PATTERN)
    for text in odd_texts():
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_merges_in_an_order_that_ranks_do_not_suggest():
    """A longer piece may rank before its parts."""
    ranks = {bytes([b]): 300 + b for b in range(97, 101)} | {b"bc": 5, b"abc": 1, b"ab": 9, b"cd": 2}
    own = bpe.Encoder(ranks, PATTERN)
    library = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcabc", "bcd", "aabcd", "cdbcabcd"):
        assert own.merge(text.encode()) == library.encode_ordinary(text)


def test_encode_rows(spark, reference):
    rows = [(k, text, "clash") for k, text in enumerate(odd_texts())] + [(None, "x", None), (50, None, None), (50, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = bpe.decode(bpe.encode(frame, PATH, PATTERN), PATH, PATTERN).collect()
    assert len(found) == len(rows)
    texts = {row[0]: row[1] or "" for row in rows}
    for row in found:
        text = texts[row["doc_id"]]
        assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == reference.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
    assert bpe.encode(frame.limit(0), PATH, PATTERN).count() == 0


def check_packed(rows, capacity):
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append(row)
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        end = 0
        for row in sorted(pieces, key=lambda row: row["offset"]):
            assert row["offset"] == end
            end += row["length"]
        assert end <= capacity
    return len(sequences)


def test_pack_documents(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = catalog.QUERIES["op7_packing"](spark, SF).collect()
    used = check_packed(rows, packing.CAPACITY)
    pieces = defaultdict(list)
    for row in rows:
        pieces[row["doc_id"]].append(row)
    total = 0
    for doc in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = [*library.encode(doc["text"] or "", add_special_tokens=False).ids, 1]
        total += len(ids)
        end = 0
        for row in sorted(pieces[doc["doc_id"]], key=lambda row: row["start"]):
            assert row["start"] == end and row["doc_tokens"] == len(ids)
            assert row["ids_crc32"] == zlib.crc32(np.array(ids[end : end + row["length"]], "<u4").tobytes())
            end += row["length"]
        assert end == len(ids)
    assert used * packing.CAPACITY < 1.02 * total


def test_ids_equal_the_library_on_odd_texts(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    frame = spark.createDataFrame([(k, text) for k, text in enumerate(odd_texts())], "doc_id long, text string")
    pieces = packing.token_pieces(frame, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN, {"<|endoftext|>": 50256})
    found = defaultdict(bytes)
    for row in pieces.orderBy("doc_id", "start").collect():
        found[row["doc_id"]] += bytes(row["ids"])
    for k, text in enumerate(odd_texts()):
        assert np.frombuffer(found[k], "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_ids_equal_the_library_on_long_white_space(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + " " * 2_000_000 + "b", "a  " + "\n" * 1_100_000, "\u3000 " * 600_000 + "x", " \t" * 600_000 + "<|endoftext|> it's", "\x1c" * 1_100_000 + " " * 200_000 + "\x1f 1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.token_pieces(frame, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN, {"<|endoftext|>": 50256})
    found = defaultdict(bytes)
    for row in pieces.orderBy("doc_id", "start").collect():
        found[row["doc_id"]] += bytes(row["ids"])
    for k, text in enumerate(texts):
        assert np.frombuffer(found[k], "<u4").tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("lengths", [[1] * 5000, [2048] * 3, [1500, 700, 700, 3, 3, 3], [5] * 700 + [2000] * 30, []])
def test_pack_lengths(spark, lengths):
    frame = spark.createDataFrame([(k // 2, k, n) for k, n in enumerate(lengths)], "doc_id long, start long, length long")
    rows = packing.pack(frame).collect()
    assert sorted(row["length"] for row in rows) == sorted(lengths)
    used = check_packed(rows, packing.CAPACITY)
    assert used <= -(-sum(lengths) // packing.CAPACITY) + 2


def test_patterns_hold_the_histogram_and_stay_few():
    draw = random.Random(5)
    histogram = {length: draw.randrange(1, 10**6) for length in range(1, 2049)}
    patterns = packing.pack_histogram(histogram)
    held = defaultdict(int)
    for pattern in patterns:
        assert sum(length * times for length, times in pattern.runs) <= 2048
        for length, times in pattern.runs:
            held[length] += times * pattern.count
    assert held == histogram and len(patterns) <= 3 * 2048


def test_sequences(spark):
    frame = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    pieces = packing.token_pieces(frame, public_tokenizers.path("byte_bpe_50k.tiktoken"), PATTERN)
    rows = packing.sequences(packing.pack(pieces)).collect()
    assert len(rows) == 1 and np.frombuffer(bytes(rows[0]["ids"]), "<u4").tolist().count(1) == 2
