"""Exact dedup, line dedup, license scan: DataFrame operators, against plain Python."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from grantlens.llm import exact, licenses, lines

DOCS = "doc_id long, text string, lang string"


def expected_exact(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    found = []
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(norm.encode()).hexdigest()
        order = sorted(ids, key=lambda i: (i is None, i or 0))
        found += [(i, keep, len(ids), k == 0, digest) for k, i in enumerate(order)]
    return sorted(found, key=str)


def exact_rows(frame):
    return sorted((tuple(r) for r in exact.exact_dedup(frame).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_exact_dedup_on_odd_rows(spark):
    rows = [
        (5, "a  b", "x"), (3, "a\tb", None), (4, "a b", "x"), (7, None, "x"), (6, "", "x"), (9, " ", "y"),
        (3, "a b", "z"), (None, "a b", "z"), (None, "alone", "z"), (None, "alone", "z"), (8, "x" * 200_000, "l"), (1, "x" * 200_000, "l"),
    ]
    assert exact_rows(spark.createDataFrame(rows, DOCS)) == expected_exact(rows)


def test_exact_dedup_of_a_text_that_most_rows_share(spark):
    rows = [(i, "the  same text" if i % 3 else f"text {i % 50}", "x") for i in range(600)] + [(1, "the same\ntext", "y")]
    frame = spark.createDataFrame(rows, DOCS)
    assert exact.heavy_texts(frame, "doc_id", "text") is not None
    assert exact_rows(frame) == expected_exact(rows)


def test_exact_dedup_keeps_columns_and_replaces_its_own(spark):
    frame = spark.createDataFrame([(1, "a", 5, True), (2, "a", 6, False)], "doc_id long, text string, keep_id long, kept boolean")
    found = exact.exact_dedup(frame)
    assert sorted(found.columns) == sorted(["doc_id", "text", "keep_id", "group_size", "kept", "text_sha256"])
    assert [(r["doc_id"], r["keep_id"]) for r in found.orderBy("doc_id").collect()] == [(1, 1), (2, 1)]
    assert exact.kept_documents(frame).columns == frame.columns
    assert exact.exact_dedup(frame.limit(0)).count() == 0


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def edited(draw, text, edits):
    chars = list(text)
    for _ in range(edits):
        kind, place = draw.randrange(3), draw.randrange(len(chars) + 1)
        if kind == 0 and chars:
            chars[min(place, len(chars) - 1)] = draw.choice("abcé ")
        elif kind == 1:
            chars.insert(place, draw.choice("abcé "))
        elif chars:
            chars.pop(min(place, len(chars) - 1))
    return "".join(chars)


def test_banded_distance(spark):
    draw = random.Random(2)
    pairs = []
    for _ in range(300):
        a = "".join(draw.choice("abcdeé ") for _ in range(draw.randrange(1, 60)))
        pairs.append((a, edited(draw, a, draw.randrange(0, 5)) or "a"))
    found = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.banded_distance("a", "b", 2).alias("d")).collect()
    assert all(row["d"] == (distance(row["a"], row["b"]) if distance(row["a"], row["b"]) <= 2 else None) for row in found)


def expected_lines(docs):
    seen = [(i is None, i or 0, n, line.strip(" \t\r\x0b\x0c")) for i, text in docs for n, line in enumerate((text or "").split("\n"))]
    seen = [row for row in seen if row[3]]
    kinds = sorted({row[3] for row in seen})
    root = {k: k for k in kinds}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    near = set()
    for k, a in enumerate(kinds):
        for b in kinds[:k]:
            if min(len(a), len(b)) >= lines.LEAST_CHARS and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                near |= {a, b}
                root[top(a)] = top(b)
    first = {}
    for row in sorted(seen):
        first.setdefault(top(row[3]), row[:3])
    found = {}
    for i, text in docs:
        own = [row for row in seen if row[:2] == (i is None, i or 0)]
        gone = [row[2] for row in own if first[top(row[3])] != row[:3]]
        found[i] = (len((text or "").split("\n")), sum(row[3] in near for row in own), len(gone), gone)
    return found


def test_line_dedup(spark):
    draw = random.Random(4)
    base = ["".join(draw.choice("abcdeé fgh") for _ in range(draw.randrange(28, 60))) for _ in range(20)]
    docs = []
    for i in range(40):
        parts = [edited(draw, draw.choice(base), draw.choice([0, 0, 1, 2, 4])) if draw.random() < 0.9 else "" for _ in range(draw.randrange(1, 5))]
        docs.append((i, "\n".join(parts)))
    docs += [(500, None), (501, ""), (502, "word " * 20_000), (503, "\n\n")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("line", F.lit("clash"))
    found = lines.dedup_lines(frame)
    assert {r["doc_id"]: (r["n_lines"], r["n_near"], r["n_removed"], r["removed"]) for r in found.collect()} == expected_lines(docs)
    kept = {r["doc_id"]: r["text"] for r in lines.kept_lines(frame, found).collect()}
    gone = expected_lines(docs)
    assert kept[3] == "\n".join(line for n, line in enumerate(docs[3][1].split("\n")) if n not in gone[3][3])


def test_line_dedup_without_rows_or_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup_lines(empty).count() == 0
    nulls = spark.createDataFrame([(None, "one line of text"), (2, "one line of text"), (2, "one line of text")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["n_removed"]) for r in lines.dedup_lines(nulls).collect()) == [("2", 0), ("None", 1)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Foo. Licensed under the APACHE license,\nversion 2.0!", {"apache-2.0"}),
        ("all  rights -- reserved", {"all-rights-reserved"}),
        ("all rights are reserved", set()),
        (licenses.NOTICES["mit-permission"].replace("limitation", "limits"), {"mit-permission"}),
        (" ".join(licenses.NOTICES["mit-permission"].split()[::2]), set()),
        ("été " * 30_000 + licenses.NOTICES["isc"], {"isc"}),
        ("", set()),
        (None, set()),
    ],
)
def test_license_scan(spark, text, expected):
    frame = spark.createDataFrame([(1, text, "clash")], "doc_id long, text string, license string")
    assert {row["license"] for row in licenses.scan(frame).collect()} == expected


def test_license_scan_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(empty).count() == 0
    assert licenses.scan(empty, {}).columns == licenses.scan(empty).columns
