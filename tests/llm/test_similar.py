"""Fingerprint groups, repeated strings, nearest neighbours, against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from grantlens.llm import ann, lines, simhash, sorting, suffix
from grantlens.llm.components import components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(values, near):
    root = list(range(len(values)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in range(len(values)):
        for j in range(k):
            if near(values[k], values[j]):
                a, b = top(k), top(j)
                root[max(a, b)] = min(a, b)
    return [top(k) for k in range(len(values))]


def test_simhash_groups(spark):
    words = [f"w{k}" for k in range(400)]
    draw = random.Random(3)
    base = [" ".join(draw.choice(words) for _ in range(120)) for _ in range(8)]
    texts = [draw.choice(base) + draw.choice(["", " w1", "\n W2 w3"]) for _ in range(60)]
    texts += ["", None, " \t", "One", "one two", "ÉTÉ été", "one two three " * 20_000]
    rows = [(k, text, "clash") for k, text in enumerate(texts)]
    found = {r["doc_id"]: r for r in simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()}
    prints = [slow_fingerprint(text) for text in texts]
    groups = slow_groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    for k in range(len(texts)):
        assert found[k]["fingerprint"] == f"{prints[k]:016x}"
        assert found[k]["component_id"] == groups[k]


def test_simhash_without_rows_or_ids(spark):
    schema = "doc_id long, text string"
    assert simhash.near_groups(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "x y z")]
    found = simhash.near_groups(spark.createDataFrame(rows, schema)).collect()
    assert sorted(str(r["component_id"]) for r in found) == ["4", "4", "4", "None"]


@pytest.mark.parametrize("node", [100_000, 50])
def test_near_links_at_any_depth(spark, monkeypatch, node):
    monkeypatch.setattr(simhash, "NODE", node)
    draw = np.random.default_rng(3)
    values = set(range(100)) | {int(v) for v in draw.integers(0, 1 << 63, 100, dtype=np.uint64)}
    for center in draw.integers(0, 1 << 63, 10, dtype=np.uint64):
        for _ in range(20):
            value = int(center)
            for bit in draw.integers(0, 64, draw.integers(0, 6)):
                value ^= 1 << int(bit)
            values.add(value)
    prints = np.array(sorted(values), np.uint64)
    signed = prints.view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.near_links(frame, len(signed)), "test").collect()}
    groups = slow_groups(prints.tolist(), lambda a, b: (a ^ b).bit_count() <= 2)
    mine, theirs = {}, {}
    for k, value in enumerate(signed):
        mine.setdefault(roots.get(value, value), set()).add(k)
        theirs.setdefault(groups[k], set()).add(k)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_on_a_path(spark):
    links = spark.range(500).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    found = components(links, "test").collect()
    assert len(found) == 501 and {r["root"] for r in found} == {0}


def slow_repeats(texts, length):
    starts = {}
    for text in texts:
        for k in range(len(text) - length + 1):
            starts[text[k : k + length]] = starts.get(text[k : k + length], 0) + 1
    found = []
    for text in texts:
        gone = bytearray(len(text))
        for k in range(len(text) - length + 1):
            if starts[text[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = len([run for run in bytes(gone).split(b"\0") if run])
        found.append((bytes(c for c, g in zip(text, gone, strict=True) if not g), len(text), sum(gone), spans))
    return found


def colliding_texts():
    """Two texts of 16 letters with one XXH64 of seed 42: the second half of one makes up for the first halves."""
    p1, p2, p4, p5, every = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5, (1 << 64) - 1

    def turned(x, n):
        return (x << n | x >> (64 - n)) & every

    def mixed(lane):
        return turned(lane * p2 & every, 31) * p1 & every

    def unmixed(value):
        return turned(value * pow(p1, -1, 1 << 64) & every, 33) * pow(p2, -1, 1 << 64) & every

    def after(half):
        return (turned((42 + p5 + 16 & every) ^ mixed(int.from_bytes(half, "little")), 27) * p1 + p4) & every

    second = b"abcdefgh"
    held = after(b"ABCDEFGH") ^ mixed(int.from_bytes(second, "little"))
    for k in range(1_000_000):
        half = f"x{k:07d}".encode()
        other = unmixed(held ^ after(half)).to_bytes(8, "little")
        if all(32 < c < 127 for c in other):
            return "ABCDEFGH" + second.decode(), (half + other).decode()


def test_keys_of_texts_that_collide_in_one_hash(spark):
    a, b = colliding_texts()
    assert xxhash.xxh64_intdigest(a, 42) == xxhash.xxh64_intdigest(b, 42)
    frame = spark.createDataFrame([(a,), (b,)], "text string")
    for columns in (suffix.text_keys("text"), lines.line_key(F.col("text"))):
        found = frame.select(*columns).collect()
        assert found[0]["k1"] == found[1]["k1"] and found[0]["k2"] != found[1]["k2"]


def repeated_texts():
    draw = random.Random(7)

    def some(n):
        return "".join(draw.choice("abcdefgh é") for _ in range(n))

    passages = [some(n) for n in (199, 200, 201, 260, 500)]
    texts = [some(draw.randrange(0, 300)) + draw.choice(passages) + some(draw.randrange(0, 300)) for _ in range(30)]
    texts += [texts[0], texts[0], passages[3][:230], passages[4][100:] + passages[3], "a" * 450, "ab" * 300, "", "short", some(30_000)]
    return texts


@pytest.mark.parametrize("heavy", [20_000, 16])
def test_remove_repeats(spark, monkeypatch, heavy):
    monkeypatch.setattr(suffix, "HEAVY", heavy)
    monkeypatch.setattr(suffix, "SAMPLED", 1 if heavy == 16 else 16)
    texts = [*repeated_texts(), None]
    rows = [(k, text, k) for k, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_spans long")
    found = {r["doc_id"]: (bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix.remove_repeats(frame).collect()}
    expected = slow_repeats([(text or "").encode() for text in texts], suffix.LENGTH)
    assert [found[k] for k in range(len(texts))] == expected


def test_remove_repeats_without_rows_or_ids(spark):
    schema = "doc_id long, text string"
    assert suffix.remove_repeats(spark.createDataFrame([], schema)).count() == 0
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(None, text), (None, text), (1, text + "!"), (1, "other " * 10)]
    found = suffix.remove_repeats(spark.createDataFrame(rows, schema)).collect()
    assert sorted(len(bytes(r["kept"])) for r in found) == [0, 0, 1, 60]


def test_deep_shallow_order():
    draw = random.Random(9)
    strings = [bytes(draw.choice(b"\0ab") for _ in range(draw.randrange(0, 40))) for _ in range(400)]
    strings += [b"x" * 100 + s for s in strings[:100]]
    groups = np.array([draw.randrange(3) for _ in strings], np.int64)
    order, shared = sorting.deep_shallow(groups, strings, 16)
    pairs = [(groups[k], strings[k]) for k in order]
    by_group = {}
    for k in range(len(pairs)):
        by_group.setdefault(pairs[k][0], []).append((pairs[k][1], shared[k]))
    assert len(by_group) == 3 and sum(shared == -1) == 3
    for rows in by_group.values():
        assert [s for s, _ in rows] == sorted(s for s, _ in rows)
        for (a, _), (b, n) in zip(rows, rows[1:], strict=False):
            assert n == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def slow_nearest(ids, vectors, query, k=10):
    away = np.sqrt(((vectors - query[1]) ** 2).sum(1))
    order = [j for j in np.lexsort((ids, away)) if ids[j] != query[0]][:k]
    return [(int(ids[j]), away[j]) for j in order]


def test_nearest_recall_and_scores(spark):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(3000, 16)).astype(np.float32)
    vectors[500:1500] = vectors[500]  # one vector has a third of the rows
    rows = [(int(k), [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [None] * 16), (None, [1.0] * 16), (9400, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit(1))
    found = {}
    for r in ann.search(frame, F.col("vec_id") % 100 == 0).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(found) == list(range(0, 3000, 100))
    ids, wide = np.arange(3000), vectors.astype(np.float64)
    hits = 0
    for query, ranks in found.items():
        assert sorted(ranks) == list(range(1, 11))
        got = [ranks[k] for k in range(1, 11)]
        assert got == sorted(got, key=lambda p: (p[1], p[0]))
        assert all(abs(score - np.sqrt(((wide[i] - wide[query]) ** 2).sum())) < 1e-12 for i, score in got)
        hits += len({i for i, _ in got} & {i for i, _ in slow_nearest(ids, wide, (query, wide[query]))})
    assert hits >= 0.9 * 10 * len(found)
    hot = [ranks for query, ranks in found.items() if 500 <= query < 1500]
    assert all(score == 0 for ranks in hot for _, score in ranks.values())


@pytest.mark.parametrize("apart", [3.0, 40.0])
def test_nearest_recall_where_density_varies(spark, apart):
    """A fifth of the vectors lie ``apart`` times as far from each other as the rest."""
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(20_000, 16)) + 100 * draw.normal(size=(1, 16))
    thin = np.arange(20_000) % 5 == 0
    vectors[thin] = draw.normal(size=(4000, 16)) * apart
    rows = [(int(k), v.tolist()) for k, v in enumerate(vectors)]
    asks = F.col("vec_id") % 100 < 2
    hits = {True: [], False: []}
    found = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), asks).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(found) == 400 and all(len(near) == 10 for near in found.values())
    for query, near in found.items():
        true = slow_nearest(np.arange(20_000), vectors, (query, vectors[query]))
        hits[bool(thin[query])].append(len(set(near) & {i for i, _ in true}) / 10)
    assert np.mean(hits[False]) >= 0.9 and np.mean(hits[True]) >= 0.9


def test_nearest_of_few_or_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    rows = [(100, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]
    found = ann.search(spark.createDataFrame(rows, schema), F.col("vec_id") % 100 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found] == [(100, 1, 1), (100, 2, 2)]


def test_line_keys_compile_and_count(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("etaonrisldxy é😀") for _ in range(draw.randrange(40, 400))) for _ in range(40)] + ["short", "e" * 200]
    keys = lines.indexed(spark.createDataFrame([(text, 1) for text in texts], "line string, times long"), 2, 30)
    found = {r["k1"]: r for r in keys.collect()}
    hashed = spark.createDataFrame([(text,) for text in texts], "line string").select("line", *lines.line_key(F.col("line"))).collect()
    for text, row in ((r["line"], found[r["k1"]]) for r in hashed):
        packed = sum((text.count(c) % 64) << 6 * k for k, c in enumerate("etaonrisld"))
        assert row["counts"] == (packed if len(text) >= 30 else None)
        assert (len(row["entries"]), len(row["probes"])) == ((3, 9) if len(text) >= 30 else (0, 0))
    # the JVM interprets a method of more than 8,000 bytes; all keys of a line were one of 12,930
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = keys._jdf.queryExecution().debug().codegenToSeq()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert code.nonEmpty()
    assert max(code.apply(k)._3().maxMethodCodeSize() for k in range(code.size())) < 8000
