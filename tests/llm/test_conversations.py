"""Repair of conversations and their trie, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.llm import repair, runs, trie
from grantlens.llm.repair_costs import BLOCK, END, LAST, SYMBOLS, joined, tables

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\f\r"


def sha(text):
    return hashlib.sha256((text if isinstance(text, bytes) else text.encode())).hexdigest()


def slow_cheapest(rows):
    """Cost, audit and lines of the best edits, by a search over all states row by row; rows are (role, text, gone, late)."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    given = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    best = {0: (0, "", ())}

    def inserted(found):
        for _ in range(4):
            for state, (cost, letters, lines) in list(found.items()):
                role, to = given[state]
                option = (cost + 5, letters + "I", (*lines, f"{role}:"))
                if to not in found or option < found[to]:
                    found[to] = option
        return found

    for role, text, gone, late in rows:
        after = {}
        for state, (cost, letters, lines) in inserted(best).items():
            options = [(state, cost + 2, "D", lines)]
            if not gone:
                if (state, role[:1]) in step:
                    options.append((step[state, role[:1]], cost + late, "K", (*lines, f"{role}:{text}")))
                name, to = given[state]
                options.append((to, cost + 1 + late, "R", (*lines, f"{name}:{text}")))
            for to, more, letter, out in options:
                option = (more, letters + letter, out)
                if to not in after or option < after[to]:
                    after[to] = option
        best = after
    found = inserted(best)
    return min(found[state] for state in (0, 3) if state in found)


def slow_audit(rows):
    every, kept = {row[0] for row in rows}, defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        role = "user" if fate == 4 else role
        kept[conv] += [(turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest(), text)] * (2 if fate == 3 else 1)
    found = set()
    for conv in every:
        turns, seen, told, counts = sorted(kept[conv]), set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, _, text in turns:
            end = text.rstrip(SPACES)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            told.append((role, text, fault in ("blank", "duplicate"), 5 * (fault == "truncated")))
        numbers = {turn[1] for turn in turns if turn[0]}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        cost, letters, lines = slow_cheapest(told)
        found.add((conv, gaps, *counts.values(), illegal, cost, letters, sha("\n".join(lines))))
    return found


def odd_turns(draw, n, convs):
    texts = [None, "", " \t", "Yes.", "No!", "no end", "End? \n", "ends. ", "long \x0b words", "a.b"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "Ada"]
    return [(draw.choice(convs), draw.choice([None, *range(6)]), draw.choice(roles), draw.choice(texts)) for _ in range(n)]


def test_block_tables_equal_search():
    draw, costs = random.Random(1), tables()
    for _ in range(3000):
        symbols = [draw.randrange(SYMBOLS) for _ in range(draw.randrange(3 * BLOCK + 2))]
        read = np.array(symbols, np.int64)
        shape, raised, bounds = costs.passed(read, costs.end)
        letters, _, state = costs.traced(read, costs.end, bounds, 0)
        rows = [("", "", True, 0) if s == 8 else ("suax"[s // 2], "", False, 5 * (s % 2)) for s in symbols]
        expected = slow_cheapest(rows)
        assert (costs.shapes[shape][0] + raised, "".join(letters) + LAST[state]) == expected[:2]
        cut = draw.randrange(len(symbols) + 1)
        behind = joined(costs.matrix(read[cut:]), list(END))
        assert joined(costs.matrix(read[:cut]), behind)[0] == expected[0]


@pytest.mark.parametrize("bits", [12, 1])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "PIECE_BITS", bits)
    draw = random.Random(5)
    rows = odd_turns(draw, 500, [None, -3, *range(60)])
    # one conversation holds a third of all rows, one row stands many times
    rows += [(7, k, ("user", "assistant")[k % 2], draw.choice(["Said so.", f"text {k}.", "cut", ""])) for k in range(250)]
    rows += [(8, 3, "user", "again.")] * 40 + [(9, None, "user", None)] * 30
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit(1) for name in ("conv", "n", "place", "rows", "audit", "code")})
    found = repair.audit(frame)
    assert found.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert [kind for _, kind in found.dtypes[1:7]] == ["bigint"] * 6
    got, expected = [tuple(row) for row in found.collect()], slow_audit(rows)
    assert len(got) == len(set(got)) == len(expected)
    assert set(got) == expected


def test_repair_of_nothing_long_texts_and_wide_turns(spark):
    assert repair.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "word " * 400_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 2, "assistant", " " * 300_000), (2, -(2**63), "user", "a."), (2, 2**63 - 1, "assistant", "b.")]
    found = {row["conv_id"]: row for row in repair.audit(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert tuple(found[1]) in slow_audit(rows[:3])
    assert found[2]["gaps"] is None and found[2]["audit"] == "KK"  # no long can say so many


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 2, "user", "Hello."), (1, 3, "tool", "Fine."), (1, 4, "user", "cut")]
    found, lines = repair.repair(spark.createDataFrame(rows, SCHEMA))
    assert found.first()["audit"] == "KKDRD"
    told = lines.orderBy("place", "nth").select("edit", "role", "text").collect()
    assert [tuple(row) for row in told] == [("K", "system", "Be kind."), ("K", "user", "Hello."), ("R", "assistant", "Fine.")]


def slow_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", sha(text or ""), text or ""))
    said = {conv: [(turn[2], turn[4]) for turn in sorted(turns)] for conv, turns in convs.items()}
    built = {}
    for conv in said:
        h = zlib.crc32(str(conv).encode()) % 4
        built[conv] = tuple(said.get(conv - int(math.fmod(conv, 20)), [])[:h] + said[conv][h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
            if depth:
                children[turns[: depth - 1]].add(turns[:depth])
    found = {}
    for node in sorted(members, key=len, reverse=True):
        inside, below = members[node], [found[child] for child in children[node]]
        saved = (len(inside) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ended = ",".join(map(str, sorted(conv for conv in inside if built[conv] == node)))
        found[node] = (
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(below),
            sum(child[5] for child in below) or 1, saved + sum(child[6] for child in below), sha(ended),
        )
    return found


@pytest.mark.parametrize("block", [4096, 2])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    draw = random.Random(3)
    rows = [(draw.choice([None, *range(-25, 70)]), draw.choice([None, *range(4)]), draw.choice([None, "user", "assistant"]), draw.choice([None, "", "a b", "c  d e"])) for _ in range(260)]
    # many equal conversations, and one that holds a third of all rows
    rows += [(100 + k, turn, "user", f"same {turn}") for k in range(60) for turn in range(3)]
    rows += [(7, turn, "user", f"long {turn % 5}") for turn in range(220)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({name: F.lit(1) for name in ("conv", "place", "depth", "p1", "words", "total")})
    nodes = trie.conversation_trie(frame)
    assert nodes.columns[:8] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got, expected = sorted(map(tuple, nodes.collect()), key=str), sorted(slow_trie(rows).values(), key=str)
    assert got == expected


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    # crc32 of 21 leaves 3, and conversation 20 is not there
    rows = [(21, 0, "user", "a"), (None, 0, "user", "b")]
    assert [tuple(row) for row in trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()] == list(slow_trie(rows).values())


def test_what_a_node_says(spark):
    rows = [(40, 0, "user", "hello there"), (40, 1, "assistant", "hi"), (41, 0, "user", "x")]
    convs, built = trie.rebuilt(trie.numbered_turns(spark.createDataFrame(rows, SCHEMA)))
    told = trie.node_turns(trie.prefix_nodes(convs, built), built).where("conv_id = 40").orderBy("depth").collect()
    assert [(row["depth"], row["role"], row["digest"]) for row in told] == [(0, None, None), (1, "user", sha("hello there")), (2, "assistant", sha("hi"))]


def test_digests_of_runs(spark):
    rows = [(k % 7 or None, k, f"v{k}" if k % 5 else None) for k in range(3000)]
    frame = spark.createDataFrame(rows, "key long, nth long, value string").repartition(5, "key").sortWithinPartitions("key", "nth")
    found = {row["key"]: row["digest"] for row in runs.digest_runs(frame, ["key"], "value", b",", "digest").collect()}
    assert found == {key: sha(",".join(v or "" for k, _, v in rows if k == key)) for key in (None, *range(1, 7))}
