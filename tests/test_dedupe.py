import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grantlens.operators import dedupe, skew
from grantlens.operators.numbering import number_batches, number_rows

SCHEMA = "i int, p string, c string"


def first_wins(rows):
    """The rule read off row by row."""
    projects, cores, fates = set(), set(), []
    for p, c in rows:
        checked = c if c else p
        if p in projects:
            fates.append("project")
        elif checked in cores:
            fates.append("core")
        else:
            projects.add(p)
            cores.add(checked)
            fates.append("keep")
    return fates


def fates_of(spark, rows, **options):
    frame = spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(rows)], SCHEMA)
    status = dedupe.two_key_status(frame, "p", "c", ["i"], **options)
    return [row["status"] for row in status.orderBy("i").collect()]


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("p1", "A"), ("p2", "A"), ("p2", "B"), ("p3", "B"), ("p1", "C")], ["keep", "core", "keep", "core", "project"]),
        ([("p1", None), ("p2", "p1")], ["keep", "core"]),
        ([(None, None), ("", ""), (None, "x"), ("", None)], ["keep", "keep", "project", "project"]),
        ([("a", "A")] * 3, ["keep", "project", "project"]),
    ],
)
def test_two_key_status(spark, rows, expected):
    assert fates_of(spark, rows) == expected == first_wins(rows)


keys = st.sampled_from([None, "", "a", "b", "c", "d", "e", "f"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(keys, keys), min_size=1, max_size=60))
def test_two_key_status_equals_reading_in_order(spark, rows):
    assert fates_of(spark, rows) == first_wins(rows)


def test_two_key_status_with_a_hot_project_and_a_hot_core(spark):
    rows = [("hot" if i % 3 == 0 else f"p{i % 50}", "HOT" if i % 3 == 1 else f"c{i % 40}") for i in range(600)]
    assert fates_of(spark, rows) == first_wins(rows)


def test_two_key_status_on_a_chain(spark):
    """Each row shares a key with the one before; doubling settles them in a few rounds."""
    frame = spark.range(100_000).select(
        F.col("id").alias("ord"), F.floor((F.col("id") + 1) / 2).cast("string").alias("p"), F.floor(F.col("id") / 2).cast("string").alias("c")
    )
    kept, rounds = dedupe.kept_pairs(frame, [], [])
    assert rounds <= 3
    assert kept.count() == 50_000 and kept.filter("ord % 2 = 1").isEmpty()


def test_two_key_status_over_the_table(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = sorted(map(tuple, lines.distinct().collect()))
    status = dedupe.two_key_status(lines.distinct(), "l_orderkey", "l_suppkey", order).collect()
    expected = first_wins([(str(row[0]), str(row[3])) for row in rows])
    assert [row["status"] for row in sorted(status)] == expected


def test_nothing_to_dedupe(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dedupe.two_key_status(empty, "p", "c", ["i"]).count() == 0
    assert dedupe.two_key_flag(empty, "p", "c", ["i"]).count() == 0
    assert number_rows(empty, ["i"]).count() == 0


def test_places_may_be_null(spark):
    frame = spark.createDataFrame([(None, "p1", "A"), (1, "p1", "B"), (2, "p2", "A")], SCHEMA)
    kept = dedupe.two_key_dedupe(frame, "p", "c", ["i"])
    assert [(row["i"], row["p"]) for row in kept.collect()] == [(None, "p1")]
    numbered = number_rows(frame, ["p"], ["i"]).collect()
    assert sorted((str(row["i"]), row["row_number"]) for row in numbered) == [("1", 1), ("2", 1), ("None", 1)]


def test_two_key_label_and_flag(spark):
    frame = spark.createDataFrame([(0, "p1", "A"), (1, "p1", "A"), (2, "p2", "A")], SCHEMA)
    labelled = dedupe.two_key_label(frame, "p", "c", ["i"]).orderBy("i").collect()
    assert [(r["skipped_project"], r["skipped_core"]) for r in labelled] == [(False, False), (True, False), (False, True)]
    flagged = dedupe.two_key_flag(frame, "p", "c", ["i"]).orderBy("i").collect()
    assert [(r["skipped_project"], r["skipped_core"]) for r in flagged] == [(False, False), (True, True), (False, True)]


def test_upsert(spark):
    store = spark.createDataFrame([("A", 0), ("B", 0)], "k string, v int")
    incoming = spark.createDataFrame([("A", 1, 1), ("A", 2, 2), ("C", 3, 0)], "k string, v int, seq int")
    merged = dedupe.upsert(store, incoming, "k", "seq")
    assert sorted(map(tuple, merged.collect())) == [("A", 2), ("B", 0), ("C", 3)]
    many = spark.createDataFrame([("A", 1, 1, 0), ("A", 2, 1, 1), ("A", 3, 0, 5)], "k string, v int, seq int, pos int")
    assert ("A", 2) in set(map(tuple, dedupe.upsert(store, many, "k", ["seq", "pos"]).collect()))
    again = dedupe.upsert(merged, incoming, "k", "seq")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_insert_ignore(spark):
    store = spark.createDataFrame([("A", 7)], "k string, p int")
    incoming = spark.createDataFrame([("A", 7), ("A", 8), ("A", 8)], "k string, p int")
    assert sorted(map(tuple, dedupe.insert_ignore(store, incoming, ["k", "p"]).collect())) == [("A", 7), ("A", 8)]


def test_missing_and_existing_keep_repeats(spark):
    wanted = spark.createDataFrame([("A",), ("B",), ("B",)], "k string")
    store = spark.createDataFrame([("A",)], "k string")
    assert [row["k"] for row in dedupe.missing_keys(wanted, store, "k").collect()] == ["B", "B"]
    assert [row["k"] for row in dedupe.existing_keys(wanted, store, "k").collect()] == ["A"]


def test_first_per_key(spark):
    rows = spark.createDataFrame([("A", 2, "y"), ("A", 1, "x"), ("B", 5, "z")], "k string, n int, v string")
    assert sorted(map(tuple, dedupe.first_per_key(rows, "k", "n").collect())) == [("A", 1, "x"), ("B", 5, "z")]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(500).select((F.col("id") % 7 % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (2, "b"), (9, "c")], "k bigint, v string")
    expected = sorted(map(tuple, left.join(right, "k", how).collect()), key=str)
    salted = skew.salted_join(left, right, "k", how, [0], F.col("id"), salts=5)
    assert sorted(map(tuple, salted.collect()), key=str) == expected


def test_hot_values(spark):
    rows = spark.range(100).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("k"))
    assert skew.hot_values(skew.key_counts(rows, "k"), "k", 100) == [0]  # of four partitions


def test_number_rows_with_one_huge_group(spark):
    rows = spark.range(0, 1000).select(
        F.when(F.col("id") % 3 > 0, F.lit("big")).otherwise(F.concat(F.lit("g"), F.col("id") % 17)).alias("g"),
        ((F.col("id") * 7919) % 1009).alias("n"),
    )
    groups = {}
    for g, n in sorted(map(tuple, rows.collect())):
        groups.setdefault(g, []).append(n)
    numbered = number_rows(rows, ["n"], ["g"]).collect()
    assert len(numbered) == 1000
    assert all(groups[row["g"]][row["row_number"] - 1] == row["n"] for row in numbered)


def test_number_batches(spark):
    numbered = number_batches(spark.range(1001), 500, ["id"]).collect()
    assert all(row["batch"] == row["id"] // 500 for row in numbered)


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_rows_are_moved_once_to_find_those_before_them(spark, tmp_path):
    rows = [(i, f"p{i % 7}", f"c{i % 5}") for i in range(60)]
    spark.createDataFrame(rows, "ord bigint, p string, c string").write.parquet(f"{tmp_path}/live")
    live = spark.read.parquet(f"{tmp_path}/live")
    assert executed(dedupe._earlier(live, "p", [])).count("Exchange hash") == 1
    kept = live.filter("ord = 0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(dedupe._earlier(dedupe._unclaimed(live, kept, "p", []), "p", []))
        assert plan.count("Exchange hash") == 2  # the rows and the kept ones
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_hot_keys_have_the_same_rows_before_them(spark):
    rows = [(i, "hot" if i % 3 else f"p{i % 7}", "c") for i in range(90)] + [(200, "lone", "c"), (201, "one more", "c")]
    live = spark.createDataFrame(rows, "ord bigint, p string, c string")

    def found(hot):
        return sorted(dedupe._earlier(live, "p", hot).select("ord", "p", "c", "p_n", "p_up").collect())

    seen, expected = {}, []
    for i, p, c in rows:
        before = seen.setdefault(p, [])
        expected.append((i, p, c, min(len(before), 2), before[0] if len(before) == 1 else None))
        before.append(i)
    assert found([]) == found(["hot", "lone", "absent"]) == expected


def test_dedupe_without_a_row_id_makes_its_rows_once(spark, tmp_path):
    rows = [(i, f"p{i % 9}", f"c{i % 4}") for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/rows")
    kept = dedupe.two_key_dedupe(spark.read.parquet(f"{tmp_path}/rows"), "p", "c", ["i"])
    assert not [path for path in kept.inputFiles() if f"{tmp_path}" in path]
    fates = first_wins([row[1:] for row in rows])
    assert sorted(row["i"] for row in kept.collect()) == [i for i, fate in enumerate(fates) if fate == "keep"]


def test_few_pieces_spare_the_numbered_rows_a_move(spark):
    rows = spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 3).alias("g"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert executed(number_rows(rows, ["n"], ["g"])).count("Exchange hash") == 1  # that of the counts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
