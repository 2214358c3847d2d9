"""Repair of the order of roles in conversations, by the cheapest edits.

A legal conversation is empty, or has the system's turn at most once and first, then user and
assistant in turn, at least once each, ending with the assistant. Rows may be kept, given the role
user or assistant, deleted, or inserted; :mod:`repair_costs` has the costs and the block tables.

Nothing here is bound to one task per conversation but the passes over its pieces. Rows without
their texts are range-sorted; ``PIECE`` consecutive places make a piece, and pieces run in parallel:
each gives the matrix of its least costs between states. One stream over the matrices of a
conversation, last piece first, finds the costs behind every piece; pieces are traced from every
state in parallel; one stream over the states found picks the trace. Texts move once, to their row.

Defined results: a NULL conversation id is a conversation of its own. Rows of one turn are taken by
role, then by the SHA-256 of the text; equal rows are copies, all but one duplicates. NULL in role or
text is one space, so such a row has no known role, or is blank. Roles are told by their first letter;
any but s, u and a cannot be kept. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grantlens.llm.repair_costs import END, GONE, LAST, ROLES, STATES, joined, tables
from grantlens.llm.runs import EMPTY_SHA256, digest_runs, slices_of_runs
from grantlens.operators.numbering import ordered
from grantlens.operators.skew import null_safe_join
from grantlens.session import stage

#: Places of one piece, as a power of two.
PIECE_BITS = 12
#: Faults of a row, the first that holds counting.
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
KEY = ["conv", "turn", "role", "digest"]
SPACES = " \t\n\x0b\f\r"


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by a hash of conversation and turn; ``copies`` says how often a row stands.

    NULL in any column is one space, also in what is hashed.
    """
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    return turns.where(fate != 0).select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(known("role")).alias("role"),
        text.alias("text"),
        F.when(fate == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def known_turns(turns: DataFrame, copies: Column) -> DataFrame:
    """The columns used, under names of our own, with the text's digest."""
    texts = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return turns.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        texts.alias("text"),
        F.unhex(F.sha2(texts.cast("binary"), 256)).alias("digest"),
        copies.cast("bigint").alias("copies"),
    )


def faulty_rows(turns: DataFrame) -> DataFrame:
    """One row per key (``KEY``) with its number of copies ``n`` and ``code``, 4 * role + fault of its first copy.

    A text was seen before if a row with an earlier turn has it too; only keys that occur in
    several turns are looked up.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    ends = F.substring(trimmed, -1, 1).isin(".", "!", "?")
    flags = turns.select(*KEY, "copies", (F.length(trimmed) == 0).alias("blank"), (~ends).alias("cut"))
    rows = flags.groupBy(*KEY, "blank", "cut").agg(F.sum("copies").alias("n"))
    said = ["conv", "role", "digest"]
    # NULL comes before every turn
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = rows.groupBy(*said).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    found = null_safe_join(rows, firsts, said, "left")
    seen = F.coalesce(F.col("first") < place, F.lit(False))
    fault = F.when(F.col("blank"), BLANK).when(seen, DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(SOUND)
    letter = F.substring("role", 1, 1)
    role = F.lit(len(ROLES))
    for k, known in enumerate(ROLES):
        role = F.when(letter == known, k).otherwise(role)
    return found.select(*KEY, "n", (role * 4 + fault).cast("int").alias("code"))


def symbols(codes: np.ndarray) -> np.ndarray:
    """What the cost tables read: 2 * role + truncated, or that the row must go."""
    roles, faults = codes >> 2, codes & 3
    return np.where(faults >= DUPLICATE, GONE, 2 * roles + (faults == TRUNCATED)).astype(np.int64)


def unlawful(left: int, right: int) -> bool:
    """Whether two roles may not stand side by side."""
    unknown = len(ROLES)
    return unknown in (left, right) or ROLES[left] + ROLES[right] not in ("su", "ua", "au")


def with_fields(rows: DataFrame, more: str) -> StructType:
    return StructType([*rows.schema.fields, *StructType.fromDDL(more).fields])


def with_matrices(pieces: DataFrame) -> DataFrame:
    """Pieces with their cost matrix, first and last role, and pairs inside that are not legal."""
    added = ["matrix", "head", "tail", "illegal"]
    names = [*pieces.columns, *added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = tables()
        wrong = np.array([[unlawful(a, b) for b in range(STATES)] for a in range(STATES)])
        for batch in batches:
            found = []
            for rows in batch.column(batch.schema.get_field_index("rows")):
                codes, n = rows.values.field("code").to_numpy(), rows.values.field("n").to_numpy()
                roles = codes >> 2
                # a copy stands beside its like, which is never legal
                illegal = int(wrong[roles[:-1], roles[1:]].sum()) + int((n - 1).sum())
                found.append((costs.matrix(symbols(codes)), int(roles[0]), int(roles[-1]), illegal))
            kinds = (pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64())
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return pieces.mapInArrow(run, with_fields(pieces, "matrix array<bigint>, head int, tail int, illegal bigint"))


def costs_behind(pieces: DataFrame) -> DataFrame:
    """``at``, the costs behind each piece, the least cost from its start, and whether it is the last."""
    slim = pieces.select("conv", "at", "matrix").repartition("conv").sortWithinPartitions("conv", F.desc("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, costs, begun = None, list(END), False
        for found, part in slices_of_runs(batches, 1):
            fresh = not begun or found != conv
            conv, begun = found, True
            rows = []
            for at, matrix in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                if fresh:
                    costs = list(END)
                behind, costs = costs, joined(matrix, costs)
                rows.append((at, behind, costs[0], fresh))
                fresh = False
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], ["at", "behind", "cost", "last"]
            )

    return slim.mapInArrow(run, "at bigint, behind array<bigint>, cost bigint, last boolean")


def traced(pieces: DataFrame) -> DataFrame:
    """Pieces with the letters and states of their rows, and the state after them, from every state."""
    names = [*pieces.columns, "letters", "states", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = tables()
        for batch in batches:
            found = []
            behind = batch.column(batch.schema.get_field_index("behind")).to_pylist()
            for rows, after in zip(batch.column(batch.schema.get_field_index("rows")), behind, strict=True):
                read, shape = symbols(rows.values.field("code").to_numpy()), costs.shape_of(after)
                _, _, bounds = costs.passed(read, shape)
                found.append(list(zip(*(costs.traced(read, shape, bounds, state) for state in range(STATES)), strict=True)))
            kinds = (pa.list_(pa.list_(pa.string())), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32()))
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    return pieces.mapInArrow(run, with_fields(pieces, "letters array<array<string>>, states array<array<int>>, ends array<int>"))


def states_before(pieces: DataFrame) -> DataFrame:
    """``at``, the state before each piece, the one after it, and whether its first role fits the role before."""
    slim = pieces.select("conv", "at", "ends", "head", "tail").repartition("conv").sortWithinPartitions("conv", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, role = None, 0, None
        for found, part in slices_of_runs(batches, 1):
            if found != conv:
                state, role = 0, None
            conv = found
            rows = []
            for at, ends, head, tail in zip(*(part.column(k).to_pylist() for k in range(1, 5)), strict=True):
                before, state = state, ends[state]
                rows.append((at, before, state, int(role is not None and unlawful(role, head))))
                role = tail
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], ["at", "start", "stop", "joint"]
            )

    return slim.mapInArrow(run, "at bigint, start int, stop int, joint bigint")


def edits(turns: DataFrame) -> DataFrame:
    """Pieces of conversations with the letters and states of their rows, from what :func:`known_turns` gives.

    ``rows`` holds the keys of the piece's rows in order, ``chosen`` their letters, ``passed`` the
    states before them, ``rest`` what is inserted after the last row of the conversation.
    """
    placed = stage(ordered(faulty_rows(turns), KEY, "place"), "repair-rows")
    row = F.struct("place", "turn", "role", "digest", "n", "code")
    grouped = placed.groupBy("conv", F.shiftright("place", PIECE_BITS).alias("piece")).agg(
        F.array_sort(F.collect_list(row)).alias("rows")
    )
    pieces = grouped.select("conv", F.col("rows")[0]["place"].alias("at"), "rows")
    pieces = stage(with_matrices(pieces), "repair-pieces")
    found = stage(traced(pieces.join(costs_behind(pieces), "at")), "repair-traces")
    chosen = found.join(states_before(found), "at")
    rest = F.when(F.col("last"), F.element_at(F.array(*map(F.lit, LAST)), F.col("stop") + 1)).otherwise("")
    return chosen.select(
        "conv", "at", "rows", "illegal", "joint", "cost", "stop", "last",
        F.col("letters")[F.col("start")].alias("chosen"), F.col("states")[F.col("start")].alias("passed"), rest.alias("rest"),
    )


def summary(turns: DataFrame, pieces: DataFrame) -> DataFrame:
    """One row per conversation with rows: faults, cost and audit."""
    count = lambda fault, n: F.sum(F.aggregate(F.filter("rows", lambda r: (r["code"] % 4) == fault), F.lit(0).cast("bigint"), lambda s, r: s + n(r)))  # noqa: E731, E501
    copies = F.aggregate("rows", F.lit(0).cast("bigint"), lambda s, r: s + F.when(r["code"] % 4 != BLANK, r["n"] - 1).otherwise(0))
    more = F.aggregate("rows", F.lit(0).cast("bigint"), lambda s, r: s + r["n"] - 1)
    audit = F.concat(
        F.array_join(F.zip_with("chosen", "rows", lambda letters, r: F.concat(letters, F.repeat(F.lit("D"), (r["n"] - 1).cast("int")))), ""), "rest"
    )
    whole = F.array_sort(F.collect_list(F.struct("at", audit.alias("audit"))))
    found = pieces.groupBy("conv").agg(
        count(BLANK, lambda r: r["n"]).alias("blank"),
        (count(DUPLICATE, lambda r: F.lit(1)) + F.sum(copies)).alias("duplicate"),
        count(TRUNCATED, lambda r: F.lit(1)).alias("truncated"),
        F.sum(F.col("illegal") + F.col("joint")).alias("illegal"),
        (F.min_by("cost", "at") + 2 * F.sum(more)).alias("cost"),
        F.array_join(F.transform(whole, lambda part: part["audit"]), "").alias("audit"),
    )
    # a span that no long can hold has no number of gaps
    span = F.try_add(F.try_subtract(F.max("turn"), F.min("turn")), F.lit(1).cast("bigint"))
    gaps = turns.groupBy("conv").agg(F.coalesce(F.max("turn").isNull(), F.lit(True)).alias("none"), span.alias("span"), F.count_distinct("turn").alias("kinds"))
    gaps = gaps.select("conv", F.when(F.col("none"), 0).otherwise(F.col("span") - F.col("kinds")).cast("bigint").alias("gaps"))
    return null_safe_join(found, gaps, ["conv"])


def repaired(turns: DataFrame, pieces: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: ``conv, place, nth, role, text``, in the order of ``place, nth``."""
    zipped = F.arrays_zip(F.col("rows").alias("row"), F.col("chosen").alias("letters"), F.col("passed").alias("state"))
    one = pieces.select("conv", F.explode(zipped).alias("r")).select(
        "conv", "r.row.place", "r.row.turn", "r.row.role", "r.row.digest", "r.letters", "r.state"
    )
    texts = turns.groupBy(*KEY).agg(F.first("text").alias("text"))
    kept = null_safe_join(one.where("letters <> 'D'"), texts, KEY)
    # what follows the last row stands behind it
    last = F.element_at("rows", -1)["place"]
    ends = pieces.where("rest <> ''").select("conv", last.alias("place"), F.lit("").alias("role"), F.col("rest").alias("letters"), F.col("stop").alias("state"), F.lit("").alias("text"), F.lit(1).alias("after"))
    both = kept.select("conv", "place", "role", "letters", "state", "text", F.lit(0).alias("after")).unionByName(ends)
    # inserted and changed rows are the user's and the assistant's in turn
    given = lambda k: F.when((k + (F.col("state") == 2).cast("int")) % 2 == 0, "user").otherwise("assistant")
    turned = F.transform(
        F.split("letters", ""),
        lambda letter, k: F.struct(
            letter.alias("edit"), k.alias("k"), F.when(letter == "K", F.col("role")).otherwise(given(k)).alias("role"),
            F.when(letter == "I", "").otherwise(F.col("text")).alias("text"),
        ),
    )
    lines = both.select("conv", "place", "after", F.explode(F.filter(turned, lambda line: line["edit"].isin("K", "R", "I"))).alias("line"))
    nth = F.col("after") * 1000 + F.col("line.k")
    return lines.select("conv", "place", nth.alias("nth"), "line.edit", "line.role", "line.text")


def repair(turns: DataFrame, copies: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Faults, cost and audit per conversation, and the turns of the repaired ones.

    ``turns`` has ``conv_id, turn, role, text``; ``copies`` says how often a row stands (once).
    """
    known = known_turns(turns, F.lit(1) if copies is None else copies)
    pieces = stage(edits(known), "repair-edits")
    return summary(known, pieces), repaired(known, pieces)


def audit(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: what the damage did, and the cheapest repair with its digest."""
    hurt = damaged(turns)
    found, lines = repair(hurt, F.col("copies"))
    line = F.concat("role", F.lit(":"), "text").alias("line")
    in_order = lines.select("conv", "place", "nth", line).repartition("conv").sortWithinPartitions("conv", "place", "nth")
    digests = digest_runs(in_order, ["conv"], "line", b"\n", "repaired_sha256")
    every = turns.select(F.col("conv_id").alias("conv")).distinct()
    joined_ = null_safe_join(null_safe_join(every, found, ["conv"], "left"), digests, ["conv"], "left")
    # only where the span overflows are gaps unknown
    numbers = [F.when(F.col("audit").isNull(), F.lit(0)).otherwise(F.col(name)).cast("bigint").alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined_.select(
        F.col("conv").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
