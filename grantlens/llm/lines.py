"""Line dedup up to a few edits, in DataFrame functions alone.

Distinct lines are joined by edit distance. A line is split into threshold-plus-one segments,
which are its entries in the index. A line within the threshold of another holds one of the
other's segments whole, near its place: the substrings that can be it, given both lengths and
how many edits may lie on either side, are the line's probes. Entry and probe meet by a hash of
length, segment number and substring. Letter counts kept beside them turn most false pairs
away inside that join. The rest is verified by a banded bit-parallel automaton: one bit per
diagonal, one word per number of edits.

Only hashes travel for the join; texts of lines are fetched for candidate pairs alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlens.llm.common import text_or_empty
from grantlens.llm.components import components
from grantlens.session import stage, stage_counted

EDITS = 2
#: Shorter lines are compared for equality only.
LEAST_CHARS = 30
#: Six bits each hold the counts of these letters, modulo 64: some of every line, others of candidates.
LETTERS, OTHERS, COUNT = "etaonrisld", "hucmgfpbvq", 64
#: Keys of lines are broadcast where there are at most so many (four numbers each).
FEW = 200_000
BLANKS = " \t\r\x0b\x0c"


def occurrences(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id``, ``row`` (a hash of the text), ``nth`` and ``line`` of every line that is not blank."""
    texts = text_or_empty(text)
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(texts).alias("row"), F.posexplode(F.split(texts, "\n")).alias("nth", "line"))
    return rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''")


def line_key(line: Column) -> list[Column]:
    """Two hashes from different seeds, as a constant comes first in one."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(1), line).alias("k2")]


def segments(length: Column, count: int) -> list[tuple[Column, Column]]:
    """Begin (from 1) and length of each of ``count`` even segments, the longer ones last."""
    short, longer = F.floor(length / count).cast("int"), (length % count).cast("int")
    found, begin = [], F.lit(1)
    for k in range(count):
        size = short + F.when(longer >= count - k, 1).otherwise(0)
        found.append((begin, size))
        begin = begin + size
    return found


def segmented(lines: DataFrame, edits: int) -> DataFrame:
    """Columns ``_length``, and ``_begin<d>_<k>`` and ``_size<d>_<k>``: segments of a line ``d`` characters shorter.

    As columns of their own they are computed once for all keys, which keeps the code that Spark
    generates for a row short enough for the compiler of the JVM.
    """
    known = lines.withColumn("_length", F.length("line"))
    found = {}
    for shorter in range(edits + 1):
        for k, (begin, size) in enumerate(segments(F.col("_length") - shorter, edits + 1)):
            found |= {f"_begin{shorter}_{k}": begin, f"_size{shorter}_{k}": size}
    return known.withColumns(found)


def keyed(edits: int) -> tuple[Column, Column]:
    """Keys of a line's index entries, and of its probes into lines at most as long; see :func:`segmented`.

    Probes that equal an own entry are left to the entries.
    """

    def key(shorter: int, number: int, shift: int) -> Column:
        begin, size = F.col(f"_begin{shorter}_{number}"), F.col(f"_size{shorter}_{number}")
        return F.xxhash64(F.col("_length") - shorter, F.lit(number), F.col("line").substr(begin + shift, size))

    entries = [key(0, k, 0) for k in range(edits + 1)]
    probes = []
    for shorter in range(edits + 1):
        for k in range(edits + 1):
            for shift in range(max(-k, shorter - (edits - k)), min(k, shorter + edits - k) + 1):
                if shorter or shift:
                    probes.append(key(shorter, k, shift))
    return F.array(*entries), F.array(*probes)


def with_letter_counts(lines: DataFrame, letters: str = LETTERS, known: Column | None = None) -> DataFrame:
    """``lines`` with ``counts``, the letters of ``line`` packed; NULL where ``known`` is false.

    Each letter is taken out of what those before it left, so that later ones read less. What is
    left stands in columns, which are computed once.
    """
    left, packed = "line", F.lit(0).cast("long")
    for place, letter in enumerate(letters):
        lines = lines.withColumn(f"_left{place}", F.replace(F.col(left), F.lit(letter), F.lit("")))
        count = F.octet_length(left) - F.octet_length(f"_left{place}")
        packed = packed.bitwiseOR(F.shiftleft(count.cast("long").bitwiseAND(F.lit(COUNT - 1)), 6 * place))
        left = f"_left{place}"
    lines = lines.withColumn("counts", packed if known is None else F.when(known, packed))
    return lines.drop(*[f"_left{place}" for place in range(len(letters))])


def counts_near(a: Column, b: Column, edits: int) -> Column:
    """Whether the letter counts differ by at most two for each edit."""
    apart = F.lit(0)
    for place in range(len(LETTERS)):
        one, other = (F.shiftrightunsigned(packed, 6 * place).bitwiseAND(F.lit(COUNT - 1)) for packed in (a, b))
        step = F.abs(one - other)
        apart = apart + F.least(step, F.lit(COUNT) - step)
    return apart <= 2 * edits


def banded_distance(a: str, b: str, edits: int) -> Column:
    """The edit distance of two string columns if at most ``edits``, else NULL.

    ``words[d]`` has a bit for each diagonal on which ``d`` edits suffice for what is read.
    """
    width = 2 * edits + 1
    mask = (1 << width) - 1
    start = F.array(*[F.lit(sum(1 << (edits - k) for k in range(d + 1))) for d in range(edits + 1)])

    def step(left: Column, right: Column):
        def read(words: Column, at: Column) -> Column:
            equal = F.lit(0)
            for bit in range(width):
                place = at - (bit - edits)
                same = F.coalesce((place >= 0) & (F.get(left, F.greatest(place, F.lit(0))) == F.get(right, at)), F.lit(False))
                equal = equal.bitwiseOR(F.when(same, 1 << bit).otherwise(0))
            moved = F.transform(F.array(equal), lambda match: advance(words, match))[0]
            # once no diagonal is left in the word of most edits, the rest need not be read
            return F.when(words[edits] == 0, words).otherwise(moved)

        return read

    def advance(words: Column, match: Column) -> Column:
        after = [words[0].bitwiseAND(match)]
        for d in range(1, edits + 1):
            before = words[d - 1]
            moved = before.bitwiseOR(F.shiftleft(before, 1)).bitwiseOR(F.shiftright(after[-1], 1))
            after.append(words[d].bitwiseAND(match).bitwiseOR(moved).bitwiseAND(F.lit(mask)))
        return F.array(*after)

    left, right = F.split(F.col(a), ""), F.split(F.col(b), "")
    pair = F.array(F.struct(left.alias("l"), right.alias("r")))

    def run(p: Column) -> Column:
        size = F.size(p["r"])
        words = F.aggregate(F.sequence(F.lit(0), size - 1), start, step(p["l"], p["r"]))
        end = F.size(p["r"]) - F.size(p["l"]) + edits
        reached = F.filter(F.sequence(F.lit(0), F.lit(edits)), lambda d: F.call_function("shiftright", F.get(words, d), end).bitwiseAND(F.lit(1)) == 1)
        return F.when((end >= 0) & (end < width), F.array_min(reached))

    return F.transform(pair, run)[0]


def indexed(distinct: DataFrame, edits: int, least_chars: int) -> DataFrame:
    """A number, the hashes, letter counts and keys of each distinct line; a shorter one has no keys."""
    line, compared, none = F.col("line"), F.col("_length") >= least_chars, F.array().cast("array<long>")
    entries, probes = keyed(edits)
    return with_letter_counts(segmented(distinct, edits), known=compared).select(
        F.monotonically_increasing_id().alias("line_id"),
        *line_key(line),
        "times",
        "counts",
        F.when(compared, entries).otherwise(none).alias("entries"),
        F.when(compared, probes).otherwise(none).alias("probes"),
    )


def line_links(lines: DataFrame, docs: DataFrame, doc_id: str, text: str, edits: int) -> DataFrame:
    """``a``, ``b``: ids of distinct lines within ``edits`` edits; ``lines`` has keys and counts."""
    entries = lines.select(F.explode("entries").alias("key"), F.col("line_id").alias("a"), F.col("counts").alias("ca"))
    probes = lines.select(F.explode("probes").alias("key"), F.col("line_id").alias("b"), F.col("counts").alias("cb"))
    same = lines.select(F.explode("entries").alias("key"), F.col("line_id").alias("b"), F.col("counts").alias("cb"))
    near = counts_near(F.col("ca"), F.col("cb"), edits)
    # lines as long as each other meet by their entries, which are dealt out once for both joins
    met = entries.join(same, (entries["key"] == same["key"]) & near & (F.col("a") < F.col("b"))).select("a", "b")
    met = met.unionByName(entries.join(probes, (entries["key"] == probes["key"]) & near & (F.col("a") != F.col("b"))).select("a", "b"))
    pairs = stage(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")
    wanted = pairs.select(F.col("a").alias("line_id")).unionByName(pairs.select(F.col("b").alias("line_id"))).distinct()
    known, count = stage_counted(lines.select("line_id", "k1", "k2").join(wanted, "line_id"), "line-wanted")
    known = F.broadcast(known) if count <= FEW else known  # else both sides are dealt out by key
    texts = occurrences(docs, doc_id, text).select(*line_key(F.col("line")), "line")
    texts = texts.join(known, ["k1", "k2"]).groupBy("line_id").agg(F.first("line").alias("line"))
    texts = stage(with_letter_counts(texts, OTHERS), "line-texts")
    both = pairs.join(texts.select(F.col("line_id").alias("a"), F.col("line").alias("left"), F.col("counts").alias("ca")), "a")
    both = both.join(texts.select(F.col("line_id").alias("b"), F.col("line").alias("right"), F.col("counts").alias("cb")), "b")
    likely = both.where(counts_near(F.col("ca"), F.col("cb"), edits))
    return likely.where(banded_distance("left", "right", edits).isNotNull()).select("a", "b")


def line_classes(docs: DataFrame, doc_id: str, text: str, edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``k1``, ``k2``, class ``root`` and ``links`` of each distinct line that is repeated or has a link.

    ``links`` is how many distinct lines are within ``edits`` edits of this one.
    """
    distinct = occurrences(docs, doc_id, text).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    lines = stage(indexed(distinct, edits, least_chars), "lines")  # from here on a line's number stands
    links = stage(line_links(lines, docs, doc_id, text, edits), "line-links")
    degree = links.select(F.explode(F.array("a", "b")).alias("line_id")).groupBy("line_id").agg(F.count(F.lit(1)).alias("links"))
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "line-classes")
    linked = roots.withColumnRenamed("node", "line_id").join(degree, "line_id")
    known = lines.select("line_id", "k1", "k2", "times").join(linked, "line_id", "left")
    return known.where("times > 1 or root is not null").select(
        "k1", "k2", F.coalesce("root", "line_id").alias("root"), F.coalesce("links", F.lit(0)).cast("long").alias("links")
    )


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: int = EDITS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Per row: ``doc_id``, ``n_lines``, ``n_near``, ``n_removed`` and ``removed``, the numbers of lines to drop.

    Lines are compared without blanks at their ends; blank lines stay. Lines are in one class
    if equal, or, from ``least_chars`` characters, linked through lines within ``edits`` edits.
    Of each class the first line in order of id stays. ``n_lines`` counts all lines, ``n_near``
    those that have a link. A NULL text has one blank line. Rows alike in id and text are one
    row of the result. Other columns are left out.
    """
    classes, count = stage_counted(line_classes(docs, doc_id, text, edits, least_chars), "line-classes")
    classes = F.broadcast(classes) if count <= FEW else classes  # else both sides are dealt out by key
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row", "nth")
    seen = occurrences(docs, doc_id, text).select(*line_key(F.col("line")), place.alias("place"))
    marked = stage(seen.join(classes, ["k1", "k2"]).select("root", "links", "place"), "line-places")
    firsts = marked.groupBy("root").agg(F.min("place").alias("first"))
    fates = marked.join(firsts, "root").select("place.*", (F.col("place") != F.col("first")).alias("gone"), (F.col("links") > 0).alias("near"))
    found = fates.where("gone or near").groupBy("id", "row").agg(
        F.sort_array(F.collect_set(F.when(F.col("gone"), F.col("nth")))).alias("removed"),
        F.count_distinct(F.when(F.col("near"), F.col("nth"))).alias("near"),
    )
    texts = text_or_empty(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(texts).alias("hash"), (F.octet_length(texts) - F.octet_length(F.replace(texts, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines")).distinct()
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["hash"] == found["row"]), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.coalesce("near", F.lit(0)).alias("n_near"), F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))


def kept_lines(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each text's removed lines gone; ``found`` is from :func:`dedup_lines`, ids unique."""
    joined = docs.join(found.select(F.col("doc_id").alias("_id"), F.col("removed").alias("_removed")), docs[doc_id].eqNullSafe(F.col("_id")), "left")
    lines = F.split(text_or_empty(text), "\n")
    kept = F.filter(lines, lambda line, nth: ~F.coalesce(F.array_contains("_removed", nth), F.lit(False)))
    return joined.withColumn(text, F.array_join(kept, "\n")).select(*docs.columns)
