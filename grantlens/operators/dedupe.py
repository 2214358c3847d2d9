"""Duplicate removal by two keys, upserts, and key look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantlens.operators import skew
from grantlens.operators.numbering import ordered
from grantlens.session import stage, stage_counted, stage_observed, staged_folder


def _key(c: Column) -> Column:
    """A text key as a non-null value, so that NULL is a key like any other."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def _two_keys(project: str, core: str) -> tuple[Column, Column]:
    """The project key and the core key of a row.

    A row without a core number stands under its project number among the cores.
    """
    core_text = F.col(core).cast("string")
    checked = F.when(F.coalesce(core_text, F.lit("")) == "", F.col(project).cast("string")).otherwise(core_text)
    return _key(F.col(project)), _key(checked)


def _keys(rows: DataFrame, project: str, core: str, order_by: Sequence[str]) -> DataFrame:
    """The order columns with project key ``p`` and core key ``c``."""
    p, c = _two_keys(project, core)
    return rows.select(*order_by, p.alias("p"), c.alias("c"))


def keyed_rows(rows: DataFrame, project: str, core: str) -> DataFrame:
    """``rows`` with both keys, never NULL, as ``_p`` and ``_c``."""
    p, c = _two_keys(project, core)
    return rows.withColumns({"_p": p, "_c": c})


def _spread(live: DataFrame, key: str, hot: list) -> tuple[DataFrame, list[str]]:
    """``live`` and the columns that tell the groups of ``key``: with a salt beside the key where some keys are hot."""
    if not hot:
        return live, [key]
    salt = f"_salt_{key}"
    if salt not in live.columns:
        spread = skew.salt_of(F.col("ord"), skew.salt_count(live))
        live = live.withColumn(salt, F.when(F.col(key).isin(hot), spread).otherwise(0))
    return live, [key, salt]


def _unclaimed(live: DataFrame, kept: DataFrame, key: str, hot: list) -> DataFrame:
    """``live`` without the rows that share ``key`` with a kept one, dealt as :func:`_earlier` deals them."""
    live, groups = _spread(live, key, hot)
    claimed = kept.select(key)
    for salt in groups[1:]:
        salts = F.sequence(F.lit(0), F.lit(skew.salt_count(live) - 1))
        claimed = claimed.withColumn(salt, F.explode(F.when(F.col(key).isin(hot), salts).otherwise(F.array(F.lit(0)))))
    return live.join(claimed, groups, "left_anti")


def _earlier(live: DataFrame, key: str, hot: list) -> DataFrame:
    """``live`` with the rows before each one that share ``key``.

    Adds ``<key>_n`` (0, 1 or 2 for more) and, where it is 1, ``<key>_up``: that row's place.
    The rows are moved once, to be counted in order. Those of hot keys are spread instead and told
    by the two least places of their key, one row for each such key.
    """
    count, up = f"{key}_n", f"{key}_up"
    live, groups = _spread(live, key, hot)
    if hot:
        first_two = Window.partitionBy(key).orderBy("ord")
        ends = live.filter(F.col(key).isin(hot)).select(key, "ord", F.row_number().over(first_two).alias("_nth")).filter("_nth <= 2")
        ends = ends.groupBy(key).agg(F.min("ord").alias("_least"), F.max("ord").alias("_second"))
    order = Window.partitionBy(*groups).orderBy("ord")
    live = live.withColumns({"_nth": F.row_number().over(order), up: F.lag("ord").over(order)})
    before, above = F.least(F.col("_nth") - 1, F.lit(2)), F.col(up)
    if hot:
        live = live.join(F.broadcast(ends), key, "left")  # fewer rows than partitions
        spread = F.when(F.col("ord") == F.col("_least"), 0).when(F.col("ord") == F.col("_second"), 1).otherwise(2)
        known = F.col("_least").isNotNull()
        before, above = F.when(known, spread).otherwise(before), F.when(known, F.col("_least")).otherwise(above)
    return live.withColumn(count, before).withColumn(up, F.when(F.col(count) == 1, above)).drop("_nth", "_least", "_second", *groups[1:])


def _twice(chains: DataFrame) -> DataFrame:
    """Chains that reach from each row to where the row they pointed at pointed."""
    known = chains.select(F.col("ord").alias("up"), F.col("up").alias("further"), F.col("odd").alias("also_odd"))
    found = F.col("further").isNotNull()
    return chains.join(known, "up", "left").select(
        "ord",
        F.when(found, F.col("further")).otherwise(F.col("up")).alias("up"),
        F.when(found, F.col("odd") != F.col("also_odd")).otherwise(F.col("odd")).alias("odd"),
        found.alias("open"),
    )


def _follow(single: DataFrame) -> DataFrame:
    """The row that ends each chain of rows with one row before them, and whether it is an odd number of steps away.

    Each table written reaches eight times as far as the last, so a chain of n rows needs log8(n).
    """
    chains, is_open = single.select("ord", "up", F.lit(True).alias("odd")), True
    while is_open:
        chains, seen = stage_observed(_twice(_twice(_twice(chains))), "chains", open=F.count_if("open"))
        is_open = bool(seen["open"])
    return chains.select("ord", "up", "odd")


def kept_pairs(slim: DataFrame, hot_p: list, hot_c: list) -> tuple[DataFrame, int]:
    """The pairs ``(ord, p, c)`` that a first-wins reading keeps, and the rounds it took.

    A row with no row before it under either key is kept. One with a single such row has the
    opposite fate; these rows form trees, which are settled by doubling steps. All rows that
    share a key with a kept one then go, and the next round begins. The first live row is
    kept in each round, so the rounds end; every table is written to the shared folder.
    """
    spark = slim.sparkSession
    folder = staged_folder(spark, "two-key")
    schema = "ord bigint, p string, c string"
    live = stage(slim.groupBy("p", "c").agg(F.min("ord").alias("ord")), "pairs")
    kept, turn = spark.createDataFrame([], schema), 0
    while True:
        marked = _earlier(_earlier(live, "p", hot_p), "c", hot_c)
        single = F.col("p_n") + F.col("c_n") == 1
        marked, seen = stage_observed(
            marked.select(
                "ord", "p", "c",
                (F.col("p_n") + F.col("c_n") == 0).alias("is_first"),
                F.when(single, F.coalesce("p_up", "c_up")).alias("up"),
            ),
            "marked",
            rows=F.count(F.lit(1)),
            single=F.count("up"),
        )
        if not seen["rows"]:
            break
        now = firsts = marked.filter("is_first").select("ord", "p", "c")
        if seen["single"]:
            even = _follow(marked.filter("up is not null")).filter("not odd")
            even = even.join(firsts.select(F.col("ord").alias("up")), "up", "left_semi")
            now = firsts.unionByName(marked.filter("up is not null").select("ord", "p", "c").join(even.select("ord"), "ord", "left_semi"))
        now.write.parquet(f"{folder}/round={turn}")
        now = spark.read.schema(schema).parquet(f"{folder}/round={turn}")
        # by project last, as the next round counts by project first: the rows lie right for it
        live = _unclaimed(_unclaimed(marked.select("ord", "p", "c"), now, "c", hot_c).select("ord", "p", "c"), now, "p", hot_p)
        turn += 1
    if turn:
        kept = spark.read.schema(schema).parquet(folder)
    return kept.select("ord", "p", "c"), turn


def _settled(keys: DataFrame, order_by: Sequence[str], place: str | None = None) -> tuple[DataFrame, DataFrame, list]:
    """Keys in order, staged, with the pairs kept and the hot project keys; ``place`` names a number that tells it."""
    if place:  # of a staged table already
        slim = keys.withColumnRenamed(place, "ord")
        total = slim.count()
    else:
        slim, total = stage_counted(ordered(keys, order_by), "keys")
    hot_p = skew.hot_values(skew.key_counts(slim, "p"), "p", total)
    hot_c = skew.hot_values(skew.key_counts(slim, "c"), "c", total)
    kept, _ = kept_pairs(slim, hot_p, hot_c)
    return slim, kept, hot_p


def two_key_status(
    rows: DataFrame, project: str, core: str, order_by: Sequence[str], row_id: str | None = None
) -> DataFrame:
    """``keep``, ``project`` or ``core`` per row, as ``(*order_by, status)`` or ``(row_id, status)``.

    Reading in order, a row is dropped as ``project`` when a kept row before it has its
    project key, else as ``core`` when one has its core key. Only kept rows claim keys,
    so a dropped row never blocks another. Repeats of a key pair are merged beforehand, and
    keys with more rows than a mean partition are salted in every join.
    """
    carried = [row_id] if row_id else list(order_by)
    slim, kept, hot_p = _settled(_keys(rows, project, core, [*order_by, *([row_id] if row_id else [])]), order_by)
    labelled = skew.salted_join(slim, kept.select("p", F.col("ord").alias("kept_ord")), "p", "left", hot_p, F.col("ord"))
    status = (
        F.when(F.col("kept_ord") == F.col("ord"), "keep")
        .when(F.col("kept_ord") < F.col("ord"), "project")
        .otherwise("core")
    )
    return labelled.select(*carried, status.alias("status"))


def _joined(rows: DataFrame, fates: DataFrame, order_by: Sequence[str], row_id: str | None, how: str = "inner") -> DataFrame:
    """Fates joined to the rows, on ``row_id`` where there is one: a single number."""
    return rows.join(fates, row_id, how) if row_id else skew.null_safe_join(rows, fates, order_by, how)


def two_key_label(
    rows: DataFrame, project: str, core: str, order_by: Sequence[str], row_id: str | None = None
) -> DataFrame:
    """All columns of ``rows`` with ``skipped_project`` and ``skipped_core``.

    ``row_id`` names a column that is unique and written, if there is one.
    """
    status = two_key_status(rows, project, core, order_by, row_id)
    return _joined(rows, status, order_by, row_id).select(
        *rows.columns,
        (F.col("status") == "project").alias("skipped_project"),
        (F.col("status") == "core").alias("skipped_core"),
    )


def two_key_dedupe(
    rows: DataFrame, project: str, core: str, order_by: Sequence[str], row_id: str | None = None
) -> DataFrame:
    """The rows a first-wins reading keeps.

    Without ``row_id`` the rows are staged in order, with their places, so that neither they are made
    twice nor both sides are moved by all of ``order_by``.
    """
    if row_id:
        slim, kept, _ = _settled(_keys(rows, project, core, [*order_by, row_id]), order_by)
        return rows.join(slim.select(row_id, "ord").join(kept.select("ord"), "ord", "left_semi"), row_id, "left_semi")
    place = "_place"
    placed = stage(ordered(rows, order_by, place), "rows")
    _, kept, _ = _settled(_keys(placed, project, core, [place]), [place], place)
    return placed.join(kept.select(F.col("ord").alias(place)), place, "left_semi").select(*rows.columns)


def two_key_flag(
    rows: DataFrame, project: str, core: str, order_by: Sequence[str], row_id: str | None = None
) -> DataFrame:
    """All rows kept and every key claimed: which rows repeat a key seen before.

    A row may be both ``skipped_project`` and ``skipped_core``.
    """
    carried = [row_id] if row_id else list(order_by)
    slim, total = stage_counted(ordered(_keys(rows, project, core, [*order_by, *([row_id] if row_id else [])]), order_by), "keys")
    flagged = slim
    for key in ("p", "c"):
        firsts = slim.groupBy(key).agg(F.min("ord").alias(f"first_{key}"), F.count(F.lit(1)).alias("n"))
        hot = skew.hot_values(firsts, key, total)
        flagged = skew.salted_join(flagged, firsts.drop("n"), key, "inner", hot, F.col("ord"))
    flags = flagged.select(
        *carried,
        (F.col("ord") > F.col("first_p")).alias("skipped_project"),
        (F.col("ord") > F.col("first_c")).alias("skipped_core"),
    )
    return _joined(rows, flags, order_by, row_id).select(*rows.columns, "skipped_project", "skipped_core")


def latest(rows: DataFrame, key: str, order_by: str | Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key.

    The greatest place per key is found on slim rows and joined back, so the wide columns
    are neither sorted nor merged. Of rows alike in key and order one is taken.
    """
    return _extreme(rows, key, order_by, F.max)


def first_per_key(rows: DataFrame, key: str, order_by: str | Sequence[str]) -> DataFrame:
    """The row with the least ``order_by`` per key."""
    return _extreme(rows, key, order_by, F.min)


def _extreme(rows: DataFrame, key: str, order_by: str | Sequence[str], pick) -> DataFrame:
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    best = rows.groupBy(key).agg(pick(place).alias("_best")).withColumnRenamed(key, "_key")
    same = F.col(key).eqNullSafe(F.col("_key")) & place.eqNullSafe(F.col("_best"))
    tied = Window.partitionBy(key).orderBy(*order)
    found = rows.join(best, same).withColumn("_nth", F.row_number().over(tied))
    return found.filter("_nth = 1").select(*rows.columns)


def upsert(store: DataFrame, incoming: DataFrame, key: str, order_by: str | Sequence[str]) -> DataFrame:
    """The store with incoming rows put in place of those with the same key.

    Of several incoming rows with one key the last by ``order_by`` (one column or several) wins. The store,
    unique in ``key``, is only anti-joined, so it is not shuffled where the incoming
    keys are few enough for AQE to broadcast.
    """
    newest = latest(incoming, key, order_by)
    kept = store.join(incoming.select(key).distinct(), key, "left_anti")
    return kept.select(*store.columns).unionByName(newest.select(*store.columns))


def insert_ignore(store: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The store with those incoming key combinations added that it lacks."""
    new = incoming.select(*keys).distinct().join(store, list(keys), "left_anti")
    return store.select(*keys).unionByName(new)


def missing_keys(wanted: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Wanted rows whose key the store lacks; repeats stay."""
    return wanted.join(store.select(key), key, "left_anti")


def existing_keys(wanted: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """Wanted rows whose key the store has; repeats stay."""
    return wanted.join(store.select(key), key, "left_semi")
