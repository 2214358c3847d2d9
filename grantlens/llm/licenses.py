"""License notices in texts, found by MinHash bands and verified by shingle containment.

All of it is DataFrame functions. A template of n words is looked for in windows of 2n words
that begin every n words, so each occurrence lies whole in some window. Bands are single
MinHash values: a window that holds four fifths of a template's shingles has at least a sixth
of their union in common with it, so all of ``BANDS`` bands miss it with a chance of
(5/6)**64, below 0.00001. A window is retrieved where a band agrees, and matches where it
really holds enough of the template's shingles.

Equal MinHash values come from equal shingles, so texts and windows without any shingle of a
template are left out before values are computed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.llm.common import text_or_empty
from grantlens.session import stage

SHINGLE, BANDS, CONTAINMENT = 5, 64, 0.8
#: What lies between words, as Java and as Python write it.
BETWEEN, BETWEEN_PYTHON = r"[^\p{L}\p{N}]+", r"[\W_]+"

#: Notices as their licenses word them.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BETWEEN), "")


def shingles(of: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order of place; none if there are fewer words."""
    last = F.size(of) - size
    places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda at: F.xxhash64(*[F.get(of, at + k) for k in range(size)]))


def min_hashes(hashes: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.lit(BANDS)),
        lambda band: F.struct(band.alias("band"), F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band))).alias("value")),
    )


def template_table(spark: SparkSession, notices: dict[str, str], shingle: int) -> DataFrame:
    """``license``, ``length`` and ``size`` in words, and distinct ``hashes``; written, as it is small and used often."""
    counted = []
    for name, text in notices.items():
        length = len([w for w in re.split(BETWEEN_PYTHON, text.lower()) if w])
        if length:
            counted.append((name, text, length, min(shingle, length)))
    table = spark.createDataFrame(counted, "license string, text string, length int, size int").withColumn("words", words(F.col("text")))
    hashed = F.lit(None).cast("array<long>")
    for size in sorted({row[3] for row in counted}):
        hashed = F.when(F.col("size") == size, shingles(F.col("words"), size)).otherwise(hashed)
    return stage(table.select("license", "length", "size", F.array_distinct(hashed).alias("hashes")), "license-templates")


def literal(values: set[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in sorted(values)])


def scan(
    docs: DataFrame,
    notices: dict[str, str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """``doc_id``, ``license``, ``containment``, ``first_word`` and ``windows`` per text and license found.

    ``containment`` is the greatest share of the template's distinct shingles in one window,
    ``first_word`` the least begin of a matching window, counted in words, ``windows`` how
    many match. A template of fewer words than a shingle is one shingle. Case, punctuation and
    line ends do not matter. NULL and empty texts hold nothing; rows repeated with one id count
    as one text each and their findings are merged. Other columns are left out.
    """
    spark = docs.sparkSession
    templates = template_table(spark, notices if notices is not None else NOTICES, shingle)
    # the templates are a parameter of the call, so they are few
    known = templates.collect()
    schema = dict(docs.dtypes)[doc_id]
    if not known:
        return spark.createDataFrame([], f"doc_id {schema}, license string, containment double, first_word long, windows long")
    by_size: dict[int, set[int]] = {}
    by_length: dict[tuple[int, int], set[int]] = {}
    for row in known:
        by_size.setdefault(row["size"], set()).update(row["hashes"])
        by_length.setdefault((row["length"], row["size"]), set()).update(row["hashes"])

    def holds_any(of: Column) -> Column:
        found = F.lit(False)
        for size, values in by_size.items():
            found = found | F.arrays_overlap(shingles(of, size), literal(values))
        return found

    once = F.array(words(text_or_empty(text)))  # a one-element array lets the words be named once
    some = docs.where(F.exists(once, holds_any)).select(F.col(doc_id).alias("doc_id"), words(text_or_empty(text)).alias("words"))
    some = stage(some, "license-texts")
    windows = None
    for (length, size), values in sorted(by_length.items()):
        begins = F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(length))
        part = (
            some.select("doc_id", shingles(F.col("words"), size).alias("all"), begins.alias("begins"))
            .select("doc_id", "all", F.explode("begins").alias("begin"))
            .select("doc_id", "begin", F.array_distinct(F.slice("all", F.col("begin") + 1, 2 * length - size + 1)).alias("held"))
            .where(F.arrays_overlap("held", literal(values)))
            .withColumn("length", F.lit(length))
        )
        windows = part if windows is None else windows.unionByName(part)
    windows = windows.withColumn("window", F.struct("doc_id", "begin"))
    bands = windows.select("doc_id", "begin", "length", "held", F.explode(min_hashes(F.col("held"))).alias("b"))
    wanted = templates.select("license", "length", F.col("hashes").alias("template"), F.explode(min_hashes(F.col("hashes"))).alias("b"))
    # one row per band and template, both parameters
    retrieved = bands.join(F.broadcast(wanted), ["length", "b"])
    share = F.size(F.array_intersect("template", "held")) / F.size("template")
    verified = retrieved.select("doc_id", "begin", "license", share.alias("share")).where(F.col("share") >= containment)
    once_each = verified.groupBy("doc_id", "license", "begin").agg(F.max("share").alias("share"))
    return once_each.groupBy("doc_id", "license").agg(
        F.max("share").alias("containment"), F.min("begin").cast("long").alias("first_word"), F.count(F.lit(1)).alias("windows")
    )


def check_sql(notices: dict[str, str], shingle: int = SHINGLE, containment: float = CONTAINMENT) -> str:
    """The same findings in SQL, by comparing all windows."""
    values = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in notices.items())
    split = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return f"""
    WITH t0(license, text) AS (VALUES {values}),
    t1 AS (SELECT license, {split.format("text")} AS w FROM t0),
    t2 AS (SELECT license, w, CAST(len(w) AS BIGINT) AS n, least(len(w), {shingle}) AS k FROM t1),
    t3 AS (SELECT DISTINCT license, n, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, n - k + 2)) AS p FROM t2)),
    sized AS (SELECT license, count(*) AS total FROM t3 GROUP BY 1),
    d AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
    ks AS (SELECT DISTINCT k FROM t2),
    sh AS (SELECT doc_id, k, p, array_to_string(w[p + 1:p + k], ' ') AS s
           FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d, ks)),
    hit AS (SELECT doc_id, license, n, sh.k, p, s FROM sh JOIN t3 USING (k, s)),
    placed AS (SELECT doc_id, license, n, k, p, s, (p // n - back) * n AS begin FROM hit, (VALUES (0), (1)) b(back)),
    seen AS (SELECT doc_id, license, begin, count(DISTINCT s) / any_value(total) AS share
             FROM placed JOIN sized USING (license) WHERE begin >= 0 AND p + k <= begin + 2 * n GROUP BY 1, 2, 3)
    SELECT doc_id, license, max(share) AS containment, CAST(min(begin) AS BIGINT) AS first_word, count(*) AS windows
    FROM seen WHERE share >= {containment} GROUP BY 1, 2
    """
