"""Cached result pages: discovery, tolerant parsing, flattening, keyed writes.

The raw layout is one JSON document per ``<root>/<fiscal_year>/<org_state>/<batch>.json``.
A page row is ``(page_year, page_state, page_file, body)``. Reading order is the
order of these three texts, then the position in the page: :data:`PAGE_ORDER`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlens.functions import variants
from grantlens.session import stage, staged_folder

PAGE_KEY = ("page_year", "page_state", "page_file")
PAGE_ORDER = (*PAGE_KEY, "pos")
PAGE_COLUMNS = (*PAGE_KEY, "body")
PAGE_SCHEMA = "page_year string, page_state string, page_file string, body string"
#: Small page files that one task reads, and files that are listed at a time, each with about a kilobyte on the driver.
FILES_A_TASK, FILES_AT_ONCE = 1000, 250_000
STORED_SCHEMA = "batch int, body string, fiscal_year string, org_state string"


def page_path_columns(path):
    """Year, state and file name from the last three parts of a page's path.

    In the layout that Spark writes, partitioned by these names, the parts are folders that
    hold one file each.
    """
    parts = F.split(F.url_decode(path), "/")
    written = F.element_at(parts, -2).startswith(f"{PAGE_KEY[-1]}=")
    columns = []
    for index, name in zip((-3, -2, -1), PAGE_KEY):
        value = F.when(written, F.element_at(parts, index - 1)).otherwise(F.element_at(parts, index))
        columns.append(F.regexp_replace(value, f"^{name}=", "").alias(name))
    return columns


def write_page_files(pages: DataFrame, root: str) -> None:
    """One text file per page, partitioned by year, state and file name, as :func:`scan_pages` reads it."""
    pages.select(*PAGE_KEY, "body").write.mode("overwrite").partitionBy(*PAGE_KEY).text(root)


def _read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where its path names nothing. Files are listed once."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    return _read_if_there(lambda: spark.read.text(path)) is not None


def _page_folders(spark: SparkSession, root: str) -> tuple[list[tuple[str, int]], bool]:
    """The folders of a year and state with their numbers of files, and whether some are of the layout that Spark writes.

    A folder's own name is made safe as a pattern. Folders of a write that is under way are left out.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/*")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    plain, written = [], False
    for status in files.globStatus(path) or []:
        year, state = status.getPath().toString().split("/")[-2:]
        if not status.isDirectory() or year == "_temporary":
            continue
        if state.startswith(f"{PAGE_KEY[1]}="):
            written = True
        else:
            name = re.sub(r"([\\*?\[\]{}])", r"\\\1", status.getPath().toString())
            plain.append((name, files.getContentSummary(status.getPath()).getFileCount()))
    return plain, written


def _groups(folders: Sequence[tuple[str, int]], most: int) -> Iterator[list[str]]:
    """Folders in their order, in groups of at most ``most`` files; a larger folder is a group of its own."""
    group, held = [], 0
    for name, n_files in folders:
        if group and held + n_files > most:
            yield group
            group, held = [], 0
        group.append(name)
        held += n_files
    if group:
        yield group


def _read_files(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Page rows of files that are not empty, by as many tasks as their number and bytes ask for.

    Spark counts a small file as some megabytes, so that a task would get only a few of them.
    """
    spark, jdf = files.sparkSession, files._jdf
    n_bytes, n_files = int(str(jdf.queryExecution().analyzed().stats().sizeInBytes())), len(jdf.inputFiles())
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = max(n_bytes // size, n_files // FILES_A_TASK, spark.sparkContext.defaultParallelism) + 1
    held = files.filter("length > 0").select(F.col("_metadata.file_path").alias("path"), "content").coalesce(tasks)
    return held.select(*page_path_columns(F.col("path")), F.col("content").cast("string").alias("body")).select(*columns)


def scan_pages(spark: SparkSession, root: str, columns: Sequence[str] = PAGE_COLUMNS) -> DataFrame:
    """One row per page file; no rows where the folder is missing.

    A file of zero bytes gives no row, so it is skipped without being listed as bad. Folders are listed
    whole, as a look at each file by itself takes longer than to read it. The driver holds what it knows of
    at most :data:`FILES_AT_ONCE` files of a folder's own names: where there are more, ``columns`` of a
    group of folders after the other are staged.
    """
    folders, written = _page_folders(spark, root)

    def read(group: list[str]) -> DataFrame:
        return _read_files(spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(group), columns)

    found = []
    groups = list(_groups(folders, FILES_AT_ONCE))
    if len(groups) > 1:
        path = staged_folder(spark, "scanned")
        for group in groups:
            read(group).write.mode("append").parquet(path)
        found.append(spark.read.schema(PAGE_SCHEMA).parquet(path).select(*columns))
    elif groups:
        found.append(read(groups[0]))
    if written:
        pattern = f"{root}/*/{PAGE_KEY[1]}=*/*.json"
        files = _read_if_there(lambda: spark.read.format("binaryFile").load(pattern))
        found += [] if files is None else [_read_files(files, columns)]
    if not found:
        return spark.createDataFrame([], PAGE_SCHEMA).select(*columns)
    return reduce(DataFrame.unionByName, found)


def parse_pages(pages: DataFrame) -> DataFrame:
    """Page keys with ``page`` (VARIANT, NULL where the body does not parse).

    Of a repeated name the last value counts; the session is set to allow such names.
    Exploding the one-element array keeps later filters from repeating the parse.
    """
    pages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return pages.select(*PAGE_KEY, F.explode_outer(F.array(variants.parse(F.col("body")))).alias("page"))


def _results() -> Column:
    return variants.elements(F.col("page"), "$.results")


def _is_bad() -> Column:
    """A page that is no JSON object, or whose ``results`` is there but no list."""
    given = F.try_variant_get("page", "$.results", "variant").isNotNull()
    return F.col("page").isNull() | ~variants.is_object(F.col("page")) | (given & _results().isNull())


def bad_pages(pages: DataFrame) -> DataFrame:
    """Keys of the pages a scan leaves out."""
    return parse_pages(pages).filter(_is_bad()).select(*PAGE_KEY)


def page_totals(pages: DataFrame) -> DataFrame:
    """Per good page: its key, ``batch``, ``total`` (0 where absent) and ``n_results``."""
    return parse_pages(pages).filter(~_is_bad()).select(
        *PAGE_KEY,
        F.regexp_extract("page_file", r"^(.*)\.json$", 1).try_cast("int").alias("batch"),
        F.coalesce(variants.number(F.col("page"), "$.meta.total", "bigint"), F.lit(0).cast("bigint")).alias("total"),
        F.coalesce(F.size(_results()), F.lit(0)).cast("bigint").alias("n_results"),
    )


def flatten_results(pages: DataFrame) -> DataFrame:
    """One row per record of every good page, with its ``pos`` in the page.

    A bad page has no list of results, so it gives no rows.
    """
    exploded = parse_pages(pages).select(*PAGE_KEY, F.posexplode_outer(_results()).alias("pos", "record"))
    return exploded.filter("pos is not null")


def read_page(stored: DataFrame, fiscal_year: str, org_state: str, batch: int) -> DataFrame:
    """One stored page by its key; year and state prune partitions."""
    return stored.filter(
        (F.col("fiscal_year") == str(fiscal_year)) & (F.col("org_state") == org_state) & (F.col("batch") == int(batch))
    )


def read_stored_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(path)


#: What a stored page is known by.
STORED_KEY = ["fiscal_year", "org_state", "batch"]


def last_pages(pages: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """One page per key: the last by ``order_by``, then by body."""
    last = Window.partitionBy(*STORED_KEY).orderBy(*[F.desc(name) for name in (*order_by, "body")])
    return pages.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1").select(*STORED_KEY, "body")


def write_pages(pages: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Keep pages by ``(fiscal_year, org_state, batch)``; a page with a known key replaces it.

    Of pages that come with one key the last by ``order_by`` (then by body) is kept. Only the
    year/state partitions that get new pages are rewritten; which these are stays a table.
    ``pages`` is read more than once: stage it where it is costly to make.
    """
    spark, key = pages.sparkSession, STORED_KEY
    incoming = last_pages(pages, order_by)
    old = _read_if_there(lambda: read_stored_pages(spark, path))
    if old is not None:
        touched = incoming.select("fiscal_year", "org_state").distinct()
        kept = old.join(touched, ["fiscal_year", "org_state"], "left_semi").join(incoming.select(*key), key, "left_anti")
        # a table cannot be read while its partitions are replaced
        incoming = stage(incoming.unionByName(kept.select(*incoming.columns)), "pages")
    # Rebalancing gathers a partition's pages into few files, and splits a huge one.
    (
        incoming.hint("rebalance", "fiscal_year", "org_state")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fiscal_year", "org_state")
        .parquet(path)
    )
