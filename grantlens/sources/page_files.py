"""Page files under their own names: ``year/state/batch.json``, one for each page.

A Python data source writes them, as Spark's own writers choose names themselves and take a folder, a
checksum file and some processes of the local system for each. Tasks write below a folder of the run, which
readers do not see; the commit gives the files their names on the driver, and an abort leaves none. Keep
large harvests as tables (:func:`pages.write_pages`); this is the layout that other programs read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from grantlens.operators.skew import null_safe_join
from grantlens.session import stage_counted
from grantlens.sources.pages import STORED_KEY, last_pages

STAGED = "_temporary"
#: Files named at a time by a commit, which waits for the file system rather than the processor.
NAMED_AT_ONCE = 16
#: Pages in a batch for Python, and the setting that says so.
PAGES_AT_ONCE, BATCH_ROWS = 32, "spark.sql.execution.arrow.maxRecordsPerBatch"


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, numbered from 0 in the folder ``held``: the names they are to have below the root."""

    held: str
    files: list[str]


def page_name(row: Row) -> str:
    """The name of a page's file; a key that is missing or would lead elsewhere is an error."""
    parts = [None if row[key] is None else str(row[key]) for key in ("fiscal_year", "org_state", "batch")]
    if any(not part or "/" in part or part in (".", "..") or part.startswith(("_", ".")) for part in parts):
        raise ValueError(f"no file can be named after {parts}")
    return "{}/{}/{}.json".format(*parts)


class PageFileWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path, self.staged = path.rstrip("/"), f"{STAGED}/{uuid.uuid4().hex}"

    def _root(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[Row]) -> Written:
        files, root = self._root()
        held, found = f"{self.staged}/{uuid.uuid4().hex}", []
        files.create_dir(f"{root}/{held}", recursive=True)
        for row in iterator:
            name = page_name(row)
            with files.open_output_stream(f"{root}/{held}/{len(found)}") as out:
                out.write((row["body"] or "").encode())
            found.append(name)
        return Written(held, found)

    def commit(self, messages: Sequence[Written | None]) -> None:
        files, root = self._root()
        tasks = [message for message in messages if message]
        for folder in {name.rsplit("/", 1)[0] for task in tasks for name in task.files}:
            files.create_dir(f"{root}/{folder}", recursive=True)

        # a local disk answers at once, so that threads would only wait for each other
        at_once = 1 if isinstance(files, fs.LocalFileSystem) else NAMED_AT_ONCE

        def put(first: int) -> None:
            for task in tasks:
                for k in range(first, len(task.files), at_once):
                    files.move(f"{root}/{task.held}/{k}", f"{root}/{task.files[k]}")

        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(put, range(at_once)))
        self._clear(files, root)

    def abort(self, messages: Sequence[Written | None]) -> None:
        self._clear(*self._root())

    def _clear(self, files: fs.FileSystem, root: str) -> None:
        """Nothing of this run is left, also of attempts that were killed; the shared folder goes with its last run."""
        if files.get_file_info(f"{root}/{self.staged}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.staged}")
        above = f"{root}/{STAGED}"
        if files.get_file_info(above).type != fs.FileType.NotFound and not files.get_file_info(fs.FileSelector(above)):
            files.delete_dir(above)


class PageFiles(DataSource):
    """``format("page_files")`` for rows ``fiscal_year, org_state, batch, body``."""

    @classmethod
    def name(cls) -> str:
        return "page_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return PageFileWriter(self.options["path"])


def _write(rows: DataFrame, root: str) -> None:
    """Pages are handed to Python a few at a time, as a batch of the usual 10,000 may be gigabytes."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(PageFiles)
    usual = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, PAGES_AT_ONCE)
    try:
        rows.write.format("page_files").mode("append").save(root)
    finally:
        spark.conf.set(BATCH_ROWS, usual)


def one_a_key(pages: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """What :func:`last_pages` gives, with pages left where they are if no other has their key.

    Keys that come more than once are found without the bodies, and only their pages are moved.
    """
    counts = pages.groupBy(*STORED_KEY).agg(F.count(F.lit(1)).alias("_n"))
    repeated, n_repeated = stage_counted(counts.filter("_n > 1").select(*STORED_KEY), "repeated-pages")
    if not n_repeated:
        return pages.select(*STORED_KEY, "body")
    once, often = (null_safe_join(pages, repeated, STORED_KEY, how) for how in ("left_anti", "left_semi"))
    return once.select(*STORED_KEY, "body").unionByName(last_pages(often, order_by))


def write_page_files(pages: DataFrame, root: str, order_by: Sequence[str] = ()) -> None:
    """Each page in a file of its own below ``root``; one that is there already is replaced, others stay.

    Of pages with one key the last by ``order_by`` (then by body) is written. A NULL body is an empty file.
    ``pages`` is read more than once: stage it where it is costly to make.
    """
    _write(one_a_key(pages, order_by), root)


def knows(path: str) -> bool:
    """Whether page files can be written below ``path``; other stores take the layout of Spark's writers."""
    try:
        fs.FileSystem.from_uri(path)
    except (OSError, ValueError, NotImplementedError):
        return False
    return True


def write_cache(pages: DataFrame, root: str) -> None:
    """Page rows as a harvest leaves them below ``root``: a file for each key, which comes once, of one line."""
    batch = F.regexp_replace("page_file", r"\.json$", "")
    line = F.concat(F.coalesce("body", F.lit("")), F.lit("\n"))
    _write(
        pages.select(F.col("page_year").alias("fiscal_year"), F.col("page_state").alias("org_state"), batch.alias("batch"), line.alias("body")),
        root,
    )
