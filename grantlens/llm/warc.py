"""Deterministic sharded writing of WARC archives, and reading them back.

Records are put in order of page id and cut into shards of about equal payload. A shard's
bounds come from running sums over that order, not from a sample, so the same pages always
give the same files, however the work was split. A task writes one shard: it regenerates all
headers and digests, compresses each record on its own, and rolls to a new file when the
compressed size reaches a limit. A file is written under a temporary name of its attempt and
renamed when whole; a repeated or rival attempt writes the same bytes under the same final
name. The manifest, written last, names every file with its size and digest; only files in a
manifest are read.

The archive's folder is any that ``pyarrow.fs`` opens, and all executors must see it.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlens.llm.common import small_batches
from grantlens.session import stage

#: Payloads of at least so many bytes may be revisits.
LEAST_REVISIT = 100
#: Payload bytes of a shard, and compressed bytes at which a file is closed.
SHARD_BYTES, ROLL_BYTES = 64 << 20, 8 << 20
#: Read records go on in batches of so many bytes.
BATCH_BYTES = 8 << 20
#: The most tasks that archives are read by.
READERS = 20_000
#: The place in order of rows without an id.
NO_ID = -(1 << 63)
#: Every record has this date: a rerun gives the same bytes.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "shard long, file string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}/{nth}')}>"


def one_line(value: str) -> str:
    """A header value: line ends and other control characters would end the header."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, nth: int) -> bytes:
    """One compressed record; a revisit has the HTTP header of the full payload and no body."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page_id, digest, nth),
        "WARC-Date": DATE,
        "WARC-Target-URI": one_line(url or ""),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "X-Page-ID": "" if page_id is None else str(page_id),
    }
    if refers_to is not None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest, 0), "X-Refers-To-Page-ID": str(refers_to)}
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in headers.items()) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=6, mtime=0)


class Roller:
    """Files of one shard, each under a temporary name until it is whole."""

    def __init__(self, folder: str, shard: int, limit: int) -> None:
        self.files, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.attempt = shard, limit, uuid.uuid4().hex
        self.number, self.done, self.stream = 0, [], None

    def add(self, data: bytes) -> None:
        if self.stream is None:
            self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{self.attempt}"
            self.stream = self.files.open_output_stream(self.temporary, compression=None)
            self.digest, self.records, self.size = hashlib.sha256(), 0, 0
        self.stream.write(data)
        self.digest.update(data)
        self.records, self.size = self.records + 1, self.size + len(data)
        if self.size >= self.limit:
            self.close()

    def close(self) -> list[tuple]:
        """Give the open file its name; all files of the shard so far."""
        if self.stream is not None:
            self.stream.close()
            self.files.move(self.temporary, f"{self.path}/{self.name}")
            self.done.append((self.shard, self.name, self.records, self.size, self.digest.hexdigest()))
            self.number, self.stream = self.number + 1, None
        return self.done


def shard_bounds(slim: DataFrame, shard_bytes: int) -> list[tuple[int, str]]:
    """The least (key, digest) of each shard: where the payload before, in that order, fills one.

    The running sum is taken in two steps, over ranges of the order and within them, and does
    not depend on where the ranges were cut. Equal rows are in one shard.
    """
    sizes = slim.groupBy("key", "digest").agg(F.sum("bytes").alias("bytes"))
    sizes = sizes.repartitionByRange("key", "digest").withColumn("range", F.spark_partition_id())
    sizes = stage(sizes, "warc-sizes")
    whole = sizes.groupBy("range").agg(F.sum("bytes").alias("whole"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ahead = whole.select("range", F.coalesce(F.sum("whole").over(before), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("range").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    # ``ahead`` has one row for each partition
    placed = sizes.withColumn("within", F.coalesce(F.sum("bytes").over(within), F.lit(0))).join(F.broadcast(ahead), "range")
    shard = F.floor((F.col("ahead") + F.col("within")) / shard_bytes)
    found = placed.groupBy(shard.alias("shard")).agg(F.min(F.struct("key", "digest")).alias("least")).collect()
    return sorted((row["least"]["key"], row["least"]["digest"]) for row in found)


def write_archive(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
) -> DataFrame:
    """Write every row of ``pages`` below ``folder``; return the manifest.

    Of rows with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the smallest
    id is a response, the others revisit it. A NULL payload is empty. Rows with a NULL id
    come first in order, are always responses, and nothing revisits them. Of rows with one id
    and one payload one is the first, and the others revisit it. Other columns are left out.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"),
        F.coalesce(F.col(page_id).cast("long"), F.lit(NO_ID)).alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    slim = stage(rows.select("id", "key", "digest", F.octet_length("payload").cast("long").alias("bytes")), "warc-slim")
    copies = slim.where((F.col("bytes") >= LEAST_REVISIT) & F.col("id").isNotNull())
    firsts = copies.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    # what a page must know of its copies travels beside it to its shard, as a row without payload
    notes = copies.join(firsts, "digest").select("key", "digest", "first").distinct()
    # one bound per shard, which is a task's work
    bounds = shard_bounds(slim, shard_bytes)
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)

    @F.pandas_udf("long")
    def shard_of(key: pd.Series, digest: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, pair) - 1 for pair in zip(key, digest, strict=True)], dtype="int64")

    both = rows.withColumns({"kind": F.lit(1), "first": F.lit(None).cast("long")}).unionByName(
        notes.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )
    ordered = (
        both.withColumn("shard", shard_of("key", "digest"))
        .repartitionById(max(1, len(bounds)), F.greatest("shard", F.lit(0)).cast("int"))  # one shard a task
        .sortWithinPartitions("shard", "key", "digest", "kind", "url")
        .select("shard", "key", "digest", "kind", "id", "url", "payload", "first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, last, nth, first, done = None, None, 0, None, []
        for batch in small_batches(batches, 200):
            for shard, key, digest, kind, own, target, body, points_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if roller is None or roller.shard != shard:
                    done += roller.close() if roller else []
                    roller = Roller(folder, shard, roll_bytes)
                if (key, digest) != last:
                    last, nth, first = (key, digest), 0, None
                if kind == 0:
                    first = points_to
                    continue
                revisits = own is not None and first is not None and (first != own or nth > 0)
                roller.add(record(own, target, body, first if revisits else None, nth))
                nth += 1
        done += roller.close() if roller else []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], ["shard", "file", "records", "bytes", "sha256"])

    # the writer of this table commits its own parts in the same way, and marks the whole when it is complete
    ordered.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a decompressed archive."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.read(int(headers["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


def parsed(headers: dict[str, str], block: bytes) -> tuple:
    """The row of a record, its digests checked."""
    if headers["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = headers["WARC-Payload-Digest"].partition(":")[2]
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    own, other = headers["X-Page-ID"], headers.get("X-Refers-To-Page-ID")
    body = payload if kind == "response" else None
    return int(own) if own else None, headers["WARC-Target-URI"], kind, int(other) if other else None, length, digest, body


def read_archive(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of all files in the manifest; ``payload`` is NULL for revisits.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with files.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    rows, held = [], 0
                    for headers, block in records(stream):
                        rows.append(parsed(headers, block))
                        held += len(block)
                        if held >= BATCH_BYTES:
                            yield as_batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield as_batch(rows)

    # dealt out by number, which is not merged again: a task for each file
    files = manifest.select("file")
    return files.repartition(int(np.clip(files.count(), 1, READERS))).mapInArrow(run, RECORD)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names)
