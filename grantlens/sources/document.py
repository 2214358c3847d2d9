"""A graph as one JSON document, for programs that load it whole.

Members are written as parts by many tasks, one member to a line, and the parts are then joined in order.
A file system writes one file by one stream, so the joining is a copy of bytes from file to file, by
a buffer of fixed size; no member is parsed or held on the way. Keep large graphs as tables
(:func:`store.write_network`).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlens.session import drop_staged, staged_folder

BUFFER = 1 << 16


def quoted(c: Column) -> Column:
    """A value as a JSON string."""
    whole = F.to_json(F.array(c.cast("string")))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def as_member(key: Column, value: Column) -> Column:
    return F.concat(quoted(key), F.lit(":"), value)


def join_parts(spark: SparkSession, pieces: Sequence[str | DataFrame], path: str) -> None:
    """Texts and members (a column ``value`` of JSON each), in order, as one file at ``path``.

    The file has its name once it is whole; one that is there already is replaced then.
    """
    folders = []
    for piece in pieces:
        if isinstance(piece, DataFrame):
            folders.append(staged_folder(spark, "document"))
            piece.select(F.concat(F.lit(","), "value").alias("value")).write.text(folders[-1])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(conf)
    held = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = files.create(held)
    try:
        waiting = iter(folders)
        for piece in pieces:
            if isinstance(piece, str):
                out.write(piece.encode())
            else:
                _copy_members(spark, next(waiting), out)
        out.close()
        files.delete(target, False)
        if not files.rename(held, target):
            raise OSError(f"{path} could not be put in place")
    finally:
        out.close()
        files.delete(held, False)
        drop_staged(spark, folders)


def _copy_members(spark: SparkSession, folder: str, out) -> None:
    """The lines of all parts; the comma before the first member is left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(conf)
    parts = sorted((str(found.getPath()), found) for found in files.listStatus(place) if found.getPath().getName().startswith("part-") and found.getLen())
    for nth, (_, found) in enumerate(parts):
        part = files.open(found.getPath())
        try:
            if not nth:
                part.seek(1)
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, BUFFER, False)
        finally:
            part.close()


def write_edges_document(edges: DataFrame, stats: DataFrame, path: str) -> None:
    """``{"edges": [...], "stats": {...}}``; ``stats`` has one row."""
    members = edges.select(F.to_json(F.struct(*edges.columns)).alias("value"))
    join_parts(edges.sparkSession, ['{"edges": [\n', members, '],\n"stats":\n', _only(stats), "\n}\n"], path)


def _only(stats: DataFrame) -> str:
    return stats.select(F.to_json(F.struct(*stats.columns)).alias("value")).first()["value"]


def write_network_document(network: dict[str, DataFrame], path: str) -> None:
    """A network (:func:`graph.build_network`) as ``{"nodes": {kind: {id: node}}, "edges": [...], "stats": {...}}``.

    An author's node has the list of its papers, and so has the size of that list.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("nth", "pmid"))), lambda paper: paper["pmid"])
    papers = network["author_papers"].groupBy("name").agg(listed.alias("papers"))
    authors = network["authors"].drop("n_papers").join(papers, "name")
    spark = authors.sparkSession
    pieces: list[str | DataFrame] = ['{"nodes": {\n']
    for nth, (kind, nodes) in enumerate({"grants": network["grants"], "papers": network["papers"], "authors": authors}.items()):
        members = nodes.select(as_member(F.col("id"), F.to_json(F.struct(*nodes.columns))).alias("value"))
        pieces += [f'{"," if nth else ""}"{kind}": {{\n', members, "}\n"]
    edges = network["edges"]
    pieces += ['},\n"edges": [\n', edges.select(F.to_json(F.struct(*edges.columns)).alias("value")), '],\n"stats":\n', _only(network["stats"]), "\n}\n"]
    join_parts(spark, pieces, path)
