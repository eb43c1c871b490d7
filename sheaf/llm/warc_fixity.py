"""Operator 2, WARC archives and their Merkle fixity audit.

``warc_records`` turns pages into WARC records laid out in files (consecutive ids share a file);
``read_warc`` reads WARC files into the same shape. Every record is hashed, and a tree of hashes is built
over ordered offset ranges: a leaf hashes the (offset, length, digest) list of the records that start
in one range of bytes, an inner node the (number, hash) list of up to ``FANOUT`` nodes below it. File
number and offset make one address space, so the tree's upper levels span files.

An audit compares the replicas' roots and descends only below nodes that differ; the records of the
leaf ranges that differ are compared last. Identical archives cost one comparison of roots. Nodes are
grouped by address, so no node gathers more than its fan-out and no hot key exists; trees are
written to the shared checkpoint folder before the descent.

Defined results: null html is an empty payload, null url an empty target; records without an id lie in files
below zero, which one by a hash of their bytes, so that no file gathers them all;
rows that repeat are records of their own; empty archives have no nodes and are equal; a record in one
replica only is ``missing`` (from the second) or ``extra``; one whose bytes differ is ``changed``.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheaf.llm.common import Scratch, ship, written

FANOUT = 16
RANGE = 1 << 16  # bytes of a leaf range
SPAN = RANGE * FANOUT ** 2  # address space of one file (16 MiB); a longer one runs into the next one's


_NAMELESS = 1 << 20  # files for records without an id


def record_bytes(url: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record."""
    body = F.coalesce(payload, F.lit(b""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.lit(b"\r\n\r\n"))


def warc_records(pages: DataFrame, per_file: int = 1024, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """record_id, file, record (the bytes); records of a file are ordered by id."""
    number = F.floor(F.col(id_col).cast("long") / per_file).cast("long")
    rows = pages.select(F.col(id_col).cast("long").alias("record_id"), number.alias("file"),
                        record_bytes(F.col(url_col), F.encode(F.col(html_col), "UTF-8")).alias("record"))
    below = -1 - F.pmod(F.xxhash64("record"), F.lit(_NAMELESS))
    return rows.withColumn("file", F.coalesce("file", below.cast("long")))


def manifest(records: DataFrame) -> DataFrame:
    """record_id, file, offset, length, digest: the layout without the bytes."""
    rows = records.select("record_id", "file", F.octet_length("record").cast("long").alias("length"),
                          F.sha2("record", 256).alias("digest"))
    order = Window.partitionBy("file").orderBy("record_id", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0).cast("long")))


def read_warc(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file (path), offset, length, digest, uri, payload of every record of uncompressed WARC files."""
    ship(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                rows = list(split_records(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.as_py()] * len(rows)), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([len(r[1]) for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.binary())],
                    names=["file", "offset", "length", "uri", "payload", "record"])
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(parse, "file string, offset long, length long, uri string, payload binary, record binary"
                            ).withColumn("digest", F.sha2("record", 256)).drop("record")


def split_records(data: bytes) -> Iterator[tuple[int, bytes, str, bytes]]:
    """(offset, record, target URI, payload) of each record; a damaged one ends at the next header."""
    at = data.find(b"WARC/")
    while 0 <= at < len(data):
        head = data.find(b"\r\n\r\n", at)
        fields = {}
        if head >= 0:
            for line in data[at:head].split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                fields[name.strip().lower()] = value.strip()
        size = fields.get(b"content-length", b"")
        end = head + 4 + int(size) + 4 if size.isdigit() else -1
        if end < 0 or end > len(data) or data[end - 4:end] != b"\r\n\r\n":
            end = data.find(b"WARC/", at + 5)
            end = len(data) if end < 0 else end
        payload = data[head + 4:end - 4] if head >= 0 else b""
        yield at, data[at:end], fields.get(b"warc-target-uri", b"").decode("utf-8", "replace"), payload
        at = data.find(b"WARC/", end)


def _leaf() -> Column:
    """The leaf range that a record starts in: file number, then 64 KiB of offset."""
    return F.col("file") * (SPAN // RANGE) + F.shiftright("offset", RANGE.bit_length() - 1)


def _parent() -> Column:
    return F.shiftright("node", FANOUT.bit_length() - 1)


def merkle_tree(layout: DataFrame, levels: int, tmp: Scratch) -> list[DataFrame]:
    """The (node, hash) table of every level: leaf ranges first; ``FANOUT`` neighbours share a parent."""
    def digest(items: Column) -> Column:
        return F.sha2(F.to_json(F.array_sort(F.collect_list(items))), 256).alias("hash")

    level = (layout.withColumn("node", _leaf()).groupBy("node")
             .agg(digest(F.struct("file", "offset", "length", "digest"))))
    tree = [tmp.write(level, "merkle")]
    for _ in range(1, levels):
        level = (tree[-1].groupBy(_parent().alias("up"))
                 .agg(digest(F.struct("node", "hash"))).withColumnRenamed("up", "node"))
        tree.append(tmp.write(level, "merkle"))
    return tree


def _levels(*layouts: DataFrame) -> int:
    """Levels up to a root: the highest address decides, so all replicas get the same number."""
    top = max((r for x in layouts for r in [x.agg(F.max(F.abs("file"))).first()[0]] if r is not None), default=0)
    n, nodes = 1, (top + 1) * (SPAN // RANGE)
    while nodes > 1:
        n, nodes = n + 1, -(-nodes // FANOUT)
    return n


def _differing(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    x, y = a.withColumnRenamed(value, "_a"), b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_b"))
    same = functools.reduce(operator.and_, [x[k].eqNullSafe(y[f"_{k}"]) for k in keys])
    both = x.join(y, same, "full").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    here = F.col("_a").isNotNull()
    return both.select(*[F.when(here, F.col(k)).otherwise(F.col(f"_{k}")).alias(k) for k in keys], "_a", "_b")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Compare two manifests: record_id, file, record_offset, record_length, status of damaged records."""
    with Scratch(first.sparkSession) as tmp:
        return written(_damage(tmp.write(first, "manifest"), tmp.write(second, "manifest"), tmp), "damage")


def _damage(first: DataFrame, second: DataFrame, tmp: Scratch) -> DataFrame:
    levels = _levels(first, second)
    trees = [merkle_tree(m, levels, tmp) for m in (first, second)]
    bad = tmp.write(_differing(trees[0][-1], trees[1][-1], ["node"], "hash").select("node"), "roots")
    for level in range(levels - 2, -1, -1):
        up = bad.withColumnRenamed("node", "up")
        below = [t[level].withColumn("up", _parent())
                 .join(up, "up", "left_semi").select("node", "hash") for t in trees]
        bad = tmp.write(_differing(*below, ["node"], "hash").select("node"), "branches")
    here = [m.withColumn("node", _leaf()).join(bad, "node", "left_semi").drop("node") for m in (first, second)]
    damaged = _differing(*here, ["record_id", "file", "offset", "length"], "digest")
    status = (F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").otherwise("changed"))
    return damaged.select("record_id", "file", F.col("offset").alias("record_offset"),
                          F.col("length").alias("record_length"), status.alias("status"))


def damaged_copy(records: DataFrame, layout: DataFrame) -> DataFrame:
    """The manifest of a replica with known damage, for the registered query: by a hash of the record's
    id, one record in 256 has a payload byte replaced and one in 256 is lost."""
    mark = F.substring(F.sha2(F.coalesce(F.col("record_id").cast("string"), F.lit("")), 256), 1, 2)
    n = F.octet_length("record")
    flipped = F.concat(F.expr("substring(record, 1, octet_length(record) - 5)"), F.lit(b"#"),
                       F.expr("substring(record, octet_length(record) - 3, 4)"))
    second = records.filter(mark != "19").select(
        "record_id", F.col("file").alias("_file"), F.sha2("record", 256).alias("_was"),
        F.sha2(F.when((mark == "07") & (n > 4), flipped).otherwise(F.col("record")), 256).alias("_is"))
    same = F.col("record_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_was"))
    second = second.withColumnRenamed("record_id", "_id").dropDuplicates(["_id", "_was"])
    return layout.join(second, same).select("record_id", "file", "length", F.col("_is").alias("digest"), "offset")


SQL = """
WITH r AS (
  SELECT page_id, CAST(floor(page_id / 1024) AS BIGINT) AS file, html,
         strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
                || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html'
                || chr(13) || chr(10) || 'Content-Length: ' || CAST(strlen(coalesce(html, '')) AS VARCHAR)
                || chr(13) || chr(10) || chr(13) || chr(10)) + strlen(coalesce(html, '')) + 4 AS n
  FROM pages),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY file ORDER BY page_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
             left(sha256(CAST(page_id AS VARCHAR)), 2) AS mark FROM r)
SELECT page_id AS record_id, file, CAST(pos AS BIGINT) AS record_offset, n AS record_length,
       CASE mark WHEN '19' THEN 'missing' ELSE 'changed' END AS status
FROM o WHERE mark IN ('07', '19')
"""
