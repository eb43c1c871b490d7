"""Shared pieces: shipping the package to executors, Arrow text columns as numpy arrays, hashing."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.session import materialize, scratch_path

_SHIPPED = "_sheaf_shipped"


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers (``addPyFile``, once per application)."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="sheaf-src-"), "sheaf_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back (cuts lineage)."""
    with _lean(df.sparkSession):
        return materialize(df, f"llm-{name}")


_BATCH_BYTES = 4 << 20
_LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
         "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(_BATCH_BYTES)}


@contextlib.contextmanager
def _lean(spark: SparkSession) -> Iterator[None]:
    """Settings of a write that hold on to little.

    Spark deletes its shuffle files when it ends, not when the driver happens to collect its garbage (which may be half an
    hour later). Python is sent rows by the megabyte: ten thousand long texts in one Arrow batch, which is Spark's default,
    take their size several times over outside the heap, in each task and its worker, and the allocators keep it.
    """
    before = {name: spark.conf.get(name, None) for name in _LEAN}
    for name, value in _LEAN.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    gc.collect()
    spark._jvm.System.gc()  # broadcasts and plans that are done


class Scratch:
    """Tables that one computation writes into the shared checkpoint folder and deletes when it ends.

    What the computation returns must not read them: ``written`` tables stay.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.clear()

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"llm-{name}")
        self.paths.append(path)
        with _lean(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for p in self.paths:
            at = jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(conf).delete(at, True)
        self.paths = []


def fresh(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that no column of ``taken`` has."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def text_mark(column: str) -> Column:
    """What tells the texts of rows with one id apart: the SHA-256 of the text, null counting as empty."""
    return F.sha2(F.coalesce(F.col(column), F.lit("")), 256)


class KeyFilter:
    """A filter of 64-bit hashes, for the scan of a large table that few rows of are wanted.

    A bit is kept per hash, in a space of ``2**lg`` bits that is cut into rows of 32768; the rows are broadcast, ``filter_bytes``
    at most. The space has 32 bits a hash while that fits, and a table of more than half as many hashes as bits has no filter
    (``of`` gives None): then it would pass nearly all rows. It never misses a hash it was built of.
    """

    def __init__(self, bits: DataFrame, lg: int):
        self.bits, self.lg = bits, lg

    @classmethod
    def of(cls, hashes: DataFrame, n: int, filter_bytes: int = 1 << 26) -> KeyFilter | None:
        """The filter of the ``n`` rows of the one column of ``hashes``."""
        lg = min(max(15, (32 * n - 1).bit_length()), (8 * filter_bytes).bit_length() - 1)
        if 2 * n > 1 << lg:
            return None
        place = cls._place(F.col("h"), lg)
        bits = hashes.toDF("h").groupBy(F.bitmap_bucket_number(place).alias("row")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        return cls(bits, lg)

    @staticmethod
    def _place(h: Column, lg: int) -> Column:
        return h.bitwiseAND(F.lit((1 << lg) - 1).cast("long")) + 1

    def mark(self, df: DataFrame, h: Column, name: str) -> DataFrame:
        """``df`` with the column ``name``: whether the filter may hold ``h``."""
        row, bits, place = (fresh(c, [*df.columns, name]) for c in ("row", "bits", "place"))
        at = F.bitmap_bit_position(place)
        byte = F.conv(F.hex(F.substr(F.col(bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
        held = F.broadcast(self.bits.toDF(row, bits))
        return (df.withColumn(place, self._place(h, self.lg)).join(held, F.bitmap_bucket_number(place) == F.col(row), "left")
                .select(*[F.col(f"`{c}`") for c in df.columns], hit.alias(name)))


def without(docs: DataFrame, id_col: str, text_col: str, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and ``text_mark`` are the two columns of ``rows``; a null id stays.

    Only documents that a filter of the ids may hold are shuffled and compared."""
    gone, mark, hit = (fresh(c, docs.columns) for c in ("gone", "mark", "hit"))
    rows = written(rows.toDF(gone, mark).filter(F.col(gone).isNotNull()), "gone")
    n = rows.count()
    if not n:
        return docs
    # Hashes differ by type: ids are compared as the documents have them.
    kind = docs.schema[id_col].dataType
    known = KeyFilter.of(rows.select(F.xxhash64(F.col(gone).cast(kind))), n)
    same = (F.col(f"`{id_col}`") == F.col(gone)) & (text_mark(f"`{text_col}`") == F.col(mark))
    if known is None:
        return docs.hint("merge").join(rows, same, "left_anti")
    marked = known.mark(docs, F.xxhash64(F.col(f"`{id_col}`")), hit)
    found = marked.filter(hit).drop(hit)
    return marked.filter(~F.col(hit)).drop(hit).unionByName(found.hint("merge").join(rows, same, "left_anti"))


def fan_out(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of hash bins for packed shuffles: a few per configured shuffle partition."""
    return per_partition * max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (bytes, offsets); null counts as empty text. No copy without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type)
                            else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    kind = np.int64 if wide else np.int32
    if bufs[1] is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(bufs[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut batches into runs of rows with about ``most`` text bytes (one row at least), so that
    the arrays derived from a slice stay small however many rows a batch has."""
    for b in batches:
        data, off = utf8(b.column(column))
        lo, n = 0, b.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
            hi = min(hi, n)
            yield b.slice(lo, hi - lo), data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            lo = hi


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


#: Odd base of the polynomial hash over bytes, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= 3 << 20:  # keep at most what a usual slice needs
            _POWERS[base] = have
    return have[:n]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over the whole slice."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    run = np.zeros(len(data) + 1, np.uint64)
    np.add(data, np.uint64(1), out=run[1:], casting="unsafe")
    run[1:] *= powers(_BASE, len(data))
    np.cumsum(run, out=run)
    h = run[ends] - run[starts]
    h *= powers(_INV, len(data))[starts]
    return mix(h + (ends - starts).astype(np.uint64) * _M1)


def words(data: np.ndarray, off: np.ndarray, lower: bool) -> tuple[np.ndarray, ...]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice: (starts, ends, hashes, first word of each text).

    The last array has one more entry than there are texts. ``lower`` folds A-Z before hashing.
    """
    solid = ~_BLANK[data]
    edge = np.empty(len(data), bool)
    if len(data):
        edge[0] = True
        np.logical_not(solid[:-1], out=edge[1:])
        edge[off[:-1][off[:-1] < len(data)]] = True
    starts = np.flatnonzero(solid & edge)
    stop = np.empty(len(data), bool)
    if len(data):
        stop[-1] = True
        np.logical_not(solid[1:], out=stop[:-1])
        stop[off[1:][off[1:] > 0] - 1] = True
    ends = np.flatnonzero(solid & stop) + 1
    first = np.searchsorted(starts, off)
    h = span_hashes(_LOWER[data] if lower else data, starts, ends)
    return starts, ends, h, first


_STEP = np.uint64(0xD6E8FEB86659FD93)


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` consecutive word hashes (as if there were no text borders)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= _STEP
        out += h[i:i + n]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
