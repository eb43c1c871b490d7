"""Operator 1, exact dedup: counting quotient filters per partition, merged by sorted remainders.

Every task of the scan builds a counting quotient filter over 64-bit fingerprints of the whole
texts: the high bits of a fingerprint (the quotient) name a slot, the rest (the remainder) is kept
sorted in it with a count. Filters built apart have the same layout, so their slots merge without
loss: the sorted remainders of one slot range are merged and the counts of equal ones added. Only
the slot ranges are shuffled, 12 bytes per distinct fingerprint of a task; a text that fills a third
of all rows is one entry per task.

A fingerprint with a merged count of one belongs to a unique text. The rest go to byte verification: a
filter of them, of a checked size, picks their rows in a second scan (and a few others), and only these
are shuffled, grouped by the whole text, which Spark compares byte by byte, after a map-side combine.
If so many fingerprints repeat that no filter of ``filter_bytes`` tells them apart, their rows are
found by an equi-join, which adaptive execution can split at a hot key; the result is the same.

Defined results: a null text counts as empty; of equal texts the row with the largest id stays; a
null id never beats another (a group of null ids only has a null ``keep_id``); rows that repeat both
id and text are counted and share their ``kept`` flag; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import KeyFilter, fan_out, ship, without, written

_FILTER = "slot int, remainders binary, counts binary"


def _build(batches: Iterator[pa.RecordBatch], bits: int, most: int) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    for b in batches:
        held.append(b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
        if sum(map(len, held)) >= most:
            yield _slots(np.concatenate(held), bits)
            held = []
    if held:
        yield _slots(np.concatenate(held), bits)


def _slots(fp: np.ndarray, bits: int) -> pa.RecordBatch:
    """The filter of some fingerprints: a row per range of slots in use."""
    fp, n = np.unique(fp, return_counts=True)
    slot = (fp >> np.uint64(64 - bits)).astype(np.int32)
    used, at = np.unique(slot, return_index=True)
    ends = [*at[1:], len(fp)]
    rest = fp << np.uint64(bits)  # remainder in the high bits; order is kept
    n = n.astype(np.uint32)
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()),
         pa.array([rest[a:z].tobytes() for a, z in zip(at, ends)], pa.binary()),
         pa.array([n[a:z].tobytes() for a, z in zip(at, ends)], pa.binary())],
        names=["slot", "remainders", "counts"])


def _merge(rows: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Merge one slot range of all filters; fingerprints with a count above one."""
    rest = np.frombuffer(b"".join(rows["remainders"]), np.uint64)
    n = np.frombuffer(b"".join(rows["counts"]), np.uint32).astype(np.int64)
    order = np.argsort(rest, kind="stable")  # merges the sorted runs
    rest = rest[order]
    at = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1]])
    total = np.add.reduceat(n[order], at)
    more = total > 1
    fp = (rest[at][more] >> np.uint64(bits)) | (np.uint64(rows["slot"].iloc[0]) << np.uint64(64 - bits))
    return pd.DataFrame({"fp": fp.view(np.int64), "n": total[more]})


def repeated_fingerprints(docs: DataFrame, fp_col: str = "fp", most: int = 1 << 21) -> DataFrame:
    """(fp, n): the fingerprints that occur more than once, from merged counting quotient filters."""
    spark = docs.sparkSession
    ship(spark)
    bits = max(4, min(20, (fan_out(spark) - 1).bit_length()))
    filters = docs.select(F.col(fp_col).alias("fp")).mapInArrow(
        lambda it: _build(it, bits, most), _FILTER)
    return filters.groupBy("slot").applyInPandas(lambda g: _merge(g, bits), "fp long, n long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                filter_bytes: int = 1 << 26) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marked = rows.withColumn("fp", F.xxhash64("text"))
    repeated = written(repeated_fingerprints(marked).select("fp"), "repeated")
    known = KeyFilter.of(repeated, repeated.count(), filter_bytes)
    # Byte verification: rows of repeated fingerprints, grouped by the text itself.
    if known is None:
        suspects = marked.hint("merge").join(repeated, "fp", "left_semi")
    else:
        suspects = known.mark(marked, F.col("fp"), "again").filter("again")
    groups = (suspects.groupBy("text")
              .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1")
              .select(F.sha2("text", 256).alias("text_sha256"), "keep_id",
                      F.col("n").alias("group_size")))
    small = rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    out = small.hint("merge").join(groups, "text_sha256", "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep, all columns as they were.

    A row goes by its id and text: another text with the same id stays."""
    gone = exact_dedup(docs, id_col, text_col).filter(~F.col("kept")).select("doc_id", "text_sha256")
    return without(docs, id_col, text_col, gone)


SQL = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
