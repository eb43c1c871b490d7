"""Joins (J1, J2).

Left joins on one named key keep a single key column. The star join attaches per-key rollups to the
entity table; every rollup is already hash-partitioned on the key by its aggregation, so the join
re-uses that partitioning instead of shuffling the rollups again. A side is broadcast only when its
size has been measured and is under the session's broadcast threshold.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-row and per-value overheads used to turn measured content into an in-memory size estimate.
_ROW_OVERHEAD = 32
_FIXED_WIDTH = 8


def broadcast_threshold(spark) -> int:
    """The session's broadcast limit in bytes (``spark.sql.autoBroadcastJoinThreshold``); 0 if off."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"": 1, "b": 1}
    for i, u in enumerate("kmgtp", 1):
        units |= {u: 1 << 10 * i, u + "b": 1 << 10 * i, u + "ib": 1 << 10 * i}
    m = re.fullmatch(r"(-?\d+(?:\.\d+)?)\s*([a-z]*)", raw)
    if not m or m[2] not in units:
        raise ValueError(f"cannot read spark.sql.autoBroadcastJoinThreshold: {raw!r}")
    return max(int(float(m[1]) * units[m[2]]), 0)


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, estimated bytes) of a table, from one aggregation over its actual content.

    Text and binary columns count their byte length, other columns a fixed width; meant for small,
    already materialized sides (a checkpoint or an aggregate) before deciding to broadcast them.
    """
    parts = [F.lit(_ROW_OVERHEAD)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.UserDefinedType)):
            # Nested content has no fixed width; its text is about as long or longer.
            parts.append(F.coalesce(F.length(c.cast("string")), F.lit(0)) * 8 + _FIXED_WIDTH)
        else:
            parts.append(F.lit(_FIXED_WIDTH))
    size = parts[0]
    for p in parts[1:]:
        size = size + p
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("bigint")).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def broadcast_if_small(df: DataFrame, size_bytes: int, limit: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size is within ``limit`` (default: the session's
    broadcast threshold); otherwise leave the join strategy to the planner and AQE."""
    limit = broadcast_threshold(df.sparkSession) if limit is None else limit
    return F.broadcast(df) if 0 < size_bytes <= limit else df


def left_join(left: DataFrame, right: DataFrame, key: str,
              right_bytes: int | None = None) -> DataFrame:
    """``left`` left join ``right`` on ``key`` (J1), one key column out.

    Pass ``right_bytes`` (from ``measured_bytes``) to broadcast ``right`` when it is under the
    session's broadcast threshold; otherwise the planner and AQE choose from statistics.
    """
    if right_bytes is not None:
        right = broadcast_if_small(right, right_bytes)
    return left.join(right, key, "left")


def star_join(entity: DataFrame, sides: Sequence[DataFrame], key: str) -> DataFrame:
    """Entity table left-joined with several per-key tables.

    Each side must hold at most one row per key, so the entity row count is preserved.
    """
    out = entity
    for s in sides:
        out = out.join(s, key, "left")
    return out
