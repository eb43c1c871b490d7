"""Profiles taken while a table is written (Q1-Q3, Q5).

Missing counts and shares need no pass of their own: they are observed on the rows as the write's tasks produce them,
and reach the driver as one row with the job's end. The observation sits directly under the write, in its last stage,
where Spark counts a partition once however often its task is run, so retried and speculative tasks do not show.

The write runs in a session of its own with the same settings: a session that has observed something can no longer be
serialised, and a fitted logistic regression takes its session with it into the tasks that score with it. In that session
generated methods are held to the size that HotSpot compiles: one above it is interpreted for as long as the write runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.columns import q
from sheaf.operators.profile import missing_condition
from sheaf.session import scratch_path

HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000  # HotSpot's HugeMethodLimit


class Profile(NamedTuple):
    """What a write observed: rows; nulls per column; nulls or NaN per column, without and with empty text, if asked for."""
    rows: int
    nulls: dict[str, int]
    missing: dict[str, int] | None
    missing_or_empty: dict[str, int] | None

    def share(self, column: str) -> float | None:
        """Share of nulls, as ``missing_share`` has it; None for a table without rows."""
        return 1.0 - (self.rows - self.nulls[column]) / self.rows if self.rows else None

    def sparse_columns(self, threshold: float = 0.40, keep: Iterable[str] = ()) -> list[str]:
        """Columns whose share of nulls exceeds ``threshold``, except those in ``keep`` (Q5)."""
        keep = set(keep)
        return [c for c in self.nulls if c not in keep and self.rows and self.share(c) > threshold]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per column; null counts where they were not asked for."""
        none: dict[str, int] = {}
        return spark.createDataFrame(
            [(c, self.rows, (self.missing or none).get(c), (self.missing_or_empty or none).get(c), self.share(c))
             for c in self.nulls], "column string, rows long, missing long, missing_or_empty long, share double")


@contextmanager
def _in_own_session(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a table of a new session of the same application, with the settings of its own."""
    spark, name = df.sparkSession, f"sheaf_{uuid.uuid4().hex}"
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.isModifiable(key):
            other.conf.set(key, value)
    if int(other.conf.get(HUGE_METHOD)) > COMPILED_BYTES:
        other.conf.set(HUGE_METHOD, COMPILED_BYTES)
    df.createGlobalTempView(name)
    try:
        yield other.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def write_observed(df: DataFrame, path: str, mode: str = "error", nulls_only: bool = False) -> tuple[DataFrame, Profile]:
    """Write ``df`` as Parquet at ``path``; the table as read back, and the profile of what was written.

    ``nulls_only`` leaves out the tests of every value for NaN and empty text, which the sparse-column rule does not use.
    """
    cols, seen = df.columns, Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        counts.append(F.count_if(q(c).isNull()).alias(f"n{i}"))
        if not nulls_only:
            counts += [F.count_if(missing_condition(df, c)).alias(f"m{i}"),
                       F.count_if(missing_condition(df, c, empty_as_missing=True)).alias(f"e{i}")]
    with _in_own_session(df) as table:
        table.observe(seen, *counts).write.mode(mode).parquet(path)
    got = seen.get
    nulls, *tested = [{c: got[f"{k}{i}"] for i, c in enumerate(cols)} for k in ("n" if nulls_only else "nme")]
    profile = Profile(got["rows"], nulls, *(tested or (None, None)))
    return df.sparkSession.read.schema(df.schema).parquet(path), profile


def materialize_observed(df: DataFrame, name: str, nulls_only: bool = False) -> tuple[DataFrame, Profile]:
    """``session.materialize`` with a profile: the table in the shared checkpoint folder, read back."""
    return write_observed(df, scratch_path(df.sparkSession, name), nulls_only=nulls_only)
