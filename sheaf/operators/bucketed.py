"""Rollups kept in buckets of their key, for star joins that shuffle no rollup.

A rollup changes only when its fact table does, while the join with the entity table is run again and again. Written once in
buckets of the key, it is read already partitioned and sorted: the star join has no exchange on a rollup's side, and none at
all if the entity table is kept in the same buckets. Files lie at the given path (the shared checkpoint folder by
default); the session's catalog holds only the table's name and its bucket specification.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from sheaf.operators.columns import q
from sheaf.operators.joins import measured_bytes, star_join
from sheaf.session import materialize, scratch_path


class Bucketed(NamedTuple):
    """A bucketed table: its name in the catalog, where it lies, its key and number of buckets."""
    name: str
    path: str
    key: str
    buckets: int

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)


def bucket_count(sizes: Sequence[int], bucket_bytes: int = 1 << 28) -> int:
    """Buckets for tables that are joined with each other: the largest in pieces of about ``bucket_bytes``, as a power of
    two, so that a table that has outgrown its buckets can be rewritten in a multiple of them."""
    need = max(1, -(-max(sizes, default=0) // bucket_bytes))
    return 1 << (need - 1).bit_length()


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str | None = None, path: str | None = None) -> Bucketed:
    """Write ``df`` in ``buckets`` buckets of ``key``, one sorted file each.

    Rows are first dealt by the same hash, so a bucket comes from one task and a table has as many files as buckets.
    Rows whose key is null share a bucket; a left join on the key matches none of them.
    """
    name = name or f"sheaf_{uuid.uuid4().hex}"
    path = path or scratch_path(df.sparkSession, name)
    (df.repartition(buckets, q(key)).write.format("parquet").option("path", path).mode("overwrite")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return Bucketed(name, path, key, buckets)


def bucket_rollups(sides: Sequence[DataFrame], key: str, buckets: int | None = None,
                   bucket_bytes: int = 1 << 28) -> list[Bucketed]:
    """Each of the rollups in the same number of buckets, by default from their measured sizes.

    A rollup that is to be measured is written first, so its facts are aggregated once.
    """
    if buckets is None:
        sides = [materialize(s, "rollup") for s in sides]
        buckets = bucket_count([measured_bytes(s)[1] for s in sides], bucket_bytes)
    return [write_bucketed(s, key, buckets) for s in sides]


def bucketed_star_join(entity: DataFrame, sides: Sequence[Bucketed], key: str) -> DataFrame:
    """``star_join`` with rollups kept in buckets.

    The join runs by merging buckets whatever the rollups' sizes, so only the entity table is dealt, once; rollups that
    differ in key or in the number of buckets would be dealt again and are refused.
    """
    if len({(s.key, s.buckets) for s in sides} | {(key, s.buckets) for s in sides}) > 1:
        raise ValueError("rollups of one join need the same key and number of buckets")
    spark = entity.sparkSession
    return star_join(entity, [s.read(spark).hint("merge") for s in sides], key)


def drop_bucketed(spark: SparkSession, sides: Sequence[Bucketed]) -> None:
    """Take the tables out of the catalog; their files go with ``session.clean_scratch``."""
    for s in sides:
        spark.sql(f"DROP TABLE IF EXISTS `{s.name}`")
