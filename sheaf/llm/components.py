"""Connected components of a link table, as Spark jobs.

Tasks of up to a million links first contract their part to a forest of stars (the components of the part do
not change). If that took several tasks, large-star and small-star rounds run until the links are stars
around each component's smallest node. Every round is two group-bys with map-side combine and two equi-joins, so
a node with very many links is pre-aggregated, and each round is written to the shared checkpoint
folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import Scratch, ship


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the links a-b, nodes that are their own left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        lo = np.minimum(root[x], root[y])
        hi = np.maximum(root[x], root[y])
        if (lo == hi).all():
            break
        np.minimum.at(root, hi, lo)
        while True:  # pointer jumping
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    names = ["node", "root"]

    def out(x, y):
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=names)

    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy()])
        b = np.concatenate([b, batch.column(1).to_numpy()])
        if len(a) > 1 << 20:
            a, b = stars(a, b)
            if len(a) > 1 << 19:  # it does not shrink any more: pass it on
                yield out(a, b)
                a, b = a[:0], b[:0]
    if len(a):
        yield out(*stars(a, b))


def _sign(edges: DataFrame) -> tuple:
    """A fingerprint of a link table, whatever the order of its rows."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str, tmp: Scratch, per_task: int = 1 << 20) -> DataFrame:
    """(node, root): the smallest node reachable from every node that has a link to another one.

    Nodes without links are not listed. Nulls and self-links are ignored. ``links`` should be a written
    table, as it is counted first; the result is a table of ``tmp``.
    """
    spark = links.sparkSession
    ship(spark)
    edges = (links.select(F.col(a).cast("long").alias("node"), F.col(b).cast("long").alias("root"))
             .filter("node IS NOT NULL AND root IS NOT NULL AND node <> root"))
    tasks = max(1, -(-edges.count() // per_task))
    edges = tmp.write(edges.coalesce(tasks).mapInArrow(_contract, "node long, root long"), "links")
    if tasks == 1:
        return edges
    sign, done = _sign(edges), Scratch(spark)
    while True:
        both = edges.select("node", "root").union(edges.select(F.col("root"), F.col("node")))
        both = both.toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # Large star: larger neighbours of u are linked to its smallest neighbour.
        large = (both.filter("v > u").join(least, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v <> m").select(F.col("v").alias("node"), F.col("m").alias("root"))
                 .union(low.select(F.col("u").alias("node"), F.col("m").alias("root"))).distinct())
        edges = tmp.write(small, "links")
        done.paths = [tmp.paths.pop(-2)]  # the round before it
        done.clear()
        now = _sign(edges)
        if now == sign:
            return edges
        sign = now
