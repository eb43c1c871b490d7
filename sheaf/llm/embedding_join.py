"""Operator 10, embedding near-duplicates: a subspace pigeonhole join.

Two unit vectors with cosine >= t are at a squared distance of at most 2 - 2t. The vectors are rotated
(principal axes of a bounded sample; any rotation keeps distances, so the sample only moves cost) and split
into ``blocks`` groups of coordinates, each given a share of that budget in proportion to its
share of the variance. The shares add up to the whole, so a linked pair is within the share in at
least one block. Each block is range-joined on its own: a grid over its leading coordinates with
cells as wide as the block's range, so that partners lie in the same or a bordering cell; cells are cut
into chunks of ``chunk`` vectors, and a task compares two chunks, so a cell that holds a third
of all vectors is many tasks of bounded memory. Candidates are verified right there with the
cosine of the original vectors in double precision, and counted only in the first block that admits
them, so no pair is ever emitted: a task returns link counts per vector and a spanning forest of its
links. Equal vectors are joined once, as one class with a multiplicity.

Pigeonhole on d coordinates is only as selective as d-dimensional balls are: on unstructured vectors
the block joins still read most chunk pairs (see the README for figures); nothing is lost either way.

Defined results: vectors that are null, zero or hold null or non-finite components link with nothing
(n_links 0, component_id = vec_id); vectors of unequal length link with nothing but their own length;
rows that repeat a vec_id are separate vectors of one component; a null vec_id gets null
component_id and kept true; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.llm.common import Scratch, ship, written
from sheaf.llm.components import connected_components, stars

_SLACK = 1e-5  # of float32 block distances against the budget; candidates are verified exactly


class Frame:
    """The rotation, the blocks and their budgets for one vector length."""

    def __init__(self, sample: np.ndarray, threshold: float, blocks: int, axes: int):
        dim = sample.shape[1]
        centred = sample - sample.mean(0) if len(sample) else sample
        value, axis = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(dim))
        # Dealt in turn, so that each block leads with axes of large variance.
        order = np.argsort(-value)
        blocks = max(1, min(blocks, dim))
        self.parts = [np.arange(b, dim, blocks) for b in range(blocks)]
        self.turn = np.ascontiguousarray(axis[:, order])
        value = np.maximum(value[order], 0) + 1e-9
        share = np.array([value[p].sum() for p in self.parts])
        self.budget = (2 - 2 * threshold) * (1 + 1e-9) * share / share.sum()
        self.axes = axes

    def cells(self, unit: np.ndarray, b: int) -> np.ndarray:
        """Grid cells in block ``b``: its leading coordinates over its range."""
        lead = self.parts[b][:self.axes]
        return np.floor((unit @ self.turn[:, lead]) / (np.sqrt(self.budget[b]) * (1 + 1e-6))).astype(np.int64)


def _vectors(packed: list[bytes], dim: int) -> np.ndarray:
    """Vectors in double precision, each scaled by a power of two so that no norm over- or underflows."""
    raw = b"".join(packed)
    kind = "<f4" if len(raw) == 4 * dim * len(packed) else "<f8"
    rows = np.frombuffer(raw, kind).reshape(-1, dim).astype(np.float64)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, initial=0))[1][:, None])


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _cell_rows(batches: Iterator[pa.RecordBatch], frames: dict[int, Frame]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            frame = frames[int(dim)]
            at = np.flatnonzero(dims == dim)
            unit = _unit(_vectors(batch.column("vec").take(pa.array(at)).to_pylist(), int(dim)))
            ids = batch.column("rep").take(pa.array(at))
            for b in range(len(frame.parts)):
                cells = frame.cells(unit, b)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.full(len(at), dim, np.int32)), pa.array(np.full(len(at), b, np.int32)),
                     pa.array(cells.tolist(), pa.list_(pa.int64()))], names=["rep", "dim", "block", "cell"])


def _compare(frames: dict[int, Frame], threshold: float, dim: int, b: int, left: pd.DataFrame,
             right: pd.DataFrame, same: bool) -> pd.DataFrame:
    """Links between two chunks of a block that no earlier block admits."""
    frame = frames[dim]
    ids = [x["rep"].to_numpy(np.int64) for x in (left, right)]
    weight = [x["copies"].to_numpy(np.int64) for x in (left, right)]
    raw = [_vectors(list(x["vec"]), dim) for x in (left, right)]
    norm = [np.linalg.norm(x, axis=1) for x in raw]
    turned = [((x / n[:, None]) @ frame.turn) for x, n in zip(raw, norm)]
    part = frame.parts[b]
    half = [-(t[:, part] ** 2).sum(1, keepdims=True) / 2 for t in turned]
    one = [np.ones((len(t), 1)) for t in turned]
    # One product gives minus half the squared distance of every pair of a tile.
    x = np.hstack([turned[0][:, part], half[0], one[0]]).astype(np.float32)
    y = np.ascontiguousarray(np.hstack([turned[1][:, part], one[1], half[1]]).astype(np.float32).T)
    bound = np.float32(-frame.budget[b] / 2 - _SLACK)
    links = [np.zeros(len(i), np.int64) for i in ids]
    found_a, found_b = [], []
    for lo in range(0, len(x), 512):
        flat = np.flatnonzero((x[lo:lo + 512] @ y).ravel() >= bound)
        for k in range(0, len(flat), 1 << 16):
            i, j = np.divmod(flat[k:k + (1 << 16)], y.shape[1])
            i += lo
            if same:
                i, j = i[i < j], j[i < j]
            d = turned[0][i] - turned[1][j]
            d *= d
            first = np.full(len(i), len(frame.parts))
            for e in range(len(frame.parts) - 1, -1, -1):
                first[d[:, frame.parts[e]].sum(1) <= frame.budget[e] * (1 + 1e-9)] = e
            cos = np.einsum("ij,ij->i", raw[0][i], raw[1][j]) / (norm[0][i] * norm[1][j])
            ok = (cos >= threshold) & (first == b)
            i, j = i[ok], j[ok]
            links[0] += np.bincount(i, weight[1][j], len(links[0])).astype(np.int64)
            links[1] += np.bincount(j, weight[0][i], len(links[1])).astype(np.int64)
            if len(i):
                node, root = stars(ids[0][i], ids[1][j])
                found_a.append(node)
                found_b.append(root)
    node = np.concatenate([ids[0], ids[1]])
    n = np.concatenate(links)
    some = n > 0
    a = np.concatenate(found_a or [np.zeros(0, np.int64)])
    z = np.concatenate(found_b or [np.zeros(0, np.int64)])
    if len(found_a) > 1:
        a, z = stars(a, z)
    return pd.DataFrame({"node": np.concatenate([node[some], a]), "root": np.concatenate([node[some], z]),
                         "n": np.concatenate([n[some], np.zeros(len(a), np.int64)])})


def neighbours(axes: int) -> list[list[int]]:
    """Half of the offsets to bordering cells, the cell itself first: each pair of cells once."""
    every = np.array(np.meshgrid(*[[-1, 0, 1]] * axes, indexing="ij")).reshape(axes, -1).T.tolist()
    return sorted(o for o in every if o >= [0] * axes)


def embedding_near_dups(vectors: DataFrame, threshold: float = 0.9, blocks: int = 4, axes: int = 1,
                        chunk: int = 16_384, sample_rows: int = 20_000, id_col: str = "vec_id",
                        vec_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    ``sample_rows`` bounds the rows that the rotation is fitted on.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vec_col).alias("v"))
    single = rows.schema["v"].dataType.elementType == T.FloatType()
    if not single:
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce(~odd & F.exists("v", lambda x: x != 0), F.lit(False))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            flat = np.asarray(col.values.to_numpy(zero_copy_only=False), "<f4" if single else "<f8")
            off = col.offsets.to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(off).astype(np.int32)),
                 pa.array([flat[a:z].tobytes() for a, z in zip(off[:-1], off[1:])], pa.binary())],
                names=["vec_id", "dim", "vec"])

    packed = rows.filter(good).mapInArrow(pack, "vec_id long, dim int, vec binary")
    packed = packed.withColumn("key", F.sha2("vec", 256))
    members = packed.select("vec_id", "key")
    with Scratch(spark) as tmp:
        named = _linked_classes(packed, threshold, blocks, axes, chunk, sample_rows, tmp)
        named = None if named is None else written(named, "near")
    alone = (rows.filter(~good) if named is not None else rows).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if named is not None:
        linked = members.hint("merge").join(named, "key").select("vec_id", "n_links", "component_id")
        alone = linked.union(alone)
    return alone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked_classes(packed: DataFrame, threshold: float, blocks: int, axes: int, chunk: int, sample_rows: int,
                    tmp: Scratch) -> DataFrame | None:
    """(key, n_links, component_id) of every class of equal vectors; None if there is none."""
    classes = tmp.write(packed.groupBy("key").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"),
        F.first("vec").alias("vec")).withColumn("rep", F.monotonically_increasing_id()), "vectors")
    frames: dict[int, Frame] = {}
    for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect():  # a row per vector length
        share = min(1.0, 1.2 * sample_rows / r["n"])
        got = (classes.filter(F.col("dim") == r["dim"])
               .filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
               .select("vec").limit(sample_rows).collect())
        frames[r["dim"]] = Frame(_unit(_vectors([bytes(x["vec"]) for x in got], r["dim"])), threshold,
                                 blocks, axes)
    if not frames:
        return None

    # Chunk numbers: a cell's vectors are dealt to as many chunks as its size asks for.
    where = tmp.write(classes.select("rep", "dim", "vec").mapInArrow(
        lambda it: _cell_rows(it, frames), "rep long, dim int, block int, cell array<long>"), "cells")
    sizes = where.groupBy("dim", "block", "cell").agg(F.count(F.lit(1)).alias("n"))
    chunks = sizes.withColumn("of", F.ceil(F.col("n") / chunk).cast("int")).select("dim", "block", "cell", "of")
    # A pair of chunks meets in one task: each vector is sent once per partner chunk of its cell and
    # of the bordering cells, on the left for the chunk pairs that start at its own cell.
    here = chunks.select("dim", "block", F.col("cell").alias("a"), F.col("of").alias("of_a"))
    steps = F.explode(F.array(*[F.array(*[F.lit(x).cast("long") for x in o]) for o in neighbours(axes)]))
    there = chunks.select("dim", "block", F.col("cell").alias("b"), F.col("of").alias("of_b"))
    near = (here.withColumn("step", steps)
            .withColumn("b", F.zip_with("a", "step", lambda p, q: p + q)).drop("step")
            .join(there, ["dim", "block", "b"]))
    number = F.pmod(F.xxhash64("rep", "block"), F.col("of")).cast("int")
    spot = where.join(chunks, ["dim", "block", "cell"]).withColumn("c", number)
    left = (spot.withColumnRenamed("cell", "a").join(near, ["dim", "block", "a"])
            .withColumn("d", F.explode(F.sequence(F.lit(0), F.col("of_b") - 1)))
            .filter((F.col("a") != F.col("b")) | (F.col("c") <= F.col("d")))
            .select("rep", "dim", "block", "a", "b", "c", "d", F.lit(0).alias("side")))
    right = (spot.withColumnRenamed("cell", "b").withColumnRenamed("c", "d").join(near, ["dim", "block", "b"])
             .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("of_a") - 1)))
             .filter((F.col("a") != F.col("b")) | (F.col("c") < F.col("d")))
             .select("rep", "dim", "block", "a", "b", "c", "d", F.lit(1).alias("side")))
    tasks = left.union(right).join(classes.select("rep", "copies", "vec"), "rep")

    def meet(g: pd.DataFrame) -> pd.DataFrame:
        a, z = g[g["side"] == 0], g[g["side"] == 1]
        dim, b = int(g["dim"].iloc[0]), int(g["block"].iloc[0])
        same = g["c"].iloc[0] == g["d"].iloc[0] and bool(np.array_equal(g["a"].iloc[0], g["b"].iloc[0]))
        z = a if same else z
        if not len(a) or not len(z):  # a chunk that its hash left empty
            return pd.DataFrame({"node": [], "root": [], "n": []}, dtype="int64")
        return _compare(frames, threshold, dim, b, a, z, same)

    found = tmp.write(tasks.groupBy("dim", "block", "a", "b", "c", "d").applyInPandas(
        meet, "node long, root long, n long"), "found")
    counts = found.filter("n > 0").groupBy(F.col("node").alias("rep")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.filter("node <> root"), "node", "root", tmp)
    named = (classes.select("rep", "key", "first", "copies")
             .join(counts, "rep", "left")
             .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
             .withColumn("root", F.coalesce("root", "rep")))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(lowest, "root").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
