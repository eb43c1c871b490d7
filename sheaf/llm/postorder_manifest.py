"""Operator 13, Merkle manifest of a dataset as a postorder append log.

Every row is a leaf; per group (language) the leaves, in order, are the lowest level of a tree in which runs of
``FAN`` neighbours become one node until one is left, the group's subroot. The subroots, in order of their groups, are
the leaves of one more such tree.

The nodes of a tree are logged in the order in which they are completed (postorder), so a builder appends only.
Builders are aligned: each owns ``size`` (a power of ``FAN``) consecutive leaves and writes the log of
its subtree as one row; the segments' tops are the leaves of the next tier, and so on, so no task holds more than one
segment however large a group is. Where a node lies in a log needs no index: after leaf ``e`` has been appended,
``e + e // 8 + e // 64 + ...`` nodes lie before it, and the node of level ``v`` that ends with leaf ``e`` follows
``v`` places after it. The same closed form addresses the siblings of every node of a path, so a proof is
read off the logs of one segment per tier: from the top tier down, each leaf's path is handed to the segment whose
top it is.

Leaves get their numbers from one range partitioning: a row's place in its partition, less that of its group's
first row there, plus the group's rows in the partitions before it. Nothing is ordered in one task.

Defined results: null values hash as ``-``; leaves with a null id come first, repeated ids in order of their hashes;
a null language is a group of its own, the first; an empty table has no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.llm.common import Scratch, ship, written

FAN = 8
SEGMENT = FAN ** 4
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: bytes) -> bytes:
    """The raw SHA-256 of digests taken as hexadecimal text."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def leaf_hash(fields: list[Column]) -> Column:
    """The hexadecimal digest of a row: each value as its length in bytes, a colon and itself; null as ``-``."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[one(c) for c in fields]), 256)


# -- places in a log ------------------------------------------------------------------------------------------------

def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def position(level: np.ndarray | int, index: np.ndarray | int, n: int):
    """Place in the log of the ``index``-th node of ``level`` in a tree of ``n`` leaves."""
    last = np.minimum((np.asarray(index, np.int64) + 1) * FAN ** level, n) - 1
    place, rest = last + level, last
    while np.any(rest):
        rest = rest // FAN
        place = place + rest
    return place


def append_log(leaves: list[bytes], h: int) -> bytes:
    """The log of a tree of height ``h``: every node is appended when its last child has been."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(h + 1)]
    for i, leaf in enumerate(leaves):
        log.append(leaf)
        open_[0].append(leaf)
        last = i == len(leaves) - 1
        for level in range(1, h + 1):
            if not last and (i + 1) % FAN ** level:
                break
            node = digest(*open_[level - 1])
            open_[level - 1] = []
            open_[level].append(node)
            log.append(node)
    return b"".join(log)


def siblings(log: bytes, n: int, h: int) -> Iterator[tuple[list[str], list[str]]]:
    """For each leaf of a log, by address alone: (left, right) siblings of its path, level by level, as text."""
    nodes = np.frombuffer(log, np.uint8).reshape(-1, 32)
    runs: list[list[str]] = []
    for level in range(h):
        count = -(-n // FAN ** level)
        at = position(level, np.arange(count), n)
        text = nodes[at].tobytes().hex()
        runs.append([text[64 * a:64 * min(a + FAN, count)] for a in range(0, count, FAN)])
    for i in range(n):
        left, right = [], []
        for run in runs:
            own = run[i // FAN]
            at = 64 * (i % FAN)
            left.append(own[:at])
            right.append(own[at + 64:])
            i //= FAN
        yield left, right


def fold(leaf: str, left: list[str], right: list[str]) -> str:
    """The root that a leaf and the siblings of its path lead to."""
    for a, z in zip(left, right):
        leaf = hashlib.sha256((a + leaf + z).encode()).hexdigest()
    return leaf


# -- numbering, building, reading proofs ----------------------------------------------------------------------------

def numbered(rows: DataFrame, group: str, order: list[str], tmp: Scratch) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in ``order`` within ``group``) and ``total`` (the group's rows)."""
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    rows = tmp.write(rows.select("*", F.shiftright("_at", 33).alias("_part")), "ordered")
    parts = rows.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy("_group")
    before = own.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_group", "_of", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                         F.sum("_rows").over(own).alias("total"))
    both = rows.join(parts, (rows["_part"] == parts["_of"]) & rows[group].eqNullSafe(parts["_group"]))
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    return both.withColumn("rank", rank).drop("_at", "_part", "_group", "_of", "_first", "_before")


_LOG = "tree string, segment long, total long, n int, levels int, log binary, top binary"


def _build(rows: pd.DataFrame, carry: list[str], size: int) -> pd.DataFrame:
    """One aligned builder: the log of a segment, with what its leaves carry."""
    rows = rows.sort_values("rank")
    total, n = int(rows["total"].iloc[0]), len(rows)
    h = height(min(size, total))
    log = append_log([bytes(x) for x in rows["hash"]], h)
    tree = rows["tree"].iloc[0]
    out = {"tree": [None if pd.isna(tree) else tree], "segment": [int(rows["rank"].iloc[0]) // size],
           "total": [total], "n": [n], "levels": [h], "log": [log], "top": [log[-32:]]}
    for c in carry:
        out[c] = [[None if pd.isna(v) else v for v in rows[c]]]
    return pd.DataFrame(out)


def _builder(carry: list[str], size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: _build(rows, carry, size)


@dataclass
class Log:
    """The tiers of a set of trees: (tree, segment, total, n, levels, log, top) rows, the leaves' tier first."""

    tiers: list[DataFrame]
    size: int  # leaves of a full segment

    def subroots(self) -> DataFrame:
        """(tree, top) of every tree."""
        tops = [t.filter(F.col("total") <= self.size).select("tree", "top") for t in self.tiers]
        out = tops[0]
        for t in tops[1:]:
            out = out.unionByName(t)
        return out


def build_log(leaves: DataFrame, carry: dict[str, str], size: int, tmp: Scratch) -> Log:
    """Logs of (tree, rank, total, hash, *carry) rows; ``carry`` names columns of the leaves that their
    segment keeps, with their types."""
    biggest = leaves.agg(F.max("total")).first()[0] or 0
    tiers: list[DataFrame] = []
    while True:
        kept = carry if not tiers else {}
        schema = _LOG + "".join(f", {c} array<{t}>" for c, t in kept.items())
        parts = leaves.withColumn("_segment", F.floor(F.col("rank") / size))
        tiers.append(tmp.write(parts.groupBy("tree", "_segment").applyInPandas(
            _builder(list(kept), size), schema), "log"))
        if biggest <= size:
            return Log(tiers, size)
        biggest = -(-biggest // size)
        leaves = tiers[-1].filter(F.col("total") > size).select(
            "tree", F.col("segment").alias("rank"), F.ceil(F.col("total") / size).alias("total"),
            F.col("top").alias("hash"))


_PATH = "left array<string>, right array<string>"


def _paths(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(tree, rank, left, right) of the leaves of segments that come with the path above them."""
    for b in batches:
        for r in b.to_pylist():
            got = list(siblings(r["log"], r["n"], r["levels"]))
            base = r["segment"] * size
            up, down = r["left"] or [], r["right"] or []
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"]] * r["n"], pa.string()), pa.array(range(base, base + r["n"]), pa.int64()),
                 pa.array([x + up for x, _ in got], pa.list_(pa.string())),
                 pa.array([y + down for _, y in got], pa.list_(pa.string()))], names=["tree", "rank", "left", "right"])


def _with_above(tier: DataFrame, above: DataFrame, on: Column) -> DataFrame:
    return tier.join(above.select(F.col("tree").alias("_tree"), F.col("rank").alias("_rank"), "left", "right"), on,
                     "left").drop("_tree", "_rank")


def paths(log: Log, tmp: Scratch, above: DataFrame | None = None) -> DataFrame:
    """The lowest tier's segments with the (left, right) siblings above each, from the tiers over it.

    ``above`` holds (tree, rank, left, right) for the trees' own roots; none if these are the end.
    """
    spark, size = log.tiers[0].sparkSession, log.size
    none = spark.createDataFrame([], "tree string, rank long, " + _PATH)
    roots = none if above is None else above
    same = F.col("tree").eqNullSafe(F.col("_tree"))
    upper = none
    for i in range(len(log.tiers) - 1, -1, -1):
        tier, last = log.tiers[i], F.col("total") <= size
        if i == len(log.tiers) - 1:
            here = _with_above(tier.filter(last), roots, same)
        else:
            here = _with_above(tier.filter(last), roots, same).unionByName(
                _with_above(tier.filter(~last), upper, same & (F.col("segment") == F.col("_rank"))))
        if i:
            upper = tmp.write(here.select("tree", "segment", "n", "levels", "log", "left", "right").mapInArrow(
                lambda it: _paths(it, size), "tree string, rank long, " + _PATH), "paths")
    return here


_OUT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean")


def _proofs(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """Every leaf's proof, and the root that it leads to from the leaf as it is now."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    for b in batches:
        for r in b.to_pylist():
            rows = []
            up, down, sub = r["left"] or [], r["right"] or [], r["subroot"].hex()
            above = "".join(a + z for a, z in zip(up, down))
            at = position(0, np.arange(r["n"]), r["n"])
            text = np.frombuffer(r["log"], np.uint8).reshape(-1, 32)[at].tobytes().hex()
            for i, (left, right) in enumerate(siblings(r["log"], r["n"], r["levels"])):
                leaf = text[64 * i:64 * i + 64]
                proof = "".join([a + z for a, z in zip(left, right)]) + above
                now = r["now"][i]
                got = fold(leaf if now is None else now.hex(), left + up, right + down)
                rows.append((r["doc_id"][i], leaf, sub, root, hashlib.sha256(proof.encode()).hexdigest(), got,
                             got == root))
            cols = list(zip(*rows))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def tampered(docs: DataFrame) -> Column:
    """The text as the registered query's tampering leaves it."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))


def manifest(docs: DataFrame, tmp: Scratch, now: Column | None = None, size: int = SEGMENT) -> tuple[Log, Log]:
    """The logs of the trees of all languages and of the tree above them.

    The lowest tier also keeps its leaves' ``doc_id`` and, where the text ``now`` gives the row another
    hash, that hash (``now``).
    """
    ship(docs.sparkSession)
    old = leaf_hash([F.col(c) for c in FIELDS])
    new = leaf_hash([F.col(c) for c in FIELDS[:-1]] + [F.col("text") if now is None else now])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("tree"),
                       F.unhex(old).alias("hash"), F.unhex(new).alias("now"))
    rows = tmp.write(rows.withColumn("now", F.when(F.col("now") != F.col("hash"), F.col("now"))), "leaves")
    leaves = tmp.write(numbered(rows, "tree", ["doc_id", "hash"], tmp), "numbered")
    trees = build_log(leaves, {"doc_id": "long", "now": "binary"}, size, tmp)
    subroots = trees.subroots().select(F.col("tree").alias("lang"), F.lit("").alias("tree"), F.col("top").alias("hash"))
    tops = tmp.write(numbered(tmp.write(subroots, "subroots"), "tree", ["lang"], tmp), "numbered")
    return trees, build_log(tops, {"lang": "string"}, size, tmp)


def proofs(docs: DataFrame, now: Column | None = None, size: int = SEGMENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The proofs are of ``docs`` as it is; folded_root starts from the row with the text ``now``.
    """
    with Scratch(docs.sparkSession) as tmp:
        trees, top = manifest(docs, tmp, now, size)
        root = top.subroots().first()
        if root is None:
            return docs.sparkSession.createDataFrame([], _OUT)
        over = paths(top, tmp).select("tree", "segment", "n", "levels", "log", "left", "right", "lang")
        # One row per language: its subroot's path to the root.
        above = tmp.write(over.mapInArrow(lambda it: _named_paths(it, size), "tree string, rank long, " + _PATH), "paths")
        here = paths(trees, tmp, above)
        sub = trees.subroots().select(F.col("tree").alias("_of"), F.col("top").alias("subroot"))
        here = here.join(sub, F.col("tree").eqNullSafe(F.col("_of"))).select(
            "doc_id", "now", "n", "levels", "log", "left", "right", "subroot")
        hex_root = bytes(root["top"]).hex()
        return written(here.mapInArrow(lambda it: _proofs(it, hex_root), _OUT), "proofs")


def _named_paths(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The paths of the top tree's leaves under their languages' names."""
    for b in batches:
        names = [v for r in b.column(b.schema.get_field_index("lang")).to_pylist() for v in r]
        done = 0
        for p in _paths(iter([b.drop_columns(["lang"])]), size):
            own = names[done:done + p.num_rows]
            done += p.num_rows
            yield p.set_column(0, "tree", pa.array(own, pa.string()))


def log_entries(log: Log) -> DataFrame:
    """(tree, tier, segment, place, digest): the log itself, for users who store or ship it."""
    out = None
    for tier, t in enumerate(log.tiers):
        n = F.col("n")
        rows = t.select("tree", F.lit(tier).alias("tier"), "segment", F.hex("log").alias("_log"), n,
                        F.posexplode(F.expr("sequence(0, CAST(octet_length(log) / 32 AS INT) - 1)")).alias("place", "_i"))
        rows = rows.select("tree", "tier", "segment", F.col("place").cast("long").alias("place"),
                           F.lower(F.expr("substring(_log, _i * 64 + 1, 64)")).alias("digest"))
        out = rows if out is None else out.unionByName(rows)
    return out


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, concat(
           CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END,
           CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
           CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
           CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END) AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         4294967295 - list_reduce([CAST(4294967295 AS BIGINT)]
             || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
           lambda c, x: list_reduce([xor(c, x), 1, 2, 3, 4, 5, 6, 7, 8],
             lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents),
h AS (SELECT doc_id, lang,
             sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
             sha256(head || CASE WHEN text IS NULL THEN '-' WHEN crc % 3 = 0 THEN strlen(low) || ':' || low
                                 ELSE strlen(text) || ':' || text END) AS now FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM h),
t AS (SELECT lang, 0 AS level, i, leaf AS hash, n FROM r
      UNION ALL
      SELECT lang, level + 1, i // 8, sha256(string_agg(hash, '' ORDER BY i)), (any_value(n) + 7) // 8
      FROM t WHERE n > 1 GROUP BY lang, level, i // 8),
s AS (SELECT lang, hash, level AS top, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
      FROM t WHERE n = 1),
u AS (SELECT 0 AS level, i, hash, n FROM s
      UNION ALL
      SELECT level + 1, i // 8, sha256(string_agg(hash, '' ORDER BY i)), (any_value(n) + 7) // 8
      FROM u WHERE n > 1 GROUP BY level, i // 8),
p AS (SELECT r.doc_id, r.lang, r.i, r.leaf, r.now, s.hash AS subroot, s.i AS si, s.top FROM r JOIN s
      ON r.lang IS NOT DISTINCT FROM s.lang),
-- the run of each path node on each level: what lies left and right of it
step AS (
  SELECT p.lang, p.i, t.level,
         coalesce(string_agg(t.hash, '' ORDER BY t.i) FILTER (WHERE t.i < p.i // CAST(8 ** t.level AS BIGINT)), '') AS l,
         coalesce(string_agg(t.hash, '' ORDER BY t.i) FILTER (WHERE t.i > p.i // CAST(8 ** t.level AS BIGINT)), '') AS r
  FROM p JOIN t ON t.lang IS NOT DISTINCT FROM p.lang AND t.level < p.top
    AND t.i // 8 = p.i // CAST(8 ** (t.level + 1) AS BIGINT)
  GROUP BY p.lang, p.i, t.level
  UNION ALL
  SELECT p.lang, p.i, p.top + u.level,
         coalesce(string_agg(u.hash, '' ORDER BY u.i) FILTER (WHERE u.i < p.si // CAST(8 ** u.level AS BIGINT)), ''),
         coalesce(string_agg(u.hash, '' ORDER BY u.i) FILTER (WHERE u.i > p.si // CAST(8 ** u.level AS BIGINT)), '')
  FROM p JOIN u ON u.n > 1 AND u.i // 8 = p.si // CAST(8 ** (u.level + 1) AS BIGINT)
  GROUP BY p.lang, p.i, p.top, u.level),
f AS (SELECT lang, i, 0 AS level, now AS hash FROM p
      UNION ALL
      SELECT f.lang, f.i, f.level + 1, sha256(step.l || f.hash || step.r)
      FROM f JOIN step ON step.lang IS NOT DISTINCT FROM f.lang AND step.i = f.i AND step.level = f.level),
e AS (SELECT lang, i, arg_max(hash, level) AS folded FROM f GROUP BY lang, i),
q AS (SELECT lang, i, string_agg(l || r, '' ORDER BY level) AS proof FROM step GROUP BY lang, i)
SELECT p.doc_id, p.leaf, p.subroot, (SELECT hash FROM u WHERE n = 1) AS root, sha256(coalesce(q.proof, '')) AS proof_sha256,
       e.folded AS folded_root, e.folded = (SELECT hash FROM u WHERE n = 1) AS verified
FROM p JOIN e ON e.lang IS NOT DISTINCT FROM p.lang AND e.i = p.i
LEFT JOIN q ON q.lang IS NOT DISTINCT FROM p.lang AND q.i = p.i
"""
