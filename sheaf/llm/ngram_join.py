"""Operator 3, n-gram Jaccard join: a size-aware heavy-light join.

A document is the set of its distinct word shingles; documents with equal sets are one class. Classes
link when the Jaccard similarity of their sets reaches ``num / den``, that is, when the symmetric
difference of their sets is at most ``(a + b) * (den - num) / (den + num)``.

Light (small) sets enumerate fixed-size subsets: for every overlap c that a partner of possible size
would need, all c-subsets. Two light sets that link share such a subset, and a shared one proves the
overlap.

Heavy (large) sets are found by scanning inverted lists. A list holds the sets that have exactly the
same shingles in one segment of the hash space. Sizes are cut into ranges of ratio ``num / den``; for a
range the space has more segments than two linked sets can differ in, so a set that is listed under
one segment more than that meets all its partners. A set is listed under its segments of
three shingles or more (two, one, and last the empty ones, if those are too few: the fuller ones
are listed in any case, so the luckier set of a pair decides). Lists of single shingles would be lossless as
well, but a passage that many documents share makes them as long as the corpus; a segment of several
shingles is equal in unlike documents only if all of them come from that passage.

The boundary between light and heavy is the one of least modelled cost (subsets enumerated against
segments listed and list partners scanned) over the corpus's own histogram of small sizes.

Signatures travel packed (about 10 bytes each) to hash bins, one entry per task and list. A list
proposes links between its pivots (the smallest key of a task, and of all tasks) and the others, never
all pairs; candidates pass a size test and a 512-bit parity sketch (its Hamming
distance is a lower bound of the symmetric difference) before the sets themselves are compared
exactly. Lists whose members are then still in several components are put together by their pivot, so that
two sets meet once for all their lists with that pivot. They meet in chunks of bounded size, twice: by wide sketches
(bits in proportion to the difference allowed), which names the sets that have a possible partner in another component,
and these with the sets themselves, compared exactly and united at once, so a meeting returns a forest of
links, fewer than its members. No link that would join two components is left out, and
groups of copies cost rows in proportion to their size.

Defined results: a null, empty or blank text has no shingles, links with nothing and is its own component;
a text with fewer words than a shingle is one shingle; rows that repeat an id share a component; rows
with a null id have a null component; other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import (Scratch, fan_out, mix, ship, signed, text_mark, text_slices, window_hashes,
                              without, words, written)
from sheaf.llm.components import connected_components
from sheaf.llm.exchange import SCHEMA, Exchange, groups

SMALL = 64  # sizes up to here may be light
_SLICE = 1 << 18  # text bytes hashed at once; the arrays derived from them take fifty times that
_KEY = np.uint64(0xA24BAED4963EE407)
_SIG = np.uint64(0x9FB21C651E98DF25)
_ALL = (1 << 64) - 1


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    _, _, h, first = words(data, off, lower=True)
    w = window_hashes(h, k)
    for a, z in zip(first[:-1].tolist(), first[1:].tolist()):
        if z - a >= k:
            yield np.unique(w[a:z - k + 1])
        elif z > a:
            yield window_hashes(h[a:z], z - a)
        else:
            yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """A 64-bit key of a whole set."""
    return int(mix(np.array([mix(s + _KEY).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def sketch(s: np.ndarray) -> np.ndarray:
    """512 parity bits as 8 integers."""
    bits = np.bincount((s >> np.uint64(55)).astype(np.int64), minlength=512) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


class Plan:
    """Thresholds, size ranges and segment counts; pure arithmetic on set sizes."""

    def __init__(self, num: int, den: int, boundary: int = 0):
        self.num, self.den, self.boundary = num, den, boundary

    def need(self, a: int, b: int) -> int:
        """Least overlap of linked sets of these sizes."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def partners(self, s: int) -> range:
        return range(-(-self.num * s // self.den), self.den * s // self.num + 1)

    def drops(self, s: int) -> list[int]:
        """How many elements each wanted subset size leaves out."""
        return sorted({s - c for b in self.partners(s) if b <= self.boundary and (c := self.need(s, b)) <= min(s, b)})

    def subsets(self, s: int) -> int:
        full = Plan(self.num, self.den, 1 << 30)
        return sum(math.comb(s, d) for d in full.drops(s))

    def first_heavy(self) -> int:
        """The least size that can have a partner above the boundary."""
        return -(-self.num * (self.boundary + 1) // self.den)

    def size_range(self, s: int) -> int:
        return _range(self.num, self.den, s)

    def segments(self, j: int) -> tuple[int, int, int]:
        """(segments, most that linked sets of range j and up differ in, least shingles of a listed
        segment) for the range j."""
        return _segments(self.num, self.den, j)

    def unlucky(self, s: int) -> float:
        """Modelled share of sets of this size that must be listed under empty segments too."""
        k, most, _ = self.segments(self.size_range(s))
        p = math.exp(-s / k)
        sd = math.sqrt(max(k * p * (1 - p), 1e-9))
        return 0.5 * math.erfc((k * (1 - p) - most - 0.5) / sd / math.sqrt(2))


@lru_cache(maxsize=100_000)
def _range(num: int, den: int, s: int) -> int:
    j, low = 0, 1
    while s > low * den // num:  # the range is [low, low * den / num]
        low = low * den // num + 1
        j += 1
    return j


@lru_cache(maxsize=10_000)
def _segments(num: int, den: int, j: int) -> tuple[int, int, int]:
    low = 1
    for _ in range(j):
        low = low * den // num + 1
    high = low * den // num
    most = (den - num) * (high + den * high // num) // (den + num)
    # Enough segments for most sets of the range to be listed under fuller ones only; the last choice,
    # non-empty ones, must do for nearly all.
    for least, typical, spare in ((3, low + 0.35 * (high - low), 0), (2, low + 0.35 * (high - low), 0), (1, low, 2)):
        k = most + 1
        while k < low:
            mean = typical / k  # shingles of a segment, nearly Poisson
            p = 1 - math.exp(-mean) * sum(mean ** i / math.factorial(i) for i in range(least))
            if k * p - spare * math.sqrt(k * p * (1 - p)) >= most + 1:
                return k, most, least
            k += max(1, k // 64)
    return max(2, 2 * (most + 1)), most, 1


def signatures(s: np.ndarray, plan: Plan) -> np.ndarray:
    """All signatures of a set: its subsets if it is light, its segments if it can meet a heavy one."""
    n = len(s)
    mixed = mix(s + _SIG)
    out = []
    if n <= plan.boundary:
        total = mixed.sum(dtype=np.uint64)
        for d in plan.drops(n):
            left_out = mixed[_combinations(n, d)].sum(1, dtype=np.uint64) if d else np.zeros(1, np.uint64)
            rest = total - left_out
            out.append(mix(rest + np.uint64(int(_KEY) * (n - d) & _ALL)))
    if n >= plan.first_heavy() and n:
        own = plan.size_range(n)
        for j in (own, own - 1) if own else (own,):
            k, most, least = plan.segments(j)
            seg = ((s >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
            at = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
            size = np.diff(np.r_[at, n])
            used = seg[at]
            body = np.add.reduceat(mixed, at)
            while least > 1 and np.count_nonzero(size >= least) <= most:
                least -= 1
            if least > 1:
                used, body = used[size >= least], body[size >= least]
            elif len(used) <= most:  # too few to be sure to meet a partner in one
                empty = np.setdiff1d(np.arange(k, dtype=np.uint64), used)
                used = np.concatenate([used, empty])
                body = np.concatenate([body, np.zeros(len(empty), np.uint64)])
            out.append(mix(body ^ mix((used + np.uint64(1)) * _SIG + np.uint64(int(_KEY) * j & _ALL))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


@lru_cache(maxsize=500)
def _combinations(n: int, d: int) -> np.ndarray:
    return np.array(list(itertools.combinations(range(n), d)), np.int64).reshape(-1, d)


_SKETCH = [f"s{i}" for i in range(8)]


def _nodes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sets named by a key; columns after id and text (a mark of the text) are passed on."""
    for rows, data, off in text_slices(batches, "text", _SLICE):
        sets = list(shingle_sets(data, off, k))
        bits = np.array([sketch(s) for s in sets]).reshape(len(sets), 8)
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), *[pa.array(bits[:, i]) for i in range(8)],
             *rows.columns[2:]], names=["doc_id", "key", "n", *_SKETCH, *rows.schema.names[2:]])


def _entries(batches: Iterator[pa.RecordBatch], k: int, plan: Plan, way: Exchange,
             most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    sig: list[np.ndarray] = []
    key: list[np.ndarray] = []
    seen: set[int] = set()
    waiting = salt = 0

    def flush() -> pa.RecordBatch:
        return way.pack(np.concatenate(sig), np.concatenate(key), salt)

    for rows, data, off in text_slices(batches, "text", _SLICE):
        salt = rows.column("part")[0].as_py() * 1009 + len(seen)
        for s in shingle_sets(data, off, k):
            if not len(s) or (own := set_key(s)) in seen:
                continue
            seen.add(own)
            got = signatures(s, plan)
            sig.append(got)
            key.append(np.full(len(got), own >> 16 & (1 << 48) - 1, np.int64))
            waiting += len(got)
            if waiting >= most:
                yield flush()
                sig, key, waiting, seen = [], [], 0, set()
    if waiting:
        yield flush()


def _lists(rows: pd.DataFrame, way: Exchange) -> pd.DataFrame:
    """The inverted lists of one bin that hold two sets or more: (list, key, pivot)."""
    (sig, key, _), (list_, own, pivot) = way.unpack(rows)
    at, count = groups(sig)
    least, most = np.minimum.reduceat(key, at), np.maximum.reduceat(key, at)
    many = np.repeat(least < most, count)
    return pd.DataFrame({"list": np.concatenate([sig[many], list_]), "key": np.concatenate([key[many], own]),
                         "pivot": np.concatenate([np.repeat(least, count)[many], pivot])})


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for _, data, off in text_slices(batches, "text", _SLICE):
        sets = [s for s in shingle_sets(data, off, k) if len(s)]
        lens = np.array([len(s) for s in sets], np.int64)
        flat = signed(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_key(s) for s in sets], pa.int64()),
             pa.ListArray.from_arrays(np.r_[0, np.cumsum(lens)].astype(np.int32), pa.array(flat))],
            names=["key", "items"])


def least_cost_boundary(sizes: dict[int, int], num: int, den: int) -> int:
    """The light/heavy boundary of least modelled cost for a histogram of small set sizes."""
    plan = Plan(num, den)
    ranges: dict[int, int] = {}
    for s, n in sizes.items():
        ranges[plan.size_range(s)] = ranges.get(plan.size_range(s), 0) + n

    def heavy(s: int) -> float:
        j = plan.size_range(s)
        listed = sum(plan.segments(i)[0] for i in {j, max(0, j - 1)})
        odd = plan.unlucky(s)
        return listed + odd * odd * ranges.get(j, 0) * plan.segments(j)[0]

    def cost(x: int) -> float:
        edge = Plan(num, den, x).first_heavy()
        return sum(n * ((plan.subsets(s) if s <= x else 0) + (heavy(s) if s >= edge else 0))
                   for s, n in sizes.items())
    return min(range(SMALL + 1), key=lambda x: (cost(x), x)) if sizes else 0


def _bound(a: Column, b: Column, num: int, den: int) -> Column:
    """Largest symmetric difference of linked sets of these sizes."""
    return F.floor((a + b) * F.lit(den - num) / F.lit(den + num))


def _apart() -> Column:
    """Lower bound of the symmetric difference of sets x and y from their sketches."""
    return sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in _SKETCH[1:]),
               F.bit_count(F.col("x.s0").bitwiseXOR(F.col("y.s0"))))


def shingle_nodes(docs: DataFrame, shingle: int, marked: bool = False) -> DataFrame:
    """doc_id, key, n and the sketch of every document (and the ``mark`` of its text)."""
    more = [text_mark("text").alias("mark")] * marked
    return docs.select("doc_id", "text", *more).mapInArrow(
        lambda it: _nodes(it, shingle),
        "doc_id long, key long, n long, " + ", ".join(f"{c} long" for c in _SKETCH) + ", mark string" * marked)


_CHUNK = 2048  # members of a group that meet as many others in one task
_ITEMS = 1 << 20  # shingles of the members of a chunk, about
_BLOCK = 1 << 22  # words compared at once


def wide_bits(n: int, num: int, den: int) -> int:
    """Bits of a set's wide sketch: a power of two, eight times what it may differ in from a linked set or more,
    so that the sketches of sets that differ in a little more than that already do."""
    return max(512, 1 << (8 * (den - num) * (n + den * n // num) // (den + num)).bit_length())


def wide_sketch(s: np.ndarray, bits: int) -> np.ndarray:
    """Parity bits as 64-bit words; halving the bits is XOR of the halves."""
    at = (mix(s.copy()) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def _halved(words: np.ndarray, bits: int) -> np.ndarray:
    while words.shape[1] * 64 > bits:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def may_link(left: list[np.ndarray], right: list[np.ndarray], x: np.ndarray, y: np.ndarray, num: int,
             den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sets (given by wide sketches and sizes) that may link by size and by sketch, in blocks."""
    def classes(words):
        width = np.array([len(w) for w in words])
        return {int(w): np.flatnonzero(width == w) for w in np.unique(width)}

    rights = classes(right)
    for w, i in classes(left).items():
        for v, j in rights.items():
            n = x[i], y[j]
            if min(n[0].max(), n[1].max()) * den < max(n[0].min(), n[1].min()) * num:
                continue  # no two of these sizes link
            bits = 64 * min(v, w)
            a = _halved(np.stack([left[k] for k in i]), bits)
            b = _halved(np.stack([right[k] for k in j]), bits)
            step = max(1, _BLOCK // max(1, b.size))
            for lo in range(0, len(i), step):
                apart = np.bitwise_count(a[lo:lo + step, None, :] ^ b[None, :, :]).sum(2, dtype=np.int64)
                p, q = n[0][lo:lo + step, None], n[1][None, :]
                ok = (np.minimum(p, q) * den >= np.maximum(p, q) * num) & (apart <= (p + q) * (den - num) // (den + num))
                u, t = np.nonzero(ok)
                yield i[lo + u], j[t]


def _meetings(rows: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """The (left, right) members of every (group, left chunk, right chunk) of a bin."""
    for _, g in rows.groupby(["p", "cl", "cr"], sort=False):
        left = g["side"].to_numpy() == 0
        yield g[left], g[~left]


def _sketches(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, wide = [], []
        for lo in range(0, b.num_rows, 64):
            some = b.slice(lo, 64)
            keys += some.column(0).to_pylist()
            for items in some.column(1):
                s = items.values.to_numpy().view(np.uint64)
                wide.append(wide_sketch(s, wide_bits(len(s), num, den)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(wide, pa.binary())], names=["key", "wide"])


def _near(rows: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """The members of one bin's meetings that have someone of another component to meet whom they may link with."""
    out = [rows.iloc[:0]]
    for left, right in _meetings(rows):
        words = [[np.frombuffer(w, np.uint64) for w in side["wide"]] for side in (left, right)]
        x, y = left["n"].to_numpy(np.int64), right["n"].to_numpy(np.int64)
        own, other = left["root"].to_numpy(np.int64), right["root"].to_numpy(np.int64)
        near = np.zeros(len(left), bool), np.zeros(len(right), bool)
        if len(left) and len(right):
            for i, j in may_link(words[0], words[1], x, y, num, den):
                apart = own[i] != other[j]
                near[0][i[apart]] = True
                near[1][j[apart]] = True
        out += [left[near[0]], right[near[1]]]
    return pd.concat(out)[["p", "cl", "cr", "side", "key", "root"]]


def linked(s: np.ndarray, t: np.ndarray, num: int, den: int) -> bool:
    both = len(s) + len(t) - len(np.unique(np.concatenate([s, t])))
    return both * den >= (len(s) + len(t) - both) * num


def _joined(rows: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links of one bin's meetings that join components, by the sets themselves: a forest, so fewer than members."""
    out: list[tuple[int, int]] = []
    for left, right in _meetings(rows):
        sets = [[np.asarray(v, np.int64).view(np.uint64) for v in side["items"]] for side in (left, right)]
        n = [np.array([len(v) for v in side], np.int64) for side in sets]
        if not len(n[0]) or not len(n[1]):
            continue
        words = [[wide_sketch(v, wide_bits(len(v), num, den)) for v in side] for side in sets]
        keys = left["key"].tolist(), right["key"].tolist()
        roots = left["root"].tolist(), right["root"].tolist()
        up: dict[int, int] = {}

        def find(r: int) -> int:
            while r in up:
                if up[r] in up:
                    up[r] = up[up[r]]
                r = up[r]
            return r

        for i, j in may_link(words[0], words[1], n[0], n[1], num, den):
            for a, b in zip(i.tolist(), j.tolist()):
                x, y = find(roots[0][a]), find(roots[1][b])
                if x != y and linked(sets[0][a], sets[1][b], num, den):
                    up[x] = y
                    out.append((keys[0][a], keys[1][b]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _mixed(on: DataFrame) -> DataFrame:
    """(list, p, main) of the lists with members (list, k, key, root, is_pivot) of several components.

    ``p`` is the list's smallest pivot (by ``k``, the key that the star of the list was built around); the lists of a
    family of alike sets have few of them. The main component is that of ``p``.
    """
    pivot = F.when(F.col("is_pivot"), F.struct("k", "key"))
    return (on.groupBy("list").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min(pivot).alias("p"),
                                   F.min_by("root", pivot).alias("main"))
            .filter("lo <> hi").select("list", F.col("p.key").alias("p"), "main"))


def ngram_components(docs: DataFrame, shingle: int = 3, num: int = 90, den: int = 100,
                     id_col: str = "doc_id", text_col: str = "text", marked: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (and the ``mark`` of the text)."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nodes = written(shingle_nodes(docs, shingle, marked), "shingles")
    with Scratch(spark) as tmp:
        named = written(_classes_by_component(docs, nodes, shingle, num, den, tmp), "components")
    mark = ["mark"] * marked
    out = nodes.select("doc_id", "key", "n", *mark).hint("merge").join(named, "key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), *mark)


def _classes_by_component(docs: DataFrame, nodes: DataFrame, shingle: int, num: int, den: int,
                          tmp: Scratch) -> DataFrame:
    """(key, component): the classes that are linked to others or have several documents or one."""
    spark = docs.sparkSession
    classes = nodes.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.max("n").alias("n"), *[F.max(c).alias(c) for c in _SKETCH])
    sizes = {r["n"]: r["k"] for r in nodes.filter(f"n BETWEEN 1 AND {SMALL}").groupBy("n").agg(
        F.count(F.lit(1)).alias("k")).collect()}  # at most SMALL rows
    plan = Plan(num, den, least_cost_boundary(sizes, num, den))
    bins = fan_out(spark)
    way = Exchange(max(4, min(20, (bins - 1).bit_length())), 4)
    lists = tmp.write(
        docs.filter("doc_id IS NOT NULL").select("text", F.spark_partition_id().alias("part")).mapInArrow(
            lambda it: _entries(it, shingle, plan, way), SCHEMA)
        .groupBy("bin").applyInPandas(lambda g: _lists(g, way), "list long, key long, pivot long"), "lists")
    # The classes that are on some list, with their whole keys.
    short = F.shiftrightunsigned("key", 16)
    listed = tmp.write(classes.withColumn("k", short).join(
        lists.select(F.col("key").alias("k")).distinct(), "k", "left_semi"), "listed")
    items = tmp.write(docs.hint("merge").join(listed.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
                      .select("text").mapInArrow(lambda it: _sets(it, shingle), "key long, items array<long>")
                      .join(listed.select("key"), "key", "left_semi").dropDuplicates(["key"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """(a, b, linked) from the sets themselves."""
        both = (pairs.join(items.select(F.col("key").alias("a"), F.col("items").alias("p")), "a")
                .join(items.select(F.col("key").alias("b"), F.col("items").alias("q")), "b"))
        common = F.size(F.array_intersect("p", "q"))
        union = F.size("p") + F.size("q") - common
        return tmp.write(both.select("a", "b", (common * den >= union * num).alias("linked")), "links")

    def struct(name: str) -> Column:
        return F.struct("key", "n", *_SKETCH).alias(name)

    xs = listed.select(F.col("k").alias("kx"), struct("x"))
    ys = listed.select(F.col("k").alias("ky"), struct("y"))
    small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    star = (lists.filter("key <> pivot").select(F.col("pivot").alias("kx"), F.col("key").alias("ky")).distinct()
            .join(xs, "kx").join(ys, "ky")
            .filter((small * den >= large * num) & (_apart() <= _bound(F.col("x.n"), F.col("y.n"), num, den)))
            .select(F.col("x.key").alias("a"), F.col("y.key").alias("b")))
    stars = verified(star).filter("linked").select("a", "b")
    roots = connected_components(stars, "a", "b", tmp)
    root = listed.select("key", "k", "n").join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    members = lists.groupBy("list", F.col("key").alias("k")).agg(
        F.max(F.col("key") == F.col("pivot")).alias("is_pivot"))
    on = members.join(root.select("k", "key", "n", F.coalesce("root", "key").alias("root")), "k")
    # Sets of one list in different components meet, once for each pivot that their lists have in common.
    group = on.join(_mixed(on), "list").groupBy("p", "key").agg(
        F.max("root").alias("root"), F.max("n").alias("n"), F.min("main").alias("main"))
    group = tmp.write(group, "groups")
    chunks = F.ceil(F.greatest(F.count(F.lit(1)) / _CHUNK, F.sum("n") / _ITEMS)).cast("int")
    sized = group.join(group.groupBy("p").agg(chunks.alias("of")), "p").withColumn(
        "c", F.pmod(F.xxhash64("key"), F.col("of")).cast("int"))
    every_chunk = F.explode(F.sequence(F.lit(0), F.col("of") - 1))
    # Whoever is in the main component meets the others as one of the right side.
    left = sized.filter("root <> main").withColumn("cr", every_chunk).withColumnRenamed("c", "cl")
    right = sized.withColumn("cl", every_chunk).withColumnRenamed("c", "cr")
    meetings = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1))).drop("of", "main")
    where = F.pmod(F.xxhash64("p", "cl", "cr"), F.lit(bins)).alias("bin")
    wide = tmp.write(items.join(group.select("key").distinct(), "key", "left_semi").mapInArrow(
        lambda it: _sketches(it, num, den), "key long, wide binary"), "sketches")
    near = tmp.write(meetings.join(wide, "key").select("*", where).groupBy("bin").applyInPandas(
        lambda g: _near(g, num, den), "p long, cl int, cr int, side int, key long, root long"), "near")
    more = tmp.write(near.join(items, "key").select("*", where).groupBy("bin").applyInPandas(
        lambda g: _joined(g, num, den), "a long, b long"), "links")
    roots = connected_components(tmp.write(stars.union(more), "links"), "a", "b", tmp)
    named = classes.select("key", "rep").join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    named = tmp.write(named.withColumn("root", F.coalesce("root", "key")), "roots")
    lowest = named.groupBy("root").agg(F.min("rep").alias("component"))
    return named.join(lowest, "root").select("key", "component")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document (the smallest id) of each component, all columns as they were.

    A row goes by its id and text: another text with the same id that is no copy stays."""
    gone = ngram_components(docs, shingle, num, den, marked=True).filter("doc_id <> component_id")
    return without(docs, "doc_id", "text", gone.select("doc_id", "mark").distinct())
