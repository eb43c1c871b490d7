"""Exact quantiles by mergeable sketches (Q6).

``percentile_disc`` and ``approxQuantile(.., 0)`` gather every distinct value of a column into one buffer. Here a
KLL sketch of each column gives, for every wanted rank, two values that enclose it with near certainty; exact counts
settle the rest, so the sketch's random choices never show in a result:

1. a pass sketches every column;
2. while the enclosed part of a column may hold more than ``max_exact_rows`` rows, a pass counts the rows below and up to
   each end and sketches the inside;
3. a pass counts the rows below the ends and every value within, and reads the wanted rank off the running count.

With the default parameters that is two passes up to about 2e8 rows and three up to about 5e10; each further pass carries a factor of
200 more. Every pass serves all columns and probabilities. Should a rank lie outside its ends, which the counts show,
the ends move apart and the pass is repeated.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheaf.operators.columns import q

#: Sketches of the tasks meet in so many groups before the last merge, so no task merges all of them.
MERGE_GROUPS = 64
#: Ranks at which a sketch is read.
GRID = 1024


def sketch_error(k: int) -> float:
    """Rank error of a KLL sketch of size ``k``, as a share of its rows, that 99% of readings keep to."""
    return 2.296 / k ** 0.9021


@dataclass
class _Part:
    """The valid values of a column strictly between two values (None: all), with ``below`` valid rows up to the
    lower one and ``rows`` inside; ``grid`` holds values at evenly spaced ranks of its sketch."""
    col: str
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    rows: int = 0
    grid: list | None = None


@dataclass
class _Target:
    prob: float
    part: _Part
    rank: int = 0
    reach: float = 0.0  # how far the ends lie from the rank, as a share of the part's rows
    result: float | None = None
    done: bool = False
    ends: tuple = ()
    within: float = 0.0  # rows strictly between the ends, as estimated

    def enclose(self, error: float) -> None:
        """Choose the ends from the part's grid."""
        steps = len(self.part.grid) - 1
        at = (self.rank - self.part.below) / self.part.rows
        i = max(0, math.floor((at - self.reach) * steps))
        j = min(steps, math.ceil((at + self.reach) * steps))
        self.ends = (self.part.grid[i], self.part.grid[j])
        self.within = ((j - i) / steps + 2 * error) * self.part.rows

    def widen(self, error: float) -> None:
        if self.reach >= 1:
            raise RuntimeError(f"no rank {self.rank} between the ends of {self.part.col}")
        self.reach *= 4
        self.enclose(error)


def _rank(p: float, n: int) -> int:
    """1-based rank of the p-quantile: the smallest value whose cumulative share reaches p."""
    return min(n, max(1, math.ceil(p * n - 1e-9)))


def _value(col: str) -> Column:
    """The column as a double; null where it is null or NaN."""
    x = q(col).cast("double")
    return F.when(~F.isnan(x), x)


def _inside(part: _Part) -> Column:
    x = _value(part.col)
    return x.isNotNull() if part.lo is None else F.coalesce((x > part.lo) & (x < part.hi), F.lit(False))


def _sketch_pass(df: DataFrame, insides: Sequence[tuple[str, Column]], counts: Sequence[Column], k: int) -> tuple[list, list]:
    """One pass: (rows, grid) of the values of each (column, condition), and the sums of ``counts``."""
    grid = F.expr("array(" + ", ".join(f"{i / GRID!r}D" for i in range(GRID + 1)) + ")")
    aggs = [F.kll_sketch_agg_double(F.when(ok, _value(c)), k).alias(f"s{i}") for i, (c, ok) in enumerate(insides)]
    aggs += [F.count_if(ok).alias(f"n{i}") for i, (_, ok) in enumerate(insides)]
    aggs += [F.count_if(ok).alias(f"c{i}") for i, ok in enumerate(counts)]
    merged = (df.groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("_group")).agg(*aggs)
              .agg(*[F.kll_merge_agg_double(f"s{i}", k).alias(f"s{i}") for i in range(len(insides))],
                   *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(insides))],
                   *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(counts))]))
    row = merged.select(
        *[F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", grid)).alias(f"g{i}")
          for i in range(len(insides))],
        *[F.coalesce(f"n{i}", F.lit(0)).alias(f"n{i}") for i in range(len(insides))],
        *[F.coalesce(f"c{i}", F.lit(0)).alias(f"c{i}") for i in range(len(counts))]).first()
    return ([(row[f"n{i}"], row[f"g{i}"]) for i in range(len(insides))], [row[f"c{i}"] for i in range(len(counts))])


def _narrow_pass(df: DataFrame, targets: Sequence[_Target], k: int) -> None:
    """Count around the ends of every target and sketch between them."""
    error = sketch_error(k)
    ends = list(dict.fromkeys((t.part.col, *t.ends) for t in targets))
    sketches, counts = _sketch_pass(
        df, [(c, F.coalesce((_value(c) > a) & (_value(c) < b), F.lit(False))) for c, a, b in ends],
        [cond for c, a, b in ends for cond in (_value(c) < a, _value(c) <= a, _value(c) < b, _value(c) <= b)], k)
    parts = {}
    for i, (c, a, b) in enumerate(ends):
        parts[c, a, b] = (counts[4 * i:4 * i + 4],
                          _Part(c, a, b, counts[4 * i + 1], sketches[i][0], sketches[i][1]))
    for t in targets:
        (lta, lea, ltb, leb), part = parts[t.part.col, *t.ends]
        if lta < t.rank <= lea:
            t.result, t.done = t.ends[0], True
        elif ltb < t.rank <= leb:
            t.result, t.done = t.ends[1], True
        elif lea < t.rank <= ltb:
            t.part, t.reach = part, 2 * error
            t.enclose(error)
        else:
            t.widen(error)


def _rank_pass(df: DataFrame, targets: Sequence[_Target], error: float) -> None:
    """Count every value from end to end, and all rows below, and read the ranks off the running counts.

    Partial aggregation makes one row of all rows below, per task, and one of each value, however often it occurs. Ends
    are values of the column, so the running count of each bracket is over ``within`` rows and two values at most.
    """
    ends = list(dict.fromkeys((t.part.col, *t.ends) for t in targets))
    rows = df.select(F.explode(F.filter(F.array(*[
        F.struct(F.lit(i).alias("e"), (_value(c) >= a).alias("in"),
                 F.when((_value(c) >= a), _value(c)).alias("v"), (_value(c) <= b).alias("up"))
        for i, (c, a, b) in enumerate(ends)]), lambda s: s["up"])).alias("r")).select("r.e", "r.in", "r.v")
    w = Window.partitionBy("e").orderBy("in", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = (rows.groupBy("e", "in", "v").agg(F.count(F.lit(1)).alias("n"))
               .select("e", "in", "v", F.sum("n").over(w).alias("upto")))
    at = {x: i for i, x in enumerate(ends)}
    firsts = []
    for t in targets:
        here = (F.col("e") == at[t.part.col, *t.ends]) & (F.col("upto") >= t.rank)
        firsts.append(F.min(F.when(here, F.struct("upto", "in", "v"))))
    row = running.agg(*[f.alias(f"t{j}") for j, f in enumerate(firsts)]).first()
    for j, t in enumerate(targets):
        found = row[f"t{j}"]
        if found is not None and found["in"]:
            t.result, t.done = found["v"], True
        else:
            t.widen(error)


def exact_quantiles_multi(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                          max_exact_rows: int = 1_000_000, accuracy: int = 8192) -> dict[str, list]:
    """Exact (observed-value) quantiles of several numeric columns; nulls and NaN do not count.

    Matches ``percentile_disc`` and ``approxQuantile(col, probs, 0)``. ``accuracy`` is the sketches' size, from 8 to 65535;
    a larger one leaves fewer rows between the ends. A column without values gives nulls.
    """
    k = min(65535, max(8, accuracy))
    error = sketch_error(k)
    cols = list(dict.fromkeys(cols))
    sketches, _ = _sketch_pass(df, [(c, _inside(_Part(c))) for c in cols], [], k)
    found: dict[str, list[_Target]] = {}
    for c, (n, grid) in zip(cols, sketches):
        part = _Part(c, rows=n, grid=grid)
        found[c] = [_Target(p, part, reach=2 * error, done=n == 0) for p in probs]
        for t in found[c]:
            if n:
                t.rank = _rank(t.prob, n)
                t.enclose(error)
    while True:
        left = [t for ts in found.values() for t in ts if not t.done]
        if not left:
            return {c: [t.result for t in ts] for c, ts in found.items()}
        large = [t for t in left if t.within > max_exact_rows and t.ends[0] < t.ends[1]]
        if large:
            _narrow_pass(df, large, k)
        else:
            _rank_pass(df, left, error)


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], max_exact_rows: int = 1_000_000,
                    accuracy: int = 8192) -> list:
    """Exact quantiles of one column; see ``exact_quantiles_multi``."""
    return exact_quantiles_multi(df, [col], probs, max_exact_rows, accuracy)[col]
