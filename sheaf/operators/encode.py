"""Categorical encoders (E2 one-hot, E5 weight of evidence) as fit -> transform pairs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.safe import round_half_up
from sheaf.operators.columns import q
from sheaf.operators.joins import broadcast_threshold
from sheaf.session import checkpoint_dir

# ---------------------------------------------------------------------------------------------
# One-hot


def one_hot_columns(col: str, values: Sequence, prefix: str | None = None) -> list[Column]:
    """One int column per value: 1 where ``col`` equals it, else 0 (null included).

    Dots and backquotes in a value become underscores in its column's name, as they do in all names
    of the workload, so that formulas can refer to it; values that would share a name are an error.
    """
    prefix = col if prefix is None else prefix
    names = [f"{prefix}_{v}".replace(".", "_").replace("`", "_") for v in values]
    if len(set(names)) < len(names):
        twice = sorted(n for n in set(names) if names.count(n) > 1)
        raise ValueError(f"levels of {col} share the column names {twice}")
    return [F.when(q(col) == v, F.lit(1)).otherwise(F.lit(0)).alias(n) for v, n in zip(values, names)]


@dataclass
class OneHotModel:
    values: dict[str, list]
    prefixes: dict[str, str]

    def columns(self) -> list[Column]:
        return [c for col, vals in self.values.items()
                for c in one_hot_columns(col, vals, self.prefixes[col])]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select("*", *self.columns())


class OneHotEncoder:
    """Fit: collect each column's levels, one per output column. Transform: plain column expressions,
    so the encoding stays inside generated code; no Python UDF, no join. For columns of very many levels
    use ``one_hot_vector``, which needs no column per level."""

    def __init__(self, cols: dict[str, str] | Sequence[str], max_levels: int | None = None):
        self.prefixes = dict(cols) if isinstance(cols, dict) else {c: c for c in cols}
        self.max_levels = max_levels

    def fit(self, df: DataFrame) -> OneHotModel:
        """All columns' levels from one scan: unpivot to (column, level), distinct, collect (the output
        schema depends on them). With ``max_levels``, a column that has more raises."""
        cols = list(self.prefixes)
        if not cols:
            return OneHotModel({}, self.prefixes)
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("c"), q(c).cast("string").alias("v")) for c in cols])))
        rows = long.filter(F.col("v").isNotNull()).distinct()
        if self.max_levels is not None:
            rows = rows.limit(len(cols) * self.max_levels + 1)
        rows = rows.collect()
        found: dict[str, list] = {c: [] for c in cols}
        for r in rows:
            found[r["c"]].append(r["v"])
        if self.max_levels is not None and any(len(v) > self.max_levels for v in found.values()):
            raise ValueError(f"more than {self.max_levels} distinct values in one of {cols}")
        return OneHotModel({c: sorted(v) for c, v in found.items()}, self.prefixes)


def one_hot(df: DataFrame, col: str, prefix: str | None = None,
            max_levels: int | None = None) -> DataFrame:
    return OneHotEncoder({col: prefix or col}, max_levels).fit(df).transform(df)


def one_hot_vector(df: DataFrame, cols: Sequence[str], suffix: str = "_vec") -> DataFrame:
    """One sparse 0/1 vector per column (levels in order of frequency, ties by value; null is all zeros
    but for a last place of its own), for columns too wide for a column per level."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder as VectorEncoder
    from pyspark.ml.feature import StringIndexer
    index = StringIndexer(inputCols=list(cols), outputCols=[f"_i{i}" for i in range(len(cols))],
                          handleInvalid="keep")
    encode = VectorEncoder(inputCols=index.getOutputCols(), outputCols=[f"{c}{suffix}" for c in cols],
                           dropLast=False)
    return Pipeline(stages=[index, encode]).fit(df).transform(df).drop(*index.getOutputCols())


# ---------------------------------------------------------------------------------------------
# Weight of evidence


@dataclass
class WoeModel:
    cols: list[str]
    mapping: DataFrame          # feature, level, woe (checkpointed)
    mapping_rows: int
    mapping_bytes: int
    broadcast_limit: int | None = None
    salts: int = 32

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        """Replace each column by its WOE (``suffix`` keeps the original and adds a new column).

        Unseen values get 0; a null gets the WOE of the null level if it was seen in fitting, else 0.
        The mapping is broadcast only when its measured size is under the broadcast threshold;
        otherwise the join shuffles on (level, salt), with ``salts`` copies of each mapping row, so that
        a level (or the nulls) with most rows is spread over that many tasks.
        """
        limit = broadcast_threshold(df.sparkSession) if self.broadcast_limit is None else self.broadcast_limit
        small = 0 < self.mapping_bytes <= limit
        out = df if small else df.withColumn("_salt", (F.rand(0) * self.salts).cast("int"))
        for i, c in enumerate(self.cols):
            m = (self.mapping.filter(F.col("feature") == c)
                 .select(F.col("level").alias(f"_lvl{i}"), F.col("woe").alias(f"_woe{i}")))
            on = q(c).cast("string").eqNullSafe(F.col(f"_lvl{i}"))
            if small:
                m = F.broadcast(m)
            else:
                m = m.withColumn(f"_salt{i}", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
                on = on & (F.col("_salt") == F.col(f"_salt{i}"))
            out = out.join(m, on, "left")
        names = df.columns
        sel = []
        for c in names:
            if c in self.cols and not suffix:
                i = self.cols.index(c)
                sel.append(F.coalesce(F.col(f"_woe{i}"), F.lit(0.0)).alias(c))
            else:
                sel.append(q(c))
        if suffix:
            sel += [F.coalesce(F.col(f"_woe{i}"), F.lit(0.0)).alias(f"{c}{suffix}")
                    for i, c in enumerate(self.cols)]
        return out.select(sel)


class WoeEncoder:
    """Weight of evidence of categorical columns against a 0/1 target.

    For level i with ``pos_i`` positives out of ``n_i`` rows, P positives and N negatives overall and
    regularization r::

        woe_i = ln( ((pos_i + r) / (P + 2r)) / ((n_i - pos_i + r) / (N + 2r)) )

    Levels seen once get 0 (guards id-like columns); null is a level of its own. Rows with a null
    target are left out of the fit. Values are rounded half-up to ``decimals`` places (6 by
    default), which makes them identical across engines and math libraries; ``None`` keeps full
    precision. All columns are counted in one aggregation: the table is unpivoted to (feature,
    level, target) and grouped once, with partial aggregation, so a level holding a third of all
    rows costs one pre-aggregated row per task.
    """

    def __init__(self, cols: Sequence[str], target: str, regularization: float = 1.0,
                 broadcast_limit: int | None = None, decimals: int | None = 6):
        self.cols, self.target = list(cols), target
        self.r = float(regularization)
        self.broadcast_limit = broadcast_limit
        self.decimals = decimals

    def fit(self, df: DataFrame) -> WoeModel:
        """Two jobs: the grouped counts (checkpointed), then one small aggregation over them for the
        class totals, the 0/1 check and the mapping's size. Every labelled row counts once per
        feature, so the first feature's levels add up to the totals."""
        y = q(self.target)
        d = df.filter(y.isNotNull())
        long = d.select(y.cast("double").alias("_y"), F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), q(c).cast("string").alias("level"))
            for c in self.cols])))
        checkpoint_dir(df.sparkSession)
        stats = (long.groupBy("feature", "level")
                 .agg(F.sum("_y").alias("pos"), F.count("_y").alias("n"),
                      F.count_if((F.col("_y") != 0) & (F.col("_y") != 1)).alias("bad"))
                 .checkpoint(eager=True))
        first = F.col("feature") == self.cols[0]
        tot = stats.agg(F.sum(F.when(first, F.col("pos"))).alias("p"),
                        F.sum(F.when(first, F.col("n"))).alias("n"),
                        F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("rows"),
                        F.sum(F.octet_length("feature") + F.coalesce(F.octet_length("level"),
                                                                      F.lit(0)) + 48)
                        .alias("bytes")).first()
        if not tot["n"]:
            raise ValueError("no rows with a target")
        if tot["bad"]:
            raise ValueError("target must be 0/1")
        p_all, n_all = float(tot["p"]), float(tot["n"])
        neg_all = n_all - p_all
        r = self.r
        woe = F.ln(((F.col("pos") + r) / F.lit(p_all + 2 * r))
                   / ((F.col("n") - F.col("pos") + r) / F.lit(neg_all + 2 * r)))
        if self.decimals is not None:
            woe = round_half_up(woe, self.decimals)
        mapping = stats.select("feature", "level",
                               F.when(F.col("n") == 1, F.lit(0.0)).otherwise(woe).alias("woe"))
        rows, size = int(tot["rows"]), int(tot["bytes"])
        return WoeModel(self.cols, mapping, rows, size, self.broadcast_limit)
