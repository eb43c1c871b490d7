"""Null filling (E3) and mean imputation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.columns import q
from sheaf.operators.profile import column_means


def fill_constant(df: DataFrame, value, subset: Sequence[str]) -> DataFrame:
    """Fill nulls of ``subset`` with a constant of the column's own kind.

    Unlike ``na.fill``, a value of another type is cast rather than silently skipped.
    """
    subset = set(subset)
    return df.select([F.coalesce(q(c), F.lit(value).cast(df.schema[c].dataType)).alias(c)
                      if c in subset else q(c) for c in df.columns])


@dataclass
class MeanImputerModel:
    means: dict[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        """Columns become double (filling 2.57 into a bigint column would store 2) and nulls take
        the fitted mean."""
        out = []
        for c in df.columns:
            if c in self.means:
                e = q(c).cast("double")
                if self.means[c] is not None:
                    e = F.coalesce(e, F.lit(float(self.means[c])))
                out.append(e.alias(c))
            else:
                out.append(q(c))
        return df.select(out)


class MeanImputer:
    """Mean imputation, each column with its own mean, all means from one aggregation.

    With ``zero_fill`` (the workload's contract) the mean is taken after counting nulls as 0.
    Means are rounded half-up to ``scale`` digits.
    """

    def __init__(self, cols: Sequence[str], scale: int = 2, zero_fill: bool = True):
        self.cols, self.scale, self.zero_fill = list(cols), scale, zero_fill

    def fit(self, df: DataFrame) -> MeanImputerModel:
        cols = [c for c in self.cols if c in df.columns]
        if not cols:
            return MeanImputerModel({})
        row = column_means(df, cols, self.scale, self.zero_fill).first()
        return MeanImputerModel({c: row[c] for c in cols})
