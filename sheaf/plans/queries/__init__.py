"""Registered queries: one per operator of the workload, each over the driver's tables.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLE[name]`` is the DuckDB SQL for the same result
(absent for model queries, whose results depend on iterative fitting). Importing this package
registers every query; the modules group them by area.
"""

from sheaf.plans.queries import (aggregates, checked, columns, encoding, filters, models,  # noqa: F401
                                 profiles, streaming, text, variants)
from sheaf.plans.queries.common import FIX, ORACLE, QUERIES, biz, feat, tables

__all__ = ["FIX", "ORACLE", "QUERIES", "biz", "feat", "tables"]
