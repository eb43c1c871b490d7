"""The query registry (see ``sheaf.plans.queries``)."""

from sheaf.plans.queries import FIX, ORACLE, QUERIES, biz, feat, tables

__all__ = ["FIX", "ORACLE", "QUERIES", "biz", "feat", "tables"]
