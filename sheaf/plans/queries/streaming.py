"""The activity rollups as streaming jobs."""

from __future__ import annotations


from pyspark.sql import functions as F

from sheaf.plans import oracle as O
from sheaf.plans.features import KEY
from sheaf.session import scratch_path
from sheaf.sources import fixtures as fx
from sheaf.sources.json import write_json
from sheaf.plans.queries.common import FIX, register


# --------------------------------------------------------------------------------- streaming

def _stream_source(spark, sf, table: str) -> str:
    """The fixture table as JSON-lines files (business_id as text, like the source files)."""
    df = fx.role(spark, sf, table)
    df = df.withColumn(KEY, F.col(KEY).cast("string"))
    return write_json(df, scratch_path(spark, f"json-{table}"))


@register("checkin_rollup_stream", O.sql(
    "SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM chk", "chk"))
def q_checkin_rollup_stream(spark, sf):
    from sheaf.streaming import run_rollup_stream
    return run_rollup_stream(spark, "checkin", _stream_source(spark, sf, "checkin"),
                             FIX.activity_as_of, max_files_per_trigger=1)


@register("tip_rollup_stream", O.sql(
    "SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM tipr",
    "tipr"))
def q_tip_rollup_stream(spark, sf):
    from sheaf.streaming import run_rollup_stream
    return run_rollup_stream(spark, "tip", _stream_source(spark, sf, "tip"), FIX.activity_as_of,
                             max_files_per_trigger=1)
