"""Check-in and tip rollups as Structured Streaming jobs.

The same operators as the batch rollups (``checkin_rollup``, ``tip_rollup``) run on a streaming
DataFrame read from a folder of JSON-lines files with a declared schema. State (one row per key)
lives in the state store, partitioned by key; progress and state are kept under a checkpoint location
in the shared checkpoint folder, so a restarted job or a lost executor resumes where it stopped.

Output is a changelog: in ``update`` mode each micro-batch appends only the keys whose rollup changed,
tagged with the batch id. A retried batch writes the same rows under the same id, so reading the
latest row per key (``latest_rollup``) is idempotent. Nothing passes through the driver, and a
trigger costs in proportion to the keys it touched, not to all keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sheaf.operators.rollups import KEY, checkin_rollup, tip_rollup
from sheaf.session import scratch_path
from sheaf.sources.schemas import SCHEMAS

ROLLUPS = {"checkin": checkin_rollup, "tip": tip_rollup}
BATCH = "_batch"


def _append_changes(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path)
    return write


def start_rollup_stream(spark: SparkSession, table: str, source: str, out: str, as_of,
                        checkpoint: str | None = None, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the rollup of ``table`` ("checkin" or "tip") over the files under ``source``.

    With ``available_now`` the query processes every file present at start (in as many micro-batches
    as ``max_files_per_trigger`` asks for) and stops; otherwise it keeps polling for new files.
    """
    reader = spark.readStream.schema(SCHEMAS[table])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    agg = ROLLUPS[table](reader.json(source), as_of)
    w = (agg.writeStream.outputMode("update").foreachBatch(_append_changes(out))
         .option("checkpointLocation", checkpoint or scratch_path(spark, f"stream-{table}")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def latest_rollup(spark: SparkSession, out: str, key: str = KEY) -> DataFrame:
    """The current rollup: for every key, its row from the latest batch that changed it."""
    changes = spark.read.parquet(out)
    cols = [c for c in changes.columns if c not in (key, BATCH)]
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(BATCH)).alias("_row"))
    return latest.select(key, *[F.col(f"_row.{c}").alias(c) for c in cols])


def run_rollup_stream(spark: SparkSession, table: str, source: str, as_of,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the rollup over everything under ``source`` and return the current result."""
    out = scratch_path(spark, f"stream-{table}-out")
    q = start_rollup_stream(spark, table, source, out, as_of,
                            max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return latest_rollup(spark, out)
