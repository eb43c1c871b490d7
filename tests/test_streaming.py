"""The streaming rollups resume from their checkpoint and end equal to the batch rollups."""

import glob
import os
import shutil

from pyspark.sql import functions as F

from sheaf.operators.rollups import checkin_rollup
from sheaf.session import scratch_path
from sheaf.sources import fixtures as fx
from sheaf.sources.json import write_json
from sheaf.streaming import latest_rollup, start_rollup_stream

SF = "/root/testdata/sf0.001"
AS_OF = "2024-03-31"


def test_resume_from_checkpoint_matches_batch(spark):
    src = fx.checkin(spark, SF).withColumn("business_id", F.col("business_id").cast("string"))
    staged = write_json(src.repartition(4), scratch_path(spark, "stage"))
    files = sorted(glob.glob(os.path.join(staged.replace("file:", ""), "part-*.json")))
    assert len(files) == 4
    source = scratch_path(spark, "src").replace("file:", "")
    os.makedirs(source)
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")

    for f in files[:2]:
        shutil.copy(f, source)
    q = start_rollup_stream(spark, "checkin", source, out, AS_OF, checkpoint=ckpt)
    q.awaitTermination()
    first = latest_rollup(spark, out).count()
    changed_first = spark.read.parquet(out).count()

    for f in files[2:]:
        shutil.copy(f, source)
    q = start_rollup_stream(spark, "checkin", source, out, AS_OF, checkpoint=ckpt)
    q.awaitTermination()
    got = sorted(tuple(r) for r in latest_rollup(spark, out).collect())
    # the second run appended only the keys the new files touched
    assert spark.read.parquet(out).count() - changed_first <= len(got)

    want = sorted(tuple(r) for r in checkin_rollup(src, AS_OF).collect())
    assert first <= len(got)
    assert got == want
