"""Writes of scratch tables hold on to little."""

import pyarrow as pa

from sheaf.llm.common import _BATCH_BYTES, Scratch, written


def test_writes_send_python_small_batches_and_leave_the_settings(spark):
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch",
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled"]

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])
    before = [spark.conf.get(n) for n in names]
    rows = spark.range(0, 4000, 1, 1).selectExpr("repeat('long text ', 3000) AS text").mapInArrow(sizes, "n long, size long")
    with Scratch(spark) as tmp:
        for out in (written(rows, "sizes").collect(), tmp.write(rows, "sizes").collect()):
            assert sum(r["n"] for r in out) == 4000
            assert max(r["n"] for r in out) <= 1000 and max(r["size"] for r in out) <= 2 * _BATCH_BYTES
    assert [spark.conf.get(n) for n in names] == before
