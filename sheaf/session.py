"""Session and scratch-space helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SCRATCH: list[tuple[str, str]] = []  # (application, path) of the tables written so far


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "sheaf",
                  driver_memory: str = "8g", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", driver_memory))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must exist (a machine-local folder would not survive the loss of the
    machine); only a local-mode session without it gets a fresh folder under the temp dir.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        d = tempfile.mkdtemp(prefix="sheaf-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for tables this library writes."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/sheaf-{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark.sparkContext.applicationId, path))
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables of this application; returns how many paths were there.

    Call it when no DataFrame that came out of the library is used any more: results may read such
    tables.
    """
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own = [x for x in _SCRATCH if x[0] == spark.sparkContext.applicationId]
    n = 0
    for x in own:
        at = jvm.org.apache.hadoop.fs.Path(x[1])
        n += bool(at.getFileSystem(conf).delete(at, True))
        _SCRATCH.remove(x)
    return n


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but later passes read a columnar table: only the
    columns they use, with filters pushed down, instead of deserializing whole rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
