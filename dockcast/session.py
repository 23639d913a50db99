"""Session helpers: building a session for tests/bench and finding the shared scratch folder.

On a cluster the session is created by the platform; library code only reads its settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "dockcast", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. UI off, UTC, AQE on."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # Python call-site capture for error messages: a debugging aid that doubles the cost of
         # building a DataFrame from many column expressions
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, models and written tables.

    Uses the checkpoint directory the cluster names (``spark.checkpoint.dir`` or one already set on
    the context). Only in local mode, when none is set (tests), a fresh folder under /tmp is
    created; on a cluster a missing setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no context handle: use the setting as given
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return d.rstrip("/")
    d = sc.getCheckpointDir()
    if d:
        # the context appends a random sub-folder; keep our tables beside it
        return d.rstrip("/")
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # a machine-local folder would not survive executor loss: the cluster must name one
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store)")
        d = tempfile.mkdtemp(prefix="run-dockcast-", dir="/tmp")   # local mode (tests) only
    sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new, unique path under the shared scratch folder (never reused, never cleared)."""
    return f"{scratch_root(spark)}/{kind}/{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (local, HDFS, object stores alike)."""
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder (of partition folders: one for each day), sorted."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def input_mark(spark: SparkSession, *paths: str) -> tuple:
    """What a table's files look like now: (path, bytes, files, last change) of each path. A stored
    table derived from them is good as long as the mark is the same; its size doesn't grow."""
    marks = []
    for path in paths:
        fs, p = _file_system(spark, path)
        total = fs.getContentSummary(p)
        marks.append((path, total.getLength(), total.getFileCount(), fs.getFileStatus(p).getModificationTime()))
    return tuple(marks)


def write_table(df: DataFrame, spark: SparkSession, kind: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut lineage by writing a parquet table to the shared folder and reading it back.

    Unlike ``localCheckpoint`` this survives executor loss: the files live on shared storage.
    """
    path = scratch_path(spark, kind)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
