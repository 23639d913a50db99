"""Compaction of the stream's table, published by manifest versions.

``ingest_into_table`` leaves a folder for each micro-batch, so a day of 5-minute batches is hundreds of small files. A
compaction takes the batches that no earlier one has covered and writes each day they touch anew: its small files
are packed by bytes into runs of about the target size, one output file for each run. The new folders are named in a
manifest, a small table whose last act is its success marker; a reader takes the newest manifest that has
one, so it sees either the table before a compaction or the table after it, never half of it.

A batch that the stream runs again after a failure overwrites its own folder with the same rows (same files, same
offsets). If a manifest covers the batch already, readers don't look at that folder any more. So a
replay neither adds nor loses rows. A compaction that is lost leaves folders that no manifest names; the next one takes
a new number. One compaction runs at a time; the stream may go on meanwhile: its later batches are read beside the manifest.

Folders that no manifest needs any more are left for the table's retention job; readers of an older manifest may still
use them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.session import child_names, path_exists

TARGET_BYTES = 128 << 20
MANIFEST = "version INT, covered BIGINT, day STRING, folder STRING, bytes BIGINT"
MANIFESTS = "_manifests"       # file scans pass over names with a leading underscore


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the sub-folders ``<prefix><n>`` whose write has ended."""
    names = child_names(spark, folder) if path_exists(spark, folder) else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix) and path_exists(spark, f"{folder}/{n}/_SUCCESS"))


def newest_manifest(spark: SparkSession, sink: str) -> tuple[int, int, dict[str, tuple[str, int]]]:
    """(version, last batch it covers, day folder -> (generation folder, bytes that were packed into it)); (0, -1, {}) before
    the first compaction. A row for each calendar day reaches the driver."""
    versions = _numbers(spark, f"{sink}/{MANIFESTS}", "v=")
    if not versions:
        return 0, -1, {}
    rows = spark.read.schema(MANIFEST).parquet(f"{sink}/{MANIFESTS}/v={versions[-1]}").collect()
    return versions[-1], max(r.covered for r in rows), {r.day: (r.folder, r.bytes) for r in rows if r.day is not None}


def live_folders(spark: SparkSession, sink: str) -> list[str]:
    """The day folders of the newest manifest and the folders of the batches after it."""
    _, covered, days = newest_manifest(spark, sink)
    later = [n for n in _numbers(spark, sink, "batch=") if n > covered]
    return [f"{sink}/{folder}/{day}" for day, (folder, _) in sorted(days.items())] + [f"{sink}/batch={n}" for n in later]


def read_current(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """The table as of now, with the columns of ``schema`` (the day among them)."""
    folders = live_folders(spark, sink)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", sink).parquet(*folders)


def packed_files(files: DataFrame, target_bytes: int) -> DataFrame:
    """(file_path, length, day) -> with ``bin``: a day's files in runs of about ``target_bytes``; the bins of a day are at most
    its bytes over the target, rounded up. The window runs over the files of one day."""
    before = F.sum("length").over(Window.partitionBy("day").orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / F.lit(target_bytes)))


def data_files(spark: SparkSession, folders: list[str], day_col: str) -> DataFrame:
    """(file_path, length, day) of data files, from a scan of metadata alone: no content is read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folders)
    day = F.regexp_extract("_metadata.file_path", f"({day_col}=[^/]+)/", 1)
    return raw.select("_metadata.file_path", F.col("_metadata.file_size").alias("length"), day.alias("day"))


def compact(spark: SparkSession, sink: str, schema: T.StructType, target_bytes: int = TARGET_BYTES, day_col: str = "obs_day") -> int | None:
    """Cover all batches that have ended: the days they touch are written anew in files of about ``target_bytes``, all
    others stay where the last manifest has them. Returns the new version, None if no batch is new."""
    version, covered, days = newest_manifest(spark, sink)
    batches = [n for n in _numbers(spark, sink, "batch=") if n > covered]
    if not batches:
        return None
    version += 1
    # negative numbers beside the stream's own, since folders of one level must share their partition column
    while path_exists(spark, f"{sink}/batch=-{version}"):           # left by a compaction that was lost
        version += 1
    folder = f"batch=-{version}"
    fresh = [f"{sink}/batch={n}" for n in batches]
    touched = [r.day for r in data_files(spark, fresh, day_col).select("day").distinct().collect()]      # one for each calendar day
    folders = fresh + [f"{sink}/{days[d][0]}/{d}" for d in touched if d in days]
    held = {}
    if touched:
        bins = packed_files(data_files(spark, folders, day_col), target_bytes)
        rows = spark.read.schema(schema).option("basePath", sink).parquet(*folders).withColumn("_file", F.col("_metadata.file_path"))
        dealt = rows.join(bins.select(F.col("file_path").alias("_file"), F.col("day").alias("_day"), F.col("bin").alias("_bin")), "_file")
        # a run meets in one task and is about one target large; two runs of a day in one task make one file
        (dealt.repartition("_day", "_bin").select(*schema.names).write.mode("errorifexists").partitionBy(day_col).parquet(f"{sink}/{folder}"))
        held = {r.day: (folder, r.bytes) for r in bins.groupBy("day").agg(F.sum("length").alias("bytes")).collect()}
    rows = [(version, batches[-1], d, *f) for d, f in sorted((days | held).items())] or [(version, batches[-1], None, None, None)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{sink}/{MANIFESTS}/v={version}")
    return version


def file_report(spark: SparkSession, sink: str, target_bytes: int = TARGET_BYTES, day_col: str = "obs_day") -> DataFrame:
    """(day, n_files, most) of the days in the newest manifest: how many files they have, and how many the bytes that were
    packed allow: those over the target, rounded up."""
    _, _, days = newest_manifest(spark, sink)
    rows = [(d.split("=", 1)[1], math.ceil(size / target_bytes)) for d, (_, size) in sorted(days.items())]
    allowed = spark.createDataFrame(rows, "day STRING, most INT")
    folders = [f"{sink}/{folder}/{d}" for d, (folder, _) in sorted(days.items())]
    if not folders:
        return allowed.withColumn("n_files", F.lit(0).cast("long")).select("day", "n_files", "most")
    files = data_files(spark, folders, day_col)
    n = files.groupBy(F.regexp_extract("day", "=(.*)", 1).alias("day")).agg(F.count(F.lit(1)).alias("n_files"))
    return n.join(allowed, "day").select("day", "n_files", "most")
