"""Loads that append (S5, S6): a ledger of loaded files, and replacement of the days that a load touches.

A table has a folder each for its readings (partitioned by day), for the ledger (a partition for each load: the files
it took, with their lengths) and for loads in progress. A load takes the landed files that no earlier load has
taken (an anti-join on file and length), curates them, merges them with the stored rows of their days alone,
and writes those days anew (dynamic partition overwrite); all other days stay as they are, unread.

A load can be lost at any point. It first stores the merged days, then its files: from then on it counts as ready. Days
are replaced from the stored merge, and the ledger entry comes last, so a load that was ready but isn't in the ledger is
finished by the next one, which replaces the same days with the same rows. One that wasn't ready left nothing
behind in the table, and its files are still new. One loader runs at a time.

At scale: the inventory is a metadata scan, the anti-join shuffles file names, the merge reads the touched days, and
only names of polls and distinct days (one for each calendar day) reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.operators.curate import append_readings, backfill_weather
from dockcast.operators.sinks import rebalance_by_day
from dockcast.session import child_names, path_exists
from dockcast.sources.snapshots import newest_poll

FILES_SCHEMA = "file_path STRING, length BIGINT"
DAY = "obs_day"


@dataclass(frozen=True)
class LoadTable:
    """Where a table lives, and the schema of its rows (with the day column)."""

    root: str
    schema: T.StructType

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def ledger(self, load: int) -> str:
        return f"{self.root}/ledger/load={load:010d}"

    def staged(self, load: int) -> str:
        return f"{self.root}/staged/load={load:010d}"


@dataclass(frozen=True)
class Loaded:
    """What a load did: its number (None if there was nothing new) and how many files and days it took."""

    load: int | None
    files: int
    days: int


def table_readings(spark: SparkSession, table: LoadTable) -> DataFrame:
    """The table's rows; none before the first load."""
    if not path_exists(spark, table.data):
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(table.data)


def loaded_files(spark: SparkSession, table: LoadTable) -> DataFrame:
    """The ledger: (file_path, length, load) of every file that a finished load has taken."""
    if not path_exists(spark, f"{table.root}/ledger"):
        return spark.createDataFrame([], FILES_SCHEMA + ", load INT")
    return spark.read.schema(FILES_SCHEMA + ", load INT").parquet(f"{table.root}/ledger")


def _loads(spark: SparkSession, folder: str, done: str) -> list[int]:
    """Numbers of the loads under a folder whose ``done`` file exists."""
    names = child_names(spark, folder) if path_exists(spark, folder) else []
    return [int(n.split("=")[1]) for n in names if n.startswith("load=") and path_exists(spark, f"{folder}/{n}/{done}")]


def unfinished_loads(spark: SparkSession, table: LoadTable) -> list[int]:
    """Loads that were ready and are not in the ledger."""
    finished = set(_loads(spark, f"{table.root}/ledger", "_SUCCESS"))
    return sorted(k for k in _loads(spark, f"{table.root}/staged", "files/_SUCCESS") if k not in finished)


def stage(spark: SparkSession, table: LoadTable, load: int, merged: DataFrame, files: DataFrame) -> None:
    """Store the touched days as they shall be, then the load's files, which makes the load ready. What an unready load of
    this number left is overwritten."""
    rebalance_by_day(merged, DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{table.staged(load)}/data")
    files.select("file_path", "length").write.mode("overwrite").parquet(f"{table.staged(load)}/files")


def publish(spark: SparkSession, table: LoadTable, load: int) -> None:
    """Replace the touched days by the staged ones, then enter the load in the ledger. Running it again changes nothing."""
    staged = spark.read.schema(table.schema).parquet(f"{table.staged(load)}/data")
    (rebalance_by_day(staged, DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(table.data))
    spark.read.schema(FILES_SCHEMA).parquet(f"{table.staged(load)}/files").write.mode("overwrite").parquet(table.ledger(load))


def finish_loads(spark: SparkSession, table: LoadTable) -> list[int]:
    """Finish what a lost load left ready, in order."""
    loads = unfinished_loads(spark, table)
    for load in loads:
        publish(spark, table, load)
    return loads


def next_load(spark: SparkSession, table: LoadTable) -> int:
    return max(_loads(spark, f"{table.root}/ledger", "_SUCCESS"), default=0) + 1


def new_files(spark: SparkSession, table: LoadTable, landing: str, prefix: str) -> DataFrame:
    """(file_path, length) of landed files that no load has taken, from a scan of metadata alone; a file that grew or was
    landed anew under its old name with another length is new. An empty file holds no snapshot."""
    landed = (spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").option("recursiveFileLookup", True).load(landing)
              .select("_metadata.file_path", F.col("_metadata.file_size").alias("length")).where("length > 0"))
    return landed.join(loaded_files(spark, table), ["file_path", "length"], "left_anti")


def touched_days(rows: DataFrame) -> list:
    """The distinct days of a load's rows: one value for each calendar day."""
    return [r[0] for r in rows.select(DAY).where(F.col(DAY).isNotNull()).distinct().collect()]


def load_landed(spark: SparkSession, table: LoadTable, landing: str, read: Callable[[list[str]], DataFrame],
                curate: Callable[[DataFrame], DataFrame], prefix: str = "part-", poll_column: str = "poll",
                polls: list[str] | None = None) -> Loaded:
    """Append what is new in a landing folder (of the given polls, or of all). ``read`` gives the elements of poll folders
    with their ``file_path``, ``curate`` the readings of elements, with the day. Only folders that hold a new file are read,
    and of them only the new files' elements are kept. Loading again, or loading polls that overlap, adds no row twice."""
    finish_loads(spark, table)
    load = next_load(spark, table)
    poll = F.regexp_extract("file_path", f"{poll_column}=([^/]+)", 1)
    files = new_files(spark, table, landing, prefix).withColumn("_poll", poll)
    if polls is not None:
        files = files.where(F.col("_poll").isin(polls))
    # stored, so that the load enters in the ledger the very files that it reads
    path = f"{table.staged(load)}/inventory"
    files.write.mode("overwrite").parquet(path)
    files = spark.read.schema(files.schema).parquet(path)
    folders = sorted(r[0] for r in files.select("_poll").distinct().collect())      # one for each poll
    if not folders:
        return Loaded(None, 0, 0)
    elements = read([f"{landing}/{poll_column}={p}" for p in folders]).join(files.select("file_path"), "file_path", "left_semi")
    fresh_path = f"{table.staged(load)}/fresh"
    curate(elements.drop("file_path")).select(*table.schema.names).write.mode("overwrite").parquet(fresh_path)
    fresh = spark.read.schema(table.schema).parquet(fresh_path)
    days = touched_days(fresh)
    old = table_readings(spark, table).where(F.col(DAY).isin(days))                  # reads the touched days alone
    stage(spark, table, load, append_readings(old, fresh), files)
    publish(spark, table, load)
    return Loaded(load, files.count(), len(days))


def load_newest(spark: SparkSession, table: LoadTable, landing: str, read: Callable[[list[str]], DataFrame],
                curate: Callable[[DataFrame], DataFrame], **kw) -> Loaded:
    """Append the newest poll, found in the folder listing."""
    newest = newest_poll(spark, landing, kw.get("poll_column", "poll"))
    return Loaded(None, 0, 0) if newest is None else load_landed(spark, table, landing, read, curate, polls=[newest], **kw)


def backfill_days(spark: SparkSession, table: LoadTable, weather_daily: DataFrame, weather_rows: int | None = None) -> Loaded:
    """J1 late: the days whose weather landed after their readings get it and are written anew, by the same steps as a load.
    Only days that lack weather and now have some are read and replaced."""
    finish_loads(spark, table)
    load = next_load(spark, table)
    lacking = table_readings(spark, table).where(F.col("soleil").isNull()).select(DAY).distinct()
    days = touched_days(lacking.join(weather_daily.where(F.col("soleil").isNotNull()).select(DAY), DAY, "left_semi"))
    if not days:
        return Loaded(None, 0, 0)
    rows = table_readings(spark, table).where(F.col(DAY).isin(days))
    stage(spark, table, load, backfill_weather(rows, weather_daily, weather_rows), spark.createDataFrame([], FILES_SCHEMA))
    publish(spark, table, load)
    return Loaded(load, 0, len(days))
