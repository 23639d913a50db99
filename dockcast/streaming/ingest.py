"""Structured Streaming: incremental ingest (T1), exactly-once readings (T2), scoring a stream (T4).

The service's timer saved a snapshot file every 5 minutes and a route loaded it. Here the landing
folder is a file stream: each trigger picks up new files only (the checkpoint remembers the rest),
the readings are curated with the same column functions as the batch path, the per-day weather is a
static side joined by broadcast after a size check, and the sink is a parquet table partitioned by
day. ``trigger(availableNow=True)`` processes what is there and stops, so a scheduler (or a test)
runs it like a batch job and a rerun adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from dockcast.operators import curate as cur
from dockcast.operators.model import StationModel
from dockcast.session import path_exists, write_table
from dockcast.sources.snapshots import CORRUPT, ELEMENT_SCHEMA, SNAPSHOT_GLOB, document_reader

DEFAULT_DELAY = "2 days"   # late-data bound for the dedup state; long on purpose (SURVEY 2.12)
DEDUP_KEY = ["id", "dtUpdate"]


def stream_elements(spark: SparkSession, landing: str, multi_line: bool = False,
                    max_files: int | None = None) -> DataFrame:
    """Snapshot files as a stream, declared schema, unparsable files or lines give no element.
    ``max_files`` bounds a micro-batch: a backlog is worked off in several."""
    r = (document_reader(spark.readStream, multi_line).schema(ELEMENT_SCHEMA)
         .option("mode", "PERMISSIVE").option("pathGlobFilter", SNAPSHOT_GLOB))
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.json(landing).where(F.col("fields").isNotNull())


def stream_readings(elements: DataFrame, weather_daily: DataFrame | None,
                    name_filter: str | None = None, weather_rows: int | None = None) -> DataFrame:
    """Curated readings of a stream (no distinct: that is T2's job), with the day column and an
    event time (an instant, needed by watermarks)."""
    r = cur.readings_from_elements(elements, weather_daily, name_filter, weather_rows)
    return r.select(*cur.READING_COLUMNS, "obs_day",
                    F.timestamp_millis("dtUpdate").alias("event_time"))


def ingest_into_table(readings: DataFrame, sink: str, checkpoint: str, day_col: str = "obs_day") -> StreamingQuery:
    """T1 with sized files: each micro-batch is rebalanced on the day (AQE splits a large day and
    merges small ones, so a batch writes a few files per day instead of one per input file) and
    written into its own ``batch=<id>`` folder with overwrite. A batch that is run again after a
    failure replaces its own folder, so every row lands exactly once. Readers see the columns
    ``batch`` and the day; the day still prunes folders."""
    cols = [c for c in readings.columns if c != "event_time"]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select(*cols).hint("rebalance", day_col).write.mode("overwrite")
         .partitionBy(day_col).parquet(f"{sink.rstrip('/')}/batch={batch_id}"))

    q = (readings.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def dedup_stream(readings: DataFrame, delay: str = DEFAULT_DELAY, key: list[str] | None = None) -> DataFrame:
    """One row per (id, dtUpdate) across overlapping snapshots. State is kept for ``delay`` of
    event time; a copy arriving later than that is not recognised (a short delay loses nothing but
    lets copies through, see tests)."""
    return readings.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(key or DEDUP_KEY)


def dedup_into_table(readings: DataFrame, sink: str, checkpoint: str, key: list[str] | None = None,
                     day_col: str = "obs_day") -> StreamingQuery:
    """T2, table-backed: each micro-batch is reduced to one row per key, then rows whose key is
    already in the sink table are dropped, and the rest are appended (partitioned by day).

    * Copies are combined map-side: the per-batch reduction is a ``max(struct)`` aggregate, so a
      group of copies holding a third of a batch never reaches one task whole (the watermark form
      shuffles every copy to the key's task).
    * The sink is the dedup state: no state store, no watermark, late copies are still caught.
      The anti-join reads only the batch's days: the batch's distinct days (a handful: one row per
      calendar day) become a partition filter on the sink (dynamic partition pruning does not
      apply to anti-joins).
    * A batch that is run again after a failure adds nothing, since its keys are then in the sink.
    * Survivor within a batch: the greatest row (deterministic); across batches the first batch wins.
    """
    key = key or DEDUP_KEY
    cols = [c for c in readings.columns if c != "event_time"]
    rest = [c for c in cols if c not in key and c != day_col]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        best = (batch.groupBy(*key, day_col).agg(F.max(F.struct(*rest)).alias("r"))
                .select(*key, day_col, *[F.col(f"r.{c}").alias(c) for c in rest]))
        # the reduced batch is stored: its days and its rows are read from there, the input once
        best = write_table(best.select(*cols), spark, "tables/dedup_batch")
        if path_exists(spark, sink):
            days = [r[0] for r in best.select(day_col).distinct().collect()]    # one for each calendar day
            existing = spark.read.schema(best.schema).parquet(sink).where(F.col(day_col).isin(days)).select(*key, day_col)
            best = best.join(existing, [*key, day_col], "left_anti")
        best.hint("rebalance", day_col).write.mode("append").partitionBy(day_col).parquet(sink)

    q = (readings.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _written(rows: DataFrame, path: str, day_col: str) -> None:
    rows.hint("rebalance", day_col).write.mode("overwrite").partitionBy(day_col).parquet(path)


def split_late(readings: DataFrame, on_time: str, late: str, marks: str, checkpoint: str, delay: str = DEFAULT_DELAY,
               key: list[str] | None = None, day_col: str = "obs_day") -> StreamingQuery:
    """T2, first step of the state-store form: rows older than the watermark go to the side table ``late``, the others, one for
    each key of the batch (the greatest, combined map-side), to ``on_time``.

    The watermark of a batch is the newest event of all batches before it less ``delay``, from the table ``marks``, which
    holds a row for each batch and is written last. A batch that is run again sees the same marks, overwrites
    its own folders, and so routes every row as before. No row is lost: each is in one of the two tables."""
    key = key or DEDUP_KEY
    cols = readings.columns
    rest = [c for c in cols if c not in [*key, day_col]]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = write_table(batch, spark, "tables/split_batch")                 # the input is read once
        is_late = F.lit(False)
        if path_exists(spark, marks):
            before = spark.read.schema("newest TIMESTAMP, batch BIGINT").parquet(marks).where(F.col("batch") < batch_id)
            # one number, in microseconds, so that no session zone has a say
            watermark = before.agg(F.unix_micros(F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("w")).first().w
            if watermark is not None:
                is_late = F.coalesce(F.unix_micros("event_time") < F.lit(watermark), F.lit(False))
        best = (stored.where(~is_late).groupBy(*key, day_col).agg(F.max(F.struct(*rest)).alias("r"))
                .select(*key, day_col, *[F.col(f"r.{c}").alias(c) for c in rest]))
        _written(best.select(*cols), f"{on_time}/batch={batch_id}", day_col)
        _written(stored.where(is_late).select(*cols), f"{late}/batch={batch_id}", day_col)
        stored.agg(F.max("event_time").alias("newest")).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")

    q = (readings.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def dedup_with_state(spark: SparkSession, on_time: str, schema: T.StructType, sink: str, checkpoint: str,
                     delay: str = DEFAULT_DELAY, key: list[str] | None = None) -> StreamingQuery:
    """T2, second step: one row for each key over all batches of ``on_time``, with the keys of the last ``delay`` of event
    time in a RocksDB state store (on the executors' disks, so the state may outgrow their memory; its snapshots
    are in the checkpoint). A copy of a key that has left the state is older than the watermark, so the first
    step has sent it aside: the two steps together are exact. Run it after the first step, over whole
    batches; the first batch that holds a key wins."""
    was = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)         # a query takes the provider when it starts and keeps it in its checkpoint
    try:
        rows = spark.readStream.schema(schema).option("basePath", on_time).parquet(f"{on_time}/batch=*")
        return ingest_into_table(dedup_stream(rows, delay, key).select(*schema.names), sink, checkpoint)
    finally:
        if was is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, was)


def stream_files(spark: SparkSession, landing: str, glob: str = SNAPSHOT_GLOB, max_files: int | None = None) -> DataFrame:
    """S4 in the service's own form (a JSON array in each file), with what quarantine needs: (fields, corrupt, file_path, length)."""
    schema = T.StructType([*ELEMENT_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    r = (document_reader(spark.readStream).schema(schema).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", glob))
    if max_files:
        r = r.option("maxFilesPerTrigger", int(max_files))
    return r.json(landing).select("fields", F.col(CORRUPT).isNotNull().alias("corrupt"), "_metadata.file_path",
                                  F.col("_metadata.file_size").alias("length"))


UNREADABLE, NO_ELEMENTS = "not JSON", "no elements"


def dead_letters(files: DataFrame) -> DataFrame:
    """(file_path, length, reason) of files that give no element: those that do not parse (a truncated file among them), and
    those that parse and hold no element. A file of no bytes gives no row at all, so a scan cannot name it."""
    each = files.groupBy("file_path", "length").agg(F.max("corrupt").alias("corrupt"), F.count("fields").alias("n"))
    reason = F.when(F.col("corrupt"), UNREADABLE).otherwise(NO_ELEMENTS)
    return each.where(F.col("corrupt") | (F.col("n") == 0)).select("file_path", "length", reason.alias("reason"))


def quarantine_into_tables(files: DataFrame, curate: Callable[[DataFrame], DataFrame], sink: str, dead: str, checkpoint: str,
                           day_col: str = "obs_day") -> StreamingQuery:
    """F5 in the stream: each micro-batch of array files is read once and feeds two tables: the curated readings (``curate`` of its
    elements, with the day) and the dead letters. Each batch writes folders of its own with overwrite, so a batch that is
    run again replaces both and a bad file is named once."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stored = write_table(batch, batch.sparkSession, "tables/quarantine_batch")
        _written(curate(stored.where(F.col("fields").isNotNull()).select("fields")), f"{sink}/batch={batch_id}", day_col)
        dead_letters(stored).write.mode("overwrite").parquet(f"{dead}/batch={batch_id}")

    q = (files.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def score_stream(readings: DataFrame, model: StationModel) -> DataFrame:
    """T4: the fitted model applies to a streaming DataFrame as to a batch one (its index is the
    static side of a stream-static join; rows without weather are left out)."""
    return model.transform(readings.where(F.col("soleil").isNotNull())) \
        .drop("id_index", "tempFeatures", "features", "rawPrediction", "probability")


def run_available_now(df: DataFrame, sink: str, checkpoint: str, partition_by: list[str] | None = None,
                      fmt: str = "parquet") -> StreamingQuery:
    """Process everything available, then stop. The file sink plus checkpoint make it exactly-once."""
    w = (df.writeStream.format(fmt).outputMode("append").option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q
