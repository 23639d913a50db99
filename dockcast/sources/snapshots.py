"""Snapshot landing folder: scan (S1), rejected files (F5), inventory (S7) and a landing writer.

A snapshot file holds a JSON array with one element per station (the service's format); files
written by Spark hold one element per line. Both read with the same schema, no inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockcast.session import child_names

# Element schema: every leaf is read as text and parsed leniently later (C12, C13). A text leaf takes
# any JSON value, so a field of an unexpected kind costs that field alone, never its neighbours.
FIELDS_TYPE = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("last_update", T.StringType()),
    T.StructField("available_bike_stands", T.StringType()),
    T.StructField("available_bikes", T.StringType()),
    T.StructField("position", T.StringType()),
    T.StructField("status", T.StringType()),
])
ELEMENT_SCHEMA = T.StructType([T.StructField("fields", FIELDS_TYPE)])
CORRUPT = "_corrupt_record"

# a snapshot file name has '.json' after at least one character; landed files start with a
# prefix (a parameter; the poller that lands them chooses it).
SNAPSHOT_GLOB = "?*.json*"
LANDING_PREFIX = "poll"


def document_reader(reader, multi_line: bool = True):
    """Options of a JSON reader (batch or stream) whose files hold one document each. Such a file is read as one record: valid JSON
    has no NUL byte, so a scan by records that end with one takes the file whole and parses it from memory. Spark's ``multiLine``
    parses from the file's stream, and for each text leaf that holds another JSON value (``position``) seeks and reads the file
    again."""
    return reader.option("lineSep", "\0") if multi_line else reader


def scan_snapshots(spark: SparkSession, path: str | list[str], multi_line: bool = True, glob: str = SNAPSHOT_GLOB,
                   base: str | None = None) -> DataFrame:
    """S1 + F5: elements of every snapshot file; a file (or line) that is not valid JSON gives none.

    ``multi_line=True`` reads each file as one document (array root -> one row per element); a document
    is read by one task, so parallelism is per file. ``multi_line=False`` reads line-delimited
    files (one element, or one array, per line) and splits large files. ``base`` is the landing folder
    that several poll folders stand in.
    """
    reader = spark.read if base is None else spark.read.option("basePath", base)
    return (document_reader(reader, multi_line).schema(ELEMENT_SCHEMA)
            .option("mode", "PERMISSIVE")
            .option("pathGlobFilter", glob)
            .json(path).where(F.col("fields").isNotNull()))


def scan_json_inferred(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """JSON scan with an inferred schema (the service's unused ``createTrain(file)``). Inference
    reads the input once more; ``sampling_ratio`` < 1 bounds that on large inputs."""
    return spark.read.option("samplingRatio", sampling_ratio).json(path)


def rejected_files(spark: SparkSession, path: str, multi_line: bool = True, glob: str = SNAPSHOT_GLOB) -> DataFrame:
    """F5 accounting: (file_path, file_name, bad_records) of the files with records that do not parse
    (in a multi-line scan a file is one record, so a bad file counts 1)."""
    schema = T.StructType(ELEMENT_SCHEMA.fields + [T.StructField(CORRUPT, T.StringType())])
    raw = (document_reader(spark.read, multi_line).schema(schema).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", glob).json(path)
           .select("_metadata.file_path", "_metadata.file_name", CORRUPT, "fields"))
    # Spark refuses a query that reads only the corrupt-record column: let the count touch a data column
    touched = F.coalesce(F.length("fields.number"), F.lit(0))
    return (raw.groupBy("file_path", "file_name")
            .agg(F.count(F.when(F.col(CORRUPT).isNotNull(), touched)).alias("bad_records")).where("bad_records > 0"))


def landed_files(spark: SparkSession, path: str, prefix: str = LANDING_PREFIX) -> DataFrame:
    """(file_path, file_name, length) of landed snapshot files, from the metadata of a binary scan:
    the listing stays with the tasks and no content is read. A file of no bytes holds no snapshot and
    is not listed (file scans pass over it)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*").option("recursiveFileLookup", True).load(path)
            .select(F.col("path").alias("file_path"), F.element_at(F.split("path", "/"), -1).alias("file_name"), "length"))


def write_landing(elements: DataFrame, path: str, poll_col: str | None = None) -> str:
    """Write elements as line-delimited snapshot files (Spark's JSON writer), optionally one folder
    per poll. Files are named ``part-*.json``, which the snapshot glob accepts."""
    w = elements.write.mode("errorifexists").option("compression", "none")
    if poll_col:
        w = w.partitionBy(poll_col)
    w.json(path)
    return path


def write_poll_files(files: DataFrame, path: str, by: list[str], mode: str = "errorifexists") -> str:
    """Write whole snapshot files (column ``value``), one for each row: each has a folder of its own,
    ``by`` its columns. Files are text, so scans need the glob ``TEXT_GLOB``."""
    files.repartition(*by).write.mode(mode).partitionBy(*by).text(path)
    return path


TEXT_GLOB = "*.txt"


def newest_poll(spark: SparkSession, path: str, column: str = "poll") -> str | None:
    """The greatest poll among a landing folder's partition folders: a listing, no file is opened."""
    polls = [n.split("=", 1)[1] for n in child_names(spark, path) if n.startswith(f"{column}=")]
    return max(polls, default=None)
