"""Sinks: ordered CSV export (K1, K2, K3), stored readings table, cache policy (K6).

The source built one CSV string on the driver (Q19). Here the export is a distributed write: a
range-partitioned sort, each task writing its own ordered part file (part files are in order).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EXPORT_ORDER = ["name", "x"]   # K1 sort keys (fixed)
CSV_SEP = ";"


def csv_ready(df: DataFrame) -> DataFrame:
    """Vector columns become ``a,b,c`` text (CSV cannot hold vectors)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, VectorUDT):
            out.append(F.array_join(vector_to_array(F.col(f.name)).cast("array<string>"), ",").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def export_ordered(df: DataFrame, path: str, order: list[str] | None = None, sep: str = CSV_SEP) -> str:
    """K1: header + rows sorted by name, x (then the remaining columns, for a total order)."""
    keys = list(order or EXPORT_ORDER)
    keys += [c for c in df.columns if c not in keys]
    (csv_ready(df).orderBy(*keys).write.mode("errorifexists")
     .option("sep", sep).option("header", True).csv(path))
    return path


def read_export(spark: SparkSession, path: str, schema: StructType, sep: str = CSV_SEP) -> DataFrame:
    """Read a K1 export back with a declared schema (no inference)."""
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def rebalance_by_day(df: DataFrame, day_col: str = "obs_day") -> DataFrame:
    """Lay rows out for a day-partitioned write with the REBALANCE hint: rows of a day meet in few
    tasks, AQE splits a day larger than the advisory partition size and merges small ones, so the
    table gets about one file per advisory size per day, not one per task and day."""
    return df.hint("rebalance", day_col)


def store_readings(readings: DataFrame, path: str, day_col: str = "obs_day", mode: str = "append") -> str:
    """Readings table on shared storage, partitioned by day: a day's load or the weather join
    then reads only the matching folders (partition pruning)."""
    rebalance_by_day(readings, day_col).write.mode(mode).partitionBy(day_col).parquet(path)
    return path


def persist_training(df: DataFrame) -> DataFrame:
    """K6: cache a training set once, in memory with spill to disk (never MEMORY_ONLY)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
