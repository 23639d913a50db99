"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.session import scratch_path

# Rows, and bytes of those of unequal size, under which a side derived from a bounded input (benchmark, sources) is shipped to every task.
SMALL_ROWS = 500_000
SMALL_BYTES = 64 << 20


def cut(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends there, and a lost
    executor costs a re-read. The schema is handed to the reader, so empty tables work."""
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(stored: DataFrame, max_rows: int = SMALL_ROWS, size: Column | None = None) -> DataFrame:
    """Broadcast hint for a stored table of at most ``max_rows`` rows (a parquet-metadata count), and of
    at most ``SMALL_BYTES`` by the sum of ``size`` where its rows hold texts or arrays; beyond that the
    planner shuffles both sides and AQE splits skewed keys."""
    if stored.count() > max_rows or size is not None and (stored.agg(F.sum(size)).first()[0] or 0) > SMALL_BYTES:
        return stored
    return F.broadcast(stored)


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``df`` as one struct, so that no name of theirs can clash with ours."""
    return F.struct(*[col(c).alias(c) for c in df.columns if c not in without])


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once for each application), as ``--py-files`` would: their
    Python workers import the functions that run there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="run-ship-"), "dockcast_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
