"""Reading the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it. Split sizes follow
    ``spark.sql.files.maxPartitionBytes`` at every scale; nothing is kept between calls, so a table
    that has changed is read as it is now."""
    return spark.read.parquet(table_path(sf_dir, name))
