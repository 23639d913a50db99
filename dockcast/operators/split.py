"""Repeatable splits (R1-R3) from a hash of the reading key.

A hash split is a narrow filter: no sort, no shuffle, and the same rows land in the same part
whatever the partitioning or the number of executors (``randomSplit`` sorts every partition to
get that, and changes with partitioning). The same bucket gives the cross-validation fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_BUCKETS = 100
TRAIN_SHARE = 0.6   # the source's 60/40 split


def key_bucket(*cols: str) -> Column:
    """0..99 from md5 of ``id:dtUpdate`` (the first 8 hex digits as a number)."""
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % N_BUCKETS).cast("int")


def with_bucket(df: DataFrame, cols=("id", "dtUpdate")) -> DataFrame:
    return df.withColumn("bucket", key_bucket(*cols))


def split_parts(df: DataFrame, train_share: float = TRAIN_SHARE, cols=("id", "dtUpdate")) -> tuple[DataFrame, DataFrame]:
    """(train, test). Weights are normalised as randomSplit does (0.3/0.6 -> 1/3, 2/3)."""
    cut = int(round(train_share * N_BUCKETS))
    b = key_bucket(*cols)
    return df.where(b < cut), df.where(b >= cut)


def label_parts(df: DataFrame, train_share: float = TRAIN_SHARE, cols=("id", "dtUpdate")) -> DataFrame:
    """R1 as a column: ``part`` = 'train' / 'test'."""
    cut = int(round(train_share * N_BUCKETS))
    b = key_bucket(*cols)
    return df.withColumn("bucket", b).withColumn(
        "part", F.when(F.col("bucket") < cut, F.lit("train")).otherwise(F.lit("test")))


def fold_column(df: DataFrame, folds: int = 3, cols=("id", "dtUpdate"), name: str = "fold") -> DataFrame:
    """Fold number for CrossValidator(foldCol=...), from the same hash."""
    return df.withColumn(name, (key_bucket(*cols) % folds).cast("int"))
