"""Operator 1: contiguous, byte-balanced shards from global prefix sums.

Rows are range-partitioned on the order columns (a row id breaks ties, so even a third of all rows
under one key is spread), each range's byte total and row count are summed, a running sum over the
few range totals gives every range its global offset, and a window inside each range gives every
row the bytes and rows before it. The row goes to the shard in which the middle of its byte
interval falls when the total is cut at ``n_shards`` equal targets.

Defined results: nulls sort first; repeated rows are kept, each with its own slot; an empty table
gives no rows; an input column named like an output column is replaced by the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, packed, small_side

OUTPUT = ("size", "shard", "slot")


def document_bytes(text: Column, overhead: int = 8) -> Column:
    """UTF-8 bytes of the text (null: none) plus a fixed overhead for each record."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("long")


def assign_shards(docs: DataFrame, n_shards: int, size: Column, order_by: list[str]) -> DataFrame:
    """``docs`` plus ``size`` (long), ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0 in
    each shard, in the order of ``order_by``). Shards are contiguous in that order and each holds
    its equal share of all bytes to within one row's size."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key = [f"key{i}" for i in range(len(order_by))]
    rows = docs.select(packed(docs, OUTPUT).alias("row"), *[col(c).alias(k) for c, k in zip(order_by, key)],
                       size.cast("long").alias("size"), F.monotonically_increasing_id().alias("tie"))
    # the ranges are stored: range bounds come from a sample, and both passes must see the same ones
    dealt = cut(rows.repartitionByRange(*key, "tie").withColumn("part", F.spark_partition_id()), "shards")

    totals = dealt.groupBy("part").agg(F.sum("size").alias("part_size"), F.count(F.lit(1)).alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row for each range
    offsets = cut(totals.select(
        "part",
        F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_size").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("total")), "shard-offsets")

    inside = Window.partitionBy("part").orderBy(*key, "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (dealt.withColumn("size_upto", F.sum("size").over(inside))
              .withColumn("rows_upto", F.row_number().over(Window.partitionBy("part").orderBy(*key, "tie")))
              .join(small_side(offsets), "part")
              .withColumn("index", F.col("rows_before") + F.col("rows_upto") - 1)
              # twice the middle of the row's byte interval, against twice the total
              .withColumn("shard", F.expr(
                  f"cast((2 * (size_before + size_upto) - size) * {int(n_shards)} div greatest(2 * total, 1) as int)"))
              # rows of no size at the very end would fall past the last cut
              .withColumn("shard", F.least(F.col("shard"), F.lit(n_shards - 1))))
    first = placed.groupBy("shard").agg(F.min("index").alias("first"))           # n_shards rows
    if n_shards <= 100_000:
        first = F.broadcast(first)
    return (placed.join(first, "shard")
            .select("row.*", "size", "shard", (F.col("index") - F.col("first")).alias("slot")))
