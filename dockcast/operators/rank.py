"""Global ranks without a single sorted task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockcast.session import write_table


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` plus the 0-based rank of each row under ``order`` (a total order of the rows).

    Rows are dealt into ranges of the order and stored (range bounds are sampled, so both steps below
    must see the same ones); a range's offset is the number of rows before it, a running sum over one
    row for each range; the rank inside a range is a window over that range alone."""
    spark = df.sparkSession
    dealt = write_table(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), spark, "tables/ranges")
    before = F.sum("rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
               .select("_range", F.coalesce(before, F.lit(0)).alias("_before")))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (dealt.withColumn("_inside", inside).join(offsets, "_range")
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_before", "_inside"))
