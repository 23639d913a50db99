"""Operator 5: mixing sources to target weights by hash thresholds, without sorting documents.

One narrow table (source, size, hash) is stored. Target sizes come from a water-filling over the
table of sources. A source takes whole repeats of all its documents plus a fraction; the fraction
is the set of documents whose 60-bit hash lies below a threshold. The threshold is found level by
level: a histogram of sizes by source and the next 12 bits of the hash, a running sum inside each
source, the bucket in which the budget ends; the next level reads the rows of that bucket alone.
Every level is an aggregation that combines before its shuffle, so a hot source is no hot task.
Rows equal in id and text share their hash; the number that each stored row got is their next level,
so a mix may end between them, however many there are.

Defined results: null text has size 0; null source is a source of its own, after all others; rows
equal in id and text are taken one by one, as many as the budget holds (which ones cannot be told from
the result); a source without words has target 0;
an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SMALL_ROWS, col, cut, packed, small_side

BITS, LEVELS = 12, 5          # 4,096 buckets a level, 60 bits in all
TIE_SHIFTS = (33, 22, 11, 0)  # levels of a stored row's number: its partition, then 11 bits each
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def mix_hash(*parts: Column) -> Column:
    """60 bits of md5 as a long: the same on every engine, run and partitioning."""
    text = F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """(source, source_size) -> with ``target``. Sources by code point, null last, get ``weights``
    in turn and share the sum of all sizes; a target stops at ``max_repeat`` times its source, and
    what is left goes to the others by weight. With sources in the order of cap / weight, the level
    after capping the first k is (total - their caps) / (other weights); the greatest of these is
    the level at which nothing is above its cap. Windows here run over one row for each source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeat)
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    t = t.select(
        "source", "source_size", "weight", "cap",
        F.coalesce(F.sum("cap").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("caps"),
        F.sum("weight").over(Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"))
    level = F.max((F.col("total") - F.col("caps")).cast("double") / F.col("rest")).over(Window.partitionBy())
    return t.select("source", "source_size",
                    F.least(F.col("weight") * level, F.col("cap").cast("double")).alias("target"))


def _refine(rows: DataFrame, state: DataFrame, inside: Column, bucket: Column) -> DataFrame:
    """One level: the bucket of each source in which its budget ends, among the rows ``inside`` the
    bucket found before."""
    edge = state.select(F.col("source").alias("of"), "at", "prefix", "below", "budget", "target", "source_size", "whole")
    hist = (rows.select("source", "size", "hash", "tie")
            .join(edge, F.col("source").eqNullSafe(F.col("of")) & inside)
            .groupBy("source", bucket.alias("bucket"))
            .agg(F.sum("size").alias("held"), *[F.first(c).alias(c) for c in ("at", "below", "budget", "target", "source_size", "whole")]))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("upto", F.col("below") + F.sum("held").over(upto))
    # the first bucket whose end reaches the budget; the last one if rounding leaves a rest
    pick = F.min(F.when(F.col("upto") >= F.col("budget"), F.col("bucket"))).over(Window.partitionBy("source"))
    last = F.max("bucket").over(Window.partitionBy("source"))
    edge = (cum.withColumn("chosen", F.coalesce(pick, last)).where("bucket = chosen")
            .select("source", "source_size", "target", "whole", "budget", "at", F.col("bucket").alias("prefix"),
                    (F.col("upto") - F.col("held")).alias("below"), F.col("held").alias("inside")))
    return small_side(cut(edge, "mix-edge"))


def mix_sources(docs: DataFrame, source: str, size: Column, hash_parts: list[Column],
                weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = MAX_REPEAT,
                payload: list[str] | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``row`` (struct of the ``payload`` columns), ``size``,
    ``source_size``, ``target`` and ``times``, how often the mix takes the row (0 .. max_repeat)."""
    keep = docs.select(*[col(c) for c in payload]) if payload is not None else docs
    rows = cut(docs.select(packed(keep).alias("row"), col(source).cast("string").alias("source"),
                           size.cast("long").alias("size"), mix_hash(*hash_parts).alias("hash"),
                           F.monotonically_increasing_id().alias("tie")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut(source_targets(sizes, weights, max_repeat)
                  .withColumn("whole", F.when(F.col("source_size") > 0, F.least(
                      F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeat).cast("long"))).otherwise(F.lit(1)))
                  # what the fraction must hold; nothing when the whole repeats reach the target
                  .withColumn("budget", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))),
                  "mix-targets")
    state = targets.withColumns({"at": F.lit(-1).cast("long"), "prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long"),
                                 "inside": F.col("source_size")})
    if targets.count() <= SMALL_ROWS:
        state = F.broadcast(state)
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        state = _refine(rows, state, F.shiftright("hash", shift + BITS) == F.col("prefix"), F.shiftright("hash", shift))
    state = state.withColumns({"at": F.col("prefix"), "prefix": F.lit(0).cast("long")})
    for shift, above in zip(TIE_SHIFTS, (63, *TIE_SHIFTS)):
        state = _refine(rows, state, (F.col("hash") == F.col("at")) & (F.shiftright("tie", above) == F.col("prefix")),
                        F.shiftright("tie", shift))
    # the last bucket is one row: taken if the sum comes nearer to the budget with it
    take = F.abs(F.col("below") + F.col("inside") - F.col("budget")) < F.abs(F.col("below") - F.col("budget"))
    final = state.select(F.col("source").alias("of"), "source_size", "target", "whole", "at",
                         (F.col("prefix") + take.cast("long")).alias("limit"))
    under = (F.col("hash") < F.col("at")) | ((F.col("hash") == F.col("at")) & (F.col("tie") < F.col("limit")))
    return (rows.join(final, F.col("source").eqNullSafe(F.col("of")))
            .select("row", "size", "source_size", "target",
                    (F.col("whole") + ((F.col("source_size") > 0) & under).cast("long")).alias("times")))
