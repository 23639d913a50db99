"""Schema inference over landed snapshots, poll by poll, with a report of drift.

Each element's fields are parsed as variants; an aggregation gives the merged type of each field in each poll. It combines
map-side, so what is shuffled is a type for each task, poll and field, however many elements there are, and no
second pass or sample is needed. The report compares each poll with the one before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockcast.sources.snapshots import SNAPSHOT_GLOB


def scan_variants(spark: SparkSession, path: str, multi_line: bool = True, glob: str = SNAPSHOT_GLOB, poll: str = "poll") -> DataFrame:
    """(poll, element): every element of the landed files as a variant, whatever its fields; arrays give one row for each of
    theirs. What does not parse gives none (``rejected_files`` counts it). The poll comes from the folder's name."""
    text = (spark.read.option("wholetext", multi_line).option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
            .select(F.regexp_extract("_metadata.file_path", f"{poll}=([^/]+)", 1).alias("poll"), F.try_parse_json("value").alias("v")))
    each = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    return text.where(F.col("v").isNotNull()).select("poll", F.explode(each).alias("element"))


def field_types(elements: DataFrame, root: str = "$.fields") -> DataFrame:
    """(poll, field, type, n): the merged type of each field of each poll and how many elements hold it. Values that agree on no
    type have the type VARIANT; a field that is always null has VOID."""
    fields = elements.select("poll", F.explode(F.try_variant_get("element", root, "map<string,variant>")).alias("field", "value"))
    merged = F.regexp_replace(F.expr("schema_of_variant_agg(value)"), " NOT NULL", "")
    return fields.groupBy("poll", "field").agg(merged.alias("type"), F.count(F.lit(1)).alias("n"))


def merged_schema(elements: DataFrame) -> DataFrame:
    """(schema): one row, the merged type of all elements of all polls."""
    return elements.agg(F.expr("schema_of_variant_agg(element)").alias("schema"))


APPEARS, VANISHES, CHANGES = "appears", "vanishes", "changes type"


def schema_drift(types: DataFrame) -> DataFrame:
    """(poll, field, change, before, after): fields of a poll that the one before it lacked, lacks that it had, and changes of
    type. The first poll is what the others are compared with; the digits of decimals are no change. Windows run over the
    polls of one field."""
    types = types.withColumn("type", F.regexp_replace("type", r"DECIMAL\([0-9, ]+\)", "DECIMAL"))
    polls = types.select("poll").distinct().withColumn("no", F.row_number().over(Window.orderBy("poll")))   # one row for each poll
    last = polls.agg(F.max("no").alias("n")).first().n or 0
    by_field = Window.partitionBy("field").orderBy("no")
    t = types.join(polls, "poll").select("no", "field", "type", F.lag("no").over(by_field).alias("prior"),
                                         F.lag("type").over(by_field).alias("was"), F.lead("no").over(by_field).alias("next"))
    def change(at, kind: str, before, after):
        return F.struct(at.alias("no"), F.lit(kind).alias("change"), before.cast("string").alias("before"), after.cast("string").alias("after"))

    none, no = F.lit(None), F.col("no")
    follows = F.coalesce(F.col("prior") == no - 1, F.lit(False))
    found = F.array_compact(F.array(
        F.when((no > 1) & ~follows, change(no, APPEARS, none, F.col("type"))),
        F.when(follows & (F.col("was") != F.col("type")), change(no, CHANGES, F.col("was"), F.col("type"))),
        F.when((no < last) & F.coalesce(F.col("next") > no + 1, F.lit(True)), change(no + 1, VANISHES, F.col("type"), none))))
    events = t.select("field", F.explode(found).alias("c")).select("field", "c.*")
    return events.join(polls, "no").select("poll", "field", "change", "before", "after")
