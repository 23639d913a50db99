"""Corpus pipeline: toxicity, near duplicates, decontamination, mixing, sharding.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame,
all but the last with the columns of ``documents``. ``run`` applies them in order, each result written
as Parquet to the shared scratch folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.llm import decontamination, mixing, ngram_join, sharding, toxicity
from dockcast.llm.common import cut
from dockcast.llm.queries import SHARDS, held_out, table

#: A boosted classifier and MinHash have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold stay."""
    scored = toxicity.score_toxicity(docs, "text", table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id."""
    return ngram_join.drop_near_duplicates(docs, "doc_id", "text")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window stay."""
    found = decontamination.find_matches(docs, F.col("text"), table(spark, sf_dir, "benchmark"), F.col("item_id"), F.col("text"))
    return found.where(decontamination.hit_words(F.col("hits")) == 0).select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a source without words is left as it is."""
    mixed = mixing.mix_sources(docs, "source", mixing.word_count(F.col("text")), [F.col("doc_id"), F.col("text")])
    taken = mixed.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return taken.select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it."""
    return sharding.assign_shards(docs, SHARDS, sharding.document_bytes(F.col("text")), ["doc_id"])


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_duplicates), ("decontamination", drop_contaminated),
          ("mixing", mix), ("sharding", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
