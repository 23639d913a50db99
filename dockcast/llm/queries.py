"""One registered query per operator: each applies its operator, with production parameters, to its
whole table and returns the full result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, byte_pairs, chat, decontamination, extraction, lexical_search, mixing, ngram_join, quality, sharding,
               suffix_dedup, tokens, toxicity)

SHARDS = 24
TOP = 20                      # documents kept for each item of a search


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.crc32(text.cast("binary")).alias("text_crc32"),
                       sharding.document_bytes(F.col("text")).alias("n"))
    placed = sharding.assign_shards(rows, SHARDS, F.col("n"), ["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontamination.find_matches(docs.select("doc_id", "text"), F.col("text"), bench, F.col("item_id"), F.col("text"))
    found = found.select(F.col("row.doc_id").alias("doc_id"), "n_words",
                         decontamination.hit_words(F.col("hits")).alias("n_hit"),
                         decontamination.hit_items(F.col("hits")).alias("items"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix_sources(docs, "source", mixing.word_count(F.col("text")), [F.col("doc_id"), F.col("text")],
                               payload=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"))
    out = chat.format_chats(rows.union(extra), F.col("conv_id"), F.col("turn"), F.col("role"), F.col("text"))
    out = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
                     chat.loss_text(F.col("segments")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                      F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return (pages.select("page_id", "url", extraction.extract(pages, F.col("html")).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.select("doc_id", (F.octet_length("kept") + F.col("n_removed")).cast("long").alias("n_bytes"), "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, "text", labels, ~held_out(F.col("doc_id")))
    return scored.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), "text", "lang", "source", payload=["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (ngram_join.jaccard_join(table(spark, sf_dir, "documents"), "doc_id", "text")
            .select("doc_id", "class_id", "n_links", "n_text_links"))


def op10_tokens(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with open(public_tokenizers.path(tokenizer), encoding="utf-8") as f:
        spec = f.read()
    out = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      tokens.count_tokens(docs, F.col("text"), spec).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > 512)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return lexical_search.rank_documents(docs, F.col("doc_id"), F.col("text"), bench, F.col("item_id"), F.col("text"), TOP)


def op12_alignment(spark: SparkSession, sf_dir: str, side_a: str = "byte_bpe_50k.json", side_b: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(side_a), encoding="utf-8") as a, open(public_tokenizers.path(side_b), "rb") as b:
        spec, model = a.read(), b.read()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = alignment.align(docs, F.col("text"), spec, model, public_tokenizers.PATTERN, payload=["doc_id"])
    return out.select("row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str, ranks: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path(ranks), "rb") as f:
        codec = byte_pairs.Codec(spark, f.read(), public_tokenizers.PATTERN)
    out = codec.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op1_sharding": op1_sharding, "op2_decontamination": op2_decontamination, "op3_extraction": op3_extraction,
           "op4_suffix_dedup": op4_suffix_dedup, "op5_mixing": op5_mixing, "op6_toxicity": op6_toxicity,
           "op7_quality": op7_quality, "op8_ngram_join": op8_ngram_join, "op9_chat": op9_chat, "op10_tokens": op10_tokens,
           "op11_lexical_search": op11_lexical_search, "op12_alignment": op12_alignment, "op13_byte_pairs": op13_byte_pairs}
