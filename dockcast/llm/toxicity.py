"""Operator 6: toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

1. Lexicons. Words (and five-letter beginnings of longer words) of a part of the training rows, with
   the share of toxic and of clean documents that hold them; those whose log odds stay high at the
   lower end of their confidence interval form the lexicons. They have a size bound and are broadcast.
2. Features of every whole text: lexicon densities, nearness of lexicon words to second-person
   pronouns, capitals, punctuation, obfuscated spellings. No label, language, source or id is one.
3. Spark ML's gradient-boosted trees on a second part of the training rows, isotonic regression of
   their probability on a third part.

The training rows are at most ``MAX_LABELLED`` of those allowed, chosen by a hash of their id; every
document is scored over its whole text.

Defined results: null and empty texts have the features of no words and get a score; ids with
several labels take the highest; null labels are left out; with no toxic or no clean training row
the score is the share of toxic ones (0 if there are none); repeated rows are each scored; very long
texts and texts of one word take time in proportion to their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, packed, ship

MAX_LABELLED = 20_000         # training rows
LEXICON_TERMS = 5_000         # terms of each lexicon
MIN_TOXIC = 3                 # toxic documents that hold a term
MIN_ODDS = 1.0                # lower end of the term's log odds
THRESHOLD = 0.3
PREFIX = 5
NEAR = 5                      # words between a lexicon word and a pronoun

#: Second-person pronouns of the corpus's languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros vuestro".split())
#: Digits and signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "*": None})

WORD = re.compile(r"[^\W\d_]+")
# possessive, and only from a word's first letter: linear on a text without a space
OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$*!|]++[^\W\d_]+")
FEATURES = ("log_words", "word_hits", "word_density", "word_kinds", "word_weight", "start_hits", "start_density", "start_kinds",
            "start_weight", "near_second_person", "second_person", "capitals", "shouting", "exclamations", "punctuation",
            "obfuscated", "obfuscated_hits")


def features(text: str | None, by_word: dict[str, float], by_start: dict[str, float]) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    words = WORD.findall(text.lower())
    n = max(len(words), 1)
    hits = [w for w in words if w in by_word]
    starts = [w[:PREFIX] for w in words if w[:PREFIX] in by_start and len(w) > PREFIX]
    second = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if second and hits:
        at = np.array(second)
        places = np.array([i for i, w in enumerate(words) if w in by_word])
        k = np.searchsorted(at, places)
        gap = np.minimum(np.abs(places - at[np.maximum(k - 1, 0)]), np.abs(at[np.minimum(k, len(at) - 1)] - places))
        near = int((gap <= NEAR).sum())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    capital = ((points >= 65) & (points <= 90)) | ((points >= 192) & (points <= 222) & (points != 215))
    sign = ((points >= 33) & (points <= 47)) | ((points >= 58) & (points <= 64)) | ((points >= 91) & (points <= 96)) | (
        (points >= 123) & (points <= 126))
    odd = OBFUSCATED.findall(text)
    plain = [w.lower().translate(LEET) for w in odd]
    return [float(np.log1p(len(words))),
            float(np.log1p(len(hits))), 100 * len(hits) / n, float(len(set(hits))), max((by_word[w] for w in hits), default=0.0),
            float(np.log1p(len(starts))), 100 * len(starts) / n, float(len(set(starts))), max((by_start[w] for w in starts), default=0.0),
            float(near), 100 * len(second) / n, float(capital.mean()), float((capital[1:] & capital[:-1]).mean()) if len(points) > 1 else 0.0,
            100 * text.count("!") / len(points), float(sign.mean()), 100 * len(odd) / n, float(sum(w in by_word for w in plain))]


def _share(ids: Column) -> Column:
    """A tenth (0 to 9) of the training rows, by id alone."""
    return F.pmod(F.xxhash64(F.lit("part"), ids), F.lit(10))


def training_labels(docs: DataFrame, labels: DataFrame, allowed: Column, max_rows: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic, tenth) of at most ``max_rows`` labelled documents for which ``allowed`` holds."""
    rows = cut(labels.where(allowed & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
               .join(docs.select(col("doc_id").alias("doc_id")), "doc_id", "left_semi")
               .groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic")), "toxic-allowed")
    # a share of the 64-bit hashes that surely holds the least max_rows keeps each task's part of the sort small
    share = min(1.5 * max_rows / max(rows.count(), 1) + 1e-12, 1.0)
    least = F.xxhash64("doc_id")
    rows = (rows if share == 1.0 else rows.where(least <= int((share - 0.5) * 2.0 ** 63 * 2))).orderBy(least, "doc_id").limit(max_rows)
    return cut(rows.select("doc_id", "toxic", _share(F.col("doc_id")).alias("tenth")), "toxic-labels")


def learn_lexicons(docs: DataFrame, text: str, rows: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Lexicons of words and of beginnings, term -> lower end of its log odds; both of bounded size."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str], Counter] = {}
        for batch in batches:
            for t, toxic in zip(batch["text"], batch["toxic"]):
                words = set(WORD.findall((t or "").lower()))
                for kind, terms in (("word", words), ("start", {w[:PREFIX] for w in words if len(w) > PREFIX})):
                    seen.setdefault((kind, "toxic" if toxic else "clean"), Counter()).update(terms)
        for (kind, side), terms in ((k, t) for k, t in seen.items() if t):
            yield pd.DataFrame({"kind": kind, "term": list(terms), "toxic": [n if side == "toxic" else 0 for n in terms.values()],
                                "clean": [n if side == "clean" else 0 for n in terms.values()]})

    labelled = (docs.select(col("doc_id").alias("doc_id"), col(text).alias("text"))
                .join(F.broadcast(rows), "doc_id").select("text", "toxic"))    # at most max_rows ids
    counts = (labelled.mapInPandas(count, "kind string, term string, toxic long, clean long")
              .groupBy("kind", "term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")))
    totals = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sum(n for t, n in totals.items() if t), sum(n for t, n in totals.items() if not t)
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n1 + 1)) - F.log(b / (n0 + 1)) - 1.64 * F.sqrt(1 / a + 1 / b)
    kept = counts.withColumn("odds", odds).where((F.col("a") >= MIN_TOXIC) & (F.col("odds") >= MIN_ODDS))
    out = []
    for kind in ("word", "start"):
        best = kept.where(F.col("kind") == kind).orderBy(F.desc("odds"), "term").limit(LEXICON_TERMS)
        out.append({r.term: r.odds for r in best.collect()})
    return out[0], out[1]


def score_toxicity(docs: DataFrame, text: str, labels: DataFrame, allowed: Column,
                   max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``row`` (struct of the columns of ``docs``) and ``score``. ``docs`` and ``labels`` meet on
    ``doc_id``; ``allowed`` says which rows of ``labels`` may be learnt from."""
    spark = docs.sparkSession
    ship(spark)
    rows = training_labels(docs, labels, allowed, max_labelled)
    part = lambda low, high: rows.where((F.col("tenth") >= low) & (F.col("tenth") <= high)).drop("tenth")
    counts = {(r.k, r.toxic): r.n for r in rows.groupBy(
        F.when(F.col("tenth") <= 3, 0).when(F.col("tenth") <= 7, 1).otherwise(2).alias("k"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = sum(n for (_, t), n in counts.items() if t)
    total = sum(counts.values())
    if not toxic or toxic == total:
        return docs.select(packed(docs).alias("row"), F.lit(toxic / total if total else 0.0).alias("score"))

    shared = spark.sparkContext.broadcast(learn_lexicons(docs, text, part(0, 3)))

    @F.pandas_udf("array<double>")
    def dense(texts: pd.Series) -> pd.Series:
        by_word, by_start = shared.value
        return pd.Series([features(t, by_word, by_start) for t in texts])

    def fit_rows(low: int, high: int) -> DataFrame:
        held = docs.select(col("doc_id").alias("doc_id"), col(text).alias("text")).join(F.broadcast(part(low, high)), "doc_id")
        return held.select(dense("text").alias("f"), F.col("toxic").alias("label"))

    # parts too small to hold both kinds are replaced by all training rows
    both = lambda k: counts.get((k, 1.0), 0) and counts.get((k, 0.0), 0)
    boost, calibrate = ((4, 7) if both(1) else (0, 9)), ((8, 9) if both(2) else (0, 9))
    vectors = lambda df: df.withColumn("features", array_to_vector("f"))
    boosting = vectors(cut(fit_rows(*boost), "toxic-boost")).repartition(4)         # a bounded sample
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3,
                          minInstancesPerNode=2, seed=11).setProbabilityCol("p").fit(boosting)
    probability = vector_to_array("p")[1]
    calibrating = trees.transform(vectors(cut(fit_rows(*calibrate), "toxic-calibrate")))
    curve = IsotonicRegression(featuresCol="x", labelCol="label", predictionCol="calibrated").fit(
        cut(calibrating.select(probability.alias("x"), "label"), "toxic-curve").coalesce(1))

    held = docs.select(packed(docs).alias("row"), dense(col(text)).alias("f"))
    scored = curve.transform(trees.transform(vectors(held)).select("row", probability.alias("x")))
    # the curve is flat in places: a hundredth of the probability keeps the order there
    return scored.select("row", (0.99 * F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)) + 0.01 * F.col("x")).alias("score"))
