"""Ranked lexical search against a plain scoring of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from test_support import edge_docs, no_docs, pairs, prose, same  # noqa: F401  (fixtures)

from dockcast.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // n_words
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 12 * m))
                        for t, n in Counter(terms(text)).items() if t in b)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return out


def ranked(docs, items, top, **kw):
    found = lexical_search.rank_documents(docs, F.col("doc_id"), F.col("text"), items, F.col("item_id"), F.col("text"), top, **kw)
    return [(r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()]


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score long")


def test_search_equals_brute_force(spark, edge_docs):
    docs = pairs(edge_docs)
    texts = [t for _, t in docs if t]
    rows = [(k, " ".join(t.split()[:30]), 1) for k, t in enumerate(texts[:12])] + [(100, None, 1), (101, "", 1), (102, "!!", 1), (103, "nowhere-at-all", 1)]
    same(ranked(edge_docs, items_of(spark, rows), 5), brute(docs, [(i, t) for i, t, _ in rows], 5))


def varied(rng, n):
    words = ["common", "the", *(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(200))]
    return [(k, " ".join(rng.choice(words) for _ in range(max(1, int(rng.lognormvariate(3, 1)))))) for k in range(n)]


def test_small_blocks_and_bounds(spark, monkeypatch):
    """Many strata, small blocks, few blocks held, narrow tables: the bounds pass over blocks, never over a result."""
    rng = random.Random(4)
    docs = varied(rng, 1500)
    rows = [(k, " ".join(rng.choice(docs)[1].split()[:12]), 0) for k in range(25)] + [(5, "the the common", 0)]
    wanted = brute(docs, [(i, t) for i, t, _ in rows], 4)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items, vocabulary = lexical_search.read_items([type("R", (), {"item_id": i, "item_text": t}) for i, t, _ in rows])
    same(ranked(frame, items_of(spark, rows), 4), wanted)
    monkeypatch.setattr(lexical_search, "CELLS", 500)
    bags = [Counter(terms(t)) for _, t in docs]
    n_docs, n_words = len(docs), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    weights = np.array([lexical_search.term_weight(n_docs, df[t.decode()]) for t in vocabulary])
    search = lexical_search.Search(items, weights, 4)
    by_m = {}
    for (i, _), b in zip(docs, bags):
        by_m.setdefault(75 + 25 * sum(b.values()) * n_docs // n_words, []).append((i, b))
    scored = []
    monkeypatch.setattr(search, "score", lambda *a, f=search.score: scored.append(a[0][0]) or f(*a))
    blocks = []
    for m, own in by_m.items():
        postings = sorted((vocabulary[t.encode()], tf, k) for k, (_, b) in enumerate(own) for t, tf in b.items() if t.encode() in vocabulary)
        held = sorted({t for t, _, _ in postings})
        starts = np.searchsorted([t for t, _, _ in postings], [*held, 1 << 30])
        blocks.append((m, np.array([i for i, _ in own]), np.array(held, int), starts, np.array([k for _, _, k in postings], int),
                       np.array([tf for _, tf, _ in postings], int)))
    search.visit([b for b in blocks if len(b[2])])
    got = [(items.ids[q], k + 1, int(i), int(s)) for q, (ss, ii) in enumerate(search.best) for k, (s, i) in enumerate(zip(ss, ii))]
    same(got, wanted)
    assert scored


def test_groups_of_items(spark):
    """A vocabulary bound far below the items': several groups, the same ranks."""
    rng = random.Random(9)
    docs = varied(rng, 120)
    rows = [(k, prose(rng, 6) + " " + rng.choice(docs)[1], 0) for k in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    same(ranked(frame, items_of(spark, rows), 3, group_terms=150), brute(docs, [(i, t) for i, t, _ in rows], 3))


def test_ties_nulls_and_repeated_rows(spark):
    docs = [(3, "one two"), (1, "one two"), (None, "one two"), (2, "one two"), (2, "one two"), (7, None), (8, ""), (None, None), (9, "three four five")]
    rows = [(None, "ONE", 0), (4, "one", 0), (4, "one", 0), (5, "zero", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1)).withColumn("item_id", F.lit("x"))
    same(ranked(frame, items_of(spark, rows), 20), brute(docs, [(i, t) for i, t, _ in rows], 20))


def test_empty_tables(spark, no_docs):
    items = items_of(spark, [(1, "a b", 0)])
    assert ranked(no_docs, items, 3) == []
    assert ranked(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), items.where("false"), 3) == []
