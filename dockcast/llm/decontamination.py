"""Operator 2: benchmark decontamination with a positional inverted index.

1. Term frequencies: one pass over the training words counts the terms of the benchmark.
2. For every benchmark window the two rarest terms are its anchors; a window with a term that never
   occurs is dropped. Windows that share anchors share their look-ups.
3. Index: one pass stores the postings (text key, position, term) of the anchor terms. Copies of a
   text share a key and collapse in a distinct that combines before its shuffle.
4. Lists are intersected from the rarest term on: a posting of the first anchor asks for the second
   at the position its offset gives, an equi-join on (text key, position, term).
5. Exact check: the alignments found are joined to their documents and every window on them is
   compared word for word. A bitmap over the hashes of the texts found, of a fixed size, tells the
   other documents beforehand: their texts are not shuffled.

Proximity matches need at least a share of a window's distinct terms, so as many terms may be absent as
the share leaves out. One of the rarest terms, one more than may be absent, must then occur: each of
them alone proposes every span that it can stand in, and the check counts the terms of each span.

Benchmark-sized sides are broadcast only after a count of their rows, and of the bytes of their words. Defined results: null text has no words;
an empty or wordless item gives no window; an item of fewer words than the width is one window;
repeated items are separate texts under one id; repeated documents each get their row.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, packed, small_side

# What separates words: ASCII characters other than digits and letters.
BREAK = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

FILTER_BITS = 24              # places of the bitmap over text hashes, as a power of two: 2^18 rows of 64


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def fold(word: Column) -> Column:
    """Lower-case A-Z alone (``lower`` does just that for ASCII, and much faster)."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def text_key(text: Column) -> list[Column]:
    """Two independent 64-bit hashes; copies of a text share them."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2")]


def benchmark_items(bench: DataFrame, item_id: Column, text: Column, width: int) -> DataFrame:
    words = F.transform(raw_words(text), fold)
    items = bench.select(item_id.alias("item_id"), words.alias("iw")).where(F.size("iw") > 0)
    return cut(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "iw", F.size("iw").alias("n"),
                            F.least(F.size("iw"), F.lit(width)).alias("w"),
                            F.aggregate("iw", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w) + 16).alias("bytes")), "decon-items")


def window_terms(docs: DataFrame, text: Column, items: DataFrame) -> DataFrame:
    """(item, n, w, pos, term, freq, start): the places of every window, with how often the training
    words hold their terms."""
    places = items.select("item", "n", "w", F.posexplode("iw").alias("pos", "term"))
    vocabulary = cut(places.select("term").distinct(), "decon-vocabulary")
    tokens = docs.select(F.explode(raw_words(text)).alias("word")).select(fold(F.col("word")).alias("term"))
    freq = cut(tokens.join(small_side(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("freq")),
               "decon-frequencies")
    return (places.join(small_side(freq), "term", "left").fillna(0, ["freq"])
            .select("*", F.explode(F.expr("sequence(greatest(pos - w + 1, 0), least(pos, n - w))")).alias("start")))


def rare_anchors(docs: DataFrame, text: Column, items: DataFrame) -> DataFrame:
    """(item, pos1, term1, pos2, term2): the two rarest terms of each window, by how often the
    training words hold them (ties by position); distinct over windows."""
    covering = window_terms(docs, text, items)
    by_window = Window.partitionBy("item", "start")
    ranked = (covering.withColumn("least", F.min("freq").over(by_window)).where("least > 0")
              .withColumn("r", F.row_number().over(by_window.orderBy("freq", "pos"))).where("r <= 2"))
    lists = ranked.groupBy("item", "start").agg(F.array_sort(F.collect_list(F.struct("r", "pos", "term"))).alias("a"))
    second = F.coalesce(F.get("a", F.lit(1)), F.get("a", F.lit(0)))      # a one-word window meets itself
    return cut(lists.select("item", F.col("a")[0]["pos"].alias("pos1"), F.col("a")[0]["term"].alias("term1"),
                            second["pos"].alias("pos2"), second["term"].alias("term2")).distinct(), "decon-anchors")


def needed_terms(terms: Column, share: float) -> Column:
    """How many of a window's distinct terms a proximity match has at least."""
    return F.greatest(F.ceil(F.lit(share) * terms - F.lit(1e-9)), F.lit(1))


def near_anchors(docs: DataFrame, text: Column, items: DataFrame, share: float) -> DataFrame:
    """(item, w, start, term): of each window the rarest distinct terms, one more than a match may
    lack; those that never occur propose nothing."""
    terms = window_terms(docs, text, items).groupBy("item", "w", "start", "term").agg(F.max("freq").alias("freq"))
    by_window = Window.partitionBy("item", "start")
    ranked = (terms.withColumn("number", F.count(F.lit(1)).over(by_window))
              .withColumn("r", F.row_number().over(by_window.orderBy("freq", "term"))))
    kept = ranked.where((F.col("r") <= F.col("number") - needed_terms(F.col("number"), share) + 1) & (F.col("freq") > 0))
    return cut(kept.select("item", "w", "start", "term"), "decon-near-anchors")


def anchor_postings(docs: DataFrame, text: Column, terms: DataFrame) -> DataFrame:
    """The index: distinct (k1, k2, pos, term) for the anchor terms."""
    terms = cut(terms.distinct(), "decon-terms")
    places = docs.select(*text_key(text), F.posexplode(raw_words(text)).alias("pos", "word"))
    return cut(places.select("k1", "k2", "pos", fold(F.col("word")).alias("term")).join(small_side(terms), "term"),
               "decon-postings")


def alignments(postings: DataFrame, anchors: DataFrame) -> DataFrame:
    """Distinct (k1, k2, item, shift): the item's word 0 would stand at document position ``shift``."""
    lists = postings.distinct()
    asked = (lists.join(small_side(anchors), F.col("term") == F.col("term1"))
             .select("k1", "k2", "item", (F.col("pos") - F.col("pos1")).alias("shift"),
                     (F.col("pos") - F.col("pos1") + F.col("pos2")).alias("pos"), F.col("term2").alias("term")))
    return asked.join(lists, ["k1", "k2", "pos", "term"]).select("k1", "k2", "item", "shift").distinct()


def near_alignments(postings: DataFrame, anchors: DataFrame, slop: int) -> DataFrame:
    """As ``alignments``: every shift at which an anchor term stands within ``slop`` words of its window's span."""
    first, last = F.greatest(F.col("pos") - F.col("w") - slop + 1, F.lit(0)), F.col("pos") + slop
    found = postings.distinct().join(small_side(anchors), "term").select("k1", "k2", "item", "start", F.explode(F.sequence(first, last)).alias("at"))
    return found.select("k1", "k2", "item", (F.col("at") - F.col("start")).alias("shift")).distinct()


def text_filter(keys: DataFrame) -> DataFrame:
    """(word, bits): a bitmap with the place of every ``k1``; at most 2^18 rows, however many keys there are."""
    place = F.pmod("k1", F.lit(1 << FILTER_BITS))
    return cut(keys.select(F.floor(place / 64).alias("word"), (place % 64).cast("int").alias("bit"))
               .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")), "decon-filter")


def find_matches(docs: DataFrame, text: Column, bench: DataFrame, item_id: Column, item_text: Column,
                 width: int = 10, slop: int = 0, share: float = 1.0) -> DataFrame:
    """``docs`` columns as struct ``row``, ``n_words`` and ``hits``: array of (item_id, start, width,
    exact), one for each occurrence of a benchmark window in the document's words. With ``slop`` or a
    ``share`` below 1, also proximity matches (exact = false): every span of the window's width inside
    the document (or from its start, if it is shorter) with at least ``share`` of the window's distinct
    terms, in any order, within ``slop`` words of it."""
    if slop < 0 or not 0 < share <= 1:
        raise ValueError("slop must not be negative, share must be above 0 and at most 1")
    loose = slop > 0 or share < 1
    items = benchmark_items(bench, item_id, item_text, width)
    if loose:
        anchors = near_anchors(docs, text, items, share)
        found = near_alignments(anchor_postings(docs, text, anchors.select("term")), anchors, slop)
    else:
        anchors = rare_anchors(docs, text, items)
        terms = anchors.select(F.col("term1").alias("term")).union(anchors.select(F.col("term2").alias("term")))
        found = alignments(anchor_postings(docs, text, terms), anchors)
    # stored, so that the join below shuffles both sides itself and AQE can split the copies of one text
    by_text = cut(found.join(small_side(items, size=F.col("bytes")), "item")
                  .groupBy("k1", "k2").agg(F.collect_list(F.struct("item_id", "iw", "n", "w", "shift")).alias("found")), "decon-found")

    place = F.pmod("k1", F.lit(1 << FILTER_BITS))
    held = (docs.select(packed(docs).alias("row"), text.alias("text"), *text_key(text))
            .join(F.broadcast(text_filter(by_text)), F.floor(place / 64) == F.col("word"), "left")
            .withColumn("listed", F.coalesce(F.expr(f"(shiftright(bits, cast(pmod(k1, {1 << FILTER_BITS}) % 64 as int)) & 1L) = 1L"), F.lit(False))))
    near_by = (held.where("listed").join(by_text.hint("merge"), ["k1", "k2"], "left")     # one plan at every size
               .select("row", "found", raw_words(F.col("text")).alias("words")))

    def windows(words: Column, x: Column) -> Column:
        starts = F.sequence(F.lit(0), x["n"] - x["w"])

        def judged(s: Column) -> Column:
            at = x["shift"] + s
            wanted = F.slice(x["iw"], s + 1, x["w"])
            exact = F.when(at >= 0, F.slice(words, F.greatest(at, F.lit(0)) + 1, x["w"]) == wanted).otherwise(F.lit(False))
            return F.struct(x["item_id"].alias("item_id"), at.alias("start"), x["w"].alias("width"), exact.alias("exact"))

        def near(v: Column) -> Column:
            wanted = F.array_distinct(F.slice(x["iw"], v["start"] - x["shift"] + 1, x["w"]))
            low = F.greatest(v["start"] - slop, F.lit(0))
            span = F.slice(words, low + 1, F.greatest(v["start"] + x["w"] + slop - low, F.lit(0)))
            inside = (v["start"] >= 0) & (v["start"] <= F.greatest(F.size(words) - x["w"], F.lit(0)))
            return inside & (F.size(F.array_intersect(wanted, span)) >= needed_terms(F.size(wanted), share))

        every = F.transform(starts, judged)
        return F.filter(every, lambda v: v["exact"] | near(v)) if loose else F.filter(every, lambda v: v["exact"])

    # transform over a one-element array binds the folded words once for all windows
    hits = F.when(F.col("found").isNotNull(), F.flatten(F.transform(
        F.array(F.transform("words", fold)),
        lambda words: F.flatten(F.transform("found", lambda x: windows(words, x))))))
    judged = near_by.select("row", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    others = held.where(~F.col("listed")).select("row", F.size(raw_words(F.col("text"))).cast("long").alias("n_words"),
                                                 F.lit(None).cast(judged.schema["hits"].dataType).alias("hits"))
    return others.union(judged)


def hit_words(hits: Column) -> Column:
    """Number of distinct word positions inside exact hits; 0 for none."""
    places = F.flatten(F.transform(F.filter(hits, lambda v: v["exact"]),
                                   lambda v: F.sequence(v["start"], v["start"] + v["width"] - 1)))
    return F.coalesce(F.size(F.array_distinct(places)), F.lit(0)).cast("long")


def hit_items(hits: Column) -> Column:
    """Ids (as text, sorted) of the items with an exact hit; rows without an id count for none."""
    ids = F.transform(F.filter(hits, lambda v: v["exact"] & v["item_id"].isNotNull()), lambda v: v["item_id"].cast("string"))
    return F.coalesce(F.array_sort(F.array_distinct(ids)), F.array().cast("array<string>"))
