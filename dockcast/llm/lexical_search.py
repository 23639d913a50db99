"""Operator 11: ranked lexical search over a length-stratified index.

A document's length enters its score only through a small whole number, the normaliser m. The index holds
documents by strata of equal m: a block is a run of documents of one stratum, with its postings by
term and, within a term, by how often the document has it (tf). All postings of a block with the same tf have the
same impact, which is computed once. The largest tf of a term in a block bounds what the term can add,
and the sum over an item's terms bounds the item's scores in the block.

Search visits the blocks of a task by falling bounds, so that good documents come first and the score an
item's k-th document has rises early. A block whose bound lies below that score is passed over for the item;
in the others only documents with one of the terms that are needed to reach it are scored. A task returns its
k best for each item; the rest is a rank over those. Scores are whole numbers of 64 bits.

Steps: (1) one pass counts the words of each document and, of the items' terms, its tf; (2) totals and document
frequencies by aggregation; (3) blocks, dealt out by ranges of (m, row), so that a hot stratum is spread; (4)
search. Only terms of the items are indexed. Items are taken in groups of about ``GROUP_TERMS`` term
occurrences, each with an index of its own, so that the shipped vocabulary is bounded however many items there are.

Defined results: a null or wordless document has no terms and is never found; an item without terms, or whose
terms no document holds, has no rows; a document is found with a score above 0 alone; equal scores by id, null
ids last, rows of equal id and score in any order; a repeated item row is ranked for itself; null items are ranked
under null; empty tables give no rows; texts are counted whole; other columns are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship

GROUP_TERMS = 200_000         # term occurrences of the items that are searched together
BLOCK_DOCS = 1024             # documents of a block at most
CELLS = 1 << 22               # cells of the impact table of terms and documents that is filled at a time
HELD_BLOCKS = 64              # blocks that a task orders by their bounds at a time
SPREAD = 64                   # parts in which the tasks' candidates of an item are first ranked
#: The parameters of the impact: a document's m is BASE + (LENGTH * n * N) div L.
BASE, LENGTH, SCALE, TF, NORM = 75, 25, 1_000_000_000, 1000, 12

# byte -> its lower-case form, or a space where terms end
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTED = "n long, terms array<int>, tfs array<int>"
BLOCK = "m long, ids array<long>, terms array<int>, starts array<int>, docs array<int>, tfs array<int>"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (SCALE * tf) // (TF * tf + NORM * m)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Items:
    """The items of a group: for each its (term, occurrences), by term number."""

    ids: list
    terms: list[np.ndarray]
    often: list[np.ndarray]


def read_items(rows: list) -> tuple[Items, dict[bytes, int]]:
    """From (item_id, text) rows; with the vocabulary."""
    vocabulary: dict[bytes, int] = {}
    items = Items([], [], [])
    for r in rows:
        found = [vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(r.item_text)]
        if found:
            terms, often = np.unique(np.array(found, np.int64), return_counts=True)
            items.ids.append(r.item_id)
            items.terms.append(terms)
            items.often.append(often)
    return items, vocabulary


def int_lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    cuts = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), kind))


def count_terms(docs: DataFrame, doc_id: Column, text: Column, vocabulary: dict[bytes, int]) -> DataFrame:
    """A stored table (row_id, doc_id, n, terms, tfs): all words of a document counted, and the tf of each term of the
    vocabulary that it has."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            n, terms, tfs = [], [], []
            for t in batch.column("text"):
                words = terms_of(t.as_py())
                held = [k for k in map(number, words) if k is not None]
                found, often = np.unique(np.array(held, np.int64), return_counts=True)
                n.append(len(words))
                terms.append(found)
                tfs.append(often)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("doc_id"), pa.array(n, pa.int64()), int_lists(terms, pa.int32()),
                 int_lists(tfs, pa.int32())], names=["row_id", "doc_id", "n", "terms", "tfs"])

    return cut(rows.mapInArrow(count, "row_id long, doc_id long, " + COUNTED).where("n > 0"), "search-terms")


def build_index(counted: DataFrame, n_docs: int, n_words: int) -> DataFrame:
    """The blocks: documents of equal m, postings by term and tf. Ids stand for themselves, null as the greatest long."""
    m = F.expr(f"{BASE}L + ({LENGTH}L * n * {n_docs}L) div {max(n_words, 1)}L")
    rows = (counted.where(F.size("terms") > 0).select(m.alias("m"), "row_id", "doc_id", "terms", "tfs")
            .repartitionByRange("m", "row_id").sortWithinPartitions("m", "row_id").select("m", "doc_id", "terms", "tfs"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ms = batch.column("m").to_numpy()
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            cuts = batch.column("terms").offsets.to_numpy()
            terms = batch.column("terms").values.to_numpy().astype(np.int64)
            tfs = batch.column("tfs").values.to_numpy().astype(np.int64)
            edges = np.flatnonzero(np.diff(ms)) + 1
            out: list[list] = [[] for _ in range(6)]
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(ms)]):
                for first in range(low, high, BLOCK_DOCS):
                    last = min(first + BLOCK_DOCS, high)
                    part = slice(cuts[first], cuts[last])
                    doc = np.repeat(np.arange(last - first), np.diff(cuts[first:last + 1]))
                    order = np.lexsort((doc, tfs[part], terms[part]))
                    held, starts = np.unique(terms[part][order], return_index=True)
                    for x, y in zip(out, (int(ms[first]), ids[first:last], held, np.append(starts, len(order)), doc[order], tfs[part][order])):
                        x.append(y)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), *[int_lists(x, k) for x, k in zip(out[1:], kinds)]],
                                             names=["m", "ids", "terms", "starts", "docs", "tfs"])

    return cut(rows.mapInArrow(blocks, BLOCK), "search-index")


class Search:
    """The best documents of each item so far, over the blocks given."""

    def __init__(self, items: Items, weights: np.ndarray, top: int):
        self.items, self.weights, self.top = items, weights, top
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items.ids]     # scores falling, then ids
        self.least = np.zeros(len(items.ids), np.int64)       # the score of the last of ``top``, 0 while there are fewer
        # items by term, to look at those alone that share a term with a block
        self.item = np.repeat(np.arange(len(items.ids)), [len(t) for t in items.terms])
        self.term = np.concatenate([*items.terms, np.empty(0, np.int64)])
        self.gain = np.concatenate([*items.often, np.empty(0, np.int64)]) * weights[self.term]

    def bounds(self, m: int, terms: np.ndarray, starts: np.ndarray, tfs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each (item, term) can add in a block, and the sum for each item."""
        most = np.zeros(len(self.weights), np.int64)
        most[terms] = impact(tfs[starts[1:] - 1], m)          # postings of a term are by tf
        adds = self.gain * most[self.term]
        total = np.zeros(len(self.items.ids), np.int64)
        np.add.at(total, self.item, adds)
        return adds, total

    def visit(self, held: list[tuple]) -> None:
        """Blocks (m, ids, terms, starts, docs, tfs), the most promising first."""
        known = [(b, *self.bounds(b[0], b[2], b[3], b[5])) for b in held]
        for block, adds, total in sorted(known, key=lambda x: -int(x[2].max(initial=0))):
            self.search(block, adds, total)

    def search(self, block: tuple, adds: np.ndarray, total: np.ndarray) -> None:
        """The block's documents, as many at a time as ``CELLS`` allows."""
        m, ids, terms, starts, docs, tfs = block
        width = max(CELLS // max(len(terms), 1), 1)
        if width >= len(ids):
            self.score(block, adds, total)
            return
        term = np.repeat(np.arange(len(terms)), np.diff(starts))
        for low in range(0, len(ids), width):
            own = (docs >= low) & (docs < low + width)
            cuts = np.concatenate(([0], np.cumsum(np.bincount(term[own], minlength=len(terms)))))
            self.score((m, ids[low:low + width], terms, cuts, docs[own] - low, tfs[own]), adds, total)

    def score(self, block: tuple, adds: np.ndarray, total: np.ndarray) -> None:
        m, ids, terms, starts, docs, tfs = block
        asked = np.flatnonzero((total > 0) & (total >= self.least))
        if not len(asked):
            return
        different, which = np.unique(tfs, return_inverse=True)
        impacts = impact(different, m)[which]                 # once for each tf
        table = np.zeros((len(terms), len(ids)), np.int64)
        table[np.repeat(np.arange(len(terms)), np.diff(starts)), docs] = impacts
        row = np.full(len(self.weights), -1, np.int64)
        row[terms] = np.arange(len(terms))
        first = np.searchsorted(self.item, asked)
        last = np.searchsorted(self.item, asked, "right")
        for q, low, high in zip(asked.tolist(), first.tolist(), last.tolist()):
            own = row[self.term[low:high]]
            there = own >= 0
            own, gain, add = own[there], self.gain[low:high][there], adds[low:high][there]
            order = np.argsort(add)
            # terms that together stay below the least score can't bring a document in by themselves
            needed = order[np.cumsum(add[order]) >= max(self.least[q], 1)]
            found = np.zeros(len(ids), bool)
            for t in own[needed].tolist():
                found[docs[starts[t]:starts[t + 1]]] = True
            place = np.flatnonzero(found)
            scores = gain @ table[np.ix_(own, place)]
            good = (scores > 0) & (scores >= self.least[q])
            if good.any():
                self.keep(q, scores[good], ids[place[good]])

    def keep(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.best[q][0], scores)), np.concatenate((self.best[q][1], ids))
        order = np.lexsort((ids, -scores))[:self.top]
        self.best[q] = (scores[order], ids[order])
        if len(order) == self.top:
            self.least[q] = scores[order[-1]]


def search_index(index: DataFrame, items: Items, weights: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score): at least the ``top`` best documents of each item, by its number."""
    shared = index.sparkSession.sparkContext.broadcast((items, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Search(*shared.value, top)
        held: list[tuple] = []
        for batch in batches:
            lists = []
            for name in ("ids", "terms", "starts", "docs", "tfs"):
                column = batch.column(name)
                cuts, values = column.offsets.to_numpy(), column.values.to_numpy().astype(np.int64)
                lists.append([values[a:b] for a, b in zip(cuts, cuts[1:])])
            for block in zip(batch.column("m").to_pylist(), *lists):
                held.append(block)
                if len(held) == HELD_BLOCKS:
                    found.visit(held)
                    held = []
        found.visit(held)
        n = [len(s) for s, _ in found.best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(n)), n), pa.int64()),
             pa.array(np.concatenate([i for _, i in found.best] or [np.empty(0, np.int64)]), pa.int64()),
             pa.array(np.concatenate([s for s, _ in found.best] or [np.empty(0, np.int64)]), pa.int64())],
            names=["item", "doc_id", "score"])

    return index.mapInArrow(search, "item long, doc_id long, score long")


def best_of(found: DataFrame, top: int) -> DataFrame:
    """(item, rank, doc_id, score) of the ``top`` best rows of each item, ranked in parts first."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SPREAD))
    some = found.withColumn("part", part).withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
    some = some.where(F.col("r") <= top).drop("part", "r")
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .where(F.col("rank") <= top).select("item", "rank", "doc_id", "score"))


def search_group(docs: DataFrame, doc_id: Column, text: Column, rows: list, top: int, like: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    items, vocabulary = read_items(rows)
    counted = count_terms(docs, doc_id, text, vocabulary)
    totals = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in frequency.collect():                             # one row for each term of the group at most
        weights[r.term] = term_weight(totals.docs, r.df)
    index = build_index(counted, totals.docs, totals.words)
    ranked = best_of(search_index(index, items, weights, top), top)
    names = spark.createDataFrame([(k, i) for k, i in enumerate(items.ids)], f"item long, item_id {like.schema['item_id'].dataType.simpleString()}")
    return ranked.join(F.broadcast(names), "item").select(        # as many rows as the group has items
        "item_id", "rank", F.when(F.col("doc_id") < F.lit(int(np.iinfo(np.int64).max)), F.col("doc_id")).alias("doc_id"), "score")


def rank_documents(docs: DataFrame, doc_id: Column, text: Column, items: DataFrame, item_id: Column, item_text: Column,
                   top: int, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item."""
    asked = cut(items.select(item_id.alias("item_id"), item_text.cast("string").alias("item_text")), "search-items")
    # a text has at most about half as many words as bytes
    size = asked.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0)).alias("b")).first().b // 2
    groups = size // group_terms + 1
    if groups == 1:
        return search_group(docs, doc_id, text, asked.collect(), top, asked)
    part = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(groups))
    return reduce(DataFrame.unionByName, [search_group(docs, doc_id, text, asked.where(part == k).collect(), top, asked)
                                          for k in range(groups)])
