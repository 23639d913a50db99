"""Operator 8: n-gram Jaccard self-join by MinHash banding.

1. Signatures: every whole text becomes its set of five-word shingles, a fingerprint of that set and
   the hashes of ``bands`` bands of ``rows`` minima each, chosen so that a pair at the threshold
   shares a band with probability ``RECALL``.
2. Texts of equal sets are one class; a class is joined as one node.
3. Banding: nodes are shuffled on band hashes. Those of a bucket are tied to its least node (a star,
   not all pairs); connected stars form candidate groups.
4. Verification on full shingle sets by matrix products. A candidate group of at most ``BLOCK`` nodes
   meets once and all its pairs are compared; small groups share tasks. A larger group is compared
   bucket by bucket, a pair in the first band that it shares and buckets of the same members once, or
   as a whole where that copies fewer texts: a chain of texts costs in proportion to its nodes, not to
   their square. What has more than ``BLOCK`` nodes is cut into blocks, and pairs of blocks are
   compared in tasks of their own. A task returns a row for each node (its number of links, its part
   of the link graph), never a row for each pair.
5. The linked nodes' connected components are the near-duplicate groups.

Defined results: null reads as empty text; texts without words equal only the same text; a text of
fewer than five words is one shingle; repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, cut, packed, ship
from .components import components
from .shingles import mixed, shingle_sets, slices

THRESHOLD = 0.8
RECALL = 0.999                # of pairs at the threshold
MAX_HASHES = 160
BLOCK = 500                   # nodes of a block
BIN = 1_000                   # nodes of small groups that share a task

_U = np.uint64


def band_shape(threshold: float, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows in a band, so the fewest chance meetings, for which bands enough
    to reach ``recall`` at ``threshold`` fit into ``max_hashes`` hash functions."""
    best = (1, 1)
    for rows in range(1, 33):
        hit = threshold ** rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    return best


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes of a row's id and text; null ids count as a value."""
    return [F.xxhash64(text, doc_id).alias("k1"), F.xxhash64(F.lit("second"), doc_id, text).alias("k2")]


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """(len(sets), bands) hashes of the bands of minima; every set must hold a shingle."""
    rng = np.random.default_rng(8)
    flip = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    times = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * _U(2) + _U(1)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sets), b + 1, np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            h = mixed(h + np.minimum.reduceat((flat ^ flip[k]) * times[k], starts))
        out[:, b] = h
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, k1, k2, s1, s2, bands): ``s1, s2`` fingerprint the set of shingles (of the text itself
    where it has no words, and then it has no bands)."""
    bands, rows = band_shape(threshold)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in slices(texts):
                sets = shingle_sets(texts[low:high])
                full = [k for k, s in enumerate(sets) if len(s)]
                # a wordless text equals only itself
                s1 = batch.column("t1").to_numpy()[low:high].view(np.uint64).copy()
                s2 = ~s1
                for k in full:
                    s1[k] = mixed(sets[k]).sum() + _U(len(sets[k]))
                    s2[k] = np.bitwise_xor.reduce(sets[k] * _U(0xD6E8FEB86659FD93))
                found: list = [None] * (high - low)
                if full:
                    for k, h in zip(full, band_hashes([sets[k] for k in full], bands, rows).view(np.int64)):
                        found[k] = h
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(s1.view(np.int64)),
                     pa.array(s2.view(np.int64)), pa.array(found, pa.list_(pa.int64()))],
                    names=["doc_id", "k1", "k2", "s1", "s2", "bands"])

    body = F.coalesce(col(text), F.lit(""))
    held = docs.select(col(doc_id).alias("doc_id"), *_row_key(col(doc_id), body), F.xxhash64(body).alias("t1"), body.alias("text"))
    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(sign, f"doc_id {kind}, k1 long, k2 long, s1 long, s2 long, bands array<long>")


def _local_roots(near: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id in each row's connected component of the symmetric relation ``near``."""
    root = ids.copy()
    top = np.iinfo(np.int64).max
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], top).min(axis=1))
        if (lower == root).all():
            return root
        root = lower


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``, by products of 0/1
    matrices over the shingles that occur on both sides, some thousand shingles at a time."""
    a, b = np.concatenate(left), np.concatenate(right)
    ra = np.repeat(np.arange(len(left)), [len(s) for s in left])
    rb = np.repeat(np.arange(len(right)), [len(s) for s in right])
    terms, count = np.unique(a, return_counts=True)
    if left is right:
        terms = terms[count > 1]
    else:
        terms = np.intersect1d(terms, b)
    out = np.zeros((len(left), len(right)), np.float32)
    if not len(terms):
        return out.astype(np.int64)

    def placed(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(terms, values), len(terms) - 1)
        ok = terms[at] == values
        at, rows = at[ok], rows[ok]
        order = np.argsort(at, kind="stable")
        return at[order], rows[order]

    ta, ra = placed(a, ra)
    tb, rb = (ta, ra) if left is right else placed(b, rb)
    width = 4096
    for low in range(0, len(terms), width):
        w = min(width, len(terms) - low)
        i, j = np.searchsorted(ta, (low, low + w))
        ma = np.zeros((len(left), w), np.float32)
        ma[ra[i:j], ta[i:j] - low] = 1
        if left is right:
            mb = ma
        else:
            i, j = np.searchsorted(tb, (low, low + w))
            mb = np.zeros((len(right), w), np.float32)
            mb[rb[i:j], tb[i:j] - low] = 1
        out += ma @ mb.T
    return np.rint(out).astype(np.int64)


VERIFIED = "node long, links long, linked_docs long, root long"


def _met_before(left: np.ndarray, right: np.ndarray, slot: int) -> np.ndarray:
    """Whether rows of band hashes share a band before ``slot``: their pair is compared there."""
    met = np.zeros((len(left), len(right)), bool)
    for b in range(slot):
        met |= left[:, b][:, None] == right[:, b][None, :]
    return met


def _verified(threshold: float):
    def verify(table: pa.Table) -> pa.Table:
        rows = table.select(["node", "slot", "unit", "side", "copies"]).to_pandas()
        bands = table.column("bands")
        texts = table.column("text").to_pylist()
        sets: list[np.ndarray] = []
        for low, high in slices(texts):
            sets += shingle_sets(texts[low:high])
        out: list[tuple[np.ndarray, ...]] = []
        for (slot, _), g in rows.groupby(["slot", "unit"], sort=False):
            ids, copies, side, at = g["node"].to_numpy(), g["copies"].to_numpy(), g["side"].to_numpy(), g.index.to_numpy()
            own = [sets[k] for k in at]
            size = np.array([len(s) for s in own])
            shares = np.array(bands.take(pa.array(at)).to_pylist(), np.int64) if slot >= 0 else None
            if (side == 0).all():
                both = overlaps(own, own)
                near = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
                np.fill_diagonal(near, False)
                if slot >= 0:
                    near &= ~_met_before(shares, shares, slot)
            else:       # two blocks: pairs across them alone
                l, r = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                near = np.zeros((len(ids), len(ids)), bool)
                if len(l) and len(r):
                    both = overlaps([own[k] for k in l], [own[k] for k in r])
                    hit = both >= threshold * (size[l][:, None] + size[r][None, :] - both) - 1e-9
                    if slot >= 0:
                        hit &= ~_met_before(shares[l], shares[r], slot)
                    near[np.ix_(l, r)], near[np.ix_(r, l)] = hit, hit.T
            links = near.sum(axis=1)
            some = links > 0
            if some.any():
                out.append((ids[some], links[some], (near @ copies)[some], _local_roots(near, ids)[some]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["node", "links", "linked_docs", "root"])

    return verify


def units(places: DataFrame, groups: DataFrame) -> DataFrame:
    """(node, slot, unit, n): the sets of ``n`` nodes whose pairs are compared. A candidate group is one
    (slot -1), or, if it has more than ``BLOCK`` nodes and that copies fewer texts, each of its buckets
    (slot and hash of the band). ``places`` are (node, slot, band), ``groups`` (node, component)."""
    copied = lambda n: F.col(n) * F.ceil(F.col(n) / BLOCK)
    # stored, as what follows is: the joins then shuffle both sides, and AQE can split a large group
    sizes = cut(groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")), "join-sizes")
    spots = places.join(groups.join(sizes.where(F.col("n") > BLOCK), "component"), "node")
    buckets = spots.groupBy("component", "slot", "band").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("node")).alias("f1"), F.bit_xor(F.xxhash64(F.lit("second"), "node")).alias("f2"))
    buckets = (buckets.where("m > 1").groupBy("component", "m", "f1", "f2").agg(F.min(F.struct("slot", "band")).alias("b"))
               .select("component", "m", "b.slot", "b.band"))
    buckets = cut(buckets, "join-buckets")
    cost = cut(buckets.groupBy("component").agg(F.sum(copied("m")).alias("cost")), "join-costs")
    sizes = cut(sizes.join(cost, "component", "left").select(
        "component", "n", F.coalesce(F.col("cost") < copied("n"), F.lit(False)).alias("by_bucket")), "join-plans")
    whole = groups.join(sizes.where("not by_bucket"), "component").select("node", F.lit(-1).alias("slot"), F.col("component").alias("unit"), "n")
    apart = places.join(groups.join(sizes.where("by_bucket"), "component"), "node").join(buckets, ["component", "slot", "band"])
    return cut(whole.union(apart.select("node", "slot", F.col("band").alias("unit"), F.col("m").alias("n"))), "join-units")


def unit_texts(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, slot, unit, copies, bands, text, side, task, low, high): a node's text for each pair of
    blocks of each of its units; (task, low, high) is a task's key."""
    body = F.coalesce(col(text), F.lit(""))
    bins = max(1, -(-wanted.count() // BIN))
    by_node = wanted.groupBy("node").agg(F.collect_list(F.struct("slot", "unit", "n")).alias("units"))     # one or at most one a band
    members = (by_node.join(nodes.select("node", "rank", "copies", "bands"), "node")
               .select("node", "units", "copies", F.when(F.col("units")[0]["slot"] >= 0, F.col("bands")).alias("bands"),
                       F.col("rank.k1").alias("k1"), F.col("rank.k2").alias("k2")))
    held = docs.select(*_row_key(col(doc_id), body), body.alias("text")).join(members, ["k1", "k2"])
    held = held.withColumn("again", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("node"))).where("again = 1")
    held = held.select("node", "copies", "bands", "text", F.explode("units").alias("u")).select(
        "node", "copies", "bands", "text", "u.slot", "u.unit", F.ceil(F.col("u.n") / BLOCK).cast("int").alias("blocks"))
    held = held.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    alone = F.col("blocks") == 1
    return held.select(
        "node", "slot", "unit", "copies", "bands", "text", F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
        F.when(alone, F.pmod(F.xxhash64("slot", "unit"), F.lit(bins))).otherwise(F.col("unit")).alias("task"),
        F.when(alone, -1).otherwise(F.least("own", "other")).alias("low"), F.when(alone, -1).otherwise(F.greatest("own", "other")).alias("high"))


def jaccard_join(docs: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: doc_id, k1, k2 (the row's key), class_id (least id among the
    documents linked directly or through others), n_links (other documents at or above the
    threshold, copies included), n_text_links (links to different sets of shingles), and ``first``:
    whether the row holds the key with which its class is represented."""
    ship(docs.sparkSession)
    body = F.coalesce(col(text), F.lit(""))
    signed = cut(signatures(docs, doc_id, text, threshold), "join-signatures")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("id"), F.col("k1").alias("k1"), F.col("k2").alias("k2"))
    nodes = (signed.groupBy("s1", "s2").agg(F.min(rank).alias("rank"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
             .withColumn("node", F.monotonically_increasing_id()))
    nodes = cut(nodes, "join-nodes")

    places = nodes.select("node", F.posexplode("bands").alias("slot", "band"))
    heads = places.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = places.join(heads, "band").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    groups = cut(components(stars), "join-groups")
    held = unit_texts(docs, doc_id, text, nodes, units(places, groups))
    verified = cut(held.groupBy("task", "low", "high").applyInArrow(_verified(threshold), VERIFIED), "join-verified")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    linked = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))

    classes = (nodes.join(links, "node", "left").join(linked, "node", "left")
               .withColumn("component", F.coalesce("component", "node")))
    classes = cut(classes, "join-classes")
    firsts = cut(classes.groupBy("component").agg(F.min("rank").alias("head")), "join-heads")
    classes = (classes.join(firsts, "component")
               .select("s1", "s2", F.col("head").alias("head"), F.coalesce("links", F.lit(0)).alias("n_text_links"),
                       (F.coalesce("linked_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    return (signed.select("doc_id", "k1", "k2", "s1", "s2").join(classes, ["s1", "s2"])
            .select("doc_id", "k1", "k2", F.col("head.id").alias("class_id"), "n_links", "n_text_links",
                    ((F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2"))).alias("first")))


def drop_near_duplicates(docs: DataFrame, doc_id: str, text: str, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the least id."""
    kept = jaccard_join(docs, doc_id, text, threshold).where("first").select("k1", "k2").distinct()
    body = F.coalesce(col(text), F.lit(""))
    held = docs.select(packed(docs).alias("row"), *_row_key(col(doc_id), body)).join(kept, ["k1", "k2"])
    again = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))
    return held.withColumn("again", again).where("again = 1").select("row.*")
