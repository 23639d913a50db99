"""Operator 12: alignment of two tokenizers by sparse products of incidence matrices.

Both tokenizers cover the same bytes. With A and B the token-by-byte incidence matrices, the product A·Bᵀ
holds, for each two tokens that overlap, how many bytes they share: the overlap links. Tokens linked by
a chain of overlaps form a group; a group ends where tokens of both sides end. The group incidences give the
shared-group links, again as a product. The matrices are compressed sparse rows built by hand; a row of a
product is gathered from the rows that its entries name (Gustavson), many rows at a time in numpy.

A space that follows another character than a space and precedes one that is not white space starts a token on
both sides, so a text falls apart there and each stretch is aligned by itself; each worker remembers
stretches up to a bound. If the two sides of a stretch have other bytes than the stretch, the text is encoded and
compared whole.

How many documents hold an id pair linked is an aggregation over the stored pairs of each document that
combines before its shuffle. The counts go back to the documents in two tiers: pairs held by many documents,
as many as ``HOT_PAIRS`` allows, are broadcast; the others meet theirs in a shuffled join.

Defined results: null and empty texts, and texts whose joined bytes on either side differ from space+text,
have no tokens, so no groups and links; strings of special tokens are plain text; equal rows are documents of
their own; an empty table gives no rows; a text without spaces of any length is one stretch, its products taken
in blocks of rows; other columns travel in the struct ``row``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col as column
from .common import cut, packed, ship, small_side

CACHE_UNITS = 300_000         # remembered stretches of a worker
CACHE_CHARS = 64_000_000      # characters of theirs and of their groups' texts
SLICE_CHARS = 1 << 20         # characters of the texts that are handled at a time, a longer text alone
BLOCK = 1 << 20               # entries of a product that are gathered at a time
HOT_PAIRS = 300_000           # rows of the broadcast tier

_WORKER: dict = {}


class Rows:
    """A sparse matrix of whole numbers as compressed rows: row r has the columns ``index[start[r]:start[r + 1]]``
    with the given values."""

    def __init__(self, start: np.ndarray, index: np.ndarray, value: np.ndarray, width: int):
        self.start, self.index, self.value, self.width = start, index, value, width

    @classmethod
    def of_entries(cls, row: np.ndarray, column: np.ndarray, value: np.ndarray, shape: tuple[int, int]) -> Rows:
        """From entries in any order, no two of the same place."""
        order = np.lexsort((column, row))
        start = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=shape[0]))))
        return cls(start, column[order], value[order], shape[1])

    def transposed(self) -> Rows:
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        return Rows.of_entries(self.index, row, self.value, (self.width, len(self.start) - 1))

    def times(self, other: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The product's entries (row, column, value), by row and column. Row r is the sum of those rows of
        ``other`` that the entries of row r name; blocks of rows bound what is held."""
        lengths = np.diff(other.start)[self.index]            # of the rows that each entry gathers
        upto = np.concatenate(([0], np.cumsum(lengths)))[self.start]
        out, first, rows = [], 0, len(self.start) - 1
        while first < rows:
            last = max(int(np.searchsorted(upto, upto[first] + BLOCK, "right")) - 1, first + 1)
            low, high = self.start[first], self.start[last]
            n = lengths[low:high]
            row = np.repeat(np.repeat(np.arange(first, last), np.diff(self.start[first:last + 1])), n)
            begin = np.cumsum(n) - n
            at = np.arange(len(row)) - np.repeat(begin, n) + np.repeat(other.start[self.index[low:high]], n)
            key, place = np.unique(row * other.width + other.index[at], return_inverse=True)
            value = np.zeros(len(key), np.int64)
            np.add.at(value, place, np.repeat(self.value[low:high], n) * other.value[at])
            out.append((key // other.width, key % other.width, value))
            first = last
        if not out:
            return tuple(np.empty(0, np.int64) for _ in range(3))
        return tuple(np.concatenate(x) for x in zip(*out))


def cover(ends: np.ndarray, n_bytes: int) -> Rows:
    """The token-by-byte incidence of tokens that end at ``ends``."""
    return Rows(np.concatenate(([0], ends)), np.arange(n_bytes), np.ones(n_bytes, np.int64), n_bytes)


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A·Bᵀ: (token of A, token of B, bytes that both cover)."""
    n = int(ends_a[-1]) if len(ends_a) else 0
    return cover(ends_a, n).times(cover(ends_b, n).transposed())


def token_groups(link_a: np.ndarray, link_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B. Links come in byte order; a new group opens where both tokens change."""
    opens = np.concatenate(([True], (np.diff(link_a) > 0) & (np.diff(link_b) > 0)))[:len(link_a)]
    group = np.cumsum(opens) - 1
    first = lambda x: np.concatenate(([True], np.diff(x) > 0))[:len(x)]
    # links are by token of A; those of B are in order too, since both sides cover the bytes from left to right
    return group[first(link_a)], group[first(link_b)]


def group_links(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray,
                n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The shared-group links by id: (group, id of A, id of B, occurrence pairs), from the group incidences of
    the distinct ids of each group."""
    def incidence(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, Rows]:
        key, n = np.unique(group << 32 | ids, return_counts=True)
        return key, Rows.of_entries(np.arange(len(key)), key >> 32, n, (len(key), n_groups))

    key_a, in_a = incidence(group_a, ids_a)
    key_b, in_b = incidence(group_b, ids_b)
    a, b, n = in_a.times(in_b.transposed())
    return key_a[a] >> 32, key_a[a] & 0xFFFFFFFF, key_b[b] & 0xFFFFFFFF, n


class Sides:
    """The two tokenizers. ``spec_a`` is the JSON of a byte-level BPE, ``model_b`` the bytes of a piece model."""

    def __init__(self, spec_a: str, model_b: bytes, pattern: str):
        import regex
        import sentencepiece
        import tiktoken

        parts = json.loads(spec_a)
        model, pre = parts["model"], parts.get("pre_tokenizer") or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                 and not pre.get("add_prefix_space") and not parts.get("normalizer") and not model.get("dropout")
                 and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
        if not plain:
            raise ValueError("side A must be a plain byte-level BPE")
        # the printable stand-ins of bytes, as byte-level vocabularies have them: printable Latin-1 for
        # itself, all others in order from U+0100 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}
        special = {t["content"] for t in parts.get("added_tokens") or []}
        ranks = {bytes(byte_of[c] for c in piece): rank for piece, rank in model["vocab"].items() if piece not in special}
        text_of = {rank: piece for piece, rank in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        base = len(ranks) - len(merges)
        if any(text_of.get(base + k) != a + b for k, (a, b) in enumerate(merges)):
            raise ValueError("the ids of side A must follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        bytes_a = {rank: token for token, rank in ranks.items()}
        bytes_b = [self._piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_a = [bytes_a.get(k, b"") for k in range(max(bytes_a) + 1)]
        self.bytes_b = bytes_b
        self.len_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.len_b = np.array([len(t) for t in bytes_b], np.int64)
        self.name_a, self.name_b = [[str(k) for k in range(len(x))] for x in (self.bytes_a, bytes_b)]
        # a piece with a space after another character could reach over the places where texts fall apart
        self.splits = not any("▁" in self.b.id_to_piece(k).lstrip("▁") for k in range(len(bytes_b)))
        self.spaces = regex.compile(r"(?<! ) (?=\S)").split
        self.odd = regex.compile(r"^[\s\x1C-\x1F]| (?:[\s\x1C-\x1F]|$)").search

    def _piece(self, k: int) -> bytes:
        if self.b.is_byte(k):
            return bytes([int(self.b.id_to_piece(k)[3:5], 16)])
        return self.b.id_to_piece(k).replace("▁", " ").encode()

    def units(self, text: str) -> list[str]:
        """The stretches of space+text, each without the space it starts with."""
        if not self.splits:
            return [text]
        if self.odd(text) is None:
            return text.split(" ")
        first, *rest = self.spaces(" " + text)
        return [first[1:], *rest] if first else rest


class Aligner:
    """Aligns stretches, remembers what it found: for each known stretch its counts, the text of its groups and its
    linked id pairs."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.width = len(sides.bytes_b)
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.counts: list[np.ndarray] = []      # blocks of (n_a, n_b, n_groups, n_links, first pair, pairs), a row a stretch
        self.pairs: list[np.ndarray] = []       # blocks of (pair, links)
        self.texts: list[str] = []
        self.n_pairs = self.weight = 0
        self.differ = False                     # whether any stretch has other bytes than its tokens
        self._joined = None

    def learn(self, units: list[str]) -> None:
        """Align stretches that aren't known yet. One is held with its number, or with -1 if a side's bytes differ."""
        sides = self.sides
        raw = [(" " + u).encode() for u in units]
        ids_a = [sides.a.encode_ordinary(" " + u) for u in units]
        ids_b = sides.b.encode(units, num_threads=1)
        same = [b"".join([sides.bytes_b[k] for k in y]) == r and b"".join([sides.bytes_a[k] for k in x]) == r
                for x, y, r in zip(ids_a, ids_b, raw)]
        good = [k for k, s in enumerate(same) if s]
        for k, s in enumerate(same):
            if not s:
                self.known[units[k]], self.differ = -1, True
        if not good:
            return
        n_a = np.array([len(ids_a[k]) for k in good])
        n_b = np.array([len(ids_b[k]) for k in good])
        flat_a = np.array([i for k in good for i in ids_a[k]], np.int64)
        flat_b = np.array([i for k in good for i in ids_b[k]], np.int64)
        # the stretches one after the other: both sides end with each, so no group reaches over two
        link_a, link_b, _ = overlap_links(np.cumsum(sides.len_a[flat_a]), np.cumsum(sides.len_b[flat_b]))
        group_a, group_b = token_groups(link_a, link_b)
        n_groups = int(group_a[-1]) + 1
        first_a = np.cumsum(n_a) - n_a
        last_group = group_a[first_a + n_a - 1]
        groups = np.diff(np.concatenate(([-1], last_group)))
        size_a, size_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
        starts = last_group + 1 - groups
        links = np.add.reduceat(size_a * size_b, starts)
        group, a, b, n = group_links(group_a, flat_a, group_b, flat_b, n_groups)
        unit = np.searchsorted(last_group, group)
        key, place = _by_pair(unit, a * self.width + b)
        total = np.zeros(key.shape[1], np.int64)
        np.add.at(total, place, n)
        held = np.bincount(key[0], minlength=len(good))
        self.counts.append(np.stack((n_a, n_b, groups, links, self.n_pairs + np.cumsum(held) - held, held), axis=1))
        self.pairs.append(np.stack((key[1], total)))
        self.n_pairs += key.shape[1]
        texts = self._group_texts(flat_a, size_a, flat_b, size_b)
        for k, low, high in zip(good, starts.tolist(), (last_group + 1).tolist()):
            self.known[units[k]] = len(self.texts)
            self.texts.append(";".join(texts[low:high]))
            self.weight += len(units[k]) + len(self.texts[-1])
        self._joined = None

    def _group_texts(self, flat_a: np.ndarray, size_a: np.ndarray, flat_b: np.ndarray, size_b: np.ndarray) -> list[str]:
        names_a = [self.sides.name_a[k] for k in flat_a.tolist()]
        names_b = [self.sides.name_b[k] for k in flat_b.tolist()]
        out, i, j = [], 0, 0
        for x, y in zip(size_a.tolist(), size_b.tolist()):
            out.append((names_a[i] if x == 1 else ",".join(names_a[i:i + x])) + "|"
                       + (names_b[j] if y == 1 else ",".join(names_b[j:j + y])))
            i, j = i + x, j + y
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        if self._joined is None:
            self.counts, self.pairs = [np.concatenate(self.counts)], [np.concatenate(self.pairs, axis=1)]
            self._joined = (self.counts[0], self.pairs[0])
        return self._joined

    def align(self, texts: list[str | None], keep_text: bool) -> list[tuple]:
        """For each text (n_a, n_b, n_groups, n_links, groups or their hash, pairs, links of each pair)."""
        if len(self.known) > CACHE_UNITS or self.weight > CACHE_CHARS:
            self.reset()
        units = [self.sides.units(t) if t else [] for t in texts]
        new = list(dict.fromkeys(u for us in units for u in us if u not in self.known))
        if new:
            self.learn(new)
        for k, us in enumerate(units if self.differ else []):
            if any(self.known[u] < 0 for u in us):      # the text as a whole decides
                if texts[k] not in self.known:
                    self.learn([texts[k]])
                units[k] = [texts[k]] if self.known[texts[k]] >= 0 else []
        nothing = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        used = [k for k, us in enumerate(units) if us]
        out: list[tuple] = [nothing] * len(texts)
        if used:
            counts, pairs = self.tables()
            size = np.array([len(units[k]) for k in used])
            at = np.fromiter((self.known[u] for k in used for u in units[k]), np.int64, int(size.sum()))
            sums = np.add.reduceat(counts[at, :4], np.cumsum(size) - size, axis=0)
            doc = np.repeat(np.arange(len(used)), size)
            key, often = np.unique(doc * len(counts) + at, return_counts=True)     # a stretch once for each document
            doc, at = key // len(counts), key % len(counts)
            held = counts[at, 5]
            place = np.arange(int(held.sum())) - np.repeat(np.cumsum(held) - held, held) + np.repeat(counts[at, 4], held)
            key, inverse = _by_pair(np.repeat(doc, held), pairs[0][place])
            links = np.zeros(key.shape[1], np.int64)
            np.add.at(links, inverse, pairs[1][place] * np.repeat(often, held))
            cuts = np.searchsorted(key[0], np.arange(len(used) + 1))
            for i, k in enumerate(used):
                text = ";".join([self.texts[self.known[u]] for u in units[k]])
                low, high = cuts[i], cuts[i + 1]
                out[k] = (*sums[i].tolist(), text if keep_text else hashlib.sha256(text.encode()).hexdigest(),
                          key[1][low:high], links[low:high])
        return out


def _by_pair(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of two columns in order, and where each row's pair stands among them."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.concatenate(([True], (np.diff(a) != 0) | (np.diff(b) != 0)))[:len(a)]
    place = np.empty(len(a), np.int64)
    place[order] = np.cumsum(new) - 1
    return np.stack((a[new], b[new])), place


def _aligner(key: int, shared: tuple) -> Aligner:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Aligner(Sides(*shared))
    return _WORKER[key]


def _runs(texts: list[str | None]) -> list[tuple[int, int]]:
    """Runs of texts of about ``SLICE_CHARS``."""
    out, first, size = [], 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > SLICE_CHARS:
            out.append((first, k))
            first, size = k, 0
        size += len(t or "")
    return out + [(first, len(texts))] if first < len(texts) else out


def link_documents(docs: DataFrame, text: Column, spec_a: str, model_b: bytes, pattern: str, keep_text: bool = False,
                   payload: list[str] | None = None) -> DataFrame:
    """A stored table, a row for each row of ``docs``: ``row_id``, ``row`` (struct of the ``payload`` columns), ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups`` (their text `a1,a2|b1;a3|b2,b3` with ``keep_text``, else its sha256; '' without
    tokens) and ``pairs``: array of (a, b, links), each linked id pair of the document once."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((spec_a, model_b, pattern))
    key = hash((spec_a, model_b, pattern))
    keep = packed(docs) if payload is None else F.struct(*[column(c).alias(c) for c in payload])
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), keep.alias("row"), text.cast("string").alias("text"))
    kinds = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<struct<a:int,b:int,links:long>>"
    pair = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("links", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(key, shared.value)
        for whole in batches:
            for low, high in _runs(whole.column("text").to_pylist()):       # a batch out for each run, so that pairs don't pile up
                batch = whole.slice(low, high - low)
                found = aligner.align(batch.column("text").to_pylist(), keep_text)
                flat, links = np.concatenate([f[5] for f in found]), np.concatenate([f[6] for f in found])
                cuts = np.concatenate(([0], np.cumsum([len(f[5]) for f in found]))).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array((flat // aligner.width).astype(np.int32)),
                                                     pa.array((flat % aligner.width).astype(np.int32)), pa.array(links)], fields=list(pair))
                columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row_id"), batch.column("row"), *columns, pa.array([f[4] for f in found], pa.string()),
                     pa.ListArray.from_arrays(pa.array(cuts), values)],
                    names=["row_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"])

    schema = rows.select("row_id", "row").schema
    for field in docs.sparkSession.createDataFrame([], kinds).schema:
        schema = schema.add(field)
    return cut(rows.mapInArrow(link, schema), "align-links")


def pair_counts(linked: DataFrame) -> DataFrame:
    """(a, b, held, best): how many documents hold a linked id pair, and whether no pair of its A id is held by more."""
    each = linked.select(F.explode("pairs").alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("held"))
    each = cut(each, "align-counts")
    most = cut(each.groupBy("a").agg(F.max("held").alias("most")), "align-most")       # one row for each id of the vocabulary
    return cut(each.join(small_side(most), "a").select("a", "b", "held", (F.col("held") == F.col("most")).alias("best")), "align-pairs")


def tier_limit(counts: DataFrame, rows: int) -> int:
    """The least power of two such that at most ``rows`` pairs are held by that many documents."""
    bits = F.floor(F.log2("held")).cast("int")
    total, limit = 0, 62
    for r in sorted(counts.groupBy(bits.alias("bits")).count().collect(), key=lambda r: -r["bits"]):       # 63 rows at most
        total += r["count"]
        if total > rows:
            break
        limit = r["bits"]
    return 1 << limit


def align(docs: DataFrame, text: Column, spec_a: str, model_b: bytes, pattern: str, keep_text: bool = False,
          hot_pairs: int = HOT_PAIRS, payload: list[str] | None = None) -> DataFrame:
    """``link_documents`` without the pairs but with ``n_best`` (links whose pair is held by as many documents as any pair of
    its A id) and ``count_sum`` (over the links, how many documents hold their pair)."""
    linked = link_documents(docs, text, spec_a, model_b, pattern, keep_text, payload)
    counts = pair_counts(linked)
    limit = tier_limit(counts, hot_pairs)
    hot = F.broadcast(counts.where(F.col("held") >= limit))            # at most ``hot_pairs`` rows
    each = linked.select("row_id", F.explode("pairs").alias("p")).select("row_id", "p.*")
    met = [each.join(hot, ["a", "b"]),
           each.join(hot, ["a", "b"], "left_anti").join(counts.where(F.col("held") < limit), ["a", "b"])]
    # the rows of a document stand together, so each sum combines them before its shuffle
    sums = [m.groupBy("row_id").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
                                    F.sum(F.col("links") * F.col("held")).alias("count_sum")) for m in met]
    total = sums[0].unionByName(sums[1]).groupBy("row_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return (linked.drop("pairs").join(total, "row_id", "left")
            .withColumns({"n_best": F.coalesce("n_best", zero), "count_sum": F.coalesce("count_sum", zero)}).drop("row_id"))
