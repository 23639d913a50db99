"""Operator 13: byte-level BPE, encoded by backtracking over longest matches, and decoded again.

A text is cut into matches of a pattern; each match is encoded by itself. Its bytes are read as Latin-1
characters, so that one pass of an automaton over the vocabulary finds the longest token at every byte. The
encoder takes the longest token that is compatible with the one before it, tries its shorter prefixes otherwise,
and steps back when none fits; an offset that led nowhere is marked and never tried again, so the work
grows with the length of the match. Two adjacent tokens are compatible if the merges would leave exactly
these two: their last merges are undone, the later one first, and at each step the two tokens that touch
must not have a merge that comes before the one just undone. These verdicts are remembered. A sequence
whose neighbours are all compatible is the one that the merges produce, so the ids are exact.

The tables (the merge behind each token, its longest shorter prefix) come from the ranks alone, are built
once on the driver, and are broadcast: they are bounded by the vocabulary. A space before a character that
is not white space always opens a match of the pattern, so texts fall apart there; what follows
such a space is remembered by each worker up to a bound, as are single matches.

Defined results: null and empty texts have no ids and decode to no bytes; a match that is itself a token is
that token; special tokens don't exist, their strings are plain text; texts of any length and matches of
any length are encoded whole; equal rows are encoded alike; other columns are never looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, packed, ship

CACHE_UNITS = 300_000         # remembered stretches between spaces, of a worker
CACHE_MATCHES = 300_000       # remembered matches of the pattern
CACHE_PAIRS = 400_000         # remembered verdicts on adjacent tokens
LONGEST = 64                  # characters of what is remembered
SLICE = 1_000                 # rows handled at a time

_WORKER: dict = {}            # one encoder for each worker process and vocabulary


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """The rank file's lines (token in base64, rank) as token bytes -> rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the merges join last to form ``token``; None if they never form it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        made = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not made:
            return None
        at = min(made)[1]
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


class BytePairs:
    """What follows from the ranks: for each token its bytes, the parts of its last merge (itself twice for
    a single byte) and its longest proper prefix that is a token (-1 for none)."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.left, self.right = list(range(size)), list(range(size))
        self.shorter, self.reached = [-1] * size, []
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            parts = last_merge(token, ranks) if len(token) > 1 else None
            if parts:
                self.left[rank], self.right[rank] = ranks[parts[0]], ranks[parts[1]]
                if any(len(p) > 1 and ranks[p] > rank for p in parts):
                    raise ValueError("a token must rank after the tokens it is merged from")
            if parts or len(token) == 1:
                self.reached.append(token)
        known = set(self.reached)
        for token in self.reached:
            for n in range(len(token) - 1, 0, -1):
                if token[:n] in known:
                    self.shorter[ranks[token]] = ranks[token[:n]]
                    break


class Encoder:
    """Encodes and decodes with the tables of ``BytePairs``; matches of ``pattern`` are encoded one by one."""

    def __init__(self, tables: BytePairs, pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.left, self.right, self.shorter = tables.ranks, tables.left, tables.right, tables.shorter
        self.size = len(self.left)
        self.length = [0] * self.size
        self.merged = {}
        self.automaton = ahocorasick.Automaton()
        for token in tables.reached:
            rank = self.ranks[token]
            self.length[rank] = len(token)
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
            if self.left[rank] != rank:
                self.merged[self.left[rank], self.right[rank]] = rank
        self.automaton.make_automaton()
        self.matches = regex.compile(pattern).findall
        self.spaces = regex.compile(r" (?=\S)").split
        # what a plain split at spaces would get wrong; Python's white space holds all that the pattern's does
        self.odd = regex.compile(r" (?:[\s\x1C-\x1F]|$)").search
        self.verdicts: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        ordered = [b""] * self.size
        for token, rank in self.ranks.items():
            ordered[rank] = token
        self.token_length = np.array([len(t) for t in ordered], np.int64)
        self.token_start = np.concatenate(([0], np.cumsum(self.token_length)))[:-1]
        self.token_bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """``_stay_apart``, remembered."""
        if len(self.verdicts) >= CACHE_PAIRS:
            self.verdicts.clear()
        apart = self.verdicts[a * self.size + b] = self._stay_apart(a, b)
        return apart

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge joins bytes across the border of ``a`` and ``b`` while the two are made."""
        before = self.size                    # a merge across the border must come before this one
        while True:
            joined = self.merged.get((a, b))
            if joined is not None and joined < before:
                return False
            a_made, b_made = self.right[a] != a, self.left[b] != b
            if a_made and (a > b or not b_made):
                # of equal ranks the left merge comes first: only a strictly lower rank comes before it
                a, before = self.right[a], a
            elif b_made:
                b, before = self.left[b], b + 1
            else:
                return True

    def encode_match(self, match: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(match)
        if whole is not None:
            return [whole]
        end, size, length, shorter, verdicts = len(match), self.size, self.length, self.shorter, self.verdicts
        longest = [0] * end                   # at each offset; matches come by their last byte, so longer ones later
        for last, (reach, token) in self.automaton.iter(match.decode("latin-1")):
            longest[last - reach] = token
        alive = bytearray(b"\x01") * (end + 1)      # offsets from which the rest may still be encoded
        ids: list[int] = []
        at, before, token = 0, -1, longest[0]
        while at < end:
            while token >= 0:
                stop = at + length[token]
                if alive[stop]:
                    if before < 0:
                        break
                    apart = verdicts.get(before * size + token)
                    if apart is None:
                        apart = self.compatible(before, token)
                    if apart:
                        break
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at, before = stop, token
                if at < end:
                    token = longest[at]
            else:
                alive[at] = 0
                at -= length[before]
                token = shorter[ids.pop()]
                before = ids[-1] if ids else -1
        return ids

    def _ids(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers, match by match."""
        out = []
        for match in self.matches(text):
            held = self.pieces.get(match)
            if held is None:
                held = np.array(self.encode_match(match.encode()), np.int32).tobytes()
                if len(match) <= LONGEST:
                    if len(self.pieces) >= CACHE_MATCHES:
                        self.pieces.clear()
                    self.pieces[match] = held
            out.append(held)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as 32-bit integers."""
        units = text.split(" ") if self.odd(text) is None else self.spaces(text)
        out, seen = [self._ids(units[0])], self.units
        for unit in units[1:]:
            held = seen.get(unit)
            if held is None:
                held = self._ids(" " + unit)
                if len(unit) <= LONGEST:
                    if len(seen) >= CACHE_UNITS:
                        seen.clear()
                    seen[unit] = held
            out.append(held)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, joined."""
        length = self.token_length[ids]
        shift = np.repeat(self.token_start[ids] - np.cumsum(length) + length, length)
        return self.token_bytes[shift + np.arange(len(shift))]


def _encoder(key: tuple, tables: BytePairs) -> Encoder:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(tables, key[1])
    return _WORKER[key]


def lists(parts: list[bytes], value: np.dtype, of: pa.DataType) -> pa.ListArray:
    """One list for each of ``parts``, the bytes of its values."""
    offsets = np.concatenate(([0], np.cumsum([len(p) // np.dtype(value).itemsize for p in parts], dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), value), of))


class Codec:
    """``encode`` and ``decode`` as columns for one vocabulary, given as the bytes of its rank file."""

    def __init__(self, spark: SparkSession, rank_file: bytes, pattern: str):
        ship(spark)
        ranks = read_ranks(rank_file)
        shared = spark.sparkContext.broadcast(BytePairs(ranks))
        key = (hash(rank_file), pattern)

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = _encoder(key, shared.value)
            for batch in batches:
                yield lists([encoder.encode(t.as_py()) if t.is_valid else b"" for t in batch], np.int32, pa.int32())

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = _encoder(key, shared.value)
            for batch in batches:
                flat = batch.values.to_numpy(zero_copy_only=False)
                cuts = batch.offsets.to_numpy()
                yield pa.array([encoder.decode(flat[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())

        self._encode, self._decode, self._shared, self._key = encode, decode, shared, key

    def encode(self, text: Column) -> Column:
        """The token ids of ``text``; no ids for null."""
        return self._encode(text.cast("string"))

    def decode(self, ids: Column) -> Column:
        """The bytes that the ids stand for; none for null."""
        return self._decode(F.coalesce(ids, F.array().cast("array<int>")))


    def round_trip(self, docs: DataFrame, text: str) -> DataFrame:
        """``docs`` columns as struct ``row``, with ``ids`` and what these ids decode to, ``decoded``, by one worker for both."""
        shared, key = self._shared, self._key

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(key, shared.value)
            for whole in batches:
                for low in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(low, SLICE)
                    ids = [encoder.encode(t.as_py()) if t.is_valid else b"" for t in batch.column("text")]
                    decoded = [encoder.decode(np.frombuffer(i, np.int32)).tobytes() for i in ids]
                    yield pa.RecordBatch.from_arrays([batch.column("row"), lists(ids, np.int32, pa.int32()), pa.array(decoded, pa.binary())],
                                                     names=["row", "ids", "decoded"])

        rows = docs.select(packed(docs).alias("row"), col(text).cast("string").alias("text"))
        return rows.mapInArrow(both, rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.BinaryType()))
