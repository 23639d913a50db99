"""Operator 10: token counts by a map-side two-tier lookup.

A space that follows a character and precedes another that is not white space always begins a new
pre-token of the byte-level tokenizer, so a text falls apart at its spaces into pieces whose token
counts add up. Tier one is a compact table of frequent pieces and their counts, built once from a
sample of bounded size and broadcast; it decides speed alone, never a result. Tier two is a
cache in each Python worker: pieces missed so far are encoded by the library, a batch at a time, and
remembered up to a bound. No piece is ever shuffled.

A piece that is empty or begins with white space may belong to a longer run of white space; a part
that holds one (or very long pieces) is encoded whole by the library. Strings of added tokens inside
a text are cut out first and count as one token each, which is the library's default.

Defined results: null and empty texts have 0 tokens; repeated rows are each counted.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

TABLE_ROWS = 2_000            # documents sampled for the table of frequent pieces
TABLE_PIECES = 50_000         # its size
CACHE_PIECES = 500_000        # remembered pieces of a worker
LONGEST = 64                  # characters of a piece that is remembered
SLICE = 200                   # texts handled at a time

_WORKER: dict = {}            # one counter for each worker process and tokenizer


class TokenCounter:
    """Counts tokens of texts as ``tokenizers`` does for ``spec`` (the tokenizer's JSON)."""

    def __init__(self, spec: str, table: dict[str, int] | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.table, self.cache = table or {}, {}
        parts = json.loads(spec)
        pre = parts.get("pre_tokenizer") or {}
        # the rule about spaces holds for the plain byte-level splitter; anything else goes to the library whole
        added = parts.get("added_tokens") or []
        self.splits = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                       and not parts.get("normalizer") and parts["model"]["type"] == "BPE"
                       and not any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added))
        self.added = re.compile("|".join(re.escape(t["content"]) for t in sorted(
            added, key=lambda t: -len(t["content"])))) if added else None

    def whole(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def parts(self, text: str) -> tuple[int, list[str]]:
        """Number of added tokens, and the parts of the text between them."""
        if self.added is None:
            return 0, [text]
        cut = self.added.split(text)
        return len(cut) - 1, cut

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [self.whole(t) if t else 0 for t in texts]
        counts, held, unknown, table, cache = [], [], set(), self.table, self.cache
        for at, text in enumerate(texts):
            n, parts = self.parts(text) if text else (0, [])
            counts.append(n)
            for part in parts:
                first, *pieces = part.split(" ")
                if any(not p or p[0].isspace() for p in pieces) or max(map(len, pieces), default=0) > LONGEST:
                    counts[at] += self.whole(part)
                    continue
                counts[at] += self.whole(first) if first else 0
                held.append((at, pieces))
                unknown.update(p for p in pieces if p not in table and p not in cache)
        if len(cache) + len(unknown) > CACHE_PIECES:
            # this slice's pieces stay, the rest is learned anew
            needed = {p for _, pieces in held for p in pieces if p in cache}
            self.cache = cache = {p: cache[p] for p in needed}
        missed = list(unknown)
        for p, e in zip(missed, self.library.encode_batch_fast([" " + p for p in missed], add_special_tokens=False)):
            cache[p] = len(e.ids)
        for at, pieces in held:
            counts[at] += sum([table[p] if p in table else cache[p] for p in pieces])
        return counts


def _counter(spec: str, table: dict[str, int]) -> TokenCounter:
    key = hash(spec)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TokenCounter(spec, table)
    return _WORKER[key]


def frequent_pieces(docs: DataFrame, text: Column, spec: str) -> dict[str, int]:
    """The most frequent pieces of a sample of about ``TABLE_ROWS`` documents with their token counts.
    Pieces are counted where the texts are, at most ``TABLE_PIECES`` for each task; only those counts
    are shuffled, and at most ``TABLE_PIECES`` pieces reach the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                seen.update(p for p in (t or "").split(" ")[1:] if p and not p[0].isspace() and len(p) <= LONGEST)
        top = seen.most_common(TABLE_PIECES)
        yield pd.DataFrame({"piece": pd.Series([p for p, _ in top], dtype=object), "n": pd.Series([n for _, n in top], dtype="int64")})

    share = min(1.0, TABLE_ROWS / max(docs.count(), 1))
    counts = docs.select(text.alias("text")).sample(False, share, 7).mapInPandas(count, "piece string, n long")
    top = counts.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(TABLE_PIECES)
    pieces = [r.piece for r in top.collect()]
    counter = TokenCounter(spec)
    encoded = counter.library.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)
    return {p: len(e.ids) for p, e in zip(pieces, encoded)}


def count_tokens(docs: DataFrame, text: Column, spec: str) -> Column:
    """A long column for ``docs``: the number of tokens of ``text`` under the tokenizer ``spec``."""
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((spec, frequent_pieces(docs, text, spec)))

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(*shared.value)
        for batch in batches:
            texts = batch.tolist()
            out: list[int] = []
            for k in range(0, len(texts), SLICE):
                out += counter.count(texts[k:k + SLICE])
            yield pd.Series(out, dtype="int64")

    return tokens(text)
