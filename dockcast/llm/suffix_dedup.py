"""Operator 4: removal of repeated 50-byte passages with suffix arrays.

Every byte goes that a 50-byte string covers which also starts in a document of a smaller id.

1. Documents are dealt into parts and stored as a table bucketed by part; each later pass reads a part
   whole, without a shuffle.
2. Anchors: a 50-byte window is represented by its least 20-byte hash (a minimizer). Equal windows
   have equal anchors, so only anchors that occur in two documents matter. Each part asks for its
   distinct anchors, once each, in the bucket of their hash, and learns which are shared. (It asks with
   32 bits beside the bucket: a chance meeting adds work, never a result.)
3. Shards: each part sends the context of its shared anchors, all windows that the anchor represents,
   to the bucket of the hash; equal contexts of a part are sent once, with their least document id.
   A hot passage is therefore at most one context for each part. A hot anchor (a short phrase with
   different text around it) has a context for each occurrence: parts tell how many distinct ones
   they have, and beyond ``HOT_CONTEXTS`` the anchor is split. Its windows are dealt singly, each by
   the hash of all its 50 bytes, once a further round of requests has dropped those that occur in one
   document alone. Equal windows have one anchor, so they are all split or none is, and still meet.
4. Each shard of contexts gets a suffix array: suffixes are sorted by 8 bytes and refined by doubling
   (Larsson and Sadakane: only groups still equal are sorted again, by the rank of what follows) to
   50 bytes. Kasai's walk gives the common prefixes of neighbours; runs of at least 50 bytes are equal
   windows. Shards of one bucket are merged by binary search of their sorted windows. The least
   document id of every window goes back to the parts that asked.
5. Each part marks the windows that start in a smaller document and cuts their bytes.

Defined results: null text is empty; rows of one id count as one document; a row without an id is
left whole and removes nothing; repeated rows are each kept or cut; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.session import scratch_path

from .common import col, cut, ship
from .shingles import powers, mixed

SPAN = 50                     # bytes of a repeated string
GRAM = 20                     # bytes that an anchor's hash covers
PART_BYTES = 4 << 20          # text of a part, about
ASK_PARTS = 16                # parts whose distinct anchors fill a bucket of requests
SHARD_CONTEXTS = 20_000       # contexts of a suffix array
HOT_CONTEXTS = 5_000          # contexts of an anchor, beyond which its windows are dealt singly
MANY = 8                      # distinct contexts of an anchor in a part, from which on they are counted
SLICE_BYTES = 1 << 20

_U = np.uint64
_PLACE = _U((1 << 31) - 1)    # low bits of a window's key: the place; the others: the hash


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first window, number of windows, hash of the context) of every anchor; a run of windows
    with one minimizer.
    ``bounds`` has the documents' ends in ``data``; windows do not cross them."""
    n = len(data)
    none = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    if n < SPAN:
        return none
    power, inverse = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * power[:n], out=total[1:])
    gram = mixed((total[GRAM:] - total[:-GRAM]) * inverse[:n - GRAM + 1])
    least = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    width = SPAN - GRAM + 1
    have = 1
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    least = np.minimum(least[:len(least) - (width - have)], least[width - have:])     # one for each window
    ends = np.repeat(bounds, np.diff(np.concatenate(([0], bounds))))
    windows = np.flatnonzero(np.arange(SPAN, n + 1) <= ends[:n - SPAN + 1])
    if not len(windows):
        return none
    place = (least[windows] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1))))
    first, many = windows[new], np.diff(np.concatenate((new, [len(windows)])))
    context = mixed((total[first + many + SPAN - 1] - total[first]) * inverse[first])
    return gram[place[new]], first, many, context


def window_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The hash of the whole window at each place."""
    power, out = powers(SPAN)[0][:SPAN], [np.empty(0, np.uint64)]
    for k in range(0, len(places), 1 << 15):
        view = np.lib.stride_tricks.sliding_window_view(data, SPAN)[places[k:k + (1 << 15)]]
        out.append(mixed(((view.astype(np.uint64) + _U(1)) * power).sum(axis=1, dtype=np.uint64)))
    return np.concatenate(out)


def each_window(at: np.ndarray, n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, document id) of the single windows of runs."""
    return np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum())), np.repeat(ids, n)


class Part:
    """The documents of a part in a fixed order (id, text), their bytes in one buffer."""

    def __init__(self, table: pa.Table):
        ids, texts = table.column("doc_id").to_pylist(), table.column("body").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k]))
        self.rows, self.ids = order, [ids[k] for k in order]
        self.sizes = np.array([len(texts[k]) for k in order], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.text = b"".join([texts[k] for k in order])
        self.data = np.frombuffer(self.text, np.uint8)

    def anchored(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(hash, first window in ``data``, number of windows, document id, hash of the context) by runs
        of documents."""
        first = 0
        while first < len(self.ids):
            base = int(self.ends[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(self.ends, base + SLICE_BYTES, side="right")))
            ends = self.ends[first:last] - base
            h, at, n, context = anchors(self.data[base:base + int(ends[-1])], ends)
            doc = np.searchsorted(ends, at, side="right")
            known = np.array([i is not None for i in self.ids[first:last]])
            ids = np.array([i or 0 for i in self.ids[first:last]], np.int64)
            ok = known[doc] if len(doc) else np.empty(0, bool)
            yield h[ok], at[ok] + base, n[ok], ids[doc[ok]] if len(doc) else np.empty(0, np.int64), context[ok]
            first = last


def _packed_rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


ASKED = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("hashes", pa.binary()), ("many", pa.binary())])
ASKED_SQL = "bucket long, part long, hashes binary, many binary"
TOLD = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), ("shared", pa.binary()), ("whole", pa.bool_()),
                  ("contexts", pa.int64()), ("hot", pa.int64())])
TOLD_SQL = "part long, bucket long, shared binary, whole boolean, contexts long, hot long"
_EVEN = _U(0xFFFFFFFE)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> _U(33)) % _U(buckets)


def _key(h: np.ndarray, buckets: int) -> np.ndarray:
    return (_bucket(h, buckets) << _U(32)) | (h & _EVEN)


def _asked(part: int, key: np.ndarray, d: np.ndarray, context: np.ndarray | None = None) -> pa.Table:
    """A part's distinct keys by bucket, 31 bits each; the 32nd says that two documents of the part hold
    the key. ``many``: keys with at least ``MANY`` distinct contexts in the part, and how many."""
    if not len(key):
        return _packed_rows([], ASKED)
    order = np.argsort(key)
    key, d = key[order], d[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((starts, [len(key)])))
    many, number = np.empty(0, np.uint64), np.empty(0, np.int64)
    if context is not None:
        often = np.repeat(size >= MANY, size)
        k, c = key[often], context[order][often]
        by_context = np.lexsort((c, k))
        k, c = k[by_context], c[by_context]
        new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])))[:len(k)]
        many, number = np.unique(k[new], return_counts=True)
        many, number = many[number >= MANY], number[number >= MANY]
    twice = np.minimum.reduceat(d, starts) != np.maximum.reduceat(d, starts)
    key = key[starts] | twice.astype(np.uint64)
    rows = []
    for k in np.split(key, np.flatnonzero(np.diff(key >> _U(32))) + 1):
        bucket = k[0] >> _U(32)
        low, high = np.searchsorted(many, [bucket << _U(32), (bucket + _U(1)) << _U(32)])
        counted = np.stack((many[low:high].astype(np.uint32), number[low:high].astype(np.uint32)), axis=1)
        rows.append((int(bucket), part, k.astype(np.uint32).tobytes(), counted.tobytes()))
    return _packed_rows(rows, ASKED)


def _ask(buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        """A part's anchors."""
        found = [(h, d, c) for h, _, _, d, c in Part(table).anchored()]
        h, d, c = (np.concatenate(x) for x in zip(*found))
        return _asked(table.column("part")[0].as_py(), _key(h, buckets), d, c)

    return ask


def _ask_windows(buckets: int):
    def ask(table: pa.Table, told: pa.Table) -> pa.Table:
        """A part's windows of hot anchors."""
        if not table.num_rows or not told.num_rows:
            return _packed_rows([], ASKED)
        held, anchor = Part(table), Told(told, False)
        found = []
        for h, at, n, d, _ in held.anchored():
            hot = anchor.find(_key(h, buckets))[1]
            places, ids = each_window(at[hot], n[hot], d[hot])
            found.append((_key(window_hashes(held.data, places), buckets), ids))
        return _asked(table.column("part")[0].as_py(), *(np.concatenate(x) for x in zip(*found)))

    return ask


def _tell_shared(hot: int | None):
    """``hot``: the contexts beyond which an anchor is hot; None: the keys are those of whole windows."""
    def tell(table: pa.Table) -> pa.Table:
        """For each part of a bucket the keys that occur in two documents anywhere, 31 bits each; the
        32nd says that the anchor is hot. With the contexts that the others will send, and the hot ones."""
        bucket = table.column("bucket")[0].as_py()
        hashes = [np.frombuffer(x, np.uint32) for x in table.column("hashes").to_pylist()]
        many = [np.frombuffer(x, np.uint32).reshape(-1, 2) for x in table.column("many").to_pylist()]
        flat = np.concatenate(hashes)
        distinct, inverse, count = np.unique(flat & np.uint32(_EVEN), return_inverse=True, return_counts=True)
        shared = count > 1
        shared[inverse[(flat & np.uint32(1)) > 0]] = True
        total = count.astype(np.int64)
        for m in many:
            total[np.searchsorted(distinct, m[:, 0])] += m[:, 1].astype(np.int64) - 1
        split = shared & (total > hot) if hot is not None else np.zeros(len(distinct), bool)
        rows, low = [], 0
        for part, h, m in zip(table.column("part").to_pylist(), hashes, many):
            own = inverse[low:low + len(h)]
            own = own[shared[own]]
            counted = np.searchsorted(distinct, m[:, 0])
            more = int((m[:, 1].astype(np.int64) - 1)[shared[counted] & ~split[counted]].sum())
            rows.append((part, bucket, (distinct[own] | split[own].astype(np.uint32)).tobytes(), hot is None,
                         int((~split[own]).sum()) + more, int(split[own].sum())))
            low += len(h)
        return _packed_rows(rows, TOLD)

    return tell


class Told:
    """The shared keys of a part: of its anchors, or of its hot anchors' whole windows."""

    def __init__(self, told: pa.Table, whole: bool):
        keys = [(_U(b) << _U(32)) | np.frombuffer(x, np.uint32).astype(np.uint64) for b, x, w in
                zip(*(told.column(c).to_pylist() for c in ("bucket", "shared", "whole"))) if x is not None and w == whole]
        self.keys = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.uint64)
        self.hot = (self.keys & _U(1)) > 0
        self.keys &= ~_U(1)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are shared, and which are those of hot anchors."""
        if not len(self.keys):
            return np.zeros(len(key), bool), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = self.keys[at] == key
        return ok, ok & self.hot[at]


class Contexts:
    """The distinct contexts of a part's shared anchors, numbered by the bucket of their anchor, and
    where they occur. The same part gives the same numbers in every pass."""

    def __init__(self, held: Part, told: pa.Table, asked_buckets: int, buckets: int):
        anchor, window = Told(told, False), Told(told, True)
        number: dict[bytes, int] = {}
        hashes, least, several, places, numbers = [], [], [], [], []
        for h, at, n, d, _ in held.anchored() if len(anchor.keys) else ():
            ok, hot = anchor.find(_key(h, asked_buckets))
            if hot.any():               # their windows singly, by their own hash
                single, ids = each_window(at[hot], n[hot], d[hot])
                by = window_hashes(held.data, single)
                here = window.find(_key(by, asked_buckets))[0]
                ok &= ~hot
                h, at, n, d = (np.concatenate((x[ok], y[here])) for x, y in
                               ((h, by), (at, single), (n, np.ones(len(by), np.int64)), (d, ids)))
                ok = np.ones(len(h), bool)
            for hk, a, m, i in zip(h[ok].tolist(), at[ok].tolist(), n[ok].tolist(), d[ok].tolist()):
                c = number.setdefault(held.text[a:a + m + SPAN - 1], len(number))
                if c == len(hashes):
                    hashes.append(hk)
                    least.append(i)
                    several.append(0)
                elif i != least[c]:
                    several[c] = 1
                    least[c] = min(least[c], i)
                places.append(a)
                numbers.append(c)
        self.bucket = _bucket(np.array(hashes, np.uint64), buckets).astype(np.int64)
        self.order = np.argsort(self.bucket, kind="stable")
        renumbered = np.empty(len(hashes), np.int64)
        renumbered[self.order] = np.arange(len(hashes))
        self.texts, self.least, self.several = list(number), np.array(least, np.int64), np.array(several, np.uint8)
        self.places = np.array(places, np.int64)
        self.numbers = renumbered[np.array(numbers, np.int64)] if numbers else np.empty(0, np.int64)


SENT = pa.schema([("bucket", pa.int64()), ("part", pa.int64()), ("first_number", pa.int64()), ("size", pa.binary()),
                  ("least", pa.binary()), ("several", pa.binary()), ("text", pa.binary())])
SENT_SQL = "bucket long, part long, first_number long, size binary, least binary, several binary, text binary"


def _send(asked_buckets: int, buckets: int):
    def send(table: pa.Table, told: pa.Table) -> pa.Table:
        """A part's contexts by bucket: sizes, least ids, whether several documents of the part hold them,
        and their bytes; numbered on from ``first_number``."""
        if not table.num_rows:
            return _packed_rows([], SENT)
        part = table.column("part")[0].as_py()
        c = Contexts(Part(table), told, asked_buckets, buckets)
        rows, number = [], 0
        for pick in np.split(c.order, np.flatnonzero(np.diff(c.bucket[c.order])) + 1) if len(c.order) else ():
            own = [c.texts[k] for k in pick.tolist()]
            rows.append((int(c.bucket[pick[0]]), part, number, (np.array([len(x) for x in own]) - SPAN).astype(np.uint8).tobytes(),
                         c.least[pick].tobytes(), c.several[pick].tobytes(), b"".join(own)))
            number += len(pick)
        return _packed_rows(rows, SENT)

    return send


def suffix_ranks(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (starts of suffixes with ``SPAN`` bytes before their context's end) and their ranks:
    equal ranks mean equal windows, and ranks are in the windows' byte order.

    Ranks at depth 8 come from sorting 8 packed bytes; depth 2d from the ranks at depth d of a place
    and of the place d further on, sorted only inside groups that depth d leaves equal."""
    n = len(data)
    room = np.repeat(ends, np.diff(np.concatenate(([0], ends)))) - np.arange(n)      # bytes to the context's end
    eight = packed_bytes(data)
    places = np.flatnonzero(room >= 8)
    order = np.argsort(eight[places])
    key = eight[places[order]]
    rank = np.zeros(n, np.int64)
    rank[places[order]] = _group_starts(key[1:] != key[:-1])
    depth = 8
    while depth < SPAN:
        step = min(depth, SPAN - depth)
        places = np.flatnonzero(room >= depth + step)
        first = rank[places]
        equal = np.bincount(first, minlength=n + 1)[first] > 1        # groups not yet split up
        new = rank.copy()
        loose = places[equal]
        if len(loose):
            a, b = rank[loose], rank[loose + step]
            order = np.argsort((a << 32) | b)
            a, b, loose = a[order], b[order], loose[order]
            split = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            inside = _group_starts(split)
            group = _group_starts(a[1:] != a[:-1])
            new[loose] = a + (inside - group)                         # a group's ranks begin where its own did
        rank = new
        depth += step
    return places, rank[places]


def _group_starts(changes: np.ndarray) -> np.ndarray:
    """For sorted values with a change before each position but the first: where each one's group starts."""
    starts = np.concatenate(([0], np.where(changes, np.arange(1, len(changes) + 1), 0)))
    return np.maximum.accumulate(starts)


def packed_bytes(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as one number whose order is theirs (0 beyond the end)."""
    eight = np.zeros(len(data), np.uint64)
    for k in range(8):
        eight[:len(data) - k] |= data[k:].astype(np.uint64) << _U(56 - 8 * k)
    return eight


def common_prefixes(data: np.ndarray, places: np.ndarray, rank: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Kasai's walk: for the windows in suffix order, the bytes each shares with the one before, up to
    ``SPAN``. If a window differs from the one before it after some bytes, the next window of its
    context agrees with its own neighbour in at least one byte fewer, so the walk goes on from there
    (equal windows say nothing about the order of what follows: then it starts anew). All contexts
    are walked side by side, eight bytes at a time while they agree."""
    eight = packed_bytes(data)
    order = np.argsort(rank)
    sorted_places = places[order]
    before = np.full(len(data) + 1, -1, np.int64)
    before[sorted_places[1:]] = sorted_places[:-1]
    window = np.zeros(len(data) + 1, bool)
    window[places] = True
    prefix = np.zeros(len(data) + 1, np.int64)
    walk = np.concatenate(([0], ends[:-1]))
    left = np.diff(np.concatenate(([0], ends))) - SPAN + 1             # windows of each context
    agreed = np.zeros(len(walk), np.int64)
    alive = np.flatnonzero(left > 0)
    step = 0
    while len(alive):
        here = walk[alive] + step
        other = before[here]
        got = np.maximum(agreed[alive] - 1, 0)
        going = np.flatnonzero(other >= 0)
        while len(going):                                              # whole words
            going = going[got[going] <= SPAN - 8]
            going = going[eight[here[going] + got[going]] == eight[other[going] + got[going]]]
            got[going] += 8
        going = np.flatnonzero(other >= 0)
        while len(going):                                              # single bytes
            going = going[got[going] < SPAN]
            going = going[data[here[going] + got[going]] == data[other[going] + got[going]]]
            got[going] += 1
        got[other < 0] = 0
        prefix[here] = got
        agreed[alive] = np.where((got < SPAN) & (other >= 0) & window[other + 1], got, 0)
        step += 1
        alive = alive[left[alive] > step]
    return prefix[sorted_places]


def window_minima(data: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, group of each, least id of each group) of one shard's windows, groups in byte order."""
    places, rank = suffix_ranks(data, ends)
    order = np.argsort(rank)
    equal = common_prefixes(data, places, rank, ends) >= SPAN
    group_sorted = np.cumsum(~equal) - 1 if len(equal) else np.empty(0, np.int64)
    group = np.empty(len(places), np.int64)
    group[order] = group_sorted
    owner = ids[np.searchsorted(ends, places, side="right")]
    least = np.minimum.reduceat(owner[order], np.flatnonzero(~equal)) if len(equal) else np.empty(0, np.int64)
    return places, group, least


ANSWER = pa.schema([("part", pa.int64()), ("context", pa.binary()), ("first", pa.binary()), ("n", pa.binary()), ("least", pa.binary())])
ANSWER_SQL = "part long, context binary, first binary, n binary, least binary"


def _resolve(table: pa.Table) -> pa.Table:
    """For each part that sent contexts to this bucket: runs of windows with their least id, where
    that is smaller than an id the part has for the context."""
    column = {c: table.column(c).to_pylist() for c in ("part", "first_number", "size", "least", "several", "text")}
    number: dict[bytes, int] = {}
    least_of: list[int] = []
    asked = []
    for part, first, size, least, several, text in zip(*column.values()):
        own = np.frombuffer(least, np.int64)
        cuts = np.concatenate(([0], np.cumsum(np.frombuffer(size, np.uint8).astype(np.int64) + SPAN))).tolist()
        mine = []
        for k, i in enumerate(own.tolist()):
            c = number.setdefault(text[cuts[k]:cuts[k + 1]], len(number))
            if c == len(least_of):
                least_of.append(i)
            elif i < least_of[c]:
                least_of[c] = i
            mine.append(c)
        greatest = np.where(np.frombuffer(several, np.uint8) > 0, np.iinfo(np.int64).max, own)
        asked.append((part, first + np.arange(len(mine)), np.array(mine, np.int64), greatest))
    contexts, ids = list(number), np.array(least_of, np.int64)

    shards = []
    for first in range(0, len(contexts), SHARD_CONTEXTS):
        own = contexts[first:first + SHARD_CONTEXTS]
        data = np.frombuffer(b"".join(own), np.uint8)
        ends = np.cumsum([len(x) for x in own])
        places, group, least = window_minima(data, ends, ids[first:first + SHARD_CONTEXTS])
        names = None
        if len(contexts) > SHARD_CONTEXTS:      # the groups' windows themselves, in byte order
            where = np.empty(len(least), np.int64)
            where[group] = places
            names = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, SPAN)[where]).view(f"S{SPAN}").ravel()
        shards.append([ends, places, group, least, names])
    for k, mine in enumerate(shards):           # merge: each looks its windows up in every later one, both keep the least
        for other in shards[k + 1:]:
            at = np.minimum(np.searchsorted(other[4], mine[4]), len(other[4]) - 1)
            same = np.flatnonzero(other[4][at] == mine[4])
            both = np.minimum(mine[3][same], other[3][at[same]])
            mine[3][same] = both
            other[3][at[same]] = both

    # runs of windows of a context with one least id
    run_context, run_first, run_n, run_least = [], [], [], []
    for k, (ends, places, group, least, _) in enumerate(shards):
        starts = np.concatenate(([0], ends[:-1]))
        owner = np.searchsorted(ends, places, side="right")
        value = least[group]
        new = np.flatnonzero(np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))))
        run_context.append(owner[new] + k * SHARD_CONTEXTS)
        run_first.append(places[new] - starts[owner[new]])
        run_n.append(np.diff(np.concatenate((new, [len(places)]))))
        run_least.append(value[new])
    run_context, run_first, run_n, run_least = (np.concatenate(x) for x in (run_context, run_first, run_n, run_least))
    low = np.searchsorted(run_context, np.arange(len(contexts)))
    count = np.searchsorted(run_context, np.arange(len(contexts)), side="right") - low
    rows = []
    for part, context, mine, greatest in asked:
        each = np.repeat(np.arange(len(mine)), count[mine])
        offset = np.arange(len(each)) - np.repeat(np.cumsum(count[mine]) - count[mine], count[mine])
        run = low[mine][each] + offset
        useful = run_least[run] < greatest[each]
        run, each = run[useful], each[useful]
        rows.append((part, context[each].astype(np.int32).tobytes(), run_first[run].astype(np.uint8).tobytes(),
                     run_n[run].astype(np.uint8).tobytes(), run_least[run].astype(np.int64).tobytes()))
    return _packed_rows(rows, ANSWER)


def _cut_part(asked_buckets: int, buckets: int):
    def cut_part(table: pa.Table, told: pa.Table) -> pa.Table:
        """The documents of a part with the marked bytes cut."""
        schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])
        if not table.num_rows:
            return _packed_rows([], schema)
        held = Part(table)
        c = Contexts(held, told, asked_buckets, buckets)
        edge = np.zeros(len(held.data) + 1, np.int32)
        runs = [np.stack((np.frombuffer(context, np.int32).astype(np.int64), np.frombuffer(first, np.uint8).astype(np.int64),
                          np.frombuffer(n, np.uint8).astype(np.int64), np.frombuffer(least, np.int64)))
                for context, first, n, least in zip(*(told.column(x).to_pylist() for x in ("context", "first", "n", "least")))
                if context is not None]
        if len(c.places) and runs:
            run = np.concatenate(runs, axis=1)
            run = run[:, np.argsort(run[0])]
            low, high = np.searchsorted(run[0], c.numbers), np.searchsorted(run[0], c.numbers, side="right")
            count = high - low
            each = np.repeat(np.arange(len(c.numbers)), count)
            pick = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + low[each]
            ids = np.array([i or 0 for i in held.ids], np.int64)
            doc = ids[np.searchsorted(held.ends, c.places[each], side="right")]
            marked = run[3][pick] < doc
            start = c.places[each[marked]] + run[1][pick[marked]]
            stop = start + run[2][pick[marked]] + SPAN - 1
            edge += np.bincount(start, minlength=len(edge)).astype(np.int32)
            edge -= np.bincount(stop, minlength=len(edge)).astype(np.int32)
        gone = np.cumsum(edge[:-1]) > 0
        removed = np.concatenate(([0], np.cumsum(gone)))
        rows = []
        for i, a, b in zip(held.ids, (held.ends - held.sizes).tolist(), held.ends.tolist()):
            m, spans, kept = int(removed[b] - removed[a]), 0, held.text[a:b]
            if m:
                mask = gone[a:b]
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                kept = held.data[a:b][~mask].tobytes()
            rows.append((i, kept, m, spans))
        return _packed_rows(rows, schema)

    return cut_part


DEALT_SQL = "part long, doc_id long, body binary"


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they are, with the number of their part: a scan's task opens a new part where the next
    text would take the open one above ``PART_BYTES``. Only a longer text is a larger part, by itself."""
    part, held = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        numbers = []
        for n in pc.binary_length(batch.column("body")).to_pylist():
            if held and held + n > PART_BYTES:
                part, held = part + 1, 0
            held += n
            numbers.append(part)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), batch.column("doc_id"), batch.column("body")],
                                         names=["part", "doc_id", "body"])


def remove_repeats(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each row of ``docs``: doc_id, ``kept`` (binary, the remaining bytes), ``n_removed``,
    ``n_spans`` (maximal removed runs)."""
    spark = docs.sparkSession
    ship(spark)
    body = F.coalesce(col(text), F.lit("")).cast("binary")
    total = docs.select(F.sum(F.octet_length(col(text)))).first()[0] or 0
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), body.alias("body")).mapInArrow(_deal, DEALT_SQL)
    parts = max(1, -(-total // PART_BYTES))
    limit = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    # a bucketed table: each pass finds a part's rows together without another shuffle
    name = f"repeats_{uuid.uuid4().hex}"
    (rows.write.option("path", scratch_path(spark, "repeat-parts")).option("compression", "zstd")
     .bucketBy(min(max(1, -(-parts // 4)), limit), "part").saveAsTable(name))
    dealt = spark.table(name)
    spark.sql(f"DROP TABLE {name}")                  # of the catalog's entry alone: the files stay in the scratch folder
    ask = max(1, -(-parts // ASK_PARTS))
    by_part = lambda df: df.groupBy("part")

    asked = by_part(dealt).applyInArrow(_ask(ask), ASKED_SQL)
    shared = cut(asked.groupBy("bucket").applyInArrow(_tell_shared(HOT_CONTEXTS), TOLD_SQL), "repeat-shared")
    if shared.where("hot > 0").limit(1).count():
        asked = by_part(dealt).cogroup(by_part(shared.where("hot > 0"))).applyInArrow(_ask_windows(ask), ASKED_SQL)
        shared = shared.unionByName(cut(asked.groupBy("bucket").applyInArrow(_tell_shared(None), TOLD_SQL), "repeat-windows"))
    n_contexts = shared.select(F.sum("contexts")).first()[0] or 0
    buckets = max(1, -(-n_contexts // SHARD_CONTEXTS))
    sent = by_part(dealt).cogroup(by_part(shared)).applyInArrow(_send(ask, buckets), SENT_SQL)
    answers = sent.groupBy("bucket").applyInArrow(_resolve, ANSWER_SQL)
    told = shared.unionByName(answers, allowMissingColumns=True)
    return by_part(dealt).cogroup(by_part(told)).applyInArrow(
        _cut_part(ask, buckets), "doc_id long, kept binary, n_removed long, n_spans long")
