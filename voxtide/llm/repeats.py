"""Operator 8, suffix-array dedup by merging Burrows-Wheeler transforms.

A byte goes if a 50-byte string covers it that also starts in a document with a
smaller id.

1. Candidates.  Each 50-byte window is represented by the smallest hash of its
   24-byte substrings, so equal windows have equal representatives.  Those met in
   two documents or more set bits of a bitmap of bounded size; chance hits only
   carry more text along.
2. Strings.  Neighbouring windows with one representative form a string (the
   windows and no more).  Strings whose representative passes the bitmap go to
   the bucket of the representative, each distinct one once per task with its
   smallest and largest document and a count, so copies of whole documents
   collapse before the shuffle.  Strings at the edges of a passage hold bytes of
   their own document and do not: those of a representative met over ``HOT`` times
   are sent window by window, as a 96-bit hash without its text that goes to a
   bucket of its own, and equal windows meet there.  No group of strings grows
   with a passage that many documents share.
3. Transforms.  In a bucket, windows of strings that share a 37-byte representative with
   another string are cut out and dealt to shards; each shard sorts its rotations
   and has its Burrows-Wheeler transform over ten-byte symbols (ordered by hash:
   any fixed order of symbols gives the same intervals).
4. Merge.  All shards of a bucket are merged by interleave refinement: the
   interleave, one shard number per suffix, is sorted stably by the transform's
   symbol, round by round.  Round r sets the borders between suffixes whose
   common prefix is r - 1 symbols; after five rounds the blocks between borders
   are the intervals of equal 50-byte windows, whose smallest document is read
   off.  No suffix is compared or sorted again.
5. The smallest documents return to the strings' places by a join on the string's
   96-bit hash, very common strings by broadcast, and the spans to their texts.

Defined results: a null text is empty; texts under 50 bytes lose nothing; rows
with one id are never smaller than each other; a null id is larger than any
other; repeated rows get equal results; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import Bitmap, Flat, blob, dealt_join, lean, materialize, mix, pieces, ranges, release, segment_hash

WINDOW, SYMBOL = 50, 10
FIRST, SECOND = 24, 37
PIECE, FLUSH_TOKENS, FLUSH_BYTES, SLICE, SHARD = 1 << 18, 1_000_000, 4 << 20, 1 << 19, 1 << 17
#: The bitmap of representatives: bits for each, and at most (64 MB).
MOST_BITS = 29
#: Representatives met more often (about: powers of two, up to twice this) send windows.
HOT = 1 << 13
_LAST = np.iinfo(np.int64).max
_VALUE = np.random.default_rng(8).integers(1, 2**64, 257, np.uint64, endpoint=False)
_P = 0xD6E8FEB86659FD93
_UP, _DOWN = [np.ones(1, np.uint64)], [np.ones(1, np.uint64)]


def gram_hashes(values: np.ndarray, q: int) -> np.ndarray:
    """Hash of each q values in a row."""
    n = len(values)
    if len(_UP[0]) < n + 1:
        size = max(n + 1, 1 << 20)
        _UP[0], _DOWN[0] = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, np.uint64(p))])) for p in (_P, pow(_P, -1, 2**64)))
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _UP[0][:n], out=run[1:])
    return mix((run[q:] - run[:n + 1 - q]) * _DOWN[0][:n + 1 - q])


def representatives(values: np.ndarray, q: int) -> np.ndarray:
    """For each start of a window, the smallest hash of its q-grams."""
    width = WINDOW - q + 1
    low, span = gram_hashes(values, q), 1
    n = len(low) - width + 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return np.minimum(low[:n], low[width - span:width - span + n])


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


class Strings:
    """The strings of a flat text: byte ``start``, number of ``windows``,
    representative ``token``, document number ``of``."""

    def __init__(self, flat: Flat):
        if len(flat.buf) < WINDOW:
            self.start = self.windows = self.of = np.zeros(0, np.int64)
            self.token = np.zeros(0, np.uint64)
            return
        token = representatives(_VALUE[flat.buf], FIRST)
        size = np.maximum(np.diff(flat.off) - WINDOW + 1, 0)
        at = ranges(flat.off[:-1], size)            # window starts, document by document
        of = np.repeat(np.arange(flat.n), size)
        token = token[at]
        new = np.ones(len(at), bool)
        new[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        most = WINDOW - FIRST + 1                   # longer runs of one representative are cut
        length = np.diff(np.append(first, len(at)))
        times = -(-length // most)
        nth = ranges(np.zeros(len(first), np.int64), times)
        first, length = np.repeat(first, times) + nth * most, np.minimum(np.repeat(length, times) - nth * most, most)
        self.start, self.windows, self.of, self.token = at[first], length, of[first], mix(token[first])


def _tokens(buckets: int):
    """Six bytes of each distinct representative of a task's documents by bucket;
    the lowest bit says that two documents of this pack have it, the next four how
    often it is met in the pack, as a power of two."""
    def pack(parts):
        token, doc = (np.concatenate(c) for c in zip(*parts))
        # a representative has 43 bits, numbers of a pack's ids fit below: one sort of plain numbers
        run = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        _, number = np.unique(doc[run], return_inverse=True)
        both = np.sort((token << np.uint64(16)) | np.repeat(number, np.diff(np.append(run, len(doc)))).astype(np.uint64))
        token, doc = both >> np.uint64(21) << np.uint64(5), both & np.uint64((1 << 21) - 1)
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        twice = np.zeros(len(token), np.uint8)
        twice[1:] = (token[1:] == token[:-1]) & (doc[1:] != doc[:-1])
        often = np.log2(np.diff(np.append(first, len(token)))).astype(np.uint64).clip(max=15)
        token = token[first] | (often << np.uint64(1)) | np.maximum.reduceat(twice, first)
        cut = np.searchsorted(((token >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))
        raw = token.view(np.uint8).reshape(-1, 8)[:, :6]
        full = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([blob(raw[cut[i]:cut[i + 1]]) for i in full], pa.binary())], ["bucket", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for part, flat in pieces(batch, limit=PIECE):
                s = Strings(flat)
                parts.append((_key(s.token) >> np.uint64(16), _ids(part.column(0))[s.of]))
                size += len(s.token)
                if size >= FLUSH_TOKENS:
                    yield pack(parts)
                    parts, size = [], 0
        if size:
            yield pack(parts)
    return run


def _repeated(group: pa.Table) -> pa.Table:
    raw = np.frombuffer(b"".join(group.column("tokens").to_pylist()), np.uint8).reshape(-1, 6)
    token = np.zeros((len(raw), 8), np.uint8)
    token[:, :6] = raw
    token = np.sort(token.view(np.uint64).ravel())
    name = token >> np.uint64(5)
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    packs = np.diff(np.append(first, len(token)))
    hit = (packs > 1) | (np.maximum.reduceat(token & np.uint64(1), first) == 1)
    n = np.add.reduceat(np.int64(1) << ((token >> np.uint64(1)) & np.uint64(15)).astype(np.int64), first)
    return pa.table({"token": pa.array((name[first[hit]] << np.uint64(21)).view(np.int64)), "n": pa.array(n[hit])})


def _key(token: np.ndarray) -> np.ndarray:
    """What the bitmap knows of a representative."""
    return (token >> np.uint64(21)) << np.uint64(21)


_STRINGS = "bucket int, size binary, body binary, k binary, t binary, low binary, above binary, n binary"
_NAMES = ["bucket", "size", "body", "k", "t", "low", "above", "n"]


def _candidates(flat: Flat, maybe: Bitmap, hot: Bitmap) -> tuple[np.ndarray, ...]:
    """Start, size, document number, representative and 96-bit hash (k, t) of the
    strings whose representative passes the bitmap; of hot ones each window, with
    size 0."""
    s = Strings(flat)
    pick = np.flatnonzero(maybe.has(_key(s.token)))
    start, size, of, token = s.start[pick], s.windows[pick] + WINDOW - 1, s.of[pick], s.token[pick]
    often = hot.has(_key(token))
    if often.any():
        count = np.where(often, s.windows[pick], 1)
        start, size, of, token = ranges(start, count), *(np.repeat(c, count) for c in (np.where(often, 0, size), of, token))
    ends = start + np.where(size == 0, WINDOW, size)
    return start, size, of, token, segment_hash(flat.buf, start, ends).view(np.int64), token.astype(np.uint32).view(np.int32)


def _strings(buckets: int, shared):
    """Distinct candidate strings of a task by bucket."""
    def pack(parts):
        size, k, t, ids, token, body = (np.concatenate(c) for c in zip(*parts))
        start = np.cumsum(size) - size
        order = np.argsort(k)                       # a hash met by two strings only leaves more rows
        k, t, ids = k[order], t[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])]))
        n = np.diff(np.append(first, len(k)))
        high, low, k, t, one = np.maximum.reduceat(ids, first), np.minimum.reduceat(ids, first), k[first], t[first], order[first]
        place = np.where(size[one] == 0, mix(k.view(np.uint64)), token[one])
        bucket = ((place >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(bucket, kind="stable")
        one, bucket = one[order], bucket[order]
        # mostly zeros and ones where a string is met once: they cost nothing on the way
        columns = [size[one].astype(np.int32), None, *(c[order] for c in (k, t, low, high - low, n.astype(np.int32)))]
        body = body[ranges(start[one], size[one])]
        ends = np.concatenate([[0], np.cumsum(size[one])])
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cut))
        packed = [[blob(body[ends[cut[i]]:ends[cut[i + 1]]] if c is None else c[cut[i]:cut[i + 1]]) for i in full] for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in packed)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, total = [], 0
        for batch in batches:
            for part, flat in pieces(batch, limit=PIECE):
                start, size, of, token, k, t = _candidates(flat, *shared.value)
                if not len(start):
                    continue
                parts.append((size, k, t, _ids(part.column(0))[of], token, flat.buf[ranges(start, size)]))
                total += int(size.sum()) + WINDOW * int((size == 0).sum())
                if total >= FLUSH_BYTES:
                    yield pack(parts)
                    parts, total = [], 0
        if total:
            yield pack(parts)
    return run


def _stable_order(key: np.ndarray) -> np.ndarray:
    """Stable sort order of numbers below 2**32: two passes over 16 bits."""
    order = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
    high = (key >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _order(key: np.ndarray) -> np.ndarray:
    """Stable sort order of numbers from 0: with their places below them as one
    plain number each, where that fits."""
    bits = max(len(key) - 1, 1).bit_length()
    if not len(key) or int(key.max()) >> (63 - bits):
        return np.argsort(key, kind="stable")
    return np.sort((key << bits) | np.arange(len(key))) & ((1 << bits) - 1)


class Transform:
    """Shards of strings, each with the sorted order of its rotations."""

    def __init__(self, body: np.ndarray, size: np.ndarray):
        length = size + 1                                   # a terminator each
        self.base = np.cumsum(length) - length
        total = int(length.sum())
        self.string = np.repeat(np.arange(len(size)), length)
        local = np.arange(total) - self.base[self.string]
        letters = np.zeros(total, np.int64)
        letters[local < size[self.string]] = body.astype(np.int64) + 1
        wrapped = ranges(np.zeros(len(size), np.int64), length + SYMBOL - 1)
        at = np.repeat(np.arange(len(size)), length + SYMBOL - 1)
        symbols = gram_hashes(_VALUE[letters[self.base[at] + wrapped % length[at]]], SYMBOL)
        symbols = symbols[ranges(np.cumsum(length + SYMBOL - 1) - (length + SYMBOL - 1), length)]
        of = length[self.string]
        self.before = self.base[self.string] + (local - SYMBOL) % of
        self.after = self.base[self.string] + (local + SYMBOL) % of
        self.window = local <= size[self.string] - WINDOW
        _, symbol = np.unique(symbols, return_inverse=True)
        self.symbol = symbol.astype(np.int64)
        ends = np.cumsum(length)
        last = np.unique(np.searchsorted(ends, np.arange(SHARD, total + SHARD, SHARD), "left").clip(max=len(size) - 1))
        self.shards = np.split(np.arange(total), ends[last][:-1]) if total else []

    def sorted_shard(self, places: np.ndarray) -> np.ndarray:
        """The shard's rotations in order, by doubling ranks of symbol prefixes."""
        lo = places[0]
        rank, step = self.symbol[places], self.after[places] - lo
        for doubling in range(9):
            key = rank * (len(places) + 1) + rank[step] if doubling else rank
            order = _order(key)
            rise = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            rank = np.empty(len(places), np.int64)
            rank[order] = rise
            if not doubling:
                continue
            if rise[-1] == len(places) - 1:
                break
            step = step[step]
        return places[order]

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """The merged order of all rotations and its blocks of equal windows."""
        listed = np.concatenate([self.sorted_shard(s) for s in self.shards])
        interleave = np.repeat(np.arange(len(self.shards)), [len(s) for s in self.shards])
        block = np.zeros(len(listed), np.int64)
        transform = self.symbol[self.before]                # the symbol before each rotation
        for _ in range(WINDOW // SYMBOL):
            merged = np.empty(len(listed), np.int64)
            merged[_stable_order(interleave)] = listed      # the i-th of a shard in the interleave is its i-th rotation
            symbol = transform[merged]
            order = _stable_order(symbol)
            symbol, block, interleave = symbol[order], block[order], interleave[order]
            block = np.concatenate([[0], np.cumsum((symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1]))])
        merged = np.empty(len(listed), np.int64)
        merged[_stable_order(interleave)] = listed
        return merged, block


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal hashes together, first places first, and what
    it goes by: the hash's top bits above the place, sorted as one plain number."""
    bits = max(len(hashes) - 1, 1).bit_length()
    both = np.sort((hashes >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(hashes), dtype=np.uint64))
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)


def smallest_owner(body: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For every window of distinct strings the smallest owner of a string that has it."""
    windows = size - WINDOW + 1
    out = np.repeat(owner, windows)
    start = np.cumsum(size) - size
    string = np.repeat(np.arange(len(size)), windows)
    at = ranges(start, windows)
    seen = representatives(_VALUE[body], SECOND)[at]
    order, seen = _grouped(seen)
    of = string[order]
    head = np.concatenate([[True], seen[1:] != seen[:-1]])
    other = np.zeros(len(seen), bool)
    other[1:] = ~head[1:] & (of[1:] != of[:-1])
    group = np.cumsum(head) - 1
    shared = np.zeros(len(seen), bool)
    shared[order] = np.bincount(group, other)[group] > 0
    if not shared.any():
        return out
    new = shared.copy()
    new[1:] &= ~(shared[:-1] & (string[1:] == string[:-1]))
    first = np.flatnonzero(new)
    run = np.cumsum(new)[shared] - 1
    count = np.bincount(run, minlength=len(first))
    text = Transform(body[ranges(at[first], count + WINDOW - 1)], count + WINDOW - 1)
    merged, block = text.blocks()
    value = np.where(text.window[merged], owner[string[first]][text.string[merged]], _LAST)
    edge = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    least = np.empty(len(merged), np.int64)
    least[merged] = np.minimum.reduceat(value, edge)[block]
    out[np.flatnonzero(shared)] = least[text.window]
    return out


def _resolve(group: pa.Table) -> pa.Table:
    """Per distinct string (or lone window): its count and the runs of windows that
    a document smaller than its largest one has, with that smallest document."""
    size, k, t, low, above, n = (np.frombuffer(b"".join(group.column(c).to_pylist()), kind) for c, kind in (
        ("size", np.int32), ("k", np.int64), ("t", np.int32), ("low", np.int64), ("above", np.int64), ("n", np.int32)))
    high = low + above
    body = np.frombuffer(b"".join(group.column("body").to_pylist()), np.uint8)
    size = size.astype(np.int64)
    start = np.cumsum(size) - size
    order = np.lexsort((low, t, k))
    first = np.flatnonzero(np.concatenate([[True], (k[order][1:] != k[order][:-1]) | (t[order][1:] != t[order][:-1])]))
    one = order[first]
    high, n = np.maximum.reduceat(high[order], first), np.add.reduceat(n[order].astype(np.int64), first)
    k, t, low, size, start = k[one], t[one], low[one], size[one], start[one]
    lone = np.flatnonzero((size == 0) & (low < high))
    zero = np.zeros(len(lone), np.int32)
    runs = pa.ListArray.from_arrays(pa.array(np.arange(len(lone) + 1), pa.int32()), pa.StructArray.from_arrays([pa.array(zero), pa.array(zero), pa.array(low[lone])], ["a", "b", "least"]))
    parts = [pa.table({"k": k[lone], "t": t[lone], "n": n[lone], "runs": runs})]
    # strings of different representatives share no window: a slice of representatives at a time
    by = np.argsort(t, kind="stable")
    by = by[size[by] > 0]
    k, t, low, high, n, size, start = (c[by] for c in (k, t, low, high, n, size, start))
    ends, a = np.cumsum(size), 0
    while a < len(t):
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SLICE, "right"))
        b = int(np.searchsorted(t, t[min(max(b, a + 1), len(t)) - 1], "right"))
        part = slice(a, b)
        least = smallest_owner(body[ranges(start[part], size[part])], size[part], low[part])
        found, lists = _runs(least, size[part], high[part])
        parts.append(pa.table({"k": k[part][found], "t": t[part][found], "n": n[part][found], "runs": lists}))
        a = b
    release()
    return pa.concat_tables(parts)


def _runs(least: np.ndarray, size: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The strings with a window that a document smaller than ``high`` has, and
    the runs of such windows with one smallest document."""
    windows = size - WINDOW + 1
    string = np.repeat(np.arange(len(size)), windows)
    hit = least < high[string]
    new = hit.copy()
    new[1:] &= ~hit[:-1] | (string[1:] != string[:-1]) | (least[1:] != least[:-1])
    head = np.flatnonzero(new)
    length = np.bincount(np.cumsum(new)[hit] - 1, minlength=len(head))
    of = string[head]
    first = head - (np.cumsum(windows) - windows)[of]
    found, offsets = np.unique(of, return_index=True)
    runs = pa.StructArray.from_arrays([pa.array(first, pa.int32()), pa.array(first + length - 1, pa.int32()), pa.array(least[head])], ["a", "b", "least"])
    return found, pa.ListArray.from_arrays(pa.array(np.append(offsets, len(head)), pa.int32()), runs)


def _places(shared, wanted):
    """Where the strings with a resolved run stand: k, t, position, id, text hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat in pieces(batch, limit=PIECE):
                start, _, of, _, k, t = _candidates(flat, *shared.value)
                ok = wanted.value.has(k.view(np.uint64))
                if not ok.any():
                    continue
                of, texts = of[ok], segment_hash(flat.buf, flat.off[:-1], flat.off[1:]).view(np.int64)
                place = (k[ok], t[ok], (start[ok] - flat.off[of]).astype(np.int32), _ids(part.column(0))[of], texts[of])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in place], ["k", "t", "pos", "id", "text_hash"])
    return run


def _digests(raw: np.ndarray, off: np.ndarray) -> pa.Array:
    view = memoryview(np.ascontiguousarray(raw))
    at = off.tolist()
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string())


def _kept(flat: Flat, of: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per document the removed bytes and maximal removed runs, and what stays of
    all with its offsets; the spans (document ``of``, bytes ``a`` to ``b``) may overlap."""
    edges = np.bincount(flat.off[of] + a, minlength=len(flat.buf) + 1) - np.bincount(flat.off[of] + b, minlength=len(flat.buf) + 1)
    gone = np.cumsum(edges)[:-1] > 0
    starts = gone.copy()
    starts[1:] &= ~gone[:-1]
    full = flat.off[:-1][flat.off[1:] > flat.off[:-1]]
    starts[full] = gone[full]                   # a run ends with its document
    removed, runs = (np.concatenate([[0], np.cumsum(c)])[flat.off] for c in (gone, starts))
    return np.diff(removed), np.diff(runs), flat.buf[~gone], flat.off - removed


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_RESULT_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _untouched(shared):
    """Result rows of documents that have no span for certain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.filter(pa.array(~shared.value.has(mix(_ids(batch.column(0)).view(np.uint64)))))
            for part, flat in pieces(rest):
                zero = pa.array(np.zeros(flat.n, np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(np.diff(flat.off)), zero, zero, _digests(flat.buf, flat.off)], _RESULT_NAMES)
    return run


def _touched(shared):
    """Documents that may have a span, with the hash of their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(shared.value.has(mix(_ids(batch.column(0)).view(np.uint64)))))
            for part, flat in pieces(some):
                texts = segment_hash(flat.buf, flat.off[:-1], flat.off[1:]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(_ids(part.column(0))), pa.array(texts), part.column(1)], ["doc_id", "id", "text_hash", "text"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, flat in pieces(batch):
            lists = part.column(2)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            a, b = (np.asarray(c, np.int64) for c in lists.flatten().flatten())
            removed, runs, left, off = _kept(flat, np.repeat(np.arange(flat.n), n), a, b)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in (np.diff(flat.off), removed, runs)), _digests(left, off)], _RESULT_NAMES)


def _screens(docs: DataFrame, buckets: int):
    """Broadcast bitmaps of the representatives met in two documents and of the hot ones."""
    tokens = docs.mapInArrow(lean(_tokens(buckets)), "bucket int, tokens binary")
    repeated = materialize(tokens.groupBy("bucket").applyInArrow(_repeated, "token bigint, n bigint"), "repeat-tokens")
    hot = repeated.where(F.col("n") > HOT)
    return docs.sparkSession.sparkContext.broadcast((Bitmap(repeated.select("token"), repeated.count(), MOST_BITS), Bitmap(hot.select("token"), hot.count(), MOST_BITS)))


def spans(docs: DataFrame) -> DataFrame:
    """(id, text_hash, spans): the byte ranges that go from each document that loses any."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = _screens(docs, buckets)
    # several buckets a task: a task holds one at a time.  The strings are not kept:
    # their places are found again in a second pass, which costs less than the disk
    strings = docs.mapInArrow(lean(_strings(4 * buckets, shared)), _STRINGS)
    resolved = materialize(strings.groupBy("bucket").applyInArrow(_resolve, "k bigint, t int, n bigint, runs array<struct<a: int, b: int, least: bigint>>"), "repeat-runs")
    wanted = spark.sparkContext.broadcast(Bitmap(resolved.select("k"), resolved.count(), MOST_BITS))
    places = docs.mapInArrow(lean(_places(shared, wanted)), "k bigint, t int, pos int, id bigint, text_hash bigint")
    total = resolved.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = dealt_join(places, resolved, ["k", "t"], "n", total, ["id", "pos"])
    run = met.select("id", "text_hash", "pos", F.explode("runs").alias("run")).where("run.least < id")
    one = F.struct((F.col("pos") + F.col("run.a")).alias("a"), (F.col("pos") + F.col("run.b") + WINDOW).alias("b"))
    return run.select("id", "text_hash", one.alias("span")).groupBy("id", "text_hash").agg(F.collect_set("span").alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = materialize(spans(texts), "repeat-spans")
    ids = found.select("id").mapInArrow(_hash_ids, "hash bigint")
    shared = docs.sparkSession.sparkContext.broadcast(Bitmap(ids, found.count(), MOST_BITS))
    touched = texts.mapInArrow(lean(_touched(shared)), "doc_id bigint, id bigint, text_hash bigint, text string")
    cut = touched.join(found, ["id", "text_hash"], "left").select("doc_id", "text", "spans").mapInArrow(lean(_cut), _RESULT)
    return texts.mapInArrow(lean(_untouched(shared)), _RESULT).unionByName(cut)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(b.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["hash"])
