"""Operator 1, n-gram Jaccard join: size-banded tiles with bitmap signatures.

A document's set is its distinct 5-word shingles (64-bit hashes).  Documents with
equal sets form one class.

1. Candidates.  Two sets of similarity p % or more share a member among the first
   ``n - ceil(p n / 100) + 1`` of each, in any common order of all shingles.  The
   order is (frequent, hash): shingles met often in the hash-order prefixes of
   all documents come last.  The set of frequent shingles is a bitmap of at most 32 MB whose
   chance hits only move a shingle back, so every order it gives finds every
   pair.  The prefix members go to buckets as packed arrays, each with its place in
   the order, its set's size and a bitmap of 128 bits.  Of documents that share one,
   those get an edge whose sizes, places and bitmaps admit a link; within a bucket
   none are compared that earlier edges have joined, and only a forest of the
   edges leaves it.  Components of these edges hold every linked pair, and grow
   with what is alike, not with what shares a shingle by chance.
2. Tiles.  A component is a tile.  One of more than ``TILE`` classes or
   ``TILE_SHINGLES`` shingles is cut into size bands (a linked pair lies in the same or adjacent bands) and a band into
   blocks, of which every pair of blocks is a tile, so no task holds more than
   about two blocks of ``TILE`` sets and ``TILE_SHINGLES`` shingles (or two sets).
3. Screening.  Every set has a hashed parity bitmap of at least as many bits as
   members.  The differing bits of two bitmaps bound the overlap from above; a
   tile joins the sets whose bound admits a link, and never compares two that are
   joined.  Only the bitmaps travel here.
   Verification.  The sets of what is left, few but linked ones, travel to tiles
   as sorted arrays.  Pairs that the bound admits and that no earlier link has
   joined are intersected exactly.
4. Components of the verified links give each class its component.

Defined results: a null or empty text, or one without words, has no shingle and
is linked with nothing; fewer than five words make one shingle; rows with a null
id take part, and a component's id is its smallest id that is not null; repeated
rows link like copies; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import Bitmap, Flat, blob, keep_rows, lean, materialize, mix, pieces, ranges, release, segment_hash, spread_join
from voxtide.llm.components import _stars, components

WORDS = 5
#: A shingle in this many hash-order prefixes counts as frequent.
FREQUENT = 4
#: Classes of a tile, and prefix members that a task packs at once.
TILE, FLUSH = 1_000, 1_000_000
#: Shingles of a tile (32 MB): longer sets make smaller blocks.
TILE_SHINGLES = 4_000_000
#: Bits of the bitmap that travels with each prefix member, neighbours by size
#: that are compared first, and pairs that a task compares at once.
SKETCH, NEXT, PAIRS = 128, 8, 250_000
#: Prefix members with their bitmaps that a task packs at once, and buckets a shuffle partition.
ROWS, FINER = 400_000, 3
_K = [np.uint64(k) for k in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class Sets:
    """Sorted distinct shingle hashes of each document: ``values`` and ``off``."""

    def __init__(self, flat: Flat):
        starts, ends, at = flat.words()
        w = segment_hash(flat.buf, starts, ends, lower=True)
        n = np.diff(at)
        count = np.where(n >= WORDS, n - WORDS + 1, np.minimum(n, 1))
        off = np.concatenate([[0], np.cumsum(count)])
        values = np.empty(off[-1], np.uint64)
        if len(w) >= WORDS:
            g = w[:len(w) - WORDS + 1].copy()
            for k in range(1, WORDS):
                g += w[k:len(w) - WORDS + 1 + k] * _K[k]
            long = n >= WORDS
            values[ranges(off[:-1][long], count[long])] = g[ranges(at[:-1][long], count[long])]
        for k in range(1, WORDS):           # a short text is one shingle of its own kind
            short = np.flatnonzero(n == k)
            values[off[short]] = sum((w[at[short] + j] * _K[j] for j in range(k)), np.full(len(short), k, np.uint64) * _K[4])
        values = mix(values)
        for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
            values[a:b].sort()
        of = np.repeat(np.arange(flat.n), count)
        keep = np.ones(len(values), bool)
        keep[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
        self.values, self.of = values[keep], of[keep]
        self.n = np.bincount(self.of, minlength=flat.n)
        self.off = np.concatenate([[0], np.cumsum(self.n)])

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set that do not depend on the order."""
        out = []
        for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
            run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.values ^ np.uint64(salt)))])
            out.append(mix(run[self.off[1:]] - run[self.off[:-1]] + self.n.astype(np.uint64)).view(np.int64))
        return tuple(out)

    def places(self, frequent: Bitmap | None = None) -> np.ndarray:
        """Each value's place among those of its set, in the order of all shingles."""
        place = np.arange(len(self.values)) - self.off[self.of]
        if frequent is None:
            return place
        late = frequent.has(self.values)
        behind = np.concatenate([[0], np.cumsum(late)])
        before = behind[:-1] - behind[self.off[self.of]]            # frequent ones of the document so far
        rare = self.n - (behind[self.off[1:]] - behind[self.off[:-1]])
        return np.where(late, rare[self.of] + before, place - before)

    def prefixes(self, percent: int, places: np.ndarray | None = None) -> np.ndarray:
        """Which values belong to the prefixes."""
        length = np.where(self.n > 0, self.n + (-percent * self.n // 100) + 1, 0)
        return (self.places() if places is None else places) < length[self.of]

    def sketches(self) -> np.ndarray:
        """A row of ``SKETCH`` bits for each set: of which hashes it has an odd number."""
        odd = np.bincount(self.of * SKETCH + (self.values & np.uint64(SKETCH - 1)).astype(np.int64), minlength=len(self.n) * SKETCH) & 1
        return np.packbits(odd.astype(np.uint8)).reshape(len(self.n), -1)


def _bucket(tokens: np.ndarray, buckets: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _tokens(percent: int, buckets: int):
    """Packed hash-order prefix members by bucket, for counting; of one member no
    more than make it frequent."""
    def pack(parts):
        tokens = np.sort(np.concatenate(parts))
        tokens = tokens[np.concatenate([np.ones(len(tokens[:FREQUENT]), bool), tokens[FREQUENT:] != tokens[:-FREQUENT]])]
        cut = np.searchsorted(_bucket(tokens, buckets), np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([blob(tokens[cut[i]:cut[i + 1]]) for i in full], pa.binary())], ["bucket", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for _, flat in pieces(batch):
                s = Sets(flat)
                parts.append(s.values[s.prefixes(percent)])
                size += len(parts[-1])
                if size >= FLUSH:
                    yield pack(parts)
                    parts, size = [], 0
        if size:
            yield pack(parts)
    return run


def _often(least: int):
    def count(group: pd.DataFrame) -> pd.DataFrame:
        tokens = np.sort(np.frombuffer(b"".join(group["tokens"]), np.uint64))
        if len(tokens) < least:
            return pd.DataFrame({"token": np.zeros(0, np.int64)})
        many = tokens[least - 1:][tokens[least - 1:] == tokens[:len(tokens) - least + 1]]
        return pd.DataFrame({"token": np.unique(many).view(np.int64)})
    return count


def _describe(percent: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat in pieces(batch):
                s = Sets(flat)
                place = s.places(shared.value)
                pick = s.prefixes(percent, place)
                at = np.concatenate([[0], np.cumsum(pick)])[s.off]
                tokens, places, at = blob(s.values[pick]), blob(place[pick].astype(np.int32)), list(zip(at[:-1].tolist(), at[1:].tolist()))
                d1, d2 = s.digests()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(s.n), pa.array(d1), pa.array(d2),
                     pa.array([tokens[a * 8:b * 8] for a, b in at], pa.binary()), pa.array([places[a * 4:b * 4] for a, b in at], pa.binary()),
                     pa.array([blob(x) for x in s.sketches()], pa.binary()),
                     pa.array([blob(signature(s.values[a:b])) for a, b in zip(s.off[:-1].tolist(), s.off[1:].tolist())], pa.binary())],
                    ["doc_id", "n_shingles", "d1", "d2", "prefix", "place", "sketch", "sign"])
    return run


def _admitted(x, y, size, place, sketch, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of rows x, y that share a token, those that may be linked by
    it as the first one shared: the members before it are then in one set only,
    and the sketches' differing bits bound the overlap."""
    both = size[x] + size[y]
    need = -(-percent * both // (100 + percent))
    ok = np.flatnonzero((place[x] <= size[x] - need) & (place[y] <= size[y] - need))
    x, y, both, need = x[ok], y[ok], both[ok], need[ok]
    ok = (both - np.bitwise_count(sketch[x] ^ sketch[y]).sum(1, dtype=np.int64)) // 2 >= need
    return x[ok], y[ok]


def _spans(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (k, i) with low[k] <= i < high[k], about ``PAIRS`` at a time (one row's go together)."""
    many = np.maximum(high - low, 0)
    upto, at = np.cumsum(many), 0
    while at < len(many):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
        yield np.repeat(np.arange(at, to), many[at:to]), ranges(low[at:to], many[at:to])
        at = to


def _connect(token, vertex, size, place, sketch, percent: int) -> np.ndarray:
    """Rows (token, vertex, set size, place of the token, sketch) → edges from each
    vertex to the first of those that admitted pairs join it to."""
    order = np.argsort(token, kind="stable")
    fresh = np.concatenate([[True], token[order][1:] != token[order][:-1], [True]]) if len(token) else np.ones(1, bool)
    order = order[~(fresh[:-1] & fresh[1:])] if len(token) else order       # a token of one row joins nothing
    if not len(order):
        return np.zeros((0, 2), np.int64)
    order = order[np.lexsort((size[order], token[order]))]
    token, vertex, size, place, sketch = token[order], vertex[order], size[order].astype(np.int64), place[order], sketch[order]
    run = np.cumsum(np.concatenate([[False], token[1:] != token[:-1]]))
    names, vertex = np.unique(vertex, return_inverse=True)
    label = np.arange(len(names))

    def join(x, y):
        nonlocal label
        x, y = label[vertex[x]], label[vertex[y]]
        if (x != y).any():
            to = np.arange(len(names))
            of, least = _stars(x, y)
            to[of] = least
            label = to[label]

    for step in range(1, NEXT + 1):             # neighbours by size first: copies of a text are then joined
        k = np.arange(len(token) - step)
        k = k[(run[k] == run[k + step]) & (size[k + step] <= size[k] * 100 // percent) & (label[vertex[k]] != label[vertex[k + step]])]
        join(*_admitted(k, k + step, size, place, sketch, percent))
    # the largest component of each token is not compared with itself
    count = np.unique(np.stack([run, label[vertex]], 1), axis=0, return_counts=True)
    best = np.lexsort((count[1], count[0][:, 0]))
    last = best[np.concatenate([count[0][best][1:, 0] != count[0][best][:-1, 0], [True]])]
    main = label[vertex] == count[0][last, 1][run]
    order = np.lexsort((size, main, run))
    vertex, size, place, sketch, part = vertex[order], size[order], place[order], sketch[order], (run * 2 + main)[order]
    key = part * (1 << 32) + size
    few = np.flatnonzero(part % 2 == 0)
    least, most = -(-size[few] * percent // 100), size[few] * 100 // percent
    for low, high in ((few + 1, np.searchsorted(key, part[few] * (1 << 32) + most, "right")),
                      (np.searchsorted(key, (part[few] + 1) * (1 << 32) + least), np.searchsorted(key, (part[few] + 1) * (1 << 32) + most, "right"))):
        for x, y in _spans(low, high):
            x = few[x]
            apart = label[vertex[x]] != label[vertex[y]]
            join(*_admitted(x[apart], y[apart], size, place, sketch, percent))
    joined = label != np.arange(len(names))
    return np.stack([names[joined], names[label[joined]]], 1)


_FIELDS = {"token": np.uint64, "vertex": np.int64, "size": np.int32, "place": np.int32, "sketch": np.uint64}
_PACKED = ", ".join(["bucket int", *(f"{name} binary" for name in _FIELDS)])


def _scatter(buckets: int):
    """Prefix members of the documents by bucket."""
    def pack(parts):
        rows = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(rows[0])
        rows = [c[order] for c in rows]
        cut = np.searchsorted(_bucket(rows[0], buckets), np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cut))
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array([blob(c[cut[i]:cut[i + 1]]) for i in full], pa.binary()) for c in rows)], ["bucket", *_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            n, vertex = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            prefix, place, sketch = (batch.column(i).to_pylist() for i in (2, 3, 4))
            _, once = np.unique(vertex, return_index=True)      # copies send their prefix once
            for k in range(0, len(once), 1000):
                some = once[k:k + 1000]
                length = np.array([len(prefix[i]) // 8 for i in some], np.int64)
                of = np.repeat(np.arange(len(some)), length)
                own = np.frombuffer(b"".join(sketch[i] for i in some), np.uint64).reshape(len(some), -1)
                parts.append((np.frombuffer(b"".join(prefix[i] for i in some), np.uint64), vertex[some][of], n[some][of].astype(np.int32),
                              np.frombuffer(b"".join(place[i] for i in some), np.int32), own[of]))
                size += len(of)
                if size >= ROWS:
                    yield pack(parts)
                    parts, size = [], 0
        if size:
            yield pack(parts)
    return run


def _meet(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(b"".join(group[name]), kind) for name, kind in _FIELDS.items()]
        edges = _connect(*rows[:-1], rows[-1].reshape(len(rows[0]), -1), percent)
        del rows
        release()
        return pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})
    return run


def _fetch(shared):
    """The sets of documents whose id may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
            wanted = batch.filter(pa.array(shared.value.has(mix(ids.astype(np.uint64)))))
            for _, flat in pieces(wanted):
                s = Sets(flat)
                d1, d2 = s.digests()
                values = blob(s.values)
                yield pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), pa.array([values[a * 8:b * 8] for a, b in zip(s.off[:-1].tolist(), s.off[1:].tolist())], pa.binary())],
                                                 ["d1", "d2", "members"])
    return run


def signature(members: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set, with a power of two bits, at least as many as members."""
    width = 1 << max(6, int(len(members) - 1).bit_length())
    odd = np.bincount((members & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


class Signatures:
    """Bitmaps by width.  A bitmap folds to half its width by XOR of its halves,
    so two sets of neighbouring sizes are compared at the width of the smaller."""

    def __init__(self, signs: list[np.ndarray]):
        self.width = np.array([len(s) for s in signs])
        self.place, self.table = {}, {}
        for w in np.unique(self.width).tolist():
            here, double = np.flatnonzero(self.width == w), np.flatnonzero(self.width == 2 * w)
            rows = [signs[i] for i in here] + [signs[i][:w] ^ signs[i][w:] for i in double]
            self.place[w] = np.full(len(signs), -1)
            self.place[w][np.concatenate([here, double])] = np.arange(len(rows))
            self.table[w] = np.stack(rows)

    def differing(self, i: int, j: np.ndarray) -> np.ndarray:
        """Bits in which set i differs from each larger set j of at most twice its width."""
        w = int(self.width[i])
        table, place, out = self.table[w], self.place[w], np.zeros(len(j), np.int64)
        for k in range(0, w, 64):               # in columns, to keep the scratch array small
            out += np.bitwise_count(table[place[j], k:k + 64] ^ table[place[i], k:k + 64]).sum(1, dtype=np.int64)
        return out


def link(n: np.ndarray, signs: list[np.ndarray], allowed, percent: int, sets: list[np.ndarray] | None = None) -> np.ndarray:
    """Component labels of sets in ascending size ``n``: of the pairs that the
    bitmaps admit, or with ``sets`` of those that also overlap enough.
    ``allowed(i, j)`` says which later sets ``j`` this tile compares with ``i``."""
    bits, label = Signatures(signs), np.arange(len(n))
    for i in range(len(n) - 1):
        j = np.arange(i + 1, int(np.searchsorted(n, n[i] * 100 // percent, "right")))
        j = j[(label[j] != label[i]) & allowed(i, j)]
        if not len(j):
            continue
        need = -(-percent * (n[i] + n[j]) // (100 + percent))
        maybe = (n[i] + n[j] - bits.differing(i, j)) // 2 >= need
        for other, least in zip(j[maybe].tolist(), need[maybe].tolist()):
            if label[other] == label[i]:
                continue
            if sets is not None:
                at = np.searchsorted(sets[other], sets[i])
                at[at == len(sets[other])] = 0
                if int((sets[other][at] == sets[i]).sum()) < least:
                    continue
            label[label == label[other]] = label[i]
    return label


def _tile_links(percent: int, exact: bool):
    """Edges from each class of a tile to one class of its component."""
    held = 0                            # shingles since memory was released: most tiles are too small to pay for it

    def run(group: pd.DataFrame) -> pd.DataFrame:
        nonlocal held
        group = group.sort_values(["n_shingles", "cls"])
        sets = [np.frombuffer(m, np.uint64) for m in group["members"]] if exact else None
        signs = [signature(s) for s in sets] if exact else [np.frombuffer(s, np.uint64) for s in group["sign"]]
        first, block, (low, part, other) = group["band"].to_numpy(), group["block"].to_numpy(), group[["tile_band", "tile_a", "tile_b"]].iloc[0]

        def allowed(i: int, j: np.ndarray) -> np.ndarray:
            ok = np.ones(len(j), bool)
            if low >= 0:                            # of two neighbouring bands: not both in the upper one
                ok &= (first[i] == low) | (first[j] == low)
            if part != other:
                ok &= block[i] != block[j]
            return ok
        label = link(group["n_shingles"].to_numpy(), signs, allowed, percent, sets)
        cls = group["cls"].to_numpy()
        out = pd.DataFrame({"a": cls, "b": cls[label]})
        held += int(group["n_shingles"].sum())
        del sets, signs, group
        if held > FLUSH:
            release()
            held = 0
        return out[out["a"] != out["b"]]
    return run


def near_duplicates(docs: DataFrame, percent: int = 80, tile: int = TILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, and the
    set's digest (d1, d2) and group (null: linked with nothing)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    buckets = FINER * int(spark.conf.get("spark.sql.shuffle.partitions"))

    counted = texts.select("text").mapInArrow(lean(_tokens(percent, buckets)), "bucket int, tokens binary")
    often = counted.groupBy("bucket").applyInPandas(_often(FREQUENT), "token bigint")
    often = materialize(often, "shingle-frequent")
    frequent = spark.sparkContext.broadcast(Bitmap(often, often.count(), 28))
    rows = materialize(texts.mapInArrow(lean(_describe(percent, frequent)), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, prefix binary, place binary, sketch binary, sign binary"), "shingle-rows")

    packed = rows.where("n_shingles > 0").select("n_shingles", "d1", "prefix", "place", "sketch").mapInArrow(lean(_scatter(buckets)), _PACKED)
    near = components(packed.groupBy("bucket").applyInPandas(_meet(percent), "a bigint, b bigint"))

    classes = (rows.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min("n_shingles").alias("n_shingles"), F.min("doc_id").alias("least_id"),
                                                                     F.count("*").alias("copies"), F.first("sign").alias("sign"))
               .withColumn("cls", F.monotonically_increasing_id()))
    classes = materialize(classes, "shingle-classes")
    key = ["root", "tile_band", "tile_a", "tile_b"]
    tiles = _tiles(classes.join(near.select(F.col("vertex").alias("d1"), "root"), "d1"), percent, tile)
    maybe = components(tiles.groupBy(*key).applyInPandas(_tile_links(percent, False), "a bigint, b bigint"))

    tiles = materialize(_tiles(classes.drop("sign").join(maybe.withColumnRenamed("vertex", "cls"), "cls"), percent, tile), "shingle-tiles")
    wanted = tiles.select(F.coalesce("least_id", F.lit(-1)).alias("id")).distinct().mapInArrow(_hash_ids, "hash bigint")
    wanted = spark.sparkContext.broadcast(Bitmap(wanted, tiles.count()))
    sets = texts.mapInArrow(lean(_fetch(wanted)), "d1 bigint, d2 bigint, members binary").join(tiles, ["d1", "d2"]).dropDuplicates([*key, "cls"])
    links = sets.groupBy(*key).applyInPandas(_tile_links(percent, True), "a bigint, b bigint")
    return _named(rows, classes, components(links))


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(b.column(0).to_numpy().astype(np.uint64)).view(np.int64))], ["hash"])


def _tiles(classes: DataFrame, percent: int, tile: int) -> DataFrame:
    """``classes`` with a component ``root``, one row per tile that each is part of."""
    crowd = classes.groupBy("root").agg(F.count("*").alias("crowd"), F.sum("n_shingles").alias("mass")).where("crowd > 1")
    width = F.log(F.lit(100 / percent * 1.008))
    spot = classes.join(crowd, "root").withColumn("band", F.when((F.col("crowd") <= tile) & (F.col("mass") <= TILE_SHINGLES), -1).otherwise(F.floor(F.log("n_shingles") / width)).cast("int"))
    spot = spot.withColumn("tile_band", F.explode(F.when(F.col("band") < 0, F.array(F.lit(-1))).otherwise(F.array(F.col("band"), F.col("band") - 1)))).where("band < 0 or tile_band >= 0")
    sizes = spot.groupBy("root", "tile_band").agg(F.least(F.count("*"), F.ceil(F.greatest(F.count("*") / F.lit(tile), F.sum("n_shingles") / F.lit(TILE_SHINGLES)))).cast("int").alias("blocks"))
    spot = spot.join(sizes, ["root", "tile_band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    spot = spot.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spot.withColumn("tile_a", F.least("block", "with")).withColumn("tile_b", F.greatest("block", "with")).drop("crowd", "mass", "blocks", "with", "copies")


def _named(rows: DataFrame, classes: DataFrame, joined: DataFrame) -> DataFrame:
    """Each row's component: the smallest id of all classes joined to its own."""
    of = classes.select("cls", "d1", "d2", "copies", "least_id").join(joined.select(F.col("vertex").alias("cls"), F.col("root").alias("home")), "cls", "left")
    homes = of.where("home is not null").groupBy("home").agg(F.min("least_id").alias("home_id"))
    of = of.join(homes, "home", "left").withColumn("component_id", F.coalesce("home_id", "least_id")).where("home is not null or copies > 1")
    of = materialize(of.select("d1", "d2", "copies", "component_id", F.coalesce("home", "cls").alias("group")), "shingle-components")
    some = rows.where("n_shingles > 0").select("doc_id", "n_shingles", "d1", "d2")
    joined_rows = spread_join(some, of, ["d1", "d2"], "copies", rows.count())
    none = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "d1", "d2", F.lit(None).cast("bigint").alias("group"))
    # a class of one row without links has no entry: its row is its own component
    own = F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return joined_rows.select("doc_id", "n_shingles", own, "d1", "d2", "group").unionByName(none)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, flat in pieces(batch):
            yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, Sets(flat).digests())], [*part.schema.names, "d1", "d2"])


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of linked ones, that of the
    smallest id, of rows that tie one of equal sets; documents without shingles
    stay.  All columns as they are."""
    found = materialize(near_duplicates(docs, percent).withColumn("row", F.monotonically_increasing_id()), "shingle-groups")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "d1", "d2", "row")
    first = found.where("group is not null").groupBy("group").agg(F.min(order).alias("first"), F.count("*").alias("members"))
    marked = spread_join(found.where("group is not null"), first, "group", "members", found.count())
    kept = marked.select("doc_id", "d1", "d2", (order == F.col("first")).alias("kept"))
    alone = found.where("group is null").select("doc_id", "d1", "d2", F.lit(True).alias("kept"))

    def keyed(rows: DataFrame, names: list[str]) -> DataFrame:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(_digests, f"{fields}, `{names[0]}` bigint, `{names[1]}` bigint")
    return keep_rows(docs, materialize(kept.unionByName(alone), "shingle-marks"), keyed, ["d1", "d2"])
