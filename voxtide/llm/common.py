"""Helpers shared by the operators: flat numpy views of Arrow text columns,
word and hash arithmetic over them, and scratch tables."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide.session import ensure_utc, materialize, ship_package, table_path

#: White space of all word definitions: \x20 and \x09-\x0D.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
#: Text bytes handled at once inside a task (one longer document goes alone).
CHUNK = 1 << 20
#: Slices of a hot key's rows in ``dealt_join``.
DEAL = 64

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)
_P = np.uint64(0x9E3779B97F4A7C15)          # odd: a unit modulo 2**64
_BYTES = np.random.default_rng(20240229).integers(1, 2**64, 256, np.uint64, endpoint=False)
_LOWER = _BYTES.copy()
_LOWER[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_POWERS: list[np.ndarray] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ensure_utc(spark)
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, table))


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection with full avalanche)."""
    h = h ^ (h >> _S33)
    h = h * _M1
    h ^= h >> _S33
    h *= _M2
    h ^= h >> _S33
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i < n, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        inverse = np.uint64(pow(int(_P), -1, 2**64))
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, p)])) for p in (_P, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def segment_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte range: a polynomial over random byte values from
    one running sum, then mixed with the length.  ``lower`` folds A-Z."""
    up, down = _powers(len(buf) + 1)
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTES)[buf] * up[:-1], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Flat:
    """The UTF-8 bytes of a text column, end to end: ``buf`` and ``off`` (n + 1
    byte offsets).  A null text is empty."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
        off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        if texts.null_count:        # a null slot may still span bytes
            texts = texts.fill_null("")
            off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
            raw = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else raw[:0]
        self.buf = raw[off[0]:off[-1]]
        self.off = off - off[0]
        self.n = len(texts)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and the word offsets of the documents."""
        inside = ~IS_SPACE[self.buf]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = np.flatnonzero(self.off[1:] > self.off[:-1])
        cut = self.off[full]                    # a document's first byte starts a word, its last ends one
        first[cut] |= inside[cut]
        cut = self.off[full + 1] - 1
        last[cut] |= inside[cut]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.off)


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, Flat]]:
    """Slices of a batch of about ``limit`` text bytes, with their flat texts."""
    flat = Flat(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < flat.n:
        to = max(at + 1, int(np.searchsorted(flat.off, flat.off[at] + limit, "right")) - 1)
        part = Flat.__new__(Flat)
        part.buf, part.off, part.n = flat.buf[flat.off[at]:flat.off[to]], flat.off[at:to + 1] - flat.off[at], to - at
        yield batch.slice(at, to - at), part
        at = to


def release() -> None:
    """Hand freed memory back to the system: a worker that waits for its next task
    is then small beside what runs next to it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def lean(task):
    """A task function over batches that releases memory at its end."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()
    return run


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + lengths[i] - 1 of all i, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


def rank_rows(df: DataFrame, by: list, name: str) -> DataFrame:
    """``df`` with ``name``: the row's position (from 0) in the global order of
    ``by``.  A range sort gives each task a contiguous piece; the pieces' row
    counts (one narrow row a task) give the offsets."""
    from pyspark.sql import Window

    parts = materialize(df.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()), name)
    counts = parts.groupBy("__part").agg(F.count("*").alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__part").orderBy(*by)) - 1
    return parts.join(before, "__part").withColumn(name, local + F.col("__before")).drop("__part", "__before")


def spread_join(left: DataFrame, right: DataFrame, key: str | list[str], rows: str, total: int) -> DataFrame:
    """Left join on ``key`` where ``right`` has one row a key and says in column
    ``rows`` how many left rows have it.  Keys over a thousandth of ``total``
    number under 1,000, so their right rows are broadcast and the left rows stay
    where they are; no key left in the shuffle has more than that share."""
    key = [key] if isinstance(key, str) else key
    hot = right.where(F.col(rows) * 1000 > F.lit(total))
    cool = right.where(F.col(rows) * 1000 <= F.lit(total))
    spread = left.join(F.broadcast(hot), key, "inner")
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cool, key, "left")
    return spread.unionByName(rest)


def dealt_join(left: DataFrame, right: DataFrame, key: list[str], rows: str, total: int, by: list[str]) -> DataFrame:
    """``spread_join`` as an inner join that computes ``left`` once: rows of the
    keys over a thousandth of ``total`` (fewer than 1,000) are dealt by a hash of
    the columns ``by`` over ``DEAL`` slices, each with a copy of the right row."""
    hot = right.where(F.col(rows) * 1000 > F.lit(total)).select(*key, F.lit(True).alias("__hot"))
    slot = F.when(F.col("__hot"), F.pmod(F.xxhash64(*by), F.lit(DEAL)).cast("int")).otherwise(0)
    slots = F.when(F.col(rows) * 1000 > F.lit(total), F.sequence(F.lit(0), F.lit(DEAL - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("__slot", slot).drop("__hot")
    return dealt.join(right.withColumn("__slot", F.explode(slots)), [*key, "__slot"]).drop("__slot")


def keep_rows(docs: DataFrame, decided: DataFrame, keyed, keys: list[str]) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (doc_id, ``keys``, kept; a row per row
    of ``docs``) keeps, all columns as they are.  Ids whose rows all go are
    dropped by id; only where rows of one id fare differently are the keys
    computed (``keyed`` adds them as columns).  Of rows that agree in id and keys
    all stay if all are kept, and the one smallest in all columns if only some are."""
    out = docs.columns
    fate = decided.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__rows"), F.sum(F.col("kept").cast("int")).alias("__kept"))
    fate = materialize(fate.where("__kept < __rows"), "fates")
    same = docs["doc_id"].eqNullSafe(F.col("__id"))
    whole = docs.join(fate.select("__id"), same, "left_anti")
    mixed = fate.where("__kept > 0").select("__id")
    names = [f"__key_{k}" for k in keys]
    stay = (decided.select(F.col("doc_id").alias("__id"), *(F.col(k).alias(n) for k, n in zip(keys, names)), "kept")
            .join(mixed.withColumnRenamed("__id", "__mixed"), F.col("__id").eqNullSafe(F.col("__mixed")), "left_semi")
            .groupBy("__id", *names).agg(F.max("kept").alias("__some"), F.min("kept").alias("__all")).where("__some"))
    odd = keyed(docs.join(mixed, same, "left_semi"), names)
    match = odd["doc_id"].eqNullSafe(F.col("__id"))
    for n in names:
        match = match & (odd[n] == stay[n])
    every = odd.join(stay.where("__all"), match, "left_semi").select(*out)
    some = odd.join(stay.where("not __all"), match, "left_semi").groupBy("doc_id", *names).agg(F.min(F.struct(*out)).alias("__one")).select("__one.*")
    return whole.unionByName(every).unionByName(some)


class Bitmap:
    """A bitmap of the top bits of a column of 64-bit hashes: sixteen bits a row,
    but never over ``2**most`` bits whatever the input's size.  It only ever says
    "maybe": a use must stay right for positions that are set by chance."""

    def __init__(self, hashes: DataFrame, rows: int, most: int = 26):
        self.shift = 64 - max(16, min(most, int(16 * rows - 1).bit_length() if rows else 16))
        name = hashes.columns[0]
        slot = F.shiftrightunsigned(name, self.shift)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.bitwiseAND(F.lit(63)).cast("int"))
        words = (hashes.select(F.shiftrightunsigned(slot, 6).alias("word"), bit.alias("bit"))
                 .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
        self.bits = np.zeros(1 << (64 - self.shift - 6), np.int64)
        self.bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
        self.bits = self.bits.view(np.uint64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slot = hashes >> np.uint64(self.shift)
        return (self.bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def labelled_sample(docs: DataFrame, known: DataFrame, a_class: int, text, most_chars: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``a_class`` ids a label.  ``known`` (id, label) has
    a row per labelled id; those first by a hash of the id are drawn from it
    alone, so that the texts meet only that bounded list of ids, broadcast.  An id
    gives one text, the smallest of its texts of at most ``most_chars`` characters,
    and is no part of the sample if it has none: what reaches the driver is bounded."""
    picks = [known.where(F.col("label") == c).orderBy(F.xxhash64("id"), "id").limit(a_class) for c in (0, 1)]
    few = picks[0].unionByName(picks[1]).withColumnRenamed("id", "__id")
    rows = docs.select(F.col("doc_id").alias("__id"), text.alias("__text")).where(F.length("__text") <= most_chars).join(F.broadcast(few), "__id")
    rows = rows.groupBy("__id", "label").agg(F.min("__text").alias("__text"))
    return [(r["__text"], r["label"]) for r in sorted(rows.collect(), key=lambda r: r["__id"])]
