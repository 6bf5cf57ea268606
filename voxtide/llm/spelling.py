"""Operator 12, spelling variant grouping with asymmetric q-chunks.

Words are the lower-cased letter runs of all texts.  Two words are near if one
code point is inserted, deleted or replaced between them.  Of such a pair the
shorter word (of equal lengths each in turn) contributes two disjoint chunks, its
halves, and the other its positional grams of the halves' sizes; one edit leaves
one of the chunks whole, moved by at most one place.  Chunks and grams meet in an
equijoin on (length of the chunked word, half, text); the gram's place is that of
the chunk, plus one for the second half of a word that is one shorter.  What
meets is verified in the join's own condition, so unverified pairs are never rows.

``n`` of a word counts all its occurrences; a text's occurrences are counted in
its task (Arrow's hash table, exact) and again by Spark before the shuffle.  The
grams of a popular chunk, one that over ``HOT`` words share, are dealt over slices
of about ``HOT``, each of which meets the chunks in a task of its own.

Defined results: a null text has no words; a null id is written as empty in
``damage``; empty texts, texts without letters and an empty table give no words;
very long runs are words like others; repeated rows count again; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import Flat, materialize, pieces, ranges
from voxtide.operators.joins import bounded_broadcast

LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A word's form occurs at least this many times as often as the word.
FACTOR = 2
#: Grams of one key beyond which the key is cut into slices, and grams a slice.
HOT = 4_096
#: Text bytes counted at once inside a task.
AT_ONCE = 4 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _crc_table() -> np.ndarray:
    """The table of CRC-32 (reversed polynomial EDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def runs(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letter runs of the texts: their bytes end to end, folded; their byte
    offsets; and the text each is of.  Letters are A-Z, a-z and the two-byte
    sequences led by C3 (U+00C0 to U+00FF)."""
    inside = _LETTER[flat.buf]
    inside[1:] |= flat.buf[:-1] == 0xC3
    edge = np.zeros(len(inside) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[flat.off] = True                               # a run ends with its text
    cut = np.flatnonzero(edge)
    first = cut[:-1]
    mine = inside[first] if len(first) else np.zeros(0, bool)
    starts, ends = first[mine], cut[1:][mine]
    letters = _FOLD[flat.buf[inside]]
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=off[1:])
    return letters, off, np.searchsorted(flat.off, starts, "right") - 1


def crc32(letters: np.ndarray, off: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of each run, carried on from its seed (the CRC of what precedes it)."""
    length = off[1:] - off[:-1]
    order = np.argsort(-length, kind="stable")
    at, shorter = off[:-1][order], -length[order]
    c = ~seeds[order]
    for p in range(min(64, int(length.max(initial=0)))):        # one byte of all runs that reach so far
        k = int(np.searchsorted(shorter, -p, "left"))
        c[:k] = _CRC[(c[:k] ^ letters[at[:k] + p]) & np.uint32(255)] ^ (c[:k] >> np.uint32(8))
    out = np.empty(len(c), np.uint32)
    out[order] = ~c
    for i in np.flatnonzero(length > 64):
        out[i] = zlib.crc32(letters[off[i]:off[i + 1]].tobytes(), int(seeds[i]))
    return out


def _strings(letters: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(np.ascontiguousarray(off)), pa.py_buffer(np.ascontiguousarray(letters)))


Damage = Callable[[list, np.ndarray, np.ndarray, np.ndarray], dict]


def damage(ids: list, letters: np.ndarray, off: np.ndarray, text: np.ndarray, every: int = 97) -> dict[int, str]:
    """Run number → run without one code point, for the runs whose CRC-32 h of
    ``<doc_id>:<run>`` is a multiple of ``every``: code point h mod length goes."""
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = crc32(letters, off, seeds[text])
    out = {}
    for k in np.flatnonzero(h % np.uint32(every) == 0):
        run = letters[off[k]:off[k + 1]].tobytes().decode()
        drop = int(h[k]) % len(run)
        out[int(k)] = run[:drop] + run[drop + 1:]
    return out


def word_counts(docs: DataFrame, change: Damage | None = None) -> DataFrame:
    """word, n: the words of at least ``LEAST_LENGTH`` code points and
    ``LEAST_COUNT`` occurrences.  ``change`` replaces runs before they count."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat in pieces(batch, "text", AT_ONCE):
                letters, off, text = runs(flat)
                changed = change(part.column(0).to_pylist(), letters, off, text) if change else {}
                if changed:
                    stay = np.ones(len(off) - 1, bool)
                    stay[list(changed)] = False
                    length = (off[1:] - off[:-1])[stay]
                    letters = letters[ranges(off[:-1][stay], length)]
                    off = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])
                for words in (_strings(letters, off), pa.array(list(changed.values()), pa.large_string())):
                    words = words.filter(pc.greater_equal(pc.utf8_length(words), LEAST_LENGTH))
                    met = words.value_counts()
                    yield pa.RecordBatch.from_arrays([met.field("values").cast(pa.string()), met.field("counts")], ["word", "n"])

    found = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _halves(word, length, of) -> list:
    """The two halves that a word of length ``of`` is cut into, as grams of
    ``word``: (length, half, text)."""
    cut = F.floor(of / 2).cast("int")
    shift = (length - of).cast("int")
    return [F.struct(of.alias("m"), F.lit(0).alias("half"), F.substring(word, F.lit(1), cut).alias("gram")),
            F.struct(of.alias("m"), F.lit(1).alias("half"), F.substring(word, cut + shift + 1, (of - cut).cast("int")).alias("gram"))]


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: all ordered pairs of near words of ``words`` (word, n)."""
    word, length = F.col("word"), F.length("word")
    own = _halves(word, length, length)
    chunks = words.select(word.alias("a"), F.col("n").alias("n_a"), F.explode(F.array(*own)).alias("c")).select("a", "n_a", "c.*")
    grams = words.select(word.alias("b"), F.col("n").alias("n_b"), F.explode(F.array(*own, *_halves(word, length, length - 1))).alias("g")).select("b", "n_b", "g.*")
    key = ["m", "half", "gram"]
    # keys with many grams: their grams are dealt over slices, and their chunks go to every slice
    often = grams.groupBy(*key).agg(F.count("*").alias("met")).where(F.col("met") > HOT).select(*key, F.ceil(F.col("met") / HOT).cast("int").alias("slices"))
    often = bounded_broadcast(materialize(often, "hot-chunks"))
    grams = grams.join(often, key, "left").withColumn("slice", F.pmod(F.xxhash64("b"), F.coalesce("slices", F.lit(1))).cast("int")).drop("slices")
    chunks = chunks.join(often, key, "left").withColumn("slice", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1))).drop("slices")
    # equal lengths meet twice (each word is chunked in turn): there the smaller word is a
    one_edit = (F.levenshtein(F.col("a"), F.col("b"), 1) == 1) & ((F.length("b") > F.col("m")) | (F.col("a") < F.col("b")))
    # a pair whose two halves both stay (an edit at the cut) meets under half 0 and, there, not again
    whole = F.substring(F.col("b"), F.lit(1), F.floor(F.col("m") / 2).cast("int")) == F.substring(F.col("a"), F.lit(1), F.floor(F.col("m") / 2).cast("int"))
    met = chunks.alias("x").join(grams.alias("y"), [*key, "slice"]).where(one_edit & ((F.col("half") == 0) | ~whole)).select("a", "n_a", "b", "n_b")
    met = materialize(met, "near-words")
    return met.unionByName(met.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n: the near word of largest n (ties: smallest in
    code-point order), if that is at least ``FACTOR`` times the word's own."""
    best = pairs.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word"))).alias("best"))
    out = words.join(best, "word", "left")
    chosen = -F.col("best.less") >= F.col("n") * FACTOR
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                      F.when(chosen, F.col("best.word")).alias("form"), F.when(chosen, -F.col("best.less")).alias("form_n"))


def rooted(found: DataFrame) -> DataFrame:
    """Adds root, the end of a word's forms.  Counts double along forms, so the
    forest has at most as many levels as a count has bits; each level is one join
    of the words left with the level above.  A word is the form of near words only,
    so no key has more rows than a word has near words."""
    found = materialize(found, "word-forms")
    level = found.where("form is null").select("word", F.col("word").alias("root"))
    rest, levels = found.where("form is not null").select("word", "form"), [level]
    while rest.limit(1).count():
        met = materialize(rest.join(level.withColumnRenamed("word", "form"), "form", "left"), "word-roots")
        level, rest = met.where("root is not null").select("word", "root"), met.where("root is null").select("word", "form")
        levels.append(level)
    roots = levels[0]
    for more in levels[1:]:
        roots = roots.unionByName(more)
    return found.join(roots, "word")


def group_variants(docs: DataFrame, change: Damage | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of all words of ``docs``."""
    words = materialize(word_counts(docs, change), "words")
    return rooted(forms(words, near_pairs(words))).select("word", "form", "root", "n", "n_near", "form_n")
