"""Operator 6, sharding by sampled splitters.

Records are ordered by (hash of the text, id, row number).  Starting from one
range, every overfull range (by bytes or by records) is subdivided: samples of
its keys are drawn, weighted by size and number, their quantiles become splitters,
and the records are range-partitioned again, until a range is overfull only by one
single record.  Exact byte and row
totals of the ranges then give each record its place in the whole order, and a
shard is an equal slice of all bytes (law ``bytes``).  Samples only decide how
the work is cut: the result depends on the total order alone.  Copies of one text
differ in the key's id, so a text that fills a third of the table is cut like any
other stretch of keys.

Defined results: a null text counts as empty (size 1); a null id comes last among
equal texts; repeated rows are separate records; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtide.llm.common import materialize

#: Records aimed at per range, and the most ranges aimed at (their totals are narrow rows).
PER_RANGE, MOST_RANGES = 100_000, 16_384
#: Samples drawn per range aimed at.
OVERSAMPLE = 24
_KEY = ("hash", "missing", "id", "row")


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("hash"),
                       F.col("doc_id").isNull().cast("int").alias("missing"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
                       F.monotonically_increasing_id().alias("row"))


def _placer(splitters: list[tuple]):
    heads = np.array([s[0] for s in splitters], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [b.column(b.schema.get_field_index(c)).to_numpy() for c in _KEY]
            low, high = (np.searchsorted(heads, keys[0], side) for side in ("left", "right"))
            out = low.copy()
            for i in np.flatnonzero(low != high):       # the hash itself is cut: compare whole keys
                out[i] = bisect_right(splitters, tuple(k[i].item() for k in keys), int(low[i]), int(high[i]))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.int32())], [*b.schema.names, "range"])
    return place


def ranged(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    fields = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    return rows.mapInArrow(_placer(splitters), f"{fields}, range int")


def split(rows: DataFrame, total: int, aim: int) -> list[tuple]:
    """Splitters such that no range holds over two of ``aim`` equal parts of the
    bytes, or of the records, besides one record.  A record's load is its share of
    the bytes plus its share of the records."""
    part, splitters, seed = 1 / aim, [], 0
    load = F.col("size") / F.lit(float(total)) + F.lit(1.0 / max(1, rows.count()))
    rows = rows.withColumn("load", load)
    while True:
        placed = ranged(rows, splitters)
        stats = placed.groupBy("range").agg(F.sum("load").alias("all"), F.max("load").alias("largest"))
        over = stats.where(F.col("all") - F.col("largest") > 2 * part).select("range")
        drawn = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        chance = F.col("load") * F.lit(OVERSAMPLE / part)
        sample = placed.join(F.broadcast(over), "range").where(drawn < chance).select("range", "load", *_KEY).collect()
        found: dict[int, list] = {}
        for s in sample:
            found.setdefault(s["range"], []).append((tuple(s[c] for c in _KEY), max(s["load"], part / OVERSAMPLE)))
        new = set()
        for keys in found.values():
            keys.sort()
            gone = 0.0
            for key, weight in keys:
                if gone + weight / 2 >= part and gone:
                    new.add(key)
                    gone = 0.0
                gone += weight
        new -= set(splitters)
        if not new:
            return splitters
        splitters, seed = sorted([*splitters, *new]), seed + 1


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot."""
    rows = materialize(records(docs), "shard-records")
    whole = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).first()
    total = whole["bytes"] or 1
    aim = min(MOST_RANGES, max(4 * shards, -(-whole["n"] // PER_RANGE)))
    placed = ranged(rows, split(rows, total, aim) if whole["n"] else [])
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    stats = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    starts = stats.select("range", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows_before"))
    inside = Window.partitionBy("range").orderBy(*_KEY)
    here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spot = (placed.withColumn("running", F.sum("size").over(here) - F.col("size")).withColumn("nth", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), "range"))
    start = F.col("bytes_before") + F.col("running")
    spot = spot.select("doc_id", "size", "text_crc32", (F.col("rows_before") + F.col("nth")).alias("at"),
                       F.floor(start * F.lit(shards) / F.lit(total)).cast("int").alias("shard"))
    spot = materialize(spot, "shard-spots")
    first = spot.groupBy("shard").agg(F.min("at").alias("first"))
    return spot.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot"))
