"""Operator 4, exact dedup: a tree merge of sorted digest runs.

Every document becomes a narrow entry: the SHA-256 of its normalised text, its
id and a row number.  Each scan task sorts its entries into a run, one entry per
digest with the smallest identifier and a count, and cuts the run by digest
range into buckets.  In each round the runs of a bucket are merged by groups of
``fan`` (with ``fan`` 2, the plain binomial exchange): run i goes to run
``i // fan``, equal digests are verified over all 256 bits, the smallest
identifier stays and the counts add up.  A text that fills a third of the
corpus is one entry of each run from the first step on, and a bucket holds a
bounded share of the distinct digests however many runs meet.

Defined results: a null text counts as empty; empty texts are equal to each
other; a null id is larger than any other; among rows with equal text and id the
first in table order stays; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import blob, keep_rows, materialize, spread_join

#: Digest entries that one bucket of one run may hold on average at the root.
PER_BUCKET = 200_000
#: Entries that a task gathers, at least, before it merges them.
MERGE_ENTRIES = 500_000
_RUN = "bucket int, run int, digests binary, ids binary, missing binary, rows binary, counts binary"
_ENTRY = "digest binary, keep_id bigint, keep_row bigint, group_size bigint"


def normalised(text):
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def entries(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))


def _merge(digests, ids, missing, rows, counts):
    """One sorted run of the given entries: per digest the smallest (null last)
    id, among equal ids the smallest row, and the summed count."""
    words = digests.view(">u8").reshape(-1, 4)
    order = np.lexsort((rows, ids, missing, words[:, 3], words[:, 2], words[:, 1], words[:, 0]))
    words = words[order]
    new = np.ones(len(order), bool)
    new[1:] = (words[1:] != words[:-1]).any(axis=1)     # verified on the whole digest
    at = np.flatnonzero(new)
    first = order[at]
    return (digests.reshape(-1, 32)[first], ids[first], missing[first], rows[first],
            np.add.reduceat(counts[order], at) if len(at) else counts[:0])


def _runs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0          # runs not merged yet, and their entries
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column(0)
            new = (np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, 32),
                   ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                   ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                   b.column(2).to_numpy().astype(np.int64), np.ones(b.num_rows, np.int64))
            parts.append(new)
            waiting += b.num_rows
            if waiting >= max(MERGE_ENTRIES, len(parts[0][1])):     # as many as were merged before: each entry is sorted a few times
                parts, waiting = [_merge(*map(np.concatenate, zip(*parts)))], 0
        if not parts:
            return
        kept = _merge(*map(np.concatenate, zip(*parts)))
        lead = kept[0].view(">u8").reshape(-1, 4)[:, 0].astype(np.uint64)
        bucket = ((lead >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        full = np.flatnonzero(cut[1:] > cut[:-1])
        me = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(full, pa.int32()), pa.array([me] * len(full), pa.int32()),
             *(pa.array([blob(a[cut[i]:cut[i + 1]]) for i in full], pa.binary()) for a in kept)],
            ["bucket", "run", "digests", "ids", "missing", "rows", "counts"])
    return run


def _unpack(row_set: pd.DataFrame):
    kinds = (("digests", np.uint8), ("ids", np.int64), ("missing", np.uint8), ("rows", np.int64), ("counts", np.int64))
    return tuple(np.frombuffer(b"".join(row_set[c]), k).reshape((-1, 32) if c == "digests" else -1) for c, k in kinds)


def _merge_runs(key, runs: pd.DataFrame) -> pd.DataFrame:
    runs = runs.sort_values("run")
    merged = runs.iloc[0][["digests", "ids", "missing", "rows", "counts"]].tolist() if len(runs) == 1 \
        else [blob(a) for a in _merge(*_unpack(runs))]
    return pd.DataFrame([[*key, *merged]], columns=["bucket", "parent", "digests", "ids", "missing", "rows", "counts"])


def _flatten(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for i in range(len(f)):
            digests, ids, missing, rows, counts = _unpack(f.iloc[i:i + 1])
            yield pd.DataFrame({"digest": [d.tobytes() for d in digests],
                                "keep_id": pd.array(ids, "Int64").copy() if not missing.any() else pd.array(np.where(missing, None, ids), "Int64"),
                                "keep_row": rows, "group_size": counts})


def tree_merge(narrow: DataFrame, total: int, fan: int = 8) -> DataFrame:
    """One row per distinct digest: digest, keep_id, keep_row, group_size."""
    runs = narrow.rdd.getNumPartitions()
    buckets = max(1, math.ceil(total / PER_BUCKET))
    tree = narrow.select("doc_id", "digest", "row").mapInArrow(_runs(buckets), _RUN)
    while runs > 1:
        tree = (tree.withColumn("parent", (F.col("run") / fan).cast("int"))
                .groupBy("bucket", "parent")
                .applyInPandas(_merge_runs, _RUN.replace("run int", "parent int"))
                .withColumnRenamed("parent", "run"))
        runs = math.ceil(runs / fan)
    return tree.mapInPandas(_flatten, _ENTRY)


def dedup(docs: DataFrame, fan: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, row (its number), digest, keep_id,
    group_size, kept."""
    narrow = materialize(entries(docs), "exact-entries")
    total = narrow.count()
    groups = materialize(tree_merge(narrow, total, fan), "exact-groups")
    shared = groups.where("group_size > 1")
    joined = spread_join(narrow, shared, "digest", "group_size", total)
    alone = F.col("group_size").isNull()
    return joined.select("doc_id", "row", "digest",
                         F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).alias("group_size"),
                         (alone | (F.col("row") == F.col("keep_row"))).alias("kept"))


def drop_copies(docs: DataFrame, fan: int = 8) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    def keyed(rows: DataFrame, names: list[str]) -> DataFrame:
        return rows.withColumn(names[0], F.unhex(F.sha2(normalised(F.col("text")), 256)))
    return keep_rows(docs, materialize(dedup(docs, fan), "exact-marks"), keyed, ["digest"])
