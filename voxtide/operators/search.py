"""Subject search through an inverted index (F1 at scale).

``search_subject`` in ``filters`` reads every text.  Here the texts of a table are
indexed once: ``postings`` holds a row per distinct three-byte gram of a
lower-cased text and document, sorted and partitioned by gram; ``grams`` how many
documents have each gram; ``texts`` the rows themselves, partitioned by document
number.  A search looks up its subject's grams, reads the postings of the rarest
few, intersects them, fetches the candidates' partitions and verifies each
candidate by ``contains``: the index only ever rules texts out.  A subject with a
gram that no text has reads neither postings nor texts.

An index grows by batches: a batch adds folders of its own (overwritten when it
is indexed again) and touches no earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide.operators.filters import search_subject
from voxtide.session import ship_package

#: Partitions of the postings (by gram) and of the texts (by document).
SLOTS, PARTS = 64, 64
#: Rarest grams of a subject that are looked up, and the most partitions of texts
#: that are named in a filter (a subject with more candidates reads all).
LOOKED_UP, NAMED_PARTS = 4, 1_000
#: Text bytes whose grams are sorted at once inside a task.
AT_ONCE = 2 << 20


def grams_of(lowered: str) -> list[int]:
    """The distinct three-byte grams of a lower-cased text, as numbers."""
    raw = lowered.encode()
    return sorted({int.from_bytes(raw[i:i + 3], "big") for i in range(len(raw) - 2)})


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, texts = batch.column(0).to_numpy(), batch.column(1).cast(pa.large_string()).fill_null("")
        off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(off, off[at] + AT_ONCE, "right")) - 1)
            b, cut = raw[off[at]:off[to]].astype(np.int64), off[at:to + 1] - off[at]
            gram = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) if len(b) > 2 else b[:0]
            text = np.searchsorted(cut, np.arange(len(gram)), "right") - 1
            whole = np.arange(len(gram)) + 3 <= cut[text + 1] if len(gram) else np.zeros(0, bool)   # no gram reaches over two texts
            met = np.unique(text[whole] << 24 | gram[whole])
            yield pa.RecordBatch.from_arrays([pa.array(met & 0xFFFFFF, pa.int32()), pa.array(docs[at + (met >> 24)], pa.int64())], ["gram", "doc"])
            at = to


def index_texts(df: DataFrame, path: str, text: str = "text", batch: int = 0) -> None:
    """Index batch ``batch`` of a table (all its columns are kept) under ``path``."""
    spark = df.sparkSession
    ship_package(spark)
    rows = df.withColumn("doc", F.monotonically_increasing_id()).withColumn("part", F.pmod(F.xxhash64("doc"), F.lit(PARTS)).cast("int"))
    texts = f"{path}/texts/batch={batch}"
    rows.write.mode("overwrite").partitionBy("part").parquet(texts)         # numbers are pinned by the write
    kept = spark.read.schema(rows.schema).parquet(texts)
    postings = kept.select("doc", F.lower(F.col(text)).alias("t")).mapInArrow(_grams, "gram int, doc bigint")
    slotted = postings.withColumn("slot", (F.col("gram") % SLOTS).cast("int"))
    slotted.repartition("slot", (F.col("gram") / SLOTS).cast("int") % 16).sortWithinPartitions("slot", "gram", "doc").write.mode("overwrite").partitionBy("slot").parquet(f"{path}/postings/batch={batch}")
    done = spark.read.schema("gram int, doc bigint, slot int").parquet(f"{path}/postings/batch={batch}")
    done.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/grams/batch={batch}")


def search_index(spark: SparkSession, path: str, subject: str, schema: str, text: str = "text") -> DataFrame:
    """The indexed rows (``schema``: their columns) whose text holds ``subject``,
    case-insensitively, like ``search_subject``.  A subject of under three bytes
    has no gram and reads all texts."""
    columns = [f.strip().split()[0] for f in schema.split(",")]
    texts = spark.read.schema(f"{schema}, doc bigint, batch int, part int").parquet(f"{path}/texts")
    grams = grams_of(spark.range(1).select(F.lower(F.lit(subject))).first()[0])      # as the texts were lower-cased
    if not grams:
        return search_subject(texts, subject, text).select(*columns)
    known = spark.read.schema("gram int, n bigint, batch int").parquet(f"{path}/grams").where(F.col("gram").isin(grams))
    counts = {r["gram"]: r["n"] for r in known.groupBy("gram").agg(F.sum("n").alias("n")).collect()}     # a row per gram of the subject
    if len(counts) < len(grams):
        return spark.createDataFrame([], schema)
    rare = sorted(grams, key=lambda g: (counts[g], g))[:LOOKED_UP]
    postings = spark.read.schema("gram int, doc bigint, batch int, slot int").parquet(f"{path}/postings")
    met = postings.where(F.col("slot").isin([g % SLOTS for g in rare]) & F.col("gram").isin(rare))
    candidates = met.groupBy("batch", "doc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(rare)).select("batch", "doc")
    parts = candidates.select(F.pmod(F.xxhash64("doc"), F.lit(PARTS)).cast("int").alias("part"), "batch").distinct().limit(NAMED_PARTS + 1).collect()
    if len(parts) <= NAMED_PARTS:
        texts = texts.where(F.col("part").isin([r["part"] for r in parts]) & F.col("batch").isin([r["batch"] for r in parts]))
    return search_subject(texts.join(candidates, ["batch", "doc"], "left_semi"), subject, text).select(*columns)
