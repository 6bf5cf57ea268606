"""Operator 9, toxicity: subword-bag embeddings under a linear softmax.

A text is lower-cased and cut into words of letters and digits; its bag holds
the byte n-grams (3 to 6) of all words with their word-end marks, hashed into
``BUCKETS``.  The bag's embeddings are averaged, and a linear softmax gives the
two classes.  Embeddings and softmax are trained jointly in numpy (Adam on the
log loss with weight decay) on a bounded sample of labelled rows: at most
``SAMPLE`` rows a class, the first by a hash of the id, of at most
``SAMPLE_CHARS`` characters, one row an id.  A bucket has an embedding if it occurs in
``LEAST_DOCS`` sample rows and its share of rows differs between the classes by
``LEAST_Z`` standard errors; the others stay at zero, so that words met by
chance carry no evidence.  A misspelt word shares most n-grams with the word
itself and needs no entry of its own.  Scoring covers every word of every text;
the model (one number a bucket) is broadcast.

Defined results: a null or empty text, or one without letters, scores the prior
of the sample; without labelled rows of both classes every row scores the share
of toxic rows (0 if none); a null id is not held out; repeated rows score alike;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import CHUNK, labelled_sample, mix

SAMPLE, SAMPLE_CHARS, LEAST_DOCS, LEAST_Z = 2_000, 20_000, 3, 3.5
SIZES = (3, 4, 5, 6)
BITS = 18
BUCKETS = 1 << BITS
DIMENSIONS, ROUNDS, RATE, DECAY, SCALE = 4, 120, 0.03, 1e-5, 100.0

_EDGE = 32
_FOLD = np.full(256, _EDGE, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_VALUE = np.random.default_rng(1).integers(1, 2**64, 256, np.uint64, endpoint=False)
_P = np.uint64(0x9E3779B97F4A7C15)


def bags(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams of one size, size by size."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    buf = _FOLD[np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)]
    ends = np.cumsum([len(r) + 1 for r in raw])
    value, edges = _VALUE[buf], np.concatenate([[0], np.cumsum(buf == _EDGE)])
    h = value
    for n in range(2, max(SIZES) + 1):
        h = h[:-1] * _P + value[n - 1:]
        if n in SIZES:
            at = np.flatnonzero(edges[n - 1:len(h) + n - 1] == edges[1:len(h) + 1])     # no word end inside
            yield np.searchsorted(ends, at, "right"), (mix(h[at]) >> np.uint64(64 - BITS)).astype(np.int64)


class Model:
    """Bucket → evidence: from embedding to softmax margin every step is linear."""

    def __init__(self, evidence: np.ndarray, prior: float):
        self.evidence, self.prior = evidence.astype(np.float32), prior

    def score(self, texts: list[str]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for of, bucket in bags(texts):
            total += np.bincount(of, self.evidence[bucket], len(texts))
            count += np.bincount(of, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(self.prior + total / np.maximum(count, 1), -30, 30)))


def _sample_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of the sample: text number, bucket, share of the bag."""
    parts = []
    for k in range(0, len(texts), 100):
        some = texts[k:k + 100]
        key = np.concatenate([of * BUCKETS + bucket for of, bucket in bags(some)])
        key, n = np.unique(key, return_counts=True)
        row = key >> BITS
        parts.append((row + k, key & (BUCKETS - 1), n / np.bincount(row, n, len(some))[row]))
    return tuple(map(np.concatenate, zip(*parts)))


def train(texts: list[str], toxic: list[int], seed: int = 7) -> Model:
    y = np.array(toxic, np.float64)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(BUCKETS), 30.0 if share else -30.0)
    row, bucket, val = _sample_rows(texts)
    n, ones = len(y), y.sum()
    docs, hits = np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket, y[row], BUCKETS)
    p = docs / n
    z = (hits / ones - (docs - hits) / (n - ones)) / np.sqrt(np.maximum(p * (1 - p), 1e-9) * (1 / ones + 1 / (n - ones)))
    chosen = (np.abs(z) >= LEAST_Z) & (docs >= LEAST_DOCS)
    column = np.cumsum(chosen) - 1
    on = chosen[bucket]
    row, col, val, width = row[on], column[bucket[on]], val[on] * SCALE, int(chosen.sum())
    rng = np.random.default_rng(seed)
    emb, top, bias = rng.normal(0, 0.1, (width, DIMENSIONS)), rng.normal(0, 1, (DIMENSIONS, 2)), np.zeros(2)
    moments = [[np.zeros_like(a), np.zeros_like(a)] for a in (emb, top, bias)]
    onehot = np.stack([1 - y, y], 1)
    for step in range(1, ROUNDS + 1):
        doc = np.stack([np.bincount(row, val * emb[col, d], n) for d in range(DIMENSIONS)], 1)
        margin = doc @ top + bias
        prob = np.exp(margin - margin.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        g = (prob - onehot) / n
        back = g @ top.T
        grads = (np.stack([np.bincount(col, val * back[row, d], width) for d in range(DIMENSIONS)], 1) + DECAY * emb, doc.T @ g, g.sum(0))
        for a, gr, (m, v) in zip((emb, top, bias), grads, moments):
            m += 0.1 * (gr - m)
            v += 0.01 * (gr * gr - v)
            a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    evidence = np.zeros(BUCKETS)
    evidence[chosen] = SCALE * (emb @ (top[:, 1] - top[:, 0]))
    return Model(evidence, float(bias[1] - bias[0]))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled rows that are not held out."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label")).where("label is not null and id is not null")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label")))
    sample = labelled_sample(docs, known, SAMPLE, F.col("text"), SAMPLE_CHARS)
    return train([t for t, _ in sample], [c for _, c in sample])


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            texts, scores, some, size = b.column(1).to_pylist(), [], [], 0
            for t in texts:
                some.append(t or "")
                size += len(some[-1])
                if size >= CHUNK:
                    scores.append(model.score(some))
                    some, size = [], 0
            scores.append(model.score(some))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(np.concatenate(scores), pa.float64())], ["doc_id", "score"])
    return score


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.select("doc_id", "text").mapInArrow(_scorer(shared), "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
