"""Operator 10, quality rules: a linear-chain CRF labels lines, Viterbi decodes.

Every line with a word is described by ``FEATURES`` numbers, which weigh more the
more words it has.  A linear-chain
conditional random field over the lines of a document marks each as content or
boilerplate; the most likely sequence comes from Viterbi decoding, and a
document is kept if at least ``LEAST_CONTENT`` of its words stand in content
lines and the base rule holds.  The field is trained here, in numpy, by its exact
gradient (forward-backward) on a bounded sample of rows with a quality label: at
most ``SAMPLE`` rows a class, the first by a hash of the id, their first
``SAMPLE_LINES`` lines if those have at most ``SAMPLE_CHARS`` characters, one row
an id.  Lines start with their row's label; after a first fit,
lines of low-quality rows that the field finds clean change sides, and the field
is fitted again.  Statistics and decoding cover whole texts.

Defined results: a null text has no words; without words base_failed is true and
the row is dropped; without labelled rows of both classes every line counts as
content and the base rule decides alone; repeated rows are judged alike; other
columns pass through ``keep`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import Flat, labelled_sample, lean, mix, pieces, release, segment_hash

SAMPLE, SAMPLE_LINES, SAMPLE_CHARS = 800, 80, 50_000
#: Text bytes of the sample described at once on the driver.
TRAIN_PIECE = 1 << 17
LEAST_CONTENT, LEAST_WORDS, MOST_REPEATED = 0.5, 50, 50
FEATURES = ("bias", "symbols", "capitals", "digits", "same_word", "repeated", "seen_line", "marks", "short", "word_length")
ROUNDS, RATE, DECAY = 100, 0.1, 1e-3

_CLASS = np.zeros((5, 256), bool)               # byte classes: symbols, capitals, digits, marks, character starts
_CLASS[0, list(b"#*$%&|<>")] = True
_CLASS[1, 65:91] = True
_CLASS[2, 48:58] = True
_CLASS[3, list(b"!?{}[]=_~^@\\")] = True
_CLASS[4] = (np.arange(256) & 0xC0) != 0x80


class Lines:
    """Lines and counts of the documents of one flat text."""

    def __init__(self, flat: Flat):
        buf, off, n = flat.buf, flat.off, flat.n
        starts, ends, words_at = flat.words()
        self.n_words = np.diff(words_at)
        of_word = np.repeat(np.arange(n), self.n_words)
        runs = np.zeros((5, len(buf) + 1), np.int32)
        for r, kind in zip(runs, _CLASS):
            np.cumsum(kind[buf], out=r[1:])
        self.n_symbols = runs[0][off[1:]] - runs[0][off[:-1]]
        per_word = runs[4][ends] - runs[4][starts]
        self.word_chars = np.bincount(of_word, per_word, n).astype(np.int64)

        hashes = segment_hash(buf, starts, ends)
        marked = self._repeated_windows(hashes, of_word)
        self.n_repeat_words = np.bincount(of_word, marked, n).astype(np.int64)

        breaks = np.flatnonzero(buf == 10)
        of_break = np.searchsorted(off, breaks, "right") - 1
        count = np.bincount(of_break, minlength=n) + 1
        first = np.cumsum(count) - count
        is_first = np.zeros(int(count.sum()), bool)
        is_first[first] = True
        line_start = np.empty(len(is_first), np.int64)
        line_start[first], line_start[~is_first] = off[:-1], breaks + 1
        line_end = np.empty(len(is_first), np.int64)
        last = first + count - 1
        is_last = np.zeros(len(is_first), bool)
        is_last[last] = True
        line_end[last], line_end[~is_last] = off[1:], breaks
        a, b = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
        of_line = np.repeat(np.arange(n), count)
        full = np.flatnonzero(b > a)
        a, b, line_start, line_end, self.of = a[full], b[full], line_start[full], line_end[full], of_line[full]
        self.words = b - a
        text = segment_hash(buf, line_start, line_end)
        order = np.lexsort((np.arange(len(text)), text, self.of))
        again = np.zeros(len(text), bool)
        again[order[1:]] = (text[order[1:]] == text[order[:-1]]) & (self.of[order[1:]] == self.of[order[:-1]])
        self.n_dup_lines = np.bincount(self.of, again, n).astype(np.int64)

        total = lambda values: np.concatenate([[0], np.cumsum(values)])
        same = np.zeros(len(hashes))
        same[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        in_words = lambda values: (t := total(values))[b] - t[a]
        chars = np.maximum(in_words(per_word), 1)
        part = lambda k: (runs[k][line_end] - runs[k][line_start]) / chars
        seen = np.zeros(len(text))
        seen[again] = 1
        self.x = np.stack([np.ones(len(full)), np.minimum(4 * part(0), 1), np.minimum(2 * part(1), 1), part(2), in_words(same) / self.words,
                           in_words(marked) / self.words, seen,
                           np.minimum(10 * part(3), 1), self.words < 4, np.minimum(chars / self.words / 10, 2)], 1).astype(np.float64)
        self.x *= np.clip(np.log1p(self.words) / 2, 0.3, 3)[:, None]       # a long line says more

    @staticmethod
    def _repeated_windows(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Words inside a three-word window that its document holds twice or more."""
        marked = np.zeros(len(hashes))
        if len(hashes) < 3:
            return marked
        three = mix(mix(mix(hashes[:-2]) + hashes[1:-1]) + hashes[2:])
        at = np.flatnonzero(of[:-2] == of[2:])
        order = at[np.lexsort((three[at], of[at]))]
        equal = (three[order[1:]] == three[order[:-1]]) & (of[order[1:]] == of[order[:-1]])
        twice = np.unique(np.concatenate([order[1:][equal], order[:-1][equal]]))
        for k in range(3):
            marked[twice + k] = 1
        return marked

    def base_failed(self) -> np.ndarray:
        return (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > MOST_REPEATED * self.n_words)


class Field:
    """Two states, 0 boilerplate and 1 content: ``w`` (features, 2) and ``t`` (2, 2)."""

    def __init__(self, w: np.ndarray, t: np.ndarray):
        self.w, self.t = w, t

    def decode(self, x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Viterbi states of all lines; all documents advance one line a step."""
        n = len(x)
        if not n:
            return np.zeros(0, np.int8)
        e = x @ self.w
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        length = np.diff(np.append(first, n))
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        back = np.zeros((n, 2), np.int8)
        best = e[first]
        for k in range(1, int(length[0])):
            live = int(np.searchsorted(-length, -k, "left"))        # documents with more than k lines
            step = best[:live, :, None] + self.t
            back[first[:live] + k] = step.argmax(1)
            best[:live] = step.max(1) + e[first[:live] + k]
        state = np.zeros(n, np.int8)
        now = best.argmax(1).astype(np.int8)
        state[first + length - 1] = now
        for k in range(int(length[0]) - 1, 0, -1):
            live = int(np.searchsorted(-length, -k, "left"))
            now[:live] = back[first[:live] + k, now[:live]]
            state[first[:live] + k - 1] = now[:live]
        return state


def _fit(x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[Field, np.ndarray]:
    """A field for padded sequences (rows, lines, features) with labels, and the
    marginal chance of content of each line."""
    rows, width, size = x.shape
    w, t = np.zeros((size, 2)), np.zeros((2, 2))
    one = np.stack([1 - y, y], 2) * mask[:, :, None]
    balance = np.where(y == 1, 1 / max((y * mask).sum(), 1), 1 / max(((1 - y) * mask).sum(), 1)) * mask
    seq = balance.sum(1, keepdims=True) / np.maximum(mask.sum(1, keepdims=True), 1)      # each class weighs the same
    pair = one[:, :-1, :, None] * one[:, 1:, None, :]
    both = (mask[:, 1:] * mask[:, :-1])[:, :, None, None]
    state = [[np.zeros_like(a), np.zeros_like(a)] for a in (w, t)]
    for step in range(1, ROUNDS + 1):
        e = x @ w
        et, em = np.exp(t), np.exp(e - e.max(2, keepdims=True))
        ahead, behind = np.zeros_like(e), np.ones_like(e)
        ahead[:, 0] = em[:, 0] / em[:, 0].sum(1, keepdims=True)
        for k in range(1, width):
            a = (ahead[:, k - 1] @ et) * em[:, k]
            ahead[:, k] = a / a.sum(1, keepdims=True)
        for k in range(width - 2, -1, -1):
            b = (em[:, k + 1] * behind[:, k + 1]) @ et.T
            behind[:, k] = np.where(mask[:, k + 1, None] > 0, b / b.sum(1, keepdims=True), 1.0)
        node = ahead * behind
        node /= node.sum(2, keepdims=True)
        edge = ahead[:, :-1, :, None] * et * (em * behind)[:, 1:, None, :]
        edge /= edge.sum((2, 3), keepdims=True)
        gw = np.einsum("rlf,rls->fs", x, (node * mask[:, :, None] - one) * seq[:, :, None]) + DECAY * w
        gt = (((edge - pair) * both) * seq[:, :, None, None]).sum((0, 1)) + DECAY * t
        for a, g, (m, v) in zip((w, t), (gw, gt), state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(w, t), node[:, :, 1]


def _sample_lines(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, place in it and features of the lines that train the field.
    The flat arrays of a piece take some sixty times its bytes; the driver holds
    those of one piece at a time."""
    at, parts = 0, [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(FEATURES))))]
    for _, flat in pieces(pa.record_batch([pa.array(texts, pa.large_string())], ["text"]), limit=TRAIN_PIECE):
        lines = Lines(flat)
        place = np.arange(len(lines.of)) - np.searchsorted(lines.of, np.arange(flat.n))[lines.of]
        use = place < SAMPLE_LINES
        parts.append((lines.of[use] + at, place[use], lines.x[use]))
        at += flat.n
    return tuple(map(np.concatenate, zip(*parts)))


def train(texts: list[str], good: list[int]) -> Field:
    if len(set(good)) < 2:
        return Field(np.array([[0.0, 1.0]] + [[0.0, 0.0]] * (len(FEATURES) - 1)), np.zeros((2, 2)))
    of, place, feature = _sample_lines(texts)
    width = max(int(place.max(initial=0)) + 1, 2)
    x, mask = np.zeros((len(texts), width, len(FEATURES))), np.zeros((len(texts), width))
    x[of, place], mask[of, place] = feature, 1
    y = np.repeat(np.array(good, float)[:, None], width, 1)
    _, chance = _fit(x, mask, y)
    field = _fit(x, mask, np.where(chance > 0.8, 1.0, y))[0]
    release()
    return field


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    known = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label")).where("label is not null and id is not null")
             .groupBy("id").agg(F.min("label").alias("label")))
    sample = labelled_sample(docs, known, SAMPLE, F.substring_index(F.col("text"), "\n", SAMPLE_LINES), SAMPLE_CHARS)
    return train([t for t, _ in sample], [c for _, c in sample])


def verdicts(flat: Flat, field: Field) -> tuple[Lines, np.ndarray, np.ndarray]:
    """The lines, and per document the share of words in content lines and whether it stays."""
    lines = Lines(flat)
    content = np.bincount(lines.of, lines.words * field.decode(lines.x, lines.of), flat.n)
    share = content / np.maximum(lines.n_words, 1)
    return lines, share, ~lines.base_failed() & (share >= LEAST_CONTENT)


def _judge(shared):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat in pieces(batch):
                lines, share, kept = verdicts(flat, shared.value)
                numbers = (lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), *(pa.array(c.astype(np.int64)) for c in numbers), pa.array(lines.base_failed()), pa.array(kept), pa.array(share)],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"])
    return judge


def judge(docs: DataFrame, field: Field) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, kept, content_share."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    return docs.select("doc_id", "text").mapInArrow(lean(_judge(shared)), (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, content_share double"))


def keep(docs: DataFrame, field: Field) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat in pieces(batch):
                yield part.filter(pa.array(verdicts(flat, shared.value)[2]))
    return docs.mapInArrow(lean(select), docs.schema)
