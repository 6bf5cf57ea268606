"""Operator 11, document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut, without gaps, into phrases (a phrase ends after a word that its own
and its predecessor's hash choose, one in ``PHRASE``), paragraphs (lines, with
their line feed) and sections (a section ends after a paragraph whose digest is
one of ``SECTION``).  All cuts depend on the text near them alone, so an edit
moves no cut elsewhere.  Each node's digest is the SHA-256 of its children's, of
a phrase that of its bytes; equal texts, and only they, have equal roots.  The
printed fingerprint holds the root whole and the other nodes' first 36 bits:

    root, then per section |digest, per paragraph /digest, per phrase .digest and
    its length in code points (base 36)

``likeness`` is the share of both texts' code points in phrases that both have
(Dice over phrases with their number), ``differences`` walks down from the roots
into the branches that differ and gives the spans of the edit.

``compared`` puts each document beside the next one in the order of (id, hash of
the text, row).  One range shuffle brings the texts in order; a task reads its
stretch as a stream, about a megabyte of text at once.  Only the first and the last
text of a stretch are written with the results, and meet their neighbours there.

Defined results: a null text counts as empty; the fingerprint of an empty text
has a root and no branches, and two empty texts are alike (1); null ids come
first; among equal ids the order is that of a hash of the text; repeated rows
follow each other; the only row is its own next one; an empty table gives no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtide.llm.common import CHUNK, Flat, mix, pieces, segment_hash
from voxtide.session import scratch_path

#: One word in so many ends a phrase, one paragraph in so many a section.
PHRASE, SECTION = 12, 4
_DIGITS = "0123456789abcdefghijklmnopqrstuvwxyz"
_LINE = 10


def _cuts(texts: list[bytes]) -> list[tuple[list[int], set[int]]]:
    """Per text the byte ends of its phrases, and which of them end a paragraph."""
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    flat = Flat.__new__(Flat)
    flat.buf, flat.off, flat.n = np.frombuffer(b"".join(texts), np.uint8), off, len(texts)
    starts, ends, first = flat.words()
    h = segment_hash(flat.buf, starts, ends)
    before = np.zeros_like(h)
    before[1:] = h[:-1]
    before[first[:-1][first[:-1] < len(h)]] = 0         # a text's first word has no predecessor
    chosen = ends[mix(h + before * np.uint64(3)) % np.uint64(PHRASE) == 0]
    lines = np.flatnonzero(flat.buf == _LINE) + 1
    cut = np.unique(np.concatenate([chosen, lines, off[1:][off[1:] > off[:-1]]]))
    at = np.searchsorted(cut, off, "right")
    line_at = np.searchsorted(lines, off, "right")
    out = []
    for i in range(len(texts)):
        out.append(((cut[at[i]:at[i + 1]] - off[i]).tolist(), {*(lines[line_at[i]:line_at[i + 1]] - off[i]).tolist(), len(texts[i])}))
    return out


def _short(digest: bytes) -> str:
    return base64.urlsafe_b64encode(digest[:6])[:6].decode()


def _base36(n: int) -> str:
    out = ""
    while True:
        n, d = divmod(n, 36)
        out = _DIGITS[d] + out
        if not n:
            return out


def _node(kind: bytes, children: list[bytes]) -> bytes:
    return hashlib.sha256(kind + b"".join(children)).digest()


def fingerprints(texts: list[str]) -> list[str]:
    """The fingerprints of ``texts``."""
    raw = [t.encode() for t in texts]
    out, at = [], 0
    while at < len(raw):                                # about a chunk of text at once
        to, size = at, 0
        while to < len(raw) and (to == at or size + len(raw[to]) <= CHUNK):
            size += len(raw[to])
            to += 1
        out += [_tree(t, cut, lines) for t, (cut, lines) in zip(raw[at:to], _cuts(raw[at:to]))]
        at = to
    return out


def _tree(text: bytes, cuts: list[int], lines: set[int]) -> str:
    sections, paragraphs, phrases = [], [], []
    body, section, paragraph = [], [], []
    start = 0
    for end in cuts:
        piece = text[start:end]
        leaf = hashlib.sha256(b"\0" + piece).digest()
        phrases.append(leaf)
        paragraph.append("." + _short(leaf) + _base36(len(piece.decode())))
        start = end
        if end in lines:
            node = _node(b"\1", phrases)
            paragraphs.append(node)
            section.append("/" + _short(node) + "".join(paragraph))
            phrases, paragraph = [], []
            if node[-1] % SECTION == 0 or end == len(text):
                node = _node(b"\2", paragraphs)
                sections.append(node)
                body.append("|" + _short(node) + "".join(section))
                paragraphs, section = [], []
    return _node(b"\3", sections).hex() + "".join(body)


def _phrases(fingerprint: str) -> tuple[Counter, int]:
    """Phrases with their number, and the code points of all."""
    met = Counter(p.split("/")[0].split("|")[0] for p in fingerprint.split(".")[1:])
    return met, sum(int(p[6:], 36) * n for p, n in met.items())


def likeness(a: str, b: str) -> float:
    """Share of the code points of both texts that lie in phrases of both; 1 where
    the roots agree."""
    if a[:64] == b[:64]:
        return 1.0
    (x, all_x), (y, all_y) = _phrases(a), _phrases(b)
    shared = sum(int(p[6:], 36) * min(n, y[p]) for p, n in x.items() if p in y)
    return 2.0 * shared / (all_x + all_y) if all_x + all_y else 0.0


def _branches(fingerprint: str) -> list:
    """[(section, [(paragraph, [(phrase, length)])])] of a printed fingerprint."""
    return [(s[:6], [(p[:6], [(x[:6], int(x[6:], 36)) for x in p.split(".")[1:]]) for p in s.split("/")[1:]]) for s in fingerprint.split("|")[1:]]


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """The spans (start, end) of code points of the first text that lie in phrases
    which the other does not have in the matching branch.  Branches that agree are
    passed over whole; nothing is said where the roots agree."""
    if a[:64] == b[:64]:
        return []
    def size(branch) -> int:
        return branch if isinstance(branch, int) else sum(size(c) for _, c in branch)

    spans: list[tuple[int, int]] = []

    def walk(mine: list, other: list, at: int) -> int:
        left = Counter(d for d, _ in other)
        odd = [(d, c) for d, c in other if d not in {x for x, _ in mine}]
        for digest, children in mine:
            if left[digest]:
                left[digest] -= 1
                at += size(children)
            elif isinstance(children, int):
                if spans and spans[-1][1] == at:
                    spans[-1] = (spans[-1][0], at + children)
                elif children:
                    spans.append((at, at + children))
                at += children
            else:               # against the children of all branches that are not matched
                at = walk(children, [c for _, kids in odd for c in kids], at)
        return at
    walk(_branches(a), _branches(b), 0)
    return spans


def edited(text: str, following: str) -> str:
    """The text with its last floor(n/2) code points replaced by the first as many
    of the next document."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_ROW = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_KINDS = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
          "near_edited": pa.float64(), "near_next": pa.float64()}
#: The rows of a stretch as they are written: both fingerprints in one text, so
#: that their common branches are compressed away.
_WRITTEN = {**{c: k for c, k in _KINDS.items() if "fingerprint" not in c}, "prints": pa.string(), "part": pa.int32(), "edge": pa.int32(), "text": pa.string()}
_WRITTEN_ROW = "doc_id bigint, n_chars bigint, edited_sha256 string, near_edited double, near_next double, prints string, part int, edge int, text string"


def _rows(ids: list, texts: list[str], following: list[str], beside: list[str] | None = None) -> dict[str, list]:
    """The result columns of documents whose next texts are ``following`` (their
    fingerprints ``beside``, by default those of the documents that follow here)."""
    new = [edited(t, f) for t, f in zip(texts, following)]
    mine, theirs = fingerprints(texts), fingerprints(new)
    beside = beside or mine[1:] + fingerprints(following[-1:])
    return {"doc_id": ids, "n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in new],
            "fingerprint": mine, "edited_fingerprint": theirs, "near_edited": [likeness(a, b) for a, b in zip(mine, theirs)],
            "near_next": [likeness(a, b) for a, b in zip(mine, beside)]}


def _batch(columns: dict[str, list], kinds: dict) -> pa.RecordBatch:
    n = len(columns["doc_id"])
    return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), kind) for c, kind in kinds.items()], list(kinds))


def _stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The results of all documents of an ordered stretch but the last; its first
    text (edge 0) and last document (edge 1) as they are."""
    ids: list = []
    texts: list[str] = []
    kinds, me = _WRITTEN, TaskContext.get().partitionId()
    begun = False
    for batch in batches:
        for part, _ in pieces(batch):
            ids += part.column(0).to_pylist()
            texts += [t or "" for t in part.column(1).to_pylist()]
            if not begun:
                yield _batch({"doc_id": ids[:1], "part": [me], "edge": [0], "text": texts[:1]}, kinds)
                begun = True
            if len(texts) > 1:
                rows = _rows(ids[:-1], texts[:-1], texts[1:])
                rows["prints"] = [f"{a} {b}" for a, b in zip(rows["fingerprint"], rows["edited_fingerprint"])]
                yield _batch(rows, kinds)
                ids, texts = ids[-1:], texts[-1:]
    if texts:
        yield _batch({"doc_id": ids, "part": [me], "edge": [1], "text": texts}, kinds)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            ids, texts, following = (b.column(k).slice(i, 1).to_pylist() for k in range(3))
            yield _batch(_rows(ids, texts, following, fingerprints(following)), _KINDS)


def compared(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    key = ["doc_id", "hash", "row"]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = rows.repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
    path = scratch_path(docs.sparkSession, "fingerprints")
    ordered.mapInArrow(_stretch, _WRITTEN_ROW).write.option("compression", "zstd").parquet(path)
    done = docs.sparkSession.read.parquet(path)
    both = F.split("prints", " ")
    # the last document of a stretch meets the first text of the next one (of the first after the last)
    edges = done.where("edge is not null").select("part", "edge", "doc_id", "text")
    parts = edges.where("edge = 0").select("part")
    order = Window.orderBy("part")          # one number per stretch
    after = parts.select("part", F.coalesce(F.lead("part").over(order), F.min("part").over(order)).alias("next"))
    first = edges.where("edge = 0").select(F.col("part").alias("next"), F.col("text").alias("following"))
    met = edges.where("edge = 1").join(after, "part").join(first, "next").select("doc_id", "text", "following")
    inner = done.where("edge is null").withColumn("fingerprint", both[0]).withColumn("edited_fingerprint", both[1]).select(*_KINDS)
    return inner.unionByName(met.mapInArrow(_pairs, _ROW))
