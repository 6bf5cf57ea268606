"""Operator 2, SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut where no piece reaches across: before each run of the space symbol
and around characters that stand alone in the vocabulary.  The distinct words of
a chunk are laid out as one flat numpy symbol array.  In each round every word
finds its best pair by a segmented minimum of the pair ranks, merges all its
leftmost non-overlapping occurrences at once, and the array is compacted; words
without a pair leave, until none remains.  Where a merge could open a pair that
ranks before the current one, a word merges its first occurrence only, so the
result is that of merging one pair at a time.  Characters outside the vocabulary
become byte pieces.  Decoding joins the pieces' bytes, drops the space of the
leading word mark and replaces bytes that are no UTF-8 by U+FFFD.

The vocabulary is read on the driver (its size is that of the model file) and
broadcast; encoded words are kept per Python worker, at most ``KEEP_WORDS``.

Defined results: a null or empty text gives the begin and end ids only and
decodes to an empty text; a null id stays null; repeated rows each get their
row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxtide.llm.common import lean, pieces as slices

SPACE = "▁"
#: Encoded words kept by a worker, and text bytes coded at once: small beside the worker itself.
KEEP_WORDS, SLICE = 40_000, 1 << 17
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Tables of a BPE model with byte fallback, identity normaliser and dummy prefix."""

    def __init__(self, model_file: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        kinds = [p.type for p in model.pieces]
        norm, train = model.normalizer_spec, model.trainer_spec
        if train.model_type != 2 or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.add_dummy_prefix or train.treat_whitespace_as_suffix or _USER in kinds or _UNUSED in kinds:
            raise ValueError("not a plain BPE model with byte fallback and identity normaliser")
        self.bos, self.eos, self.unk = train.bos_id, train.eos_id, kinds.index(_UNKNOWN)
        names = [p.piece for p in model.pieces]
        symbol = {p: i for i, (p, k) in enumerate(zip(names, kinds)) if k == _NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in symbol):
            raise ValueError("a piece reaches across a space")
        self.n = len(names)
        for p in [p for p in symbol if len(p) > 1]:     # characters that are no piece by themselves
            for c in p:
                symbol.setdefault(c, self.n + len(symbol))
        self.size = max(symbol.values()) + 1
        order = sorted({-p.score for p, k in zip(model.pieces, kinds) if k == _NORMAL})
        rank_of = {s: i for i, s in enumerate(order)}
        table = []
        for p, i in symbol.items():
            if i < self.n and len(p) > 1:
                table += [(symbol[p[:k]] * self.size + symbol[p[k:]], rank_of[-model.pieces[i].score], i)
                          for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        table.sort()
        self.key, rank, self.made = (np.array(c, np.int64) for c in zip(*table))
        self.rank = rank.astype(np.int32)
        opens = np.full(self.size, _NONE, np.int64)     # best rank of a pair that the symbol is part of
        for part in (self.key // self.size, self.key % self.size):
            np.minimum.at(opens, part, rank)
        self.one_by_one = opens[self.made] <= rank
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.byte = [names.index(f"<0x{b:02X}>") for b in range(256)]
        inner = {c for p, i in symbol.items() if i < self.n and len(p) > 1 for c in p}
        alone = "".join(re.escape(c) for c in map(chr, range(1, 32)) if c not in inner)
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+|[{alone}]")
        self.surface = [b"" if k == _CONTROL else train.unk_surface.encode() if k == _UNKNOWN
                        else bytes([int(p[3:5], 16)]) if k == _BYTE else p.replace(SPACE, " ").encode() for p, k in zip(names, kinds)]
        self.kind = kinds
        self._controls = {i for i, k in enumerate(kinds) if k == _CONTROL}

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Table rows of the pairs, -1 where there is none."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where((self.key[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian unsigned 32-bit integers."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.char[points].astype(np.int64)
        sym = np.where(sym < 0, -1 - points.astype(np.int64), sym)
        ids, word = self._bytes(*self._rounds(sym, np.repeat(np.arange(len(words)), lengths)))
        ends = np.searchsorted(word, np.arange(len(words)), "right") * 4
        flat, at, out = ids.astype("<u4").tobytes(), 0, []
        for e in ends.tolist():
            out.append(flat[at:e])
            at = e
        return out

    def _rounds(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        done = []
        pair = np.full(len(sym), -1, np.int64)      # table row of (i, i + 1), -1 at a word's end
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair[inner] = self.find(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(first, len(word)))
            rank = np.where(pair >= 0, self.rank[pair], _NONE)
            best = np.repeat(np.minimum.reduceat(rank, first), length)
            live = best < _NONE
            if not live.all():
                done.append((sym[~live], word[~live]))
                sym, word, pair, rank, best = (a[live] for a in (sym, word, pair, rank, best))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            careful = self.one_by_one[pair[at]]
            if careful.any():
                of = word[at]
                head = np.concatenate([[True], of[1:] != of[:-1]])
                slow = np.zeros(of[-1] + 1, bool)
                slow[of[careful]] = True
                at = at[head | ~slow[of]]
            run = np.concatenate([[True], at[1:] != at[:-1] + 1])
            start = at[run][np.cumsum(run) - 1]
            at = at[(at - start) % 2 == 0]
            sym = sym.copy()
            sym[at] = self.made[pair[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            now = (np.cumsum(keep) - 1)[at]         # places of the merged symbols after compaction
            sym, word, pair = sym[keep], word[keep], pair[keep]
            last = np.concatenate([word[1:] != word[:-1], [True]])
            touched = np.zeros(len(sym), bool)
            touched[now] = touched[now[now > 0] - 1] = True
            pair[touched] = -1
            fresh = np.flatnonzero(touched & ~last)
            pair[fresh] = self.find(sym[fresh], sym[fresh + 1])
        if not done:
            return sym, word
        sym, word = (np.concatenate(a) for a in zip(*done))
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]

    def _bytes(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols outside the vocabulary as byte pieces."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.n))
        if not len(odd):
            return sym, word
        point_of = {int(self.char[p]): p for p in np.flatnonzero(self.char >= self.n)}
        spelled = [[self.byte[b] for b in chr(-1 - s if s < 0 else point_of[s]).encode()] for s in sym[odd].tolist()]
        times = np.ones(len(sym), np.int64)
        times[odd] = [len(x) for x in spelled]
        out, word = np.repeat(sym, times), np.repeat(word, times)
        out[np.isin(np.repeat(np.arange(len(sym)), times), odd)] = [b for x in spelled for b in x]
        return out, word

    def words(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; a control piece also ends a run of byte pieces."""
        inner = [i for i, x in enumerate(ids[1:-1], 1) if self.kind[x] == _CONTROL] if self._controls.intersection(ids[1:-1]) else []
        runs = [ids[a:b] for a, b in zip([0, *inner], [*inner, len(ids)])]
        out = "".join(_text(b"".join(map(self.surface.__getitem__, run))) for run in runs)
        lead = next((i for i in ids if self.kind[i] != _CONTROL), None)
        return out[1:] if lead is not None and self.kind[lead] == _NORMAL and out[:1] == " " else out


def _text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return _repair(raw)


def _repair(raw: bytes) -> str:
    """UTF-8 where each byte of an invalid sequence becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        for n in range(1, 5):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_KEPT: dict[str, bytes] = {}


def encode_texts(vocabulary: Vocabulary, texts: list[str], kept: dict[str, bytes]) -> list[bytes]:
    """The ids of each text, begin and end ids included; ``kept`` holds encoded words."""
    cut = [vocabulary.words(t) for t in texts]
    if len(kept) > KEEP_WORDS:
        kept.clear()
    new = list(set().union(*cut).difference(kept))
    if new:
        kept.update(zip(new, vocabulary.encode_words(new)))
    bos, eos = (np.uint32(i).astype("<u4").tobytes() for i in (vocabulary.bos, vocabulary.eos))
    return [b"".join([bos, *map(kept.__getitem__, words), eos]) for words in cut]


def _coder(shared, with_ids: bool):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for part, _ in slices(batch, limit=SLICE):
                coded = encode_texts(vocabulary, [t or "" for t in part.column(1).to_pylist()], _KEPT)
                numbers = [np.frombuffer(c, "<u4") for c in coded]
                decoded = [vocabulary.decode(n.tolist()) for n in numbers]
                columns = [part.column(0).cast(pa.int64()), pa.array([len(n) for n in numbers], pa.int64())]
                if with_ids:
                    flat = np.concatenate(numbers).astype(np.int32) if numbers else np.zeros(0, np.int32)
                    ends = np.cumsum([0, *map(len, numbers)]).astype(np.int32)
                    columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(decoded, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded"])
                else:
                    columns += [pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
                                for xs in (coded, [d.encode() for d in decoded])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return code


def code(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids, decoded."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_file))
    return docs.select("doc_id", "text").mapInArrow(lean(_coder(shared, True)), "doc_id bigint, n_tokens bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """``code`` with the ids and the decoded text as SHA-256 digests."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(model_file))
    return docs.select("doc_id", "text").mapInArrow(lean(_coder(shared, False)), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
