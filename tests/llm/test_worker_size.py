"""What a Python worker holds while it codes texts."""

import numpy as np
import pyarrow as pa

from voxtide.llm import piece_coding
from voxtide.llm.queries import piece_model


def test_kept_words_and_pieces_stay_small(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join("".join(chr(97 + c) for c in w) for w in rng.integers(0, 26, (2000, 7))) for _ in range(60)] + ["", None, "x\ty z"]
    monkeypatch.setattr(piece_coding, "_KEPT", kept := {})
    shared = type("Shared", (), {"value": piece_coding.Vocabulary(piece_model())})
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    most, coded = 0, []
    for part in piece_coding._coder(shared, True)(iter([batch])):
        most = max(most, len(kept))
        coded += zip(part.column(1).to_pylist(), part.column(3).to_pylist())
    assert [d for _, d in coded] == [t or "" for t in texts]        # 120,000 different words
    assert most < 70_000
