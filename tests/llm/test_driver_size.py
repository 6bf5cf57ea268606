"""What the driver holds while it trains on its sample."""

import tracemalloc

import numpy as np
import pyarrow as pa

from voxtide.llm import common, quality


def _sample():
    rng = np.random.default_rng(5)
    words = np.array(["river", "bank", "seven", "small", "birds", "sing", "tall", "trees", "BUY", "$$$ now!", "fox"])
    texts = ["\n".join(" ".join(words[w]) for w in rng.integers(0, 8 + 3 * (k % 2), (20, 20))) for k in range(1000)]
    return [*texts, "", "\n \n"], [*(1 - k % 2 for k in range(1000)), 1, 0]


def test_quality_sample_is_described_piece_by_piece():
    texts, _ = _sample()
    common._powers(common.CHUNK + 1)
    tracemalloc.start()
    of, place, x = quality._sample_lines(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * sum(map(len, texts))          # the whole sample's flat arrays take some sixty times its bytes
    lines = quality.Lines(common.Flat(pa.array(texts, pa.large_string())))
    assert (of == lines.of).all() and (x == lines.x).all()
    assert (place == np.tile(np.arange(20), 1000)).all()


def test_quality_training_takes_no_whole_sample(monkeypatch):
    texts, good = _sample()
    monkeypatch.setattr(quality, "ROUNDS", 2)
    common._powers(common.CHUNK + 1)
    tracemalloc.start()
    field = quality.train(texts, good)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert field.w.shape == (len(quality.FEATURES), 2)
    assert peak < 20 * sum(map(len, texts))
