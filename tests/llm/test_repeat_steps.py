"""Steps of operator 8 by themselves, and how often it goes over the texts."""

import io
import random
from collections import Counter
from contextlib import redirect_stdout

import numpy as np
import pyarrow as pa

from voxtide.llm import common, repeats


def test_places_are_found_in_one_pass(spark):
    r = random.Random(6)
    line = "".join(r.choices("abcdefgh", k=70))
    docs = spark.createDataFrame([(i, "".join(r.choices("ijkl", k=30)) + line) for i in range(60)], "doc_id bigint, text string").repartition(4)
    found = repeats.spans(docs)
    with redirect_stdout(io.StringIO()) as plan:
        found.explain("simple")
    assert plan.getvalue().count("MapInArrow") == 1
    assert found.count() == 59


def test_dealt_join_takes_every_row_once(spark):
    left = spark.createDataFrame([(k, t, i) for i in range(900) for k, t in ((1, 1), (1, i), (i, 2))], "k bigint, t int, id bigint")
    counts = Counter((x["k"], x["t"]) for x in left.collect())
    rows = [(k, t, n, f"{k}-{t}") for (k, t), n in counts.items() if t != 5] + [(-1, -1, 0, "none")]
    right = spark.createDataFrame(rows, "k bigint, t int, n bigint, value string")
    got = Counter(map(tuple, common.dealt_join(left, right, ["k", "t"], "n", 100_000, ["id"]).select("k", "t", "id", "n", "value").collect()))
    assert got == Counter((x["k"], x["t"], x["id"], counts[x["k"], x["t"]], f"{x['k']}-{x['t']}") for x in left.collect() if x["t"] != 5)


def test_cut_of_spans_in_flat_texts():
    r = random.Random(8)
    texts = [None, "", *("".join(r.choices("abé ", k=r.randint(1, 40))) for _ in range(60))]
    raws = [(t or "").encode() for t in texts]
    spans = [sorted({(a, r.randint(a + 1, len(x))) for a in (r.randrange(len(x)) for _ in range(r.randint(0, 4)))} | ({(0, len(x))} if r.random() < 0.2 else set())) if x else [] for x in raws]
    lists = pa.array([[{"a": a, "b": b} for a, b in s] or None for s in spans], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), lists], ["doc_id", "text", "spans"])
    got = [row for part in repeats._cut(iter([batch.slice(0, 7), batch.slice(7)])) for row in zip(*(c.to_pylist() for c in part.columns))]
    for (doc, size, removed, runs, digest), raw, s in zip(got, raws, spans, strict=True):
        gone = np.zeros(len(raw) + 1, bool)
        for a, b in s:
            gone[a:b] = True
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        assert (size, removed, runs, digest) == (len(raw), gone.sum(), (gone[:-1] & ~gone[1:]).sum(), repeats.hashlib.sha256(kept).hexdigest())


def test_plain_number_sorts_group_and_keep_places():
    rng = np.random.default_rng(2)
    for most in (3, 1000, 2**62):
        key = rng.integers(0, most, 777)
        assert (repeats._order(key) == np.argsort(key, kind="stable")).all()
    assert len(repeats._order(np.zeros(0, np.int64))) == 0
    hashes = common.mix(rng.integers(0, 90, 777).astype(np.uint64))
    order, group = repeats._grouped(hashes)
    assert (group[1:] == group[:-1]).tolist() == (hashes[order][1:] == hashes[order][:-1]).tolist()
    assert (order[1:] > order[:-1])[group[1:] == group[:-1]].all()
