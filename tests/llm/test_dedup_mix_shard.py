"""Operators 4, 5 and 6 on hard cases, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from voxtide.llm import exact_dedup, mixing, sharding
from voxtide.llm.queries import ORACLE_SQL


def norm(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute_groups(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r["text"])].append(r["doc_id"])
    return {t: (min((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_exact_dedup_matches_brute_force(hard):
    for fan in (2, 8):
        got = exact_dedup.dedup(hard, fan).collect()
        want = brute_groups(hard.collect())
        by_digest = {hashlib.sha256(t.encode()).digest(): v for t, v in want.items()}
        assert len(got) == hard.count()
        assert all((r["keep_id"], r["group_size"]) == by_digest[bytes(r["digest"])] for r in got)
        kept = Counter(bytes(r["digest"]) for r in got if r["kept"])
        assert kept == Counter(by_digest.keys())                       # one row each, repeated rows included
        assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_drop_copies_keeps_columns_and_one_row_each(hard):
    left = exact_dedup.drop_copies(hard)
    assert left.columns == hard.columns
    want = brute_groups(hard.collect())
    assert sorted((norm(r["text"]), str(r["doc_id"])) for r in left.collect()) == sorted((t, str(i)) for t, (i, _) in want.items())


def test_hot_group_is_one_entry_per_run(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot text' else concat('t', id) end as text").repartition(11)
    groups = exact_dedup.tree_merge(exact_dedup.entries(rows), 5000, 2).collect()
    sizes = Counter(g["group_size"] for g in groups)
    assert sizes == {1: 3333, 1667: 1} and min(g["keep_id"] for g in groups if g["group_size"] > 1) == 0


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_ = sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else weight[s] * rest / open_ for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not over or not open_:
            return target
        capped |= over


def test_mixture(hard):
    got = mixing.mixture(hard).collect()
    rows = hard.collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    target = brute_targets({s: sizes[s] for s in {r["source"] for r in rows}})
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"], round(r["target"], 6)) for r in got) == sorted(
        (str(r["doc_id"]), size(r["text"]), sizes[r["source"]], round(target[r["source"]], 6)) for r in rows)
    assert all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture(hard).collect()))


def test_mix_repeats_rows_as_the_mixture_says(hard):
    mixed = mixing.mix(hard)
    assert mixed.columns == hard.columns
    words = Counter()
    for r in mixed.collect():
        words[r["doc_id"]] += len(re.findall("[^\x20\x09-\x0d]+", r["text"] or ""))
    want = Counter()
    for r in mixing.mixture(hard).collect():
        want[r["doc_id"]] += r["taken"]
    assert +words == +want


def test_taken_words_come_near_targets(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(5 + id % 90 as int)) as text", "concat('s', id % 4) as source")
    rows = mixing.mixture(docs).groupBy((F.col("doc_id") % 4).alias("s")).agg(F.first("target"), F.sum("taken")).collect()
    assert len(rows) == 4 and all(abs(r[2] - r[1]) < 0.01 * r[1] for r in rows)


def test_rows_that_share_an_id_draw_each_on_its_own(spark, tmp_path):
    """A source of null ids and one of a single id, copies among them, come as near
    to their targets as others; SQL and reruns over other partitions agree."""
    rows = [(None, f"{'w ' * (20 + i % 30)}{i % 50}", "a", i % 3) for i in range(600)] + [(7, "one text for all " * 9, "b", None) for i in range(300)]
    rows += [(1000 + i, "z " * (10 + i % 9), "c", 0) for i in range(300)] + [(7, None, None, 0), (7, "", None, 0), (None, None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, extra int")
    got = mixing.mixture(docs.repartition(5)).collect()
    taken, target = Counter(), {}
    first = {i: min(s for d, _, s, _ in rows if d == i and s) for i in (None, 7)}
    for r in got:
        source = first.get(r["doc_id"], "c") if r["source_size"] else None
        taken[source] += r["taken"]
        target[source] = r["target"]
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) < 0.01 * target[s] for s in "abc")
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixture(docs.coalesce(1)).collect()))
    mixed = [sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (1, 7)]
    assert mixed[0] == mixed[1]
    words = Counter()
    for r in mixing.mix(docs).collect():
        words[r["source"]] += len(re.findall("[^\x20\x09-\x0d]+", r["text"] or ""))
    assert +words == +taken
    docs.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    want = con.sql(ORACLE_SQL["op5_source_mix"]).fetchall()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == Counter((r[0], r[1], r[4]) for r in want)


def test_shards(hard, spark):
    big = spark.range(4000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'hot' else repeat(concat('t', id), cast(1 + id % 40 as int)) end as text")
    for docs, shards in ((hard, 2), (big, 8)):
        rows = docs.collect()
        got = sharding.shard(docs, shards).collect()
        size = lambda t: len((t or "").encode()) + 1
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted((str(r["doc_id"]), size(r["text"]), zlib.crc32((r["text"] or "").encode())) for r in rows)
        total, largest, held, slots = sum(size(r["text"]) for r in rows), max(size(r["text"]) for r in rows), Counter(), defaultdict(list)
        for r in got:
            held[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert set(held) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert all(abs(held[s] - total / shards) <= largest for s in range(shards))


def test_overfull_ranges_are_cut(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "'same text' as text")
    rows = sharding.records(docs)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    total = rows.agg({"size": "sum"}).first()[0]
    splitters = sharding.split(rows, total, 16)
    ranges = sharding.ranged(rows, splitters).groupBy("range").sum("size").collect()
    assert max(r[1] for r in ranges) <= 2 * (total // 16) + 10


def test_ranges_are_cut_by_rows_too(spark):
    """A table of many null texts among few long ones: no range over two parts of the rows."""
    docs = spark.range(6000).selectExpr("case when id % 7 > 0 then id end as doc_id", "case when id % 30 = 0 then repeat(cast(id as string), 500) end as text")
    rows = spark.createDataFrame(sharding.records(docs).collect(), sharding.records(docs).schema)
    splitters = sharding.split(rows, rows.agg({"size": "sum"}).first()[0], 16)
    assert max(r["count"] for r in sharding.ranged(rows, splitters).groupBy("range").count().collect()) <= 2 * 6000 / 16 + 1


def test_shards_follow_the_whole_order(spark):
    """Brute force of the law: records in the order of the key, equal slices of all bytes."""
    docs = spark.range(700).selectExpr("case when id % 9 > 0 then id % 500 end as doc_id", "case when id % 4 = 0 then 'copy' else repeat(cast(id as string), cast(id % 13 as int)) end as text")
    rows = spark.createDataFrame(docs.collect(), docs.schema).repartition(3)
    keyed = sorted((r["hash"], r["missing"], r["id"], r["size"], str(r["doc_id"]), r["text_crc32"]) for r in sharding.records(rows).collect())
    total, start, want, slots = sum(k[3] for k in keyed), 0, [], Counter()
    for k in keyed:
        shard = start * 5 // total
        want.append((k[4], k[5], k[3], shard, slots[shard]))
        slots[shard] += 1
        start += k[3]
    assert sorted((str(r["doc_id"]), r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in sharding.shard(rows, 5).collect()) == sorted(want)


def test_runs_merge_in_linear_steps(monkeypatch):
    """Entries are gathered before they are merged: few merges, the same run."""
    import numpy as np
    import pyarrow as pa
    calls = []
    merge = exact_dedup._merge
    monkeypatch.setattr(exact_dedup, "_merge", lambda *a: calls.append(len(a[1])) or merge(*a))
    monkeypatch.setattr(exact_dedup, "MERGE_ENTRIES", 100)
    monkeypatch.setattr(exact_dedup, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    rng = np.random.default_rng(3)
    ids, digests = np.arange(4000), [bytes([d % 251]) * 32 for d in rng.integers(0, 4000, 4000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[i:i + 20]), pa.array(digests[i:i + 20], pa.binary()), pa.array(ids[i:i + 20])], ["doc_id", "digest", "row"]) for i in range(0, 4000, 20)]
    (out,) = exact_dedup._runs(1)(iter(batches))
    got = np.frombuffer(out.column(out.schema.get_field_index("counts"))[0].as_py(), np.int64)
    assert got.sum() == 4000 and len(got) == len(set(digests))
    assert sum(calls) <= 4 * 4000 and len(calls) < 100


def test_empty_tables(empty):
    assert exact_dedup.dedup(empty).count() == exact_dedup.drop_copies(empty).count() == 0
    assert mixing.mixture(empty).count() == mixing.mix(empty).count() == 0
    assert sharding.shard(empty).count() == 0
