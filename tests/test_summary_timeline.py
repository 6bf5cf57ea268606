"""Aggregates, chunked joins against brute force, timeline upsert/expiry."""

import hashlib
import math

import pandas as pd
from pyspark.sql import functions as F

from voxtide.functions.completers import digest_completer
from voxtide.operators import summary as A
from voxtide.operators.timeline import active_entries, upsert_timeline

TICKETS = "ticket_id STRING, channel STRING, sentiment STRING, body STRING, category STRING, tags ARRAY<STRUCT<id: STRING>>"


def _tickets(spark, n=600):
    rows = []
    for i in range(n):
        # one hot group (channel a, Positive) holds two thirds of the rows
        ch, sent = ("a", "Positive") if i % 3 else (("b", "Negative") if i % 2 else ("c", "Positive"))
        body = None if i % 97 == 0 else ("x" * (i % 50 + 1) + f"#{i}")
        tags = [{"id": "tag/bug"}, {"id": f"tag/{sent}"}]
        rows.append((f"t{i:05d}", ch, sent, body, "bug" if i % 4 else "praise", tags))
    return spark.createDataFrame(rows, TICKETS).repartition(7)


def _brute(pdf: pd.DataFrame, max_chars: int) -> dict:
    out = {}
    for (ch, s), g in pdf.groupby(["channel", "sentiment"]):
        g = g.assign(b=g["body"].fillna("")).sort_values(["ticket_id", "b"])
        size = g["b"].str.len() + 1             # a text and its separator
        start = size.cumsum() - size
        g = g.assign(chunk=(start // max_chars).astype(int))
        for c, gg in g.groupby("chunk"):
            out[(ch, s, c)] = (len(gg), ",".join(gg["b"]))
    return out


def test_join_bodies_matches_brute_force_with_hot_group(spark):
    t = _tickets(spark)
    got = {(r.channel, r.sentiment, r.chunk): (r.n_items, r.text)
           for r in A.join_texts(t, ["channel", "sentiment"], ["ticket_id", "body"], "body", 700, partitions=5).collect()}
    want = _brute(t.toPandas(), 700)
    assert got == want
    # a chunk starts below the bound: at most max_chars + one body + separators
    assert all(len(text) <= 700 + 56 + n for n, text in got.values())


def test_sentiment_pct_and_nan(spark):
    t = _tickets(spark)
    r = A.sentiment_pct(t).first()
    assert r.positive + r.negative == 600
    assert abs(r.positive_pct + r.negative_pct - 100.0) < 1e-9
    e = A.sentiment_pct(t.where("false")).first()
    assert e.positive == 0 and math.isnan(e.positive_pct) and math.isnan(e.negative_pct)


def test_category_counts_pivot_chart(spark):
    t = _tickets(spark)
    counts = {(r.category, r.n) for r in A.category_counts(t).collect()}
    assert counts == {("bug", 450), ("praise", 150)}
    piv = A.category_counts(t, pivot=True).first()
    assert piv["bug"] == 450 and piv["praise"] == 150 and piv["question"] == 0
    chart = A.chart_data(A.category_counts(t)).first()
    assert chart.labels == ["bug", "praise"] and chart.data == [450, 150]


def test_summarise_converges_per_group(spark):
    t = _tickets(spark)
    s, dead = A.summarise(t, digest_completer, max_chars=2000, partitions=4)
    rows = s.collect()
    assert sorted((r.channel, r.sentiment) for r in rows) == [("a", "Positive"), ("b", "Negative"), ("c", "Positive")]
    hot = [r for r in rows if r.channel == "a"][0]
    assert hot.levels >= 2 and hot.actions.startswith("action ")
    assert dead.count() == 0


def test_upsert_latest_and_expiry(spark):
    cols = "entry_id STRING, object STRING, body STRING, body_type STRING, type STRING, visibility STRING, " \
           "expires_at TIMESTAMP, seq BIGINT, updated_at TIMESTAMP"
    old = spark.createDataFrame([], cols)
    rows = [("e1", "o", f"v{i}", "text", "timeline_comment", "internal", None, i, None) for i in range(50)]
    upd = spark.createDataFrame(rows, cols).withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    upd = upd.unionByName(spark.createDataFrame(
        [("e2", "o", "x", "text", "timeline_comment", "internal", None, 1, None)], cols)
        .withColumn("updated_at", F.lit("2024-01-02").cast("timestamp"))
        .withColumn("expires_at", F.lit("2024-01-02 00:01:00").cast("timestamp")))
    latest = {r.entry_id: r for r in upsert_timeline(old, upd).collect()}
    assert latest["e1"].body == "v49" and latest["e2"].body == "x"
    act = active_entries(upsert_timeline(old, upd), F.lit("2024-01-02 00:00:30"))
    assert act.count() == 2
    assert active_entries(upsert_timeline(old, upd), F.lit("2024-01-02 00:01:00")).count() == 1


def test_counts_follow_tags_not_sentiment_field(spark):
    """A ticket whose category is the Positive tag and whose sentiment is
    Negative counts in both shares."""
    rows = [("t1", "a", "Negative", "b", "Positive", [{"id": "tag/Positive"}, {"id": "tag/Negative"}]),
            ("t2", "a", "Positive", "b", "bug", [{"id": "tag/bug"}, {"id": "tag/Positive"}])]
    r = A.sentiment_pct(spark.createDataFrame(rows, TICKETS)).first()
    assert (r.positive, r.negative) == (2, 1)
    assert abs(r.positive_pct - (2 / 3) * 100) < 1e-12


def test_write_timeline_appends(spark, tmp_path):
    from voxtide.operators.timeline import write_timeline
    cols = "entry_id STRING, object STRING, body STRING, body_type STRING, type STRING, visibility STRING, " \
           "expires_at TIMESTAMP, seq BIGINT, updated_at TIMESTAMP"
    e = spark.createDataFrame([("e1", "o", "b", "text", "timeline_comment", "internal", None, 1, None)], cols)
    path = str(tmp_path / "timeline")
    write_timeline(e, path)
    write_timeline(e, path)
    assert spark.read.parquet(path).count() == 2


def _brute_summarise(pdf: pd.DataFrame, max_chars: int) -> dict:
    """Pure-Python rendition of the hierarchical summary on a small fixture."""
    import json as _json

    from voxtide import constants as C

    def js_num(x):
        return "NaN" if math.isnan(x) else (str(int(x)) if x == math.floor(x) else repr(x))

    def tagged(tags, name):
        return any(t["id"] == f"tag/{name}" for t in tags)

    def share(p, n):
        return float("nan") if p + n == 0 else (p / (p + n)) * 100.0

    pct = {ch: share(sum(tagged(t, "Positive") for t in g["tags"]), sum(tagged(t, "Negative") for t in g["tags"])) for ch, g in pdf.groupby("channel")}
    # an item: order, id that cuts, text, positive, negative
    items = {k: [(r.ticket_id, r.ticket_id, r.body or "", tagged(r.tags, "Positive"), tagged(r.tags, "Negative")) for r in g.itertuples()]
             for k, g in pdf.groupby(["channel", "sentiment"])}
    level, done = 0, {}
    while items:
        answers = {}
        for (ch, s), its in items.items():
            chunks, start, stretch = {}, 0, 0
            for item in sorted(its):
                chunks.setdefault((stretch, start // max_chars), []).append(item)
                start += len(item[2]) + 1
                if int(hashlib.md5(f"{level}:{item[1]}".encode()).hexdigest()[:8], 16) % A.FAN == 0:
                    stretch, start = stretch + 1, 0
            for c, mine in chunks.items():
                p, n = sum(i[3] for i in mine), sum(i[4] for i in mine)
                said = pct[ch] if len(chunks) == 1 else share(p, n)
                prompt = C.SUMMARY_PROMPT.replace("{positive_pct}", js_num(said)).replace("{reviews}", ",".join(i[2] for i in mine))
                a = _json.loads(_json.loads(digest_completer([prompt])[0])["choices"][0]["text"])
                a = {k: ",".join(v) if isinstance(v, list) else v for k, v in a.items()}
                answers.setdefault((ch, s), []).append((c, max(i[1] for i in mine), a, p, n))
        level += 1
        done |= {k: (v[0][2], level) for k, v in answers.items() if len(v) == 1}     # finished groups leave
        items = {k: [(c, end, _json.dumps({f: a[f] for f in ("customer_likings", "customer_pain_points", "focus", "actions")}, separators=(",", ":")), p, n)
                     for c, end, a, p, n in v] for k, v in answers.items() if len(v) > 1}
    return done


def _logged(path, fail=()):
    """A completer that writes down the prompts it is asked."""
    def complete(prompts):
        with open(path, "a") as f:
            f.writelines(hashlib.md5(p.encode()).hexdigest() + "\n" for p in prompts)
        return [None if any(x in p for x in fail) else a for p, a in zip(prompts, digest_completer(prompts))]
    return complete


def _asked(path):
    with open(path) as f:
        out = f.read().split()
    open(path, "w").close()
    return out


def _many(spark, n, group="g"):
    rows = [(f"{group}{i:05d}", "social", "Positive", f"body {group} {i}", "bug", [{"id": "tag/bug"}, {"id": "tag/Positive"}]) for i in range(n)]
    return spark.createDataFrame(rows, TICKETS)


def test_one_more_ticket_asks_for_one_chunk_a_level(spark, tmp_path):
    log, store = str(tmp_path / "log"), str(tmp_path / "store")
    t = _many(spark, 600)
    first = A.summarise(t, _logged(log), max_chars=5000, store=store)[0].collect()[0]
    asked = _asked(log)
    assert first.levels >= 3 and len(asked) > 30
    assert A.summarise(t, _logged(log), max_chars=5000, store=store)[0].collect() == [first] and _asked(log) == []
    name = next(f"g00300{c}" for c in "abcdefghij" if int(hashlib.md5(f"0:g00300{c}".encode()).hexdigest()[:8], 16) % A.FAN)
    more = spark.createDataFrame([(name, "social", "Positive", "one more", "bug", [{"id": "tag/bug"}, {"id": "tag/Positive"}])], TICKETS)
    second = A.summarise(t.unionByName(more), _logged(log), max_chars=5000, store=store)[0].collect()[0]
    again = _asked(log)
    assert 1 <= len(again) <= second.levels and second.customer_pain_points != first.customer_pain_points


def test_budget_is_per_group_and_failed_calls_stay_apart(spark, tmp_path):
    log = str(tmp_path / "log")
    many, few = _many(spark, 80), _many(spark, 3, "h").withColumn("channel", F.lit("domain"))
    # answers are longer than the budget, which doubles for the large group alone
    alone = A.summarise(many, _logged(log), max_chars=100)[0].collect()
    both, dead = A.summarise(many.unionByName(few), _logged(log, ("body h 1",)), max_chars=100)
    rows = {r.channel: r for r in both.collect()}
    assert [rows["social"]] == alone and alone[0].levels >= 3 and rows["domain"].n_failed == 1 == dead.count()


def test_summarise_matches_brute_force(spark):
    t = _tickets(spark)
    s, _ = A.summarise(t, digest_completer, max_chars=2000, partitions=3)
    got = {(r.channel, r.sentiment): (r.customer_likings, r.customer_pain_points, r.focus, r.actions, r.levels)
           for r in s.collect()}
    want = {k: (a["customer_likings"], a["customer_pain_points"], a["focus"], a["actions"], lv)
            for k, (a, lv) in _brute_summarise(t.toPandas(), 2000).items()}
    assert got == want


def test_small_group_does_not_depend_on_others(spark):
    t = _tickets(spark)
    small = t.where("channel = 'product'").limit(1)
    one = spark.createDataFrame(small.collect(), small.schema)
    alone, _ = A.summarise(one, digest_completer, by=("channel",), max_chars=3000)
    both, _ = A.summarise(t.where("channel <> 'product'").unionByName(one), digest_completer, by=("channel",), max_chars=3000)
    assert alone.collect() == both.where("channel = 'product'").collect()


def test_failed_chunks_are_counted_and_long_answers_end(spark):
    t = _tickets(spark)

    def some(prompts):
        return [None if len(p) % 2 else a for p, a in zip(prompts, digest_completer(prompts))]
    got, dead = A.summarise(t, some, by=("channel",), max_chars=3000)
    rows = got.collect()
    assert len(rows) == t.select("channel").distinct().count()          # a group without any answer keeps its row
    assert sum(r.n_failed for r in rows) == dead.count() > 0 and all(r.n_chunks >= 1 for r in rows)

    def wordy(prompts):
        import json as _json
        return [_json.dumps({"choices": [{"text": _json.dumps({"customer_likings": "l" * 900, "focus": p[-9:]})}]}) for p in prompts]
    rows = A.summarise(t, wordy, by=("channel",), max_chars=400)[0].collect()
    assert all(len(r.customer_likings) == 900 for r in rows)


def test_empty_bodies_fill_chunks(spark):
    df = spark.range(20000).selectExpr("'g' AS g", "lpad(cast(id as string), 6, '0') AS k", "CAST(NULL AS STRING) AS body")
    got = A.join_texts(df, ["g"], ["k"], "body", 100).collect()
    assert len(got) == 200 and all(r.n_items == 100 for r in got)
    same = spark.range(1000).selectExpr("'g' AS g", "'k' AS k", "'0123456789' AS body")
    got = A.join_texts(same, ["g"], ["k"], "body", 110, partitions=7).collect()
    assert len(got) == 100 and all(r.text == ",".join(["0123456789"] * 10) for r in got)


def test_merged_counts_equal_the_full_aggregate(spark, tmp_path):
    t, path = _tickets(spark), str(tmp_path / "counts")
    part = F.pmod(F.hash("ticket_id"), F.lit(3))
    for batch in (0, 1, 2, 1):                      # three appends, one of them replayed
        A.write_counts(t.where(part == batch), path, batch)
    counts = A.read_counts(spark, path)
    for by in ((), ("channel",)):
        assert sorted(A.merged_pct(counts, by).collect()) == sorted(A.sentiment_pct(t, by).collect())
    assert sorted(A.merged_category_counts(counts, ("channel",)).collect()) == sorted(A.category_counts(t, ("channel",)).collect())
