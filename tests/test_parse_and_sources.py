"""Answer parsing (N2–N11, P2, P10), tag resolution and payload readers."""

import json

from pyspark.sql import functions as F

from voxtide.operators.annotate import parse_annotation, parse_completion, parse_summary
from voxtide.operators.tickets import resolve_tags
from voxtide.sources import payloads as S
from voxtide.sources.tables import tags_df

GOOD = {"Relevance": True, "Sentiments": "Positive", "Category": "bug", "sub_category": "minor",
        "Severity": "High", "Feature": "login", "insight": "i", "description": "d", "response": "r",
        "review": "x"}


def _answers(spark):
    rows = [
        ("valid", json.dumps(GOOD)),
        ("not_json", "sorry, I cannot"),
        ("truncated", json.dumps(GOOD)[:30]),
        ("array", json.dumps([GOOD])),
        ("rel_false", json.dumps({**GOOD, "Relevance": "false"})),
        ("cat_missing", json.dumps({k: v for k, v in GOOD.items() if k != "Category"})),
        ("cat_unknown", json.dumps({**GOOD, "Category": "feature_request"})),
        ("cat_case", json.dumps({**GOOD, "Category": "Bug"})),
        ("cat_positive", json.dumps({**GOOD, "Category": "Positive"})),
        ("neutral", json.dumps({**GOOD, "Sentiments": "Neutral"})),
        ("null", None),
    ]
    return spark.createDataFrame(rows, "review_id STRING, answer STRING").withColumn("channel", F.lit("appstore"))


def test_parse_annotation_cases(spark):
    good, dead = parse_annotation(_answers(spark))
    g = {r.review_id: r for r in good.collect()}
    d = {r.key: r.reason for r in dead.collect()}
    assert d == {"not_json": "malformed_answer", "truncated": "malformed_answer", "array": "malformed_answer",
                 "null": "inference_failed"}
    assert g["valid"].relevance is True and g["rel_false"].relevance is False
    assert g["valid"].category == "bug" and g["cat_missing"].category is None
    # good rows + dead letters = input rows
    assert len(g) + len(d) == 11


def test_resolve_tags_fallback_and_unknown_sentiment(spark):
    good, _ = parse_annotation(_answers(spark))
    res, dead = resolve_tags(good, tags_df(spark))
    r = {x.review_id: x for x in res.collect()}
    assert r["valid"].category == "bug"
    assert [t.id for t in r["valid"].tags] == ["tag/bug", "tag/Positive"]
    assert r["cat_unknown"].category == "failed_to_infer_category"
    assert r["cat_missing"].category == "failed_to_infer_category"
    assert r["cat_case"].category == "failed_to_infer_category"          # case-sensitive
    assert [t.id for t in r["cat_positive"].tags] == ["tag/Positive", "tag/Positive"]  # duplicates kept
    assert {x.key: x.reason for x in dead.collect()} == {"neutral": "unknown_sentiment"}


def test_completion_envelope(spark):
    df = spark.createDataFrame([('{"choices":[{"text":"abc"}]}',), ('{"choices":[]}',), ("oops",), (None,)], "c STRING")
    assert [r[0] for r in df.select(parse_completion(F.col("c"))).collect()] == ["abc", None, None, None]


def test_parse_summary_actions_array(spark):
    rows = [("k1", json.dumps({"customer_likings": "a", "customer_pain_points": "b", "focus": "c", "actions": "d"})),
            ("k2", json.dumps({"customer_likings": "a", "customer_pain_points": "b", "focus": ["x", "y"],
                               "actions": ["p", "q"]})),
            ("k3", "nope")]
    s, dead = parse_summary(spark.createDataFrame(rows, "chunk_key STRING, answer STRING"))
    got = {r.chunk_key: r for r in s.collect()}
    assert got["k1"].actions == "d" and got["k2"].actions == "p,q" and got["k2"].focus == "x,y"
    assert [r.key for r in dead.collect()] == ["k3"]


def test_payload_readers_edge_cases(spark):
    raw = spark.createDataFrame([
        ("social", 1, json.dumps({"results": [{"tweet_id": "1", "text": "hi", "expanded_url": ""},
                                             {"tweet_id": "2", "text": None}]})),
        ("social", 2, json.dumps({"results": []})),
        ("social", 3, json.dumps({"error": "rate limited"})),
        ("social", 4, "<html>"),
        ("appstore", 1, json.dumps({"data": [{"id": "a", "title": "", "text": "t", "rating": 5}]})),
        ("business", 1, json.dumps({"reviews": [{"author": "ann", "comment": "ok"}, {"author": "ann", "comment": "ok"}]})),
        ("domain", 1, json.dumps({"reviews": [{"title": "T", "text": "x"}]})),
        ("product", 1, json.dumps({"initial_reviews": [{"review_id": "g1", "review_content": "c"}]})),
    ], "channel STRING, page BIGINT, payload STRING")
    reviews, dead = S.read_all(raw)
    rows = reviews.collect()
    assert len(rows) == 7
    soc = {r.review_id: r for r in rows if r.channel == "social"}
    assert soc["1"].url == "" and soc["2"].text is None and soc["2"].url is None
    biz = [r for r in rows if r.channel == "business"]
    assert len(biz) == 2 and biz[0].review_id == biz[1].review_id  # equal reviews share a key, stay separate
    assert {(r.key, r.reason) for r in dead.collect()} == {("social:3", "missing_envelope"),
                                                           ("social:4", "malformed_payload")}


def test_domain_first_page_only(spark):
    raw = spark.createDataFrame([
        ("domain", 1, json.dumps({"reviews": [{"title": "a", "text": "x"}]})),
        ("domain", 2, json.dumps({"reviews": [{"title": "b", "text": "y"}]})),
    ], "channel STRING, page BIGINT, payload STRING")
    revs, _ = S.read_domain(raw, pages=[1])
    assert [r.title for r in revs.collect()] == ["a"]
    revs_all, _ = S.read_domain(raw)
    assert revs_all.count() == 2


def test_check_model_split(spark):
    from voxtide.operators.filters import check_model, mark_allowed
    from voxtide.sources.tables import allowed_models_df
    cfg = spark.createDataFrame([("a", "mixtral-8x7b-instruct"), ("b", "gpt-x"), ("c", None)],
                                "app STRING, llm_model STRING")
    ok, bad = check_model(cfg, allowed_models_df(spark))
    assert [r.app for r in ok.collect()] == ["a"]
    assert sorted(r.app for r in bad.collect()) == ["b", "c"]
    marked = {r.app: r.accepted for r in mark_allowed(cfg, allowed_models_df(spark)).collect()}
    assert marked == {"a": True, "b": False, "c": False}


def test_webhook_event_with_spaced_created_date(spark, tmp_path):
    """S7/W3 on a hand-written work-created event shaped like the one landed
    fixture: a JSON array, nested owners, stray spaces in created_date."""
    from voxtide.sources.tables import read_events
    from voxtide.streaming.jobs import flatten_work_created
    event = [{
        "payload": {"id": "evt-1", "timestamp": "2023-04-03T14:14:30.336123Z", "type": "work_created",
                    "unique_key": "k-1", "webhook_id": "hook-1",
                    "work_created": {"work": {
                        "applies_to_part": {"id": "part-1", "name": "Part", "type": "product"},
                        "created_by": {"id": "user-1", "display_name": "Ann"},
                        "created_date": "2023-04-03T14: 14: 30.336Z", "custom_fields": None,
                        "display_id": "TKT-1", "id": "work-1",
                        "owned_by": [{"id": "user-1"}, {"id": "user-2"}],
                        "severity": "medium", "stage": {"name": "queued", "ordinal": 10},
                        "state": "open", "title": "Title", "type": "ticket"}}},
        "context": {"snap_in_id": "app-1", "dev_oid": "org-1", "snap_in_version_id": "v1"},
    }]
    path = tmp_path / "events.json"
    path.write_text(json.dumps(event, indent=2))
    flat = flatten_work_created(read_events(spark, str(path))).orderBy("owner_id").collect()
    assert [r.owner_id for r in flat] == ["user-1", "user-2"]
    r = flat[0]
    assert r.stage_ordinal == 10 and r.severity == "medium" and r.app_id == "app-1"
    assert r.created_ts.isoformat().startswith("2023-04-03T14:14:30.336")
    assert r.event_ts.isoformat().startswith("2023-04-03T14:14:30.336123")


def test_ratings_that_are_no_whole_numbers(spark):
    from voxtide.sources import payloads as S
    items = [{"id": "a", "text": "t", "rating": 5}, {"id": "b", "text": "t", "rating": 4.5}, {"id": "c", "text": "t", "rating": "five"}, {"id": "d", "text": "t"}, {"id": "e", "text": "t", "rating": "3"}]
    raw = spark.createDataFrame([("appstore", 1, json.dumps({"data": items}))], "channel STRING, page BIGINT, payload STRING")
    for good, dead in (S.read_all(raw), S.read_appstore(raw)):
        assert {r.review_id: r.rating for r in good.collect()} == {"a": 5, "b": None, "c": None, "d": None, "e": 3}
        assert sorted((r.key, r.reason, r.raw) for r in dead.collect()) == [("b", "bad_rating", "4.5"), ("c", "bad_rating", "five")]
