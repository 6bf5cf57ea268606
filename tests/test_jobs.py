"""Model annotation with failures (N1), ticket sink (K1), invariants, command events."""

import json
import tempfile

from pyspark.sql import functions as F

from stand_ins import length_rule_completer
from voxtide.operators.annotate import NOT_STORED, annotate, parse_annotation, store_answers
from voxtide.operators.tickets import write_tickets
from voxtide.plans import review_job
from voxtide.streaming.jobs import command_events

SF = "/root/testdata/sf0.001"


def test_annotate_failing_completer_fills_dead_letters(spark):
    def flaky(prompts):
        out = []
        for p in prompts:
            if p.endswith("boom"):
                raise RuntimeError("service down")  # whole batch fails
            out.append(None if p.endswith("none") else json.dumps({"choices": [{"text": json.dumps(
                {"Sentiments": "Positive", "Category": "bug", "Severity": "Low"})}]}))
        return out

    df = spark.createDataFrame([("r1", "ok"), ("r2", "none"), ("r3", "ok"), ("r4", "ok")], "review_id STRING, prompt STRING")
    ans = annotate(df, flaky, partitions=2)
    good, dead = parse_annotation(ans.drop("completion"))
    assert sorted(r.review_id for r in good.collect()) == ["r1", "r3", "r4"]
    assert [(r.key, r.reason) for r in dead.collect()] == [("r2", "inference_failed")]
    # identical prompts are inferred once: one completion row per distinct prompt
    assert ans.select("prompt_key").distinct().count() == 2

    boom = spark.createDataFrame([("r9", "boom")], "review_id STRING, prompt STRING")
    g2, d2 = parse_annotation(annotate(boom, flaky).drop("completion"))
    assert g2.count() == 0 and [r.reason for r in d2.collect()] == ["inference_failed"]


def test_model_completer_answers_are_written_once(spark):
    df = spark.createDataFrame([("r1", "x" * 10), ("r2", "y" * 22)], "review_id STRING, prompt STRING")
    a = annotate(df.withColumn("prompt", F.concat(F.lit("no mark "), "prompt")), length_rule_completer)
    # the completer never saw its marker: every answer is a failure, not an exception
    assert a.where(F.col("answer").isNull()).count() == 2


def test_failed_calls_keep_their_message(spark):
    def refuses(prompts):
        """Fails a whole call over one prompt, as a service does over bad input."""
        if any(len(p) % 7 == 0 for p in prompts):
            raise ValueError("refused input")
        return [json.dumps({"choices": [{"text": "{}"}]}) for _ in prompts]
    df = spark.createDataFrame([(f"r{i}", "x" * i) for i in range(1, 30)], "review_id STRING, prompt STRING")
    rows = annotate(df, refuses, partitions=1).collect()
    assert {r["review_id"] for r in rows if r["error"] is None} == {f"r{i}" for i in range(1, 30) if i % 7}
    assert {r["error"] for r in rows if r["answer"] is None} == {"ValueError: refused input"}


def test_stored_answers_are_replayed_and_the_rest_is_asked(spark, tmp_path):
    rows = [(5, "same"), (3, "same"), (4, "same"), (6, "own"), (7, "none"), (8, "null"), (None, "same"), (9, None)]
    prompts = spark.createDataFrame(rows, "doc_id BIGINT, prompt STRING").withColumn("prompt_key", F.sha2("prompt", 256))
    answers = spark.createDataFrame([(5, "five"), (4, "four"), (6, 'a "quoted"\nanswer'), (8, None), (11, "of no review")], "doc_id BIGINT, answer STRING")
    store = str(tmp_path / "answers")
    assert [r["error"] for r in annotate(prompts, store=store).collect()] == [NOT_STORED] * len(rows)     # no store yet
    store_answers(prompts, answers, store)
    got = {(r["doc_id"], r["answer"], r["error"]) for r in annotate(prompts, store=store).collect()}
    assert got == {(5, "four", None), (3, "four", None), (4, "four", None), (None, "four", None), (6, 'a "quoted"\nanswer', None),
                   (7, None, NOT_STORED), (8, None, NOT_STORED), (9, None, NOT_STORED)}
    asked = spark.sparkContext.accumulator(0)

    def counted(texts):
        asked.add(sum(t is not None for t in texts))
        return [None if t is None else json.dumps({"choices": [{"text": f"model: {t}"}]}) for t in texts]
    again = {r["doc_id"]: r["answer"] for r in annotate(prompts.where("prompt is not null"), counted, store=store).collect()}
    assert again == {5: "four", 3: "four", 4: "four", None: "four", 6: 'a "quoted"\nanswer', 7: "model: none", 8: "model: null"} and asked.value == 2


def test_review_job_invariants(spark):
    from voxtide.sources import views
    run = review_job.run_labels(spark, SF)
    n_in = views.reviews(spark, SF).count()            # from the source, before any join
    dead = run.dead_letters.groupBy("stage").count().collect()
    n_dead = sum(r["count"] for r in dead)
    assert run.tickets.count() + n_dead == n_in        # good rows + dead letters = input rows
    tl = review_job.timeline_for(run.tickets, "2024-01-01 00:00:00")
    per = {r.channel: r.n for r in run.tickets.groupBy("channel").agg(F.count("*").alias("n")).collect()}
    expect = sum(n * (7 if ch in ("appstore", "domain") else 6) for ch, n in per.items())
    assert tl.count() == expect                        # status + 5 (or 6) comments per ticket


def test_write_tickets_skip_existing(spark):
    run = review_job.run_labels(spark, SF)
    path = tempfile.mkdtemp(prefix="voxtide-tickets-") + "/t"
    first = run.tickets.where(F.col("channel") == "social")
    write_tickets(first, path)
    n_first = spark.read.parquet(path).count()
    write_tickets(run.tickets, path, skip_existing=True)
    total = spark.read.parquet(path)
    assert total.count() == run.tickets.count()
    assert total.select("ticket_id").distinct().count() == total.count()
    assert n_first == first.count()


def test_command_events_first_per_delivery(spark):
    rows = [(i, i // 3, "5" if i % 2 else "x") for i in range(9)]
    df = spark.createDataFrame(rows, "event_id BIGINT, delivery_id BIGINT, parameters STRING")
    allv = {r.event_id: r.n for r in command_events(df, "all").collect()}
    assert allv == {i: (5 if i % 2 else 10) for i in range(9)}
    first = sorted(r.event_id for r in command_events(df, "first").collect())
    assert first == [0, 3, 6]


def test_read_events_batch_matches_flatten(spark, tmp_path):
    """Landed JSON-array files read in batch with the explicit schema."""
    from voxtide.sources.tables import read_events
    from voxtide.streaming.jobs import flatten_work_created, land_webhooks
    path = str(tmp_path / "hooks")
    land_webhooks(spark, SF, path, per_file=300)
    flat = flatten_work_created(read_events(spark, path))
    n_events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert flat.select("event_id").distinct().count() == n_events
    assert flat.count() == n_events + (n_events + 1) // 2   # even events have two owners
    assert flat.where("event_ts IS NULL OR created_ts IS NULL").count() == 0


def test_rules_answer_flows_into_tickets(spark):
    from voxtide.operators.annotate import annotate_rules, rules_answer
    from voxtide.operators.outcomes import split_outcomes
    from voxtide.plans.catalog import RULES
    from voxtide.sources import views
    reviews = views.reviews(spark, SF)
    ann = rules_answer(annotate_rules(reviews, RULES))
    joined = reviews.join(ann.select("channel", "review_id", "answer"), ["channel", "review_id"])
    run = review_job.run_annotated(spark, joined)
    assert run.tickets.count() > 0
    good, dead = split_outcomes(run.tickets, F.col("category") != "failed_to_infer_category", "check",
                                F.col("ticket_id"), "uncategorised", F.col("category"))
    assert good.count() + dead.count() == run.tickets.count()


def test_annotate_store_only_infers_missing(spark, tmp_path):
    import uuid

    def random_answer(prompts):
        return [json.dumps({"choices": [{"text": json.dumps({"Sentiments": "Positive",
                                                             "insight": uuid.uuid4().hex})}]}) for _ in prompts]

    store = str(tmp_path / "completions")
    first = spark.createDataFrame([("r1", "a"), ("r2", "b")], "review_id STRING, prompt STRING")
    a1 = {r.review_id: r.answer for r in annotate(first, random_answer, store=store).collect()}
    more = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r3", "c")], "review_id STRING, prompt STRING")
    a2 = {r.review_id: r.answer for r in annotate(more, random_answer, store=store).collect()}
    assert a2["r1"] == a1["r1"] and a2["r2"] == a1["r2"] and a2["r3"] is not None
    assert spark.read.parquet(store).count() == 3


def test_review_and_summary_commands(spark, tmp_path):
    from voxtide.functions.completers import digest_completer
    from voxtide.plans.review_job import review_command, summary_command
    from voxtide.sources import payloads as S
    from voxtide.sources import views
    raw = S.land_pages(views.reviews(spark, SF), broken_every=10)
    out = str(tmp_path / "job")
    paths = review_command(spark, raw, out, completer=length_rule_completer, limit=10,
                           created_at="2024-01-01 00:00:00")
    t = spark.read.parquet(paths["tickets"])
    per = {r["channel"]: r["count"] for r in t.groupBy("channel").count().collect()}
    assert 0 < per["social"] <= 10 and 0 < per["appstore"] <= 10 and per["product"] > 10     # only two channels have a limit
    n1 = t.count()
    review_command(spark, raw, out, completer=length_rule_completer, limit=10)   # re-run: nothing new
    assert spark.read.parquet(paths["tickets"]).count() == n1
    dead = spark.read.parquet(paths["dead_letters"])
    assert dead.columns == ["stage", "channel", "key", "reason", "message", "raw"]
    assert dead.distinct().count() == dead.count()    # the re-run added none
    tl_rows = spark.read.parquet(paths["timeline"]).count()
    assert tl_rows == sum(7 if r.channel in ("appstore", "domain") else 6 for r in t.select("channel").collect())
    tl = summary_command(spark, paths["tickets"], digest_completer, out, by=("channel",))
    report = spark.read.parquet(tl).where(F.col("body").startswith("Positive sentiment %: "))
    assert report.count() == t.select("channel").distinct().count()


def _answerer():
    def answers(prompts):
        return [json.dumps({"choices": [{"text": json.dumps({"Sentiments": "Positive", "Severity": "Low", "insight": p[:5]})}]}) for p in prompts]
    return answers


def test_one_bad_prompt_costs_one_answer(spark, tmp_path):
    answers = _answerer()

    def picky(prompts):
        if any("bad" in p for p in prompts):
            raise ValueError("cannot read this")
        return answers(prompts)

    def short(prompts):
        return answers(prompts)[1:] if len(prompts) > 1 else answers(prompts)

    df = spark.createDataFrame([(f"r{i}", "bad" if i == 17 else f"text {i}", "social") for i in range(50)], "review_id STRING, prompt STRING, channel STRING")
    store = str(tmp_path / "store")
    good, dead = parse_annotation(annotate(df, picky, partitions=1, store=store).drop("completion"))
    assert good.count() == 49
    assert [(r.channel, r.key, r.reason, r.message) for r in dead.collect()] == [("social", "r17", "inference_failed", "ValueError: cannot read this")]
    assert spark.read.parquet(store).count() == 49                      # failures are not stored
    good, dead = parse_annotation(annotate(df, answers, store=store).drop("completion"))
    assert good.count() == 50 and dead.count() == 0                     # the next run asks again
    good, _ = parse_annotation(annotate(df, short, partitions=1).drop("completion"))
    assert good.count() == 50                                           # a short reply is repeated one by one


def test_store_written_twice_does_not_multiply_rows(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([("r1", "a"), ("r2", "b")], "review_id STRING, prompt STRING")
    annotate(df, _answerer(), store=store).count()
    spark.read.parquet(store).write.mode("append").parquet(store + "2")
    spark.read.parquet(store).write.mode("append").parquet(store + "2")
    assert annotate(df, _answerer(), store=store + "2").count() == 2


def test_crash_between_sinks_is_completed_by_the_next_run(spark, tmp_path, monkeypatch):
    from voxtide.operators import timeline as TL
    from voxtide.sources import payloads as S
    from voxtide.sources import views
    raw = S.land_pages(views.reviews(spark, SF).where("doc_id < 40"), broken_every=3)
    clean, broken = str(tmp_path / "clean"), str(tmp_path / "broken")
    args = {"completer": length_rule_completer, "created_at": "2024-01-01 00:00:00"}
    review_job.review_command(spark, raw, clean, **args)

    def crash(*a, **k):
        raise OSError("disk gone")
    with monkeypatch.context() as m:
        m.setattr(TL, "write_timeline", crash)
        try:
            review_job.review_command(spark, raw, broken, **args)
        except OSError:
            pass
    review_job.review_command(spark, raw, broken, **args)
    for table in ("tickets", "timeline", "dead_letters"):
        a, b = (spark.read.parquet(f"{d}/{table}") for d in (clean, broken))
        assert a.count() > 0 and a.exceptAll(b.select(a.columns)).count() == b.exceptAll(a.select(b.columns)).count() == 0


def test_ids_stay_apart_and_bad_items_are_dead_letters(spark):
    from voxtide.operators.annotate import annotate_rules
    from voxtide.sources import payloads as S
    pages = [("product", 1, '{"initial_reviews":[{"review_id":"5","review_content":"not good"},null,{"review_content":"no id"}]}'),
             ("social", 1, '{"results":[{"tweet_id":"5","text":"the best"}]}'),
             ("business", 1, '{"reviews":[{"author":"x"},{"comment":"x"},{"author":"x","comment":"x"},null]}'), ("other", 1, "{}")]
    raw = spark.createDataFrame(pages, "channel STRING, page BIGINT, payload STRING")
    good, dead = S.read_all(raw)
    assert good.count() == 5 and good.select("channel", "review_id").distinct().count() == 5
    assert sorted(r.reason for r in dead.collect()) == ["missing_id"] * 3 + ["unknown_channel"]
    rules = [("the", "Sentiments", "Positive", 1.0, 1), ("not", "Sentiments", "Negative", 1.0, 2)]
    got = {(r.channel, r.review_id): r.Sentiments for r in annotate_rules(good.where("review_id = '5'"), rules, fields=("Sentiments",)).collect()}
    assert got == {("product", "5"): "Negative", ("social", "5"): "Positive"}


def test_copies_in_a_batch_make_one_ticket(spark, tmp_path):
    t = review_job.run_labels(spark, SF).tickets
    path = str(tmp_path / "t")
    write_tickets(t.unionByName(t), path, skip_existing=True)
    assert spark.read.parquet(path).count() == t.select("ticket_id").distinct().count()


def test_requests_carry_model_and_settings():
    from voxtide import constants as C
    from voxtide.operators.annotate import request_completer
    sent = []
    done = request_completer(lambda rs: sent.extend(rs) or ["x"] * len(rs), params={"top_p": 0.5})(["p", "q"])
    assert done == ["x", "x"] and [r["prompt"] for r in sent] == ["p", "q"]
    assert all(r["model"] == C.DEFAULT_MODEL and r["top_p"] == 0.5 and set(C.INFERENCE_PARAMS) <= set(r) for r in sent)


def test_command_event_to_job(spark):
    from voxtide.sources.commands import job_config, parse_commands
    from voxtide.sources.tables import allowed_models_df, config_df
    good = json.dumps({"payload": {"parameters": " 7 please"}, "context": {"snap_in_id": "app-1"}, "input_data": {
        "global_values": {"app_id": "com.example.app", "default_part_id": "PROD-1", "default_owner_id": "DEVU-1"},
        "resources": {"tags": {"bug": {"id": "tag-9"}}}}})
    bad = good.replace('"default_part_id"', '"llm_model_to_use": "no-such-model", "default_part_id"')
    raw = spark.createDataFrame([(1, "appstore", good), (2, "appstore", bad), (3, "social", "not json")], "event_id BIGINT, channel STRING, value STRING")
    jobs, dead = parse_commands(raw, allowed_models_df(spark))
    (job,) = jobs.collect()
    assert (job.app_id, job.n, job.subject, job.default_part_id, job.tags) == ("app-1", 7, "com.example.app", "PROD-1", {"bug": "tag-9"})
    assert sorted((r.key, r.reason) for r in dead.collect()) == [("2", "model_not_allowed"), ("3", "malformed_event")]
    (cfg,) = job_config(jobs, config_df(spark)).collect()
    assert cfg.channel == "appstore" and cfg.default_owner_id == "DEVU-1" and cfg.company


def test_calls_are_packed_by_size():
    from voxtide.operators.annotate import pack
    assert pack([]) == [] and pack([5], 3) == [(0, 1)]
    assert pack([1, 1, 1, 9, 1, 1], 3, 10) == [(0, 3), (3, 4), (4, 6)]
    assert pack([0] * 10, 3, 4) == [(0, 4), (4, 8), (8, 10)]


def test_a_killed_run_loses_one_bucket_at_most(spark, tmp_path):
    answers = _answerer()
    log, store = str(tmp_path / "log"), str(tmp_path / "store")

    def dies(prompts):
        with open(log) as f:
            if len(f.readlines()) >= 3:
                import os
                os._exit(1)                             # the worker goes, not only the call
        return asked(prompts)

    def asked(prompts):
        with open(log, "a") as f:
            f.writelines("call\n" for _ in prompts)
        return answers(prompts)

    open(log, "w").close()
    df = spark.createDataFrame([(f"r{i}", f"text {i}") for i in range(40)], "review_id STRING, prompt STRING")
    try:
        annotate(df, dies, partitions=1, store=store, bucket_size=10)
    except Exception:  # noqa: BLE001
        pass
    kept = spark.read.parquet(store).count()
    assert 0 < kept < 40
    open(log, "w").close()
    good, _ = parse_annotation(annotate(df, asked, partitions=1, store=store, bucket_size=10).drop("completion"))
    with open(log) as f:
        assert good.count() == 40 and len(f.readlines()) == 40 - kept     # only what was not stored is asked again


def test_rule_table_against_brute_force(spark):
    import random
    import re
    from voxtide.operators.annotate import annotate_rules
    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(60)]
    rules = [(rng.choice(words), rng.choice("XY"), rng.choice("pqr"), rng.choice([0.5, 1.0, -2.0]), rng.randint(1, 9)) for _ in range(200)]
    texts = [None, "", "é ab é", "K a\u212a a"] + ["-".join(rng.choice(words).upper() if rng.random() < .3 else rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = spark.createDataFrame([(i, "c", t) for i, t in enumerate(texts)], "review_id long, channel string, text string").repartition(3)
    want = {}
    for i, t in enumerate(texts):
        tokens = re.split("[^a-z]+", (t or "").lower())
        best = {}
        for f in "XY":
            found = []
            for v in "pqr":
                mine = [(r[3] * tokens.count(r[0]), r[4]) for r in rules if r[1] == f and r[2] == v and r[0] in tokens]
                if mine:
                    found.append((-sum(s for s, _ in mine), min(k for _, k in mine), -ord(v), v))
            best[f] = min(found)[3] if found else None
        if any(best.values()):
            want[i] = best
    got = {r.review_id: {"X": r.X, "Y": r.Y} for r in annotate_rules(df, rules, ("review_id",), ("X", "Y")).collect()}
    assert got == want
