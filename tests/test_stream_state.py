"""Streams with state over several triggers and a restart."""

import datetime as dt
import json

from pyspark.sql import functions as F

from voxtide.sources import payloads as S
from voxtide.sources import views
from voxtide.streaming import jobs as W
from voxtide.streaming.state import expiries, first_of_delivery

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def run(stream, out, checkpoint):
    q = stream.writeStream.foreachBatch(W.batch_sink(out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return q


def state_rows(q):
    """Rows of state after the last trigger."""
    return q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]


def land(spark, rows, schema, folder, name):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")
    return f"{folder}/*"


COMMANDS = "event_id long, delivery_id long, ts timestamp"


def test_first_event_over_triggers_and_a_restart(spark, tmp_path):
    schema = "event_id long, delivery_id long, ts timestamp, note string"
    def go(*names):
        for name in names:
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
            q = run(first_of_delivery(stream, "10 minutes", "30 minutes"), f"{tmp_path}/out", f"{tmp_path}/chk")
        return q
    land(spark, [(2, 1, at(1), "b"), (1, 1, at(0), "a"), (7, 2, at(1), "x")], schema, f"{tmp_path}/in", "1")
    q = go("1")
    assert state_rows(q) == 2
    land(spark, [(3, 1, at(12), "later event of a handled delivery"), (8, 3, at(14), "y")], schema, f"{tmp_path}/in", "2")
    go("2")             # starts again from the checkpoint
    land(spark, [(20, 9, at(300), "z")], schema, f"{tmp_path}/in", "3")
    land(spark, [(21, 9, at(301), "w")], schema, f"{tmp_path}/in", "4")
    q = go("3")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.delivery_id, r.event_id, r.note) for r in got.collect()) == [(1, 1, "a"), (2, 7, "x"), (3, 8, "y"), (9, 20, "z")]
    assert state_rows(q) == 1           # the handled deliveries of the first hour are forgotten


VERSIONS = "entry_id string, object string, seq long, updated_at timestamp, expires_at timestamp"


def brute_expiries(rows, watermark):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[3], r[2]))
        for v, following in zip(mine, [*mine[1:], None]):
            if v[4] is not None and (v[4] < watermark if following is None else v[4] <= following[3]):
                out.append((key, v[2], v[4].replace(tzinfo=None)))
    return sorted(out)


def test_expiry_timers(spark, tmp_path):
    rows = [("a", "o", 1, at(0), at(5)), ("a", "o", 2, at(3), at(9)),           # renewed before it ran out
            ("b", "o", 3, at(1), at(2)), ("b", "o", 4, at(20), at(21)),         # ran out, then written again
            ("c", "o", 5, at(2), None), ("d", "o", 6, at(4), at(500)), ("d", "o", 7, at(30), None),
            ("e", "o", 8, at(31), at(32)), ("f", "o", 9, at(60), at(61)), ("g", "o", 10, at(61), at(300))]
    parts = [rows[:5], rows[5:7], rows[7:9], rows[9:]]
    for cuts in ([parts[0], parts[1] + parts[2], parts[3]], [rows]):
        folder = f"{tmp_path}/{len(cuts)}"
        for k, part in enumerate(cuts):
            land(spark, part, VERSIONS, f"{folder}/in", str(k))
            stream = spark.readStream.schema(VERSIONS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/*")
            q = run(expiries(stream, "10 minutes"), f"{folder}/out", f"{folder}/chk")
        got = sorted((r.entry_id, r.seq, r.expired_at) for r in spark.read.parquet(f"{folder}/out").collect())
        assert got == brute_expiries(rows, at(51))
        assert state_rows(q) == 2       # f and g are still to run out


def test_late_rows_are_split_off(spark, tmp_path):
    schema = "ticket_id string, channel string, created_at timestamp"
    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        q = W.split_late(stream, str(tmp_path), f"{tmp_path}/chk", "1 hour", "1 hour")
        q.awaitTermination()
    land(spark, [("a", "x", at(10)), ("b", "x", at(70)), ("n", "x", None)], schema, f"{tmp_path}/in", "1")
    go()
    land(spark, [("c", "x", at(5)), ("d", "x", at(250))], schema, f"{tmp_path}/in", "2")     # watermark 0:10, no hour is closed
    go()
    land(spark, [("e", "x", at(119)), ("f", "x", at(181)), ("g", "x", at(190))], schema, f"{tmp_path}/in", "3")   # watermark 3:10
    go()
    read = lambda name: sorted(r.ticket_id for r in spark.read.parquet(f"{tmp_path}/{name}").collect())
    assert read("late") == ["e", "n"] and read("in_time") == ["a", "b", "c", "d", "f", "g"]


def test_landing_keeps_the_order(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "timestamp_millis(1704067200000 + id * 1000) as ts").repartition(5)
    assert W.land_in_order(rows.where("id < 600"), "ts", f"{tmp_path}/in") == 4
    assert W.land_in_order(rows.where("id >= 600"), "ts", f"{tmp_path}/in") == 4
    stream = spark.readStream.schema("id long, ts timestamp").option("maxFilesPerTrigger", 2).json(f"{tmp_path}/in")
    run(stream, f"{tmp_path}/out", f"{tmp_path}/chk")
    spans = [(r.a, r.b) for r in spark.read.parquet(f"{tmp_path}/out").groupBy("batch_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("batch_id").collect()]
    assert len(spans) == 4 and spans[0][0] == 0 and spans[-1][1] == 999
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def _event(n, part="PROD-1", model=None):
    values = {"app_id": "com.example.app", "default_part_id": part, "default_owner_id": "DEVU-1"} | ({"llm_model_to_use": model} if model else {})
    return json.dumps({"payload": {"parameters": str(n)}, "context": {"snap_in_id": "app-1"}, "input_data": {
        "global_values": values, "resources": {"tags": {"bug": {"id": "tag-9"}}}}})


def test_commands_start_the_review_job_and_replays_add_nothing(spark, tmp_path):
    from voxtide import constants as C
    from voxtide.session import materialize
    raw = materialize(S.land_pages(views.reviews(spark, SF)), "pages")
    seen = str(tmp_path / "requests")

    def send(requests):
        with open(f"{seen}", "a") as f:
            f.writelines(r["model"] + "\n" for r in requests)
        return [json.dumps({"choices": [{"text": json.dumps({"Sentiments": "Positive", "Category": "bug", "Severity": "Low"})}]}) for _ in requests]

    out = str(tmp_path / "job")
    handle = W.job_dispatcher(spark, raw, out, send=send, created_at="2024-01-01 00:00:00")
    model = C.ALLOWED_MODELS[3]
    rows = [(1, 1, at(0), "appstore", _event(3)), (2, 1, at(1), "appstore", _event(5, "PROD-2", model)),
            (3, 2, at(2), "appstore", _event(9, model="no-such-model")), (4, 2, at(3), "social", "not json")]
    spark.createDataFrame(rows, W.COMMAND_SCHEMA).coalesce(1).write.json(f"{tmp_path}/in/1")
    batches = []

    def keep(jobs, dead, batch_id):
        batches.append((jobs, dead, batch_id))
        handle(jobs, dead, batch_id)
    W.command_stream(spark, f"{tmp_path}/in/*", keep, f"{tmp_path}/chk").awaitTermination()
    tickets = spark.read.parquet(f"{out}/tickets")
    assert {(r.channel, r.applies_to_part) for r in tickets.collect()} == {("appstore", "PROD-2")} and tickets.count() == 5
    assert sorted((r.key, r.reason) for r in spark.read.parquet(f"{out}/refused").collect()) == [("3", "model_not_allowed"), ("4", "malformed_event")]
    with open(seen) as f:
        assert set(f.read().split()) == {model}     # the request carries the model of the settings
    before = {k: spark.read.parquet(f"{out}/{k}").count() for k in ("tickets", "timeline", "dead_letters", "runs")}
    handle(*batches[0])                             # the batch is replayed: its run is known
    W.job_dispatcher(spark, raw, out, send=send)(*batches[0][:2], batches[0][2] + 1)    # a new run asks for the same reviews
    after = {k: spark.read.parquet(f"{out}/{k}").count() for k in before}
    assert {k: after[k] - before[k] for k in before} == {"tickets": 0, "timeline": 0, "dead_letters": 0, "runs": 1}
