"""What the streams cost as their input grows: state by groups of keys, triggers
by rows, landing without copies."""

import datetime as dt
import glob
import os

from voxtide.session import checkpoint_root
from voxtide.streaming import catalog as S
from voxtide.streaming import jobs as W
from voxtide.streaming import state
from voxtide.streaming.state import expiries, first_of_delivery

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
FAR = 2**60


def run(stream, out, checkpoint):
    q = stream.writeStream.foreachBatch(W.batch_sink(out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return q


def land(spark, rows, schema, folder):
    """One file an element of ``rows``, read in their order."""
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def test_first_events_of_many_deliveries_share_state_rows(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(seconds=m)
    # four events a delivery over two triggers; ids that doubles do not hold, beside null ones
    rows = [(FAR + n, FAR + n // 4, at(n % 1000), f"note {n}") for n in range(2400)]
    rows += [(None, FAR + 599, at(1), "no id"), (FAR + 5000, None, at(2), "no delivery"), (None, None, at(3), "neither")]
    rows += [(FAR + 6000, FAR + 7000, None, "no time")]
    parts = [[r for i, r in enumerate(rows) if i % 4 in (1, 3)], [r for i, r in enumerate(rows) if i % 4 in (0, 2)]]
    stream = land(spark, parts, "event_id long, delivery_id long, ts timestamp, note string", f"{tmp_path}/in")
    q = run(first_of_delivery(stream, "1 day", "1 day"), f"{tmp_path}/out", f"{tmp_path}/chk")
    want, done = [], set()
    for part in parts:
        first = {}
        for r in sorted(part, key=lambda r: (r[0] is None, r[0] or 0)):
            first.setdefault(r[1], r)
        want += [(r[0], k, r[3]) for k, r in first.items() if k not in done]
        done |= set(first)
    got = [(r.event_id, r.delivery_id, r.note) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= state.BUCKETS < len(done)


def test_expiries_of_many_entries_share_state_rows(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [[(f"e{n}", "o", FAR + n, at(0), at(1)) for n in range(600)] + [(None, None, FAR, at(0), at(900))],
            [(f"e{n}", "o", FAR + 600 + n, at(n % 3), at(1000) if n % 5 else None) for n in range(600)],
            [("late", "o", FAR + 1300, at(30), at(31))]]
    stream = land(spark, rows, "entry_id string, object string, seq long, updated_at timestamp, expires_at timestamp", f"{tmp_path}/in")
    q = run(expiries(stream, "10 minutes"), f"{tmp_path}/out", f"{tmp_path}/chk")
    got = sorted((r.entry_id, r.seq) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted((f"e{n}", FAR + n) for n in range(600) if n % 3)       # the others were replaced in time
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= state.BUCKETS < 482


def test_webhook_triggers_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(W, "ARRAY_ROWS", 20)        # 50 files
    out = S.stream_webhook(spark, SF)
    base = max(glob.glob(checkpoint_root(spark).removeprefix("file:") + "/voxtide/stream-webhook-*"), key=os.path.getmtime)
    assert len(glob.glob(f"{base}/in/part-*")) == 50
    assert len([f for f in os.listdir(f"{base}/chk/commits") if f.isdigit()]) == 2
    assert out.count() == 1500


def test_landing_keeps_no_copies(spark, monkeypatch, tmp_path):
    kept = []
    monkeypatch.setattr(W, "materialize", lambda df, name, *a: kept.append(name) or df)
    monkeypatch.setattr(S, "materialize", lambda df, name, *a: kept.append(name) or df)
    jobs = lambda rows, dead, batch_id: rows.write.mode("overwrite").parquet(f"{tmp_path}/jobs/batch_id={batch_id}")
    events = spark.read.parquet(f"{SF}/events.parquet")
    S._arrivals(events, "ts", f"{tmp_path}/in", lambda each: S._run(W.command_stream(spark, f"{tmp_path}/in", jobs, f"{tmp_path}/chk")), landed=W.command_rows)
    assert not kept         # neither the rows before landing nor those of a stateless micro-batch
    files = [f for f in os.listdir(f"{tmp_path}/in") if "part-" in f and not f.startswith(".")]
    assert files and all(f.endswith(".json.gz") for f in files)
    landed = spark.read.schema(W.COMMAND_SCHEMA).json(f"{tmp_path}/in")
    assert landed.count() == events.count()
    assert landed.drop("ts").exceptAll(W.command_rows(events).drop("ts")).count() == 0     # (the landed time has milliseconds)
    asked = W.parse_commands(W.command_rows(events), W.allowed_models_df(spark))[0]
    assert spark.read.parquet(f"{tmp_path}/jobs").count() == asked.count()
