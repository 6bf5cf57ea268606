"""Streaming queries of the catalogue.

Each query lands input derived from the driver tables as files in a fresh
folder under the checkpoint root, runs the streaming job with an
``availableNow`` trigger of several micro-batches, waits for it, and returns the
sink read back as a DataFrame.  Jobs with event-time state get their input in two
arrivals, ordered by event time: the job ends after the first and starts again
from its checkpoint with the second.  The SQL oracle is the batch result, so each
check is "stream = batch".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide.functions.text import iso_ts
from voxtide.operators.annotate import annotate_labels
from voxtide.operators.summary import merged_pct, read_counts
from voxtide.plans import catalog as Q
from voxtide.plans import oracle as O
from voxtide.plans import review_job
from voxtide.session import ensure_utc, materialize, scratch_path, ship_package
from voxtide.sources import payloads, views
from voxtide.sources.tables import read_events
from voxtide.streaming import jobs as W
from voxtide.streaming.state import expiries

STREAM_QUERIES: dict = {}
REVIEW_SCHEMA = ("doc_id BIGINT, channel STRING, review_id STRING, title STRING, url STRING, author STRING, "
                 "text STRING, rating BIGINT, score BIGINT, lang STRING, page BIGINT")
TICKET_TIME_SCHEMA = "ticket_id STRING, channel STRING, tags ARRAY<STRUCT<id: STRING>>, created_at TIMESTAMP"
#: Rows of a trigger; a run has at least ``LEAST_TRIGGERS`` where it has the files.
TRIGGER_ROWS, LEAST_TRIGGERS = 1_000_000, 2
#: Events of a delivery, and re-deliveries, lie within this time of each other.
DELAY, HORIZON = "6 hours", "1 day"
EXPIRY_DELAY_MINUTES = 10
#: Every so many tickets one arrives after all others.
LATE_EVERY = 25


def _each(files: int) -> int:
    """Files per trigger."""
    return max(1, min(TRIGGER_ROWS // W.FILE_ROWS, files // LEAST_TRIGGERS))


def _arrivals(rows: DataFrame, ts: str, in_dir: str, run, form: str = "json", landed=None) -> None:
    """Land ``rows`` in two arrivals, ordered by ``ts``, and ``run(files per
    trigger)`` the job after each.  ``rows`` come straight from a stored table;
    ``landed`` makes of them, row by row, what is written."""
    half = rows.agg(F.percentile_approx(F.unix_micros(F.col(ts).cast("timestamp")), 0.5, 10_000)).first()[0]
    early = F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")) <= F.lit(half), F.lit(True))

    def written(part: DataFrame) -> DataFrame:
        part = landed(part) if landed else part
        return part.withColumns({c: F.col(c).cast("timestamp") for c, kind in part.dtypes if kind == "timestamp_ntz"})
    for part in (rows.where(early), rows.where(~early)):
        files = W.land_in_order(part, ts, in_dir, form=form, landed=written)
        if files:
            run(_each(files))


def stream_query(fn):
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    STREAM_QUERIES[fn.__name__] = wrapped
    return wrapped


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _commands(spark, sf_dir, events):
    base = scratch_path(spark, f"stream-commands-{events}")
    out = f"{base}/out"
    sink, refused = W.batch_sink(out), W.batch_sink(f"{base}/refused")

    def handler(jobs, dead, batch_id):
        sink(jobs.select("event_id", "channel", "n", "llm_model"), batch_id)
        refused(dead, batch_id)
    _arrivals(views.read_table(spark, sf_dir, "events"), "ts", f"{base}/in", lambda each: _run(W.command_stream(
        spark, f"{base}/in", handler, f"{base}/chk", events=events, max_files=each, delay=DELAY, horizon=HORIZON)), landed=W.command_rows)
    return spark.read.parquet(out).drop("batch_id")


@stream_query
def stream_commands(spark, sf_dir):
    """Nested command events as a file stream; each parsed to its job request."""
    return _commands(spark, sf_dir, "all")


@stream_query
def stream_first_event(spark, sf_dir):
    """Only the first event of each delivery is handled, whose events arrive
    in several micro-batches and around a restart."""
    return _commands(spark, sf_dir, "first")


@stream_query
def stream_command_jobs(spark, sf_dir):
    """Command events start the review job with their settings; the
    tickets that all runs together wrote.  (The ready answers are keyed by document
    id, which the pages of three channels carry; the reviews of the others end as
    dead letters of the job.)"""
    base = scratch_path(spark, "stream-jobs")
    raw = materialize(payloads.land_pages(views.reviews(spark, sf_dir)), "landed-pages")
    answers = materialize(views.label_answers(spark, sf_dir).select(F.col("doc_id").cast("string").alias("review_id"), "answer"), "job-answers")
    handler = W.job_dispatcher(spark, raw, f"{base}/job", answers=answers, created_at=Q.CREATED_AT)
    # one micro-batch per arrival: two runs of the review job, whatever the number of commands
    _arrivals(views.read_table(spark, sf_dir, "events"), "ts", f"{base}/in",
              lambda each: _run(W.command_stream(spark, f"{base}/in", handler, f"{base}/chk")), landed=W.command_rows)
    t = spark.read.parquet(f"{base}/job/tickets")
    return t.select("ticket_id", "channel", "applies_to_part", F.col("owned_by")[0].alias("owner"))


def _webhook_stream(spark, in_dir, max_files=None, arrays=True):
    r = spark.readStream.schema(W.WEBHOOK_SCHEMA).option("multiLine", arrays)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(in_dir)


@stream_query
def stream_webhook(spark, sf_dir):
    """Work-created webhook stream (JSON arrays) flattened per owner."""
    base = scratch_path(spark, "stream-webhook")
    W.land_webhooks(spark, sf_dir, f"{base}/in", W.ARRAY_ROWS)
    each = max(4, min(TRIGGER_ROWS // W.ARRAY_ROWS, W.files_in(spark, f"{base}/in") // LEAST_TRIGGERS))
    flat = W.flatten_work_created(_webhook_stream(spark, f"{base}/in", max_files=each))
    _run(flat.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    r = spark.read.parquet(f"{base}/out")
    return r.withColumn("event_ts", iso_ts(F.col("event_ts"))).withColumn("created_ts", iso_ts(F.col("created_ts")))


@stream_query
def events_landed(spark, sf_dir):
    """Landed files of event arrays read in batch with the explicit schema."""
    path = scratch_path(spark, "events-landed")
    W.land_webhooks(spark, sf_dir, path)
    flat = W.flatten_work_created(read_events(spark, path))
    return flat.withColumn("event_ts", iso_ts(F.col("event_ts"))).withColumn("created_ts", iso_ts(F.col("created_ts")))


@stream_query
def stream_dedupe(spark, sf_dir):
    """Re-deliveries (same unique_key within the watermark) dropped, over
    several triggers and a restart."""
    base = scratch_path(spark, "stream-dedupe")

    def run(each):
        s = _webhook_stream(spark, f"{base}/in", each, arrays=False).select(
            F.col("payload.unique_key").alias("unique_key"),
            F.try_to_timestamp(F.regexp_replace(F.col("payload.timestamp"), r"\s", "")).alias("event_ts"))
        _run(W.dedupe_deliveries(s, "unique_key", DELAY).writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    _arrivals(views.read_table(spark, sf_dir, "events"), "ts", f"{base}/in", run, form="text", landed=lambda ev: W.payloads_of(ev).select("value"))
    return spark.read.parquet(f"{base}/out").select("unique_key")


def _review_stream(spark, sf_dir) -> str:
    base = scratch_path(spark, "stream-reviews")
    reviews = views.reviews(spark, sf_dir)
    files = W.land_files(reviews.count())
    reviews.repartitionByRange(files, "doc_id").write.json(f"{base}/in")
    # built once; each micro-batch joins the written table
    answers = materialize(views.label_answers(spark, sf_dir), "stream-answers")

    def to_outcomes(batch):
        run = review_job.run_annotated(spark, materialize(annotate_labels(batch, answers), "stream-annotated"), missing="no_answer")
        return run.tickets, run.dead_letters

    def to_timeline(tickets):
        return review_job.timeline_for(tickets, Q.CREATED_AT)

    stream = spark.readStream.schema(REVIEW_SCHEMA).option("maxFilesPerTrigger", _each(files)).json(f"{base}/in")
    _run(W.review_stream(stream, to_outcomes, to_timeline, f"{base}/out", f"{base}/chk"))
    return f"{base}/out"


@stream_query
def stream_tickets(spark, sf_dir):
    """Review stream → tickets (+ timeline) per micro-batch."""
    out = _review_stream(spark, sf_dir)
    return Q._ticket_out(spark.read.parquet(f"{out}/tickets").drop("batch_id"))


@stream_query
def stream_dead_letters(spark, sf_dir):
    """Failed rows of the review stream."""
    out = _review_stream(spark, sf_dir)
    return spark.read.parquet(f"{out}/dead_letters").select("stage", "channel", "key", "reason", "message")


@stream_query
def stream_shares(spark, sf_dir):
    """Shares per channel from the counts that each micro-batch left."""
    out = _review_stream(spark, sf_dir)
    return merged_pct(read_counts(spark, f"{out}/counts"), by=("channel",))


@stream_query
def stream_expiry(spark, sf_dir):
    """Timeline entries as a stream; a row for each version that runs out, by
    event-time timers."""
    base = scratch_path(spark, "stream-expiry")
    schema = "entry_id STRING, object STRING, seq BIGINT, updated_at TIMESTAMP, expires_at TIMESTAMP"
    sink = W.batch_sink(f"{base}/out")

    def run(each):
        entries = spark.readStream.schema(schema).option("maxFilesPerTrigger", each).parquet(f"{base}/in")
        _run(expiries(entries, f"{EXPIRY_DELAY_MINUTES} minutes").writeStream.foreachBatch(sink)
             .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    _arrivals(views.entries(spark, sf_dir).select("entry_id", "object", "seq", "updated_at", "expires_at"), "updated_at", f"{base}/in", run, form="parquet")
    return spark.read.parquet(f"{base}/out").select("entry_id", "object", "seq", iso_ts(F.col("expired_at")).alias("expired_at"))


def _ticket_times(spark, sf_dir) -> DataFrame:
    """Tickets with a time (2024-01-01 plus review id minutes); some arrive late."""
    t = review_job.run_labels(spark, sf_dir).tickets
    number = F.col("review_id").cast("int")
    return t.select("ticket_id", "channel", "tags", (number % LATE_EVERY == 1).alias("tardy"),
                    (F.lit(Q.CREATED_AT).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), number)).alias("created_at"))


def _sentiment_stream(spark, sf_dir) -> str:
    """The ticket stream with late rows split off, and windowed counts of the rest."""
    base = scratch_path(spark, "stream-sentiment")
    tickets = materialize(_ticket_times(spark, sf_dir), "ticket-times")

    def run(each):
        stream = spark.readStream.schema(TICKET_TIME_SCHEMA).option("maxFilesPerTrigger", each).parquet(f"{base}/in")
        _run(W.split_late(stream, base, f"{base}/chk-split", "1 hour", "1 hour"))
        checked = spark.readStream.schema(TICKET_TIME_SCHEMA).parquet(f"{base}/in_time")
        agg = W.sentiment_stream(checked, "1 hour", "1 hour").select(
            F.col("window.start").alias("window_start"), "channel", "positive", "negative", "positive_pct")
        _run(agg.writeStream.outputMode("update").foreachBatch(W.batch_sink(f"{base}/out"))
             .option("checkpointLocation", f"{base}/chk").trigger(availableNow=True).start())
    _arrivals(tickets.where("not tardy").drop("tardy"), "created_at", f"{base}/in", run, form="parquet")
    if W.land_in_order(tickets.where("tardy").drop("tardy"), "created_at", f"{base}/in", form="parquet"):
        run(100_000)        # what is tardy comes at last, in one trigger
    return base


@stream_query
def stream_sentiment(spark, sf_dir):
    """Hourly Positive / Negative shares per channel over a ticket stream,
    without the tickets whose hour was closed when they came."""
    base = _sentiment_stream(spark, sf_dir)
    latest = W.latest_per_key(spark.read.parquet(f"{base}/out"), ["window_start", "channel"])
    return latest.select(iso_ts(F.col("window_start")).alias("window_start"), "channel", "positive", "negative",
                         "positive_pct")


@stream_query
def stream_late(spark, sf_dir):
    """The tickets that came after their hour was closed."""
    base = _sentiment_stream(spark, sf_dir)
    return spark.read.parquet(f"{base}/late").select("ticket_id", "channel", iso_ts(F.col("created_at")).alias("created_at"))


def stream_oracle() -> dict[str, str]:
    o = O.build()
    minutes = f"TIMESTAMP {O.s(Q.CREATED_AT)} + to_minutes(CAST(review_id AS BIGINT))"
    # the watermark of the last trigger is an hour behind the latest of the punctual tickets
    times = (f"tt AS (SELECT *, {minutes} AS created_at, CAST(review_id AS BIGINT) % {LATE_EVERY} = 1 AS tardy FROM tickets), "
             "mark AS (SELECT max(created_at) FILTER (WHERE NOT tardy) - INTERVAL 1 HOUR AS watermark FROM tt), "
             "timed AS (SELECT tt.*, coalesce(tardy AND time_bucket(INTERVAL 1 HOUR, created_at) + INTERVAL 1 HOUR <= watermark, false) AS late FROM tt, mark)")
    jobs = o["command_jobs"]
    started = (f"jobs AS ({jobs}), asked AS (SELECT channel, max(n) AS n FROM jobs WHERE channel IN ('social', 'appstore', 'product') GROUP BY channel), "
               "ranked AS (SELECT channel, review_id, row_number() OVER (PARTITION BY channel ORDER BY CASE channel WHEN 'appstore' THEN -rating ELSE page END, review_id) AS place FROM reviews)")
    return {
        "stream_command_jobs": (O.BASE + f", {started} SELECT t.ticket_id, t.channel, 'part/' || t.channel AS applies_to_part, 'owner/' || t.channel AS owner "
                                "FROM tickets t JOIN ranked r ON t.channel = r.channel AND t.review_id = r.review_id JOIN asked a ON a.channel = t.channel "
                                "WHERE t.channel = 'product' OR r.place <= a.n"),
        "stream_commands": f"SELECT event_id, channel, n, llm_model FROM ({jobs})",
        "stream_first_event": (f"SELECT event_id, channel, n, llm_model FROM ({jobs}) WHERE event_id IN "
                               "(SELECT min(event_id) FROM events GROUP BY event_id // 4)"),
        "stream_webhook": o["event_flatten"],
        "events_landed": o["event_flatten"],
        "stream_dedupe": "SELECT DISTINCT 'key/' || CAST(event_id // 2 AS VARCHAR) AS unique_key FROM events",
        "stream_tickets": o["tickets"],
        "stream_dead_letters": o["dead_letters"],
        "stream_shares": o["sentiment_pct_by_channel"],
        "stream_expiry": (f"SELECT entry_id, object, seq, {O.iso('expires_at')} AS expired_at FROM ("
                          "SELECT user_id || '-' || event_type AS entry_id, 'app/' || (user_id % 5) AS object, event_id AS seq, "
                          "date_trunc('millisecond', ts + INTERVAL 1 MINUTE) AS expires_at, "
                          "lead(date_trunc('millisecond', ts)) OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('millisecond', ts), event_id) AS next_at, "
                          f"date_trunc('millisecond', max(ts) OVER ()) - INTERVAL {EXPIRY_DELAY_MINUTES} MINUTE AS watermark FROM events) "
                          "WHERE CASE WHEN next_at IS NULL THEN expires_at < watermark ELSE next_at >= expires_at END"),
        "stream_sentiment": (O.BASE + f", {times} "
                             f"SELECT {O.iso('time_bucket(INTERVAL 1 HOUR, created_at)')} AS window_start, channel, "
                             "positive, negative, CASE WHEN positive + negative = 0 THEN 'NaN'::DOUBLE ELSE "
                             "(CAST(positive AS DOUBLE) / (positive + negative)) * 100.0 END AS positive_pct FROM ("
                             "SELECT time_bucket(INTERVAL 1 HOUR, created_at) AS created_at, channel, "
                             "count(*) FILTER (WHERE tag_category = 'tag/Positive' OR tag_sentiment = 'tag/Positive') AS positive, "
                             "count(*) FILTER (WHERE tag_category = 'tag/Negative' OR tag_sentiment = 'tag/Negative') AS negative "
                             "FROM timed WHERE NOT late GROUP BY 1, 2)"),
        "stream_late": O.BASE + f", {times} SELECT ticket_id, channel, {O.iso('created_at')} AS created_at FROM timed WHERE late",
    }
