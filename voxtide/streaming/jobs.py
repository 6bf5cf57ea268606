"""Structured Streaming jobs.

Inputs are landed JSON files (one object per line, or arrays with
``multiLine``), read with an explicit schema.  Sinks are Parquet tables written
from ``foreachBatch`` into ``batch_id=<n>`` folders with overwrite, so a
replayed micro-batch replaces its own output instead of duplicating it.
Checkpoints go under the shared checkpoint root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voxtide import schemas
from voxtide.functions.text import iso_ts, parse_limit
from voxtide.operators.summary import pct_expr, write_counts
from voxtide.plans.review_job import review_command
from voxtide.session import materialize, path_exists, scratch_path
from voxtide.sources import views
from voxtide.sources.commands import job_config, parse_commands
from voxtide.sources.tables import allowed_models_df, config_df, tag_id
from voxtide.streaming.state import first_of_delivery, interval_ms

WEBHOOK_SCHEMA = schemas.WEBHOOK_EVENT
#: A landed command: the envelope of our landing and the event as it came (JSON text).
COMMAND_SCHEMA = "event_id BIGINT, delivery_id BIGINT, ts TIMESTAMP, channel STRING, value STRING"


# ------------------------------------------------------------------ W1, W2
def command_events(commands: DataFrame, events: str = "all") -> DataFrame:
    """W1/W2 on one batch: parse each command's argument; with ``events='first'``
    only the first event of every delivery is handled."""
    out = commands.withColumn("n", parse_limit(F.col("parameters")))
    if events == "first":
        one = F.min_by(F.struct(*[c for c in out.columns if c != "delivery_id"]), F.col("event_id"))
        out = out.groupBy("delivery_id").agg(one.alias("_e")).select(*[F.col(c) if c == "delivery_id" else F.col(f"_e.{c}").alias(c) for c in out.columns])
    elif events != "all":
        raise ValueError(f"events must be 'all' or 'first', not {events!r}")
    return out


def command_stream(spark: SparkSession, in_dir: str, handler: Callable[[DataFrame, DataFrame, int], None],
                   checkpoint: str, events: str = "all", max_files: int | None = None,
                   available_now: bool = True, delay: str = "1 hour", horizon: str = "2 hours") -> StreamingQuery:
    """The landed command events, parsed with their settings, for
    ``handler(jobs, dead_letters, batch_id)`` per micro-batch.  With
    ``events='first'`` (W2) only the first event of each delivery is handled, once
    over all micro-batches (keyed state, see ``first_of_delivery``)."""
    if events not in ("all", "first"):
        raise ValueError(f"events must be 'all' or 'first', not {events!r}")
    r = spark.readStream.schema(COMMAND_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    stream = r.json(in_dir)
    if events == "first":
        stream = first_of_delivery(stream, delay, horizon)

    def each(batch: DataFrame, batch_id: int) -> None:
        if events == "first":
            batch = materialize(batch, "commands")      # stateful rows are computed once
        jobs, dead = parse_commands(batch, allowed_models_df(batch.sparkSession))
        handler(jobs, dead, batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def job_dispatcher(spark: SparkSession, raw: DataFrame, out_dir: str, **review_args) -> Callable[[DataFrame, DataFrame, int], None]:
    """W1/S9 → the review job: a ``command_stream`` handler that runs the review
    command for the jobs of a micro-batch over the landed pages ``raw``.

    The jobs of a batch come down to one setting per channel (that of the latest
    event, with the largest limit asked for), so a batch of many commands is one
    run over all channels that were asked for.  The run id is a digest of the
    batch's settings and number: a replayed batch finds its run in ``runs`` and
    does nothing; one that died half-way repeats, and its sinks take only what
    they do not hold."""
    def handle(jobs: DataFrame, dead: DataFrame, batch_id: int) -> None:
        settings = materialize(job_config(jobs, config_df(spark)), "job-settings")      # a row per channel
        found = settings.orderBy("channel").collect()
        run_id = hashlib.sha256(repr((batch_id, [tuple(r) for r in found])).encode()).hexdigest()[:16]
        done = f"{out_dir}/runs/run_id={run_id}"
        if path_exists(spark, f"{done}/_SUCCESS"):
            return
        if found:
            asked = raw.join(F.broadcast(settings.select("channel")), "channel", "left_semi")
            review_command(spark, asked, out_dir, config=settings, limit={r["channel"]: r["n"] for r in found}, **review_args)
        dead.write.mode("overwrite").parquet(f"{out_dir}/refused/batch_id={batch_id}")
        settings.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(done)
    return handle


# ------------------------------------------------------------------ W3, W4
def flatten_work_created(events: DataFrame) -> DataFrame:
    """One row per (event, owner) with the work's main fields.

    ``created_date`` may hold stray spaces (``14: 14: 30``); whitespace is
    removed before parsing.  Events without owners keep one row."""
    w = F.col("payload.work_created.work")
    x = events.select(
        F.col("payload.id").alias("event_id"),
        F.col("payload.unique_key").alias("unique_key"),
        F.try_to_timestamp(F.regexp_replace(F.col("payload.timestamp"), r"\s", "")).alias("event_ts"),
        w["id"].alias("work_id"),
        w["display_id"].alias("display_id"),
        w["title"].alias("title"),
        w["severity"].alias("severity"),
        w["stage"]["name"].alias("stage"),
        w["stage"]["ordinal"].cast("bigint").alias("stage_ordinal"),
        w["applies_to_part"]["id"].alias("part_id"),
        w["created_by"]["id"].alias("created_by"),
        F.try_to_timestamp(F.regexp_replace(w["created_date"], r"\s", "")).alias("created_ts"),
        F.col("context.snap_in_id").alias("app_id"),
        F.explode_outer(w["owned_by"]).alias("owner"),
    )
    return x.withColumn("owner_id", F.col("owner.id")).drop("owner")


def dedupe_deliveries(stream: DataFrame, key: str = "unique_key", delay: str = "1 hour",
                      ts: str = "event_ts") -> DataFrame:
    """Drop re-deliveries of the same event key seen within ``delay``
    (state is bounded by the watermark)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


# ------------------------------------------------------------------ W5
def batch_sink(out_dir: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: each micro-batch overwrites its own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
    return write


def review_stream(stream: DataFrame, to_outcomes: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
                  to_timeline: Callable[[DataFrame], DataFrame], out_dir: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Per micro-batch, build tickets and dead letters, write them, then
    build the timeline entries from the written tickets (each sink idempotent
    per ``batch_id``), and the batch's counts beside those of the earlier ones, so
    the shares over all tickets read no ticket again.  The batch is materialised first, so ticket building (and any model call
    inside it) sees one evaluation; the timeline reads the ticket files instead
    of recomputing them."""
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{out_dir}/_input/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        tickets_path = f"{out_dir}/tickets/batch_id={batch_id}"
        tickets, dead = to_outcomes(spark.read.parquet(path))
        tickets.write.mode("overwrite").parquet(tickets_path)
        dead.write.mode("overwrite").parquet(f"{out_dir}/dead_letters/batch_id={batch_id}")
        written = spark.read.parquet(tickets_path)
        to_timeline(written).write.mode("overwrite").parquet(f"{out_dir}/timeline/batch_id={batch_id}")
        write_counts(written, f"{out_dir}/counts", batch_id)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


# ------------------------------------------------------------------ W6
def sentiment_stream(tickets: DataFrame, width: str = "1 hour", delay: str = "1 hour",
                     ts: str = "created_at", by=("channel",)) -> DataFrame:
    """Positive / Negative ticket counts and shares per tumbling window."""
    pos = F.exists("tags", lambda t: t["id"] == F.lit(tag_id("Positive")))
    neg = F.exists("tags", lambda t: t["id"] == F.lit(tag_id("Negative")))
    agg = (tickets.withWatermark(ts, delay)
           .groupBy(F.window(ts, width).alias("window"), *by)
           .agg(F.count_if(pos).alias("positive"), F.count_if(neg).alias("negative")))
    total = F.col("positive") + F.col("negative")
    return agg.select("window", *by, "positive", "negative",
                      pct_expr(F.col("positive"), total).alias("positive_pct"))


def split_late(stream: DataFrame, out_dir: str, checkpoint: str, width: str = "1 hour", delay: str = "1 hour",
               ts: str = "created_at", available_now: bool = True) -> StreamingQuery:
    """Rows whose window of ``width`` was closed when they came go to
    ``out_dir/late``, the others to ``out_dir/in_time``, one folder per micro-batch.

    The watermark of a micro-batch is the latest event time of those before it
    less ``delay``, and a window is closed when its end is not after it: the rows
    that Spark's windowed aggregate would drop without a word.  Each micro-batch
    writes its watermark as one row, and reads that of the one before, so a replay
    splits as the first time did.  Rows without event time are late."""
    span = interval_ms(stream.sparkSession, width) * 1000

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = materialize(batch, "split-late")
        before = f"{out_dir}/watermark/batch_id={batch_id - 1}"
        mark = spark.read.parquet(before).first()["watermark"] if batch_id and path_exists(spark, before) else None
        # (as arithmetic: F.window leaves rows without a time out)
        end = F.timestamp_micros(F.unix_micros(ts) - F.pmod(F.unix_micros(ts), F.lit(span)) + F.lit(span))
        closed = end <= F.lit(mark).cast("timestamp")
        late = F.coalesce(closed, F.col(ts).isNull())
        batch.where(late).write.mode("overwrite").parquet(f"{out_dir}/late/batch_id={batch_id}")
        batch.where(~late).write.mode("overwrite").parquet(f"{out_dir}/in_time/batch_id={batch_id}")
        seen = F.date_trunc("millisecond", F.max(ts)) - F.expr(f"INTERVAL {delay}")
        batch.agg(F.greatest(seen, F.lit(mark).cast("timestamp")).alias("watermark")).write.mode("overwrite").parquet(f"{out_dir}/watermark/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def latest_per_key(sink: DataFrame, keys: list[str]) -> DataFrame:
    """Read side of an update-mode sink: the row of the highest batch per key."""
    cols = [c for c in sink.columns if c not in keys and c != "batch_id"]
    g = sink.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("v"))
    return g.select(*keys, *[F.col(f"v.{c}").alias(c) for c in cols])


# ------------------------------------------------------------------ landing (test input)
def webhook_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work-created webhook events built from ``events`` as JSON text
    (column ``value``).  Pairs of events share a ``unique_key`` (a
    re-delivery); even events have two owners."""
    return payloads_of(views.read_table(spark, sf_dir, "events"))


def payloads_of(ev: DataFrame) -> DataFrame:
    """``webhook_payloads`` of the given rows of ``events``."""
    eid = F.col("event_id").cast("string")
    uid = F.col("user_id")

    def user(u):
        return F.struct(F.concat(F.lit("user/"), u.cast("string")).alias("id"),
                        F.concat(F.lit("User "), u.cast("string")).alias("display_name"))

    owners = F.when(F.col("event_id") % 2 == 0, F.array(user(uid), user((uid + 1) % 150))) \
              .otherwise(F.array(user(uid)))
    work = F.struct(
        F.struct(F.concat(F.lit("part/"), (uid % 5).cast("string")).alias("id"),
                 F.lit("part").alias("type")).alias("applies_to_part"),
        user(uid).alias("created_by"),
        F.regexp_replace(iso_ts(F.col("ts")), ":", ": ").alias("created_date"),
        F.concat(F.lit("TKT-"), eid).alias("display_id"),
        F.concat(F.lit("work/"), eid).alias("id"),
        owners.alias("owned_by"),
        F.lower(views.pick(["Blocker", "High", "Medium", "Low"], F.col("event_id") % 4)).alias("severity"),
        F.struct(F.col("event_type").alias("name"), (F.col("event_id") % 4).cast("int").alias("ordinal")
                 ).alias("stage"),
        F.concat(F.lit("Event "), eid).alias("title"),
        F.lit("ticket").alias("type"),
    )
    payload = F.struct(
        F.concat(F.lit("evt/"), eid).alias("id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.lit("work_created").alias("type"),
        F.concat(F.lit("key/"), F.floor(F.col("event_id") / 2).cast("string")).alias("unique_key"),
        F.struct(work.alias("work")).alias("work_created"),
    )
    ctx = F.struct(F.concat(F.lit("app/"), (uid % 5).cast("string")).alias("snap_in_id"))
    return ev.select(F.col("event_id"), F.col("ts"),
                     F.to_json(F.struct(payload.alias("payload"), ctx.alias("context"))).alias("value"))


#: Rows per landed file; a landing has at least ``LEAST_FILES``.
FILE_ROWS, LEAST_FILES = 100_000, 4
#: Events per landed array file.
ARRAY_ROWS = 5000


def land_files(rows: int) -> int:
    """Number of files to land so many rows in."""
    return max(LEAST_FILES, -(-rows // FILE_ROWS))


def land_in_order(rows: DataFrame, order: str, out_dir: str, drop: tuple = (), form: str = "json",
                  landed: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Land ``rows`` in files that a file stream reads in the order of column
    ``order``: a range sort deals them over files, and the files' modification
    times, which the file source goes by, follow the order.  (The file system must
    keep times that are set, as HDFS and local disks do; on an object store land
    the ranges one after the other.)  Adds to what landed before; returns the
    number of files.

    ``rows`` are read for their number, for the borders of the ranges and for the
    sort, so they should come from a stored table.  ``landed`` makes the written
    rows of the sorted ones, row by row: long texts then are neither kept nor
    shuffled, and are written compressed."""
    spark = rows.sparkSession
    n = rows.count()
    if not n:
        return 0
    files = land_files(n)
    staged = scratch_path(spark, "landed")
    out = rows.repartitionByRange(files, order).sortWithinPartitions(order)
    out = (landed(out) if landed else out).drop(*drop).write
    out = out.format(form) if form == "parquet" else out.format(form).option("compression", "gzip")
    out.save(staged)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(out_dir))
    parts = sorted((f.getPath() for f in fs.listStatus(path(staged)) if f.getPath().getName().startswith("part-")), key=lambda f: f.getName())
    there = [f.getModificationTime() for f in fs.listStatus(path(out_dir))]
    start = max([int(jvm.java.lang.System.currentTimeMillis()) - 1000 * len(parts), *(t + 1000 for t in there)])
    for i, part in enumerate(parts):        # metadata only: one call per file of FILE_ROWS rows
        fs.setTimes(part, start + 1000 * i, -1)
        fs.rename(part, path(f"{out_dir}/{len(there):06d}-{part.getName()}"))
    return len(parts)


def command_rows(ev: DataFrame) -> DataFrame:
    """Rows of ``events`` as command events, as they land (deliveries of four events)."""
    c = views.command_events_of(ev)
    return c.select("event_id", F.floor(F.col("event_id") / 4).cast("bigint").alias("delivery_id"), "ts", "channel", "value")


def land_webhooks(spark: SparkSession, sf_dir: str, out_dir: str, per_file: int = ARRAY_ROWS) -> None:
    """Land webhook events as files that each hold one JSON array (read with
    ``multiLine``); each array holds at most ``per_file`` consecutive events."""
    w = webhook_payloads(spark, sf_dir)
    webhook_arrays(w, per_file).select("value").write.mode("overwrite").option("maxRecordsPerFile", 1).text(out_dir)


def files_in(spark: SparkSession, folder: str) -> int:
    """Number of landed files."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sum(1 for f in listed if f.getPath().getName().startswith("part-"))


def webhook_arrays(payloads: DataFrame, per_file: int) -> DataFrame:
    """JSON arrays of at most ``per_file`` consecutive events (_f, value)."""
    return payloads.groupBy(F.floor(F.col("event_id") / per_file).alias("_f")).agg(
        F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct("event_id", "value"))), lambda x: x["value"]), ","), F.lit("]")).alias("value"))
