"""End-to-end review job: reviews → annotations → tickets → timeline.

The batch form of one review command of the original jobs, for all channels
in one plan.  Every step is a DataFrame operator; the only shuffles are the
review⋈answer join (unique keys) and, when asked, the incremental anti join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide.operators.annotate import annotate_labels, normalise_severity, parse_annotation
from voxtide.operators.filters import relevance_filter
from voxtide.operators.outcomes import union_all
from voxtide.operators.tickets import build_tickets, comment_bodies, comment_entry, resolve_tags
from voxtide.operators.timeline import TIMELINE_COLUMNS, status_entry
from voxtide.sources import views
from voxtide.sources.tables import config_df, tags_df


@dataclass
class ReviewRun:
    parsed: DataFrame          # typed annotations (all parsed rows)
    resolved: DataFrame        # after category fallback + tag ids
    tickets: DataFrame
    dead_letters: DataFrame


def run_annotated(spark: SparkSession, annotated: DataFrame, relevance: str = "observed",
                  missing: str = "inference_failed", config: DataFrame | None = None) -> ReviewRun:
    """Ticket stage for reviews that already carry an ``answer`` text; one
    without is a dead letter with the reason ``missing``.  ``config`` replaces the
    fixed settings (part, owner) per channel."""
    parsed, dead_parse = parse_annotation(annotated, missing=missing)
    parsed = normalise_severity(parsed)
    resolved, dead_tags = resolve_tags(parsed, tags_df(spark))
    kept = relevance_filter(resolved, relevance)
    tickets, dead_ticket = build_tickets(kept, config if config is not None else config_df(spark))
    return ReviewRun(parsed, resolved, tickets, union_all(dead_parse, dead_tags, dead_ticket))


def run_labels(spark: SparkSession, sf_dir: str, relevance: str = "observed") -> ReviewRun:
    """Review job with the label annotator (ready answers joined by doc_id)."""
    annotated = annotate_labels(views.reviews(spark, sf_dir), views.label_answers(spark, sf_dir))
    return run_annotated(spark, annotated, relevance, missing="no_answer")


def limit_reviews(reviews: DataFrame, n: int | dict[str, int]) -> DataFrame:
    """T3 as the jobs apply it: the ``n`` best social reviews by ``score``, where
    the source sends one, else the first in landing order, and the ``n``
    best-rated app store reviews (``n`` may give a number per channel; a channel
    that it does not name is not cut).  The other channels are never cut."""
    from voxtide.operators.filters import top_n

    if isinstance(n, dict):
        out = reviews
        for channel in ("social", "appstore"):
            if channel in n:
                mine = F.col("channel").eqNullSafe(F.lit(channel))
                out = limit_reviews(out.where(mine), max(0, n[channel])).unionByName(out.where(~mine))
        return out
    parts = {"social": ("score",) if "score" in reviews.columns else (), "appstore": ("rating",)}
    whole = reviews.where(~F.col("channel").isin(list(parts)) | F.col("channel").isNull())
    social = reviews.where("channel = 'social'")
    social = top_n(social, n, by=parts["social"]) if parts["social"] else social.orderBy("page", "review_id").limit(n)
    rated = top_n(reviews.where("channel = 'appstore'"), n, by=parts["appstore"])
    return whole.unionByName(social.select(*reviews.columns)).unionByName(rated.select(*reviews.columns))


def timeline_for(tickets: DataFrame, created_at: str, app_object=None) -> DataFrame:
    """Status message (K2) plus detail comments (K3, K5) for every ticket,
    from one pass over the tickets (one array per ticket, then explode)."""
    obj = app_object if app_object is not None else F.concat(F.lit("app/"), F.col("channel"))
    status = status_entry(tickets, obj, F.lit(created_at))
    created = F.lit(created_at).cast("timestamp")
    comments = F.transform(comment_bodies(), lambda b, i: comment_entry(F.col("ticket_id"), b, i, created))
    x = tickets.select(F.explode(F.concat(F.array(status), comments)).alias("e"))
    return x.select([F.col(f"e.{c}").alias(c) for c in TIMELINE_COLUMNS])


# --------------------------------------------------------------------------- commands
def review_command(spark: SparkSession, raw: DataFrame, out_dir: str, completer=None,
                   answers: DataFrame | None = None, limit: int | dict[str, int] | None = None,
                   relevance: str = "observed", created_at: str = "1970-01-01 00:00:00",
                   app_object=None, config: DataFrame | None = None, send=None) -> dict[str, str]:
    """The review command as one batch job.

    landed pages → canonical reviews (dead letters for bad pages) → optional
    ``limit`` of the channels that have one → answers (``completer`` over rendered
    prompts, or a client ``send`` that gets requests with the model of the channel's
    settings; kept in a completions store under ``out_dir``; or ready
    ``answers(review_id, answer)``) → typed annotations → tags → tickets
    (appended, skipping tickets already stored) → timeline entries of all
    tickets of this run → dead letters.  Each sink takes only rows it does not
    hold yet, so a run that died between sinks is completed by the next one.
    ``config`` (channel, company, default_part_id, default_owner_id, llm_model)
    replaces the fixed settings.  Returns the table paths.
    """
    from voxtide.operators.annotate import annotate
    from voxtide.operators.outcomes import union_all as _union
    from voxtide.operators.render import render_prompt
    from voxtide.operators.tickets import one_per_ticket, write_tickets
    from voxtide.operators.timeline import write_timeline
    from voxtide.operators.joins import bounded_broadcast
    from voxtide.session import materialize
    from voxtide.sources.payloads import read_all

    if sum(x is not None for x in (completer, send, answers)) != 1:
        raise ValueError("give exactly one of completer, send or answers")
    config = config_df(spark) if config is None else config
    paths = {k: f"{out_dir}/{k}" for k in ("tickets", "timeline", "dead_letters", "completions")}
    reviews, dead_src = read_all(raw)
    reviews = materialize(reviews if limit is None else limit_reviews(reviews, limit), "reviews")
    if answers is None:
        cfg = bounded_broadcast(config.select("channel", "company", "llm_model"))
        prompts = render_prompt(reviews.join(cfg, "channel", "left"))
        annotated = annotate(prompts, completer, store=paths["completions"], send=send).drop(
            "completion", "prompt", "prompt_key", "company", "llm_model")
    else:
        keys = [c for c in ("channel", "review_id") if c in answers.columns]
        annotated = annotate_labels(reviews, answers.select(*keys, "answer"), keys)
    run = run_annotated(spark, materialize(annotated, "annotated"), relevance, "inference_failed" if answers is None else "no_answer", config)
    tickets = materialize(one_per_ticket(run.tickets), "tickets-all")
    write_tickets(tickets, paths["tickets"], skip_existing=True)
    write_timeline(timeline_for(tickets, created_at, app_object), paths["timeline"], skip_existing=True)
    append_new(_union(dead_src, run.dead_letters), paths["dead_letters"])
    return paths


def append_new(rows: DataFrame, path: str) -> None:
    """Append the rows that the table at ``path`` does not hold yet (all columns
    compared, NULLs equal), so repeating a run changes nothing."""
    from voxtide.session import materialize, path_exists

    spark = rows.sparkSession
    rows = rows.distinct()
    if path_exists(spark, path):
        rows = rows.exceptAll(spark.read.parquet(path).select(*rows.columns).distinct())
    materialize(rows, "append").write.mode("append").parquet(path)


def summary_command(spark: SparkSession, tickets_path: str, completer, out_dir: str,
                    by=("channel",), max_chars: int | None = None, app_object=None,
                    created_at: str | None = None) -> str:
    """The summary command as one batch job: one scan
    of the ticket table, shares (A1–A4), chunked hierarchical summary (A6) and
    the six report entries (K6), appended to ``out_dir/timeline``."""
    from voxtide import constants as C
    from voxtide.operators.joins import bounded_broadcast
    from voxtide.operators.summary import group_bound, sentiment_pct, summarise
    from voxtide.operators.timeline import summary_report, write_timeline
    from voxtide.session import materialize
    from voxtide.sources.tables import scan_tickets

    tickets = scan_tickets(spark, tickets_path)
    by = list(by)
    summary, dead = summarise(tickets, completer, by=by, max_chars=max_chars or C.SUMMARY_CHUNK_CHARS)
    pct = sentiment_pct(tickets, by=by)
    joined = materialize(summary, "summary").join(bounded_broadcast(pct, known_rows=group_bound(by)), by, "left")
    obj = app_object if app_object is not None else F.lit("app")
    entries = summary_report(joined, obj, created_at)
    path = f"{out_dir}/timeline"
    write_timeline(entries, path)
    dead.write.mode("append").parquet(f"{out_dir}/dead_letters")
    return path
