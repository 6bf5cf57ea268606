"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (or data Spark derives from them) in
full.  Long texts are reported as md5 + length so results stay small; the
hash covers the whole text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide.functions import completers
from voxtide.functions.text import iso_ts, parse_limit, strip_links, wrap_review_text
from voxtide.operators import annotate as N
from voxtide.operators import filters as FL
from voxtide.operators import search as SI
from voxtide.operators import summary as A
from voxtide.operators import tickets as K
from voxtide.operators import timeline as TL
from voxtide.operators.joins import bounded_broadcast
from voxtide.operators.outcomes import union_all
from voxtide.operators.render import body_expr, render_chat, render_prompt, render_summary_prompt, title_expr
from voxtide.plans import review_job
from voxtide.session import ensure_utc, materialize, scratch_path, ship_package
from voxtide.sources import payloads as S
from voxtide.sources import views
from voxtide.sources.commands import parse_commands
from voxtide.sources.tables import (allowed_models_df, config_df, scan_tickets, sub_category_rules_df,
                                    tag_id, tags_df)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the catalogue queries (fixed, like a report's settings).
TOP_N = 10
SEARCH_TERM = "the"
# a common one, rarer ones, one with a link that a single review has, one that no text has, one too short to have grams
SEARCH_SUBJECTS = ("The", "thanea", "Einver", "https://t.co/30", "no such subject", "ñ")
CREATED_AT = "2024-01-01 00:00:00"
AS_OF = "2024-01-15 12:00:00"
UPSERT_SPLIT = "2024-01-15 00:00:00"
CHUNK_CHARS = 20_000
SUMMARY_CHARS = 50_000
# Rule table of the rule annotator (token, field, value, weight, rank).
RULES = [
    ("the", "Sentiments", "Positive", 1.0, 1),
    ("and", "Sentiments", "Positive", 0.5, 2),
    ("not", "Sentiments", "Negative", 2.0, 3),
    ("was", "Sentiments", "Negative", 1.0, 4),
    ("that", "Category", "complaint", 1.0, 1),
    ("this", "Category", "praise", 1.0, 2),
    ("from", "Category", "question", 1.0, 3),
    ("with", "Category", "suggestion", 1.0, 4),
    ("is", "Severity", "Low", 1.0, 1),
    ("of", "Severity", "Medium", 1.0, 2),
    ("to", "Severity", "High", 1.0, 3),
]


def query(fn):
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = wrapped
    return wrapped


def _text_cols(c: str = "text", prefix: str = "text"):
    return [F.md5(F.col(c)).alias(f"{prefix}_md5"), F.length(F.col(c)).cast("bigint").alias(f"{prefix}_len")]


# ------------------------------------------------------------------ sources
def _raw(spark, sf_dir):
    return S.land_pages(views.reviews(spark, sf_dir), broken_every=views.BROKEN_PAGE_EVERY)


def _source_out(df: DataFrame) -> DataFrame:
    return df.select("channel", "review_id", "title", "url", "author", *_text_cols(), "rating", "page")


def _source_query(channel: str):
    def q(spark, sf_dir):
        revs, _ = S.READERS[channel](_raw(spark, sf_dir))
        return _source_out(revs)
    q.__name__ = f"source_{channel}"
    q.__doc__ = f"S{C.CHANNELS.index(channel) + 1}: {channel} payload pages → canonical reviews."
    return query(q)


for _ch in C.CHANNELS:
    _source_query(_ch)


@query
def source_domain_page(spark, sf_dir):
    """S5 as the original fetched it: the first landed page only."""
    revs, _ = S.read_domain(_raw(spark, sf_dir), pages=[1])
    return _source_out(revs)


@query
def source_dead_letters(spark, sf_dir):
    """Pages that landed without their envelope."""
    _, dead = S.read_all(_raw(spark, sf_dir))
    return dead.select("stage", "key", "reason")


@query
def reviews_unified(spark, sf_dir):
    """All five channels in one canonical table."""
    revs, _ = S.read_all(_raw(spark, sf_dir))
    return _source_out(revs)


@query
def tag_usage(spark, sf_dir):
    """Tag dictionary with the number of tickets carrying each tag."""
    t = review_job.run_labels(spark, sf_dir).tickets
    used = t.select(F.explode("tags").alias("t")).groupBy(F.col("t.id").alias("id")).agg(
        F.count(F.lit(1)).alias("n_tickets"))
    # ``used`` has one row per tag id, and ids come from the 11-entry dictionary.
    return (tags_df(spark).join(bounded_broadcast(used, known_rows=len(C.TAGS)), "id", "left")
            .select("name", "description", "id", F.coalesce("n_tickets", F.lit(0)).alias("n_tickets")))


@query
def channel_config(spark, sf_dir):
    """Job configuration per channel with its review count."""
    n = views.reviews(spark, sf_dir).groupBy("channel").agg(F.count(F.lit(1)).alias("n_reviews"))
    return (config_df(spark).join(n, "channel", "left")
            .select("channel", "company", "default_part_id", "default_owner_id", "llm_model",
                    F.coalesce("n_reviews", F.lit(0)).alias("n_reviews")))


# ------------------------------------------------------------------ filters
@query
def search_subject(spark, sf_dir):
    """reviews mentioning the subject (case-insensitive)."""
    return FL.search_subject(views.reviews(spark, sf_dir), SEARCH_TERM).select("review_id", "channel")


@query
def search_indexed(spark, sf_dir):
    """F1 at scale: several subjects looked up in an inverted index of two batches."""
    path, schema = scratch_path(spark, "subject-index"), "review_id string, channel string, text string"
    r = views.reviews(spark, sf_dir).select("review_id", "channel", "text", "lang")
    for batch, part in enumerate((F.col("lang") == "en", F.col("lang") != "en")):
        SI.index_texts(r.where(part).drop("lang"), path, batch=batch)
    found = [SI.search_index(spark, path, x, schema).select(F.lit(x).alias("subject"), "review_id", "channel") for x in SEARCH_SUBJECTS]
    return union_all(*found)


@query
def filter_language(spark, sf_dir):
    """English reviews only."""
    return FL.filter_language(views.reviews(spark, sf_dir), "en").select("review_id", "channel", "lang")


@query
def relevance_observed(spark, sf_dir):
    """F3 observed: every parsed annotation kept and marked relevant."""
    run = review_job.run_labels(spark, sf_dir)
    return FL.relevance_filter(run.parsed, "observed").select("review_id", "relevance")


@query
def relevance_strict(spark, sf_dir):
    """F3 strict: annotations the model marked not relevant are dropped."""
    run = review_job.run_labels(spark, sf_dir)
    return FL.relevance_filter(run.parsed, "strict").select("review_id", "relevance")


@query
def parse_limit_q(spark, sf_dir):
    """Leading-integer parse of command arguments, default 10."""
    c = views.commands(spark, sf_dir)
    return c.select("event_id", "parameters", parse_limit(F.col("parameters")).alias("n"))


def _requested_models(spark, sf_dir):
    c = views.commands(spark, sf_dir)
    m = views.pick(C.ALLOWED_MODELS, F.col("k") % 40)
    return c.select("event_id", F.coalesce(m, F.concat(F.lit("model-"), F.col("k").cast("string"))
                                           ).alias("llm_model"))


@query
def model_allowlist(spark, sf_dir):
    """requested models checked against the allow-list."""
    return FL.mark_allowed(_requested_models(spark, sf_dir), allowed_models_df(spark)).select(
        "event_id", "llm_model", "accepted")


@query
def command_jobs(spark, sf_dir):
    """Command events parsed to job requests: limit, settings, subject, tag ids."""
    jobs, _ = parse_commands(views.command_events(spark, sf_dir), allowed_models_df(spark))
    return jobs.select("event_id", "channel", "app_id", "n", "default_part_id", "default_owner_id", "llm_model", "subject",
                       F.col("tags")["bug"].alias("tag_bug"), F.size("tags").cast("bigint").alias("n_tags"))


@query
def command_refusals(spark, sf_dir):
    """Command events whose model is not allowed."""
    _, dead = parse_commands(views.command_events(spark, sf_dir), allowed_models_df(spark))
    return dead.select("stage", "channel", "key", "reason", "message")


@query
def top_by_rating(spark, sf_dir):
    """The 10 best-rated reviews."""
    return FL.top_n(views.reviews(spark, sf_dir), TOP_N, by=("rating",)).select("review_id", "channel", "rating")


@query
def top_by_score(spark, sf_dir):
    """The 10 best reviews by a caller-given score."""
    return FL.top_n(views.reviews(spark, sf_dir), TOP_N, by=("score",)).select("review_id", "channel", "score")


@query
def top_n_per_channel(spark, sf_dir):
    """The 10 best-rated reviews of each channel."""
    return FL.top_n(views.reviews(spark, sf_dir), TOP_N, by=("rating",), per="channel").select(
        "channel", "review_id", "rating", F.col("rank").cast("bigint").alias("rank"))


# ------------------------------------------------------------------ render
@query
def titles(spark, sf_dir):
    """Ticket titles of every review."""
    return views.reviews(spark, sf_dir).select("review_id", "channel", title_expr().alias("title"))


@query
def bodies(spark, sf_dir):
    """Ticket bodies of every parsed annotation."""
    run = review_job.run_labels(spark, sf_dir)
    b = run.parsed.select("review_id", "channel", body_expr().alias("body"))
    return b.select("review_id", "channel", *_text_cols("body", "body"))


@query
def strip_links_q(spark, sf_dir):
    """Review text with short links removed."""
    r = views.reviews(spark, sf_dir).select("review_id", strip_links(F.col("text")).alias("clean"))
    return r.select("review_id", *_text_cols("clean", "clean"))


def _with_company(spark, sf_dir):
    cfg = bounded_broadcast(config_df(spark).select("channel", "company"))
    return views.reviews(spark, sf_dir).join(cfg, "channel", "left")


@query
def annotation_prompts(spark, sf_dir):
    """The annotation prompt of every review."""
    p = render_prompt(_with_company(spark, sf_dir))
    return p.select("review_id", "channel", *_text_cols("prompt", "prompt"), "prompt_key")


@query
def product_prompt_alt(spark, sf_dir):
    """The alternate product prompt and review wrapper."""
    r = _with_company(spark, sf_dir).where(F.col("channel") == "product")
    p = render_prompt(r, template="product_alt").withColumn("wrapped", wrap_review_text(F.col("text")))
    return p.select("review_id", *_text_cols("prompt", "prompt"), *_text_cols("wrapped", "wrapped"))


CHAT_SYSTEM = C.ANNOTATION_PROMPT.replace(" The review: {review}", "")
CHAT_HUMAN = "The review: {review}"


@query
def chat_messages(spark, sf_dir):
    """System + human chat messages with named variables."""
    m = render_chat(_with_company(spark, sf_dir), CHAT_SYSTEM, CHAT_HUMAN,
                    {"company": "company", "review": "text"})
    return m.select("review_id", F.md5(F.col("messages")[0]["content"]).alias("system_md5"),
                    F.md5(F.col("messages")[1]["content"]).alias("human_md5"),
                    F.size("messages").cast("bigint").alias("n_messages"))


# ------------------------------------------------------------------ annotate
def _model_annotated(spark, sf_dir):
    """Every review's prompt, answered by a completions store that holds the labelled reviews' answers."""
    prompts = render_prompt(_with_company(spark, sf_dir))
    store = scratch_path(spark, "answers")
    N.store_answers(prompts, views.label_answers(spark, sf_dir), store)
    return N.annotate(prompts, store=store)


@query
def annotate_model(spark, sf_dir):
    """Every review's prompt answered from the store of labelled answers, answers parsed."""
    parsed, _ = N.parse_annotation(_model_annotated(spark, sf_dir))
    return parsed.select("review_id", "channel", "relevance", "sentiment", "category", "severity",
                         "feature", "description")


@query
def annotate_rules(spark, sf_dir):
    """Rule-table annotator over whole review texts."""
    r = N.annotate_rules(views.reviews(spark, sf_dir), RULES)
    return r.select("review_id", "Sentiments", "Category", "Severity")


@query
def annotate_labels(spark, sf_dir):
    """Ready answers joined and parsed into typed fields."""
    run = review_job.run_labels(spark, sf_dir)
    return run.parsed.select("review_id", "channel", "relevance", "sentiment", "category", "sub_category",
                             "severity", "feature", "insight", "description", "response", "review_clean")


@query
def annotation_parse(spark, sf_dir):
    """Answers wrapped in completion envelopes, unwrapped and parsed."""
    a = N.annotate_labels(views.reviews(spark, sf_dir), views.label_answers(spark, sf_dir))
    env = a.withColumn("completion", F.to_json(F.struct(F.array(F.struct(F.col("answer").alias("text"))
                                                                 ).alias("choices"))))
    env = env.withColumn("answer", N.parse_completion(F.col("completion"))).drop("completion")
    parsed, _ = N.parse_annotation(env)
    return parsed.select("review_id", "sentiment", "category", "severity")


@query
def parse_failures(spark, sf_dir):
    """Answers that could not be parsed."""
    a = N.annotate_labels(views.reviews(spark, sf_dir), views.label_answers(spark, sf_dir))
    _, dead = N.parse_annotation(a, missing="no_answer")
    return dead.select("stage", "channel", "key", "reason")


@query
def sub_category_check(spark, sf_dir):
    """Sub-category validity for the category."""
    run = review_job.run_labels(spark, sf_dir)
    c = N.check_sub_category(run.parsed, sub_category_rules_df(spark))
    return c.select("review_id", "category", "sub_category", "sub_category_valid")


@query
def severity_norm(spark, sf_dir):
    """Raw and normalised severity."""
    run = review_job.run_labels(spark, sf_dir)
    return run.parsed.select("review_id", "severity", "severity_norm")


@query
def category_fallback(spark, sf_dir):
    """Category validated against the tag names."""
    run = review_job.run_labels(spark, sf_dir)
    return run.resolved.select("review_id", "category_raw", "category")


@query
def tag_ids(spark, sf_dir):
    """Category and sentiment tag ids."""
    run = review_job.run_labels(spark, sf_dir)
    return run.resolved.select("review_id", F.col("tags")[0]["id"].alias("tag_category"),
                               F.col("tags")[1]["id"].alias("tag_sentiment"))


# ------------------------------------------------------------------ tickets
def _ticket_out(t: DataFrame) -> DataFrame:
    return t.select("ticket_id", "channel", "review_id", "title",
                    F.array_join(F.transform("tags", lambda x: x["id"]), ",").alias("tags"),
                    *_text_cols("body", "body"), "type",
                    F.col("owned_by")[0].alias("owner"), "applies_to_part", "severity")


@query
def tickets(spark, sf_dir):
    """One ticket per accepted review."""
    return _ticket_out(review_job.run_labels(spark, sf_dir).tickets)


@query
def tickets_model(spark, sf_dir):
    """N1 → K1: tickets of every review whose prompt has a stored answer."""
    run = review_job.run_annotated(spark, _model_annotated(spark, sf_dir).drop("completion"))
    return _ticket_out(run.tickets)


@query
def tickets_rules(spark, sf_dir):
    """N12 → K1: tickets of the reviews the rule annotator labels."""
    reviews = views.reviews(spark, sf_dir)
    ann = N.rules_answer(N.annotate_rules(reviews, RULES)).select("channel", "review_id", "answer")
    run = review_job.run_annotated(spark, N.annotate_labels(reviews, ann, ["channel", "review_id"]))
    return _ticket_out(run.tickets)


@query
def tickets_incremental(spark, sf_dir):
    """K1 skip_existing: tickets not yet stored, when an earlier run ticketed
    the English reviews only."""
    t = review_job.run_labels(spark, sf_dir).tickets
    earlier = t.join(views.reviews(spark, sf_dir).where(F.col("lang") == "en").select("channel", "review_id"),
                     ["channel", "review_id"], "left_semi")
    return K.incremental_tickets(t, earlier).select("ticket_id", "channel", "review_id")


@query
def ticket_scan(spark, sf_dir):
    """K1 sink + S6 scan: tickets written as Parquet (by channel) and read
    back with the type predicate pushed down."""
    path = scratch_path(spark, "tickets")
    K.write_tickets(review_job.run_labels(spark, sf_dir).tickets, path)
    return _ticket_out(scan_tickets(spark, path))


@query
def tickets_by_tag(spark, sf_dir):
    """Tickets tagged Negative."""
    t = review_job.run_labels(spark, sf_dir).tickets
    return K.tickets_by_tag(t, tag_id("Negative")).select("ticket_id", "channel")


@query
def dead_letters(spark, sf_dir):
    """K9: every failed row of the review job."""
    return review_job.run_labels(spark, sf_dir).dead_letters.select("stage", "channel", "key", "reason", "message")


@query
def review_outcomes(spark, sf_dir):
    """K9: every review ends as a ticket or as a dead letter; counts per channel."""
    run = review_job.run_labels(spark, sf_dir)
    ends = run.tickets.select("channel", F.lit("ticket").alias("outcome")).unionByName(
        run.dead_letters.select("channel", F.col("reason").alias("outcome")))
    return ends.groupBy("channel", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query
def severity_refused(spark, sf_dir):
    """Tickets refused where the severity levels are enforced (an option)."""
    run = review_job.run_labels(spark, sf_dir)
    _, dead = K.build_tickets(run.resolved, config_df(spark), check_severity=True)
    return dead.select("channel", "key", "reason")


@query
def review_limit(spark, sf_dir):
    """T3 as the jobs apply it: social by score, app store by rating, the rest whole."""
    return review_job.limit_reviews(views.reviews(spark, sf_dir), TOP_N).select("channel", "review_id")


@query
def annotate_failures(spark, sf_dir):
    """Prompts without a stored answer, and answers that don't parse, end as
    dead letters with their message."""
    _, dead = N.parse_annotation(_model_annotated(spark, sf_dir))
    return dead.select("channel", "key", "reason", "message")


# ------------------------------------------------------------------ timeline
@query
def status_messages(spark, sf_dir):
    """K2: status message per ticket with a one-minute expiry."""
    t = review_job.run_labels(spark, sf_dir).tickets
    s = TL.status_messages(t, F.concat(F.lit("app/"), F.col("channel")), F.lit(CREATED_AT))
    return s.select("entry_id", "object", "body", iso_ts(F.col("expires_at")).alias("expires_at"))


@query
def detail_comments(spark, sf_dir):
    """K3: five or six comments per ticket."""
    t = review_job.run_labels(spark, sf_dir).tickets
    return K.detail_comments(t).select("object", "seq", "body")


@query
def chart_comments(spark, sf_dir):
    """K5: the chart comment of app-store and domain tickets."""
    t = review_job.run_labels(spark, sf_dir).tickets
    return K.detail_comments(t).where(F.col("seq") == 6).select("object", "body")


@query
def timeline_create(spark, sf_dir):
    """K7: every timeline entry the review job creates."""
    t = review_job.run_labels(spark, sf_dir).tickets
    path = scratch_path(spark, "timeline")
    TL.write_timeline(review_job.timeline_for(t, CREATED_AT), path, skip_existing=True)
    e = spark.read.parquet(path)
    return e.select("entry_id", "object", "seq", "body", "body_type", "type", "visibility",
                    iso_ts(F.col("expires_at")).alias("expires_at"), iso_ts(F.col("updated_at")).alias("updated_at"))


@query
def timeline_latest(spark, sf_dir):
    """K4: latest version per entry after an update batch."""
    e = views.entries(spark, sf_dir)
    old = e.where(F.col("updated_at") < F.lit(UPSERT_SPLIT).cast("timestamp"))
    new = e.where(F.col("updated_at") >= F.lit(UPSERT_SPLIT).cast("timestamp"))
    u = TL.upsert_timeline(old, new)
    return u.select("entry_id", "seq", "body", iso_ts(F.col("updated_at")).alias("updated_at"))


@query
def active_entries(spark, sf_dir):
    """K8: entries still visible at a given instant."""
    a = TL.active_entries(views.entries(spark, sf_dir), F.lit(AS_OF))
    return a.select("entry_id", "seq", iso_ts(F.col("expires_at")).alias("expires_at"))


# ------------------------------------------------------------------ aggregates
@query
def sentiment_pct(spark, sf_dir):
    """A1–A4: Positive / Negative ticket counts and shares."""
    return A.sentiment_pct(review_job.run_labels(spark, sf_dir).tickets)


@query
def sentiment_pct_by_channel(spark, sf_dir):
    """Sentiment shares per channel."""
    return A.sentiment_pct(review_job.run_labels(spark, sf_dir).tickets, by=("channel",))


@query
def sentiment_pct_merged(spark, sf_dir):
    """A1–A4, A9 kept up to date: shares per channel from the counts of three ticket
    batches, one of them written twice."""
    t = materialize(review_job.run_labels(spark, sf_dir).tickets.select("ticket_id", "channel", "category", "tags"), "tickets-counted")
    path = scratch_path(spark, "counts")
    for batch in (0, 1, 1, 2):
        A.write_counts(t.where(F.pmod(F.xxhash64("ticket_id"), F.lit(3)) == batch), path, batch)
    return A.merged_pct(A.read_counts(spark, path), by=("channel",))


@query
def sentiment_pct_empty(spark, sf_dir):
    """Shares over no tickets are NaN, not an error."""
    t = review_job.run_labels(spark, sf_dir).tickets.where(F.col("category") == "no_such_category")
    return A.sentiment_pct(t)


@query
def bodies_joined(spark, sf_dir):
    """Ticket bodies comma-joined per (channel, sentiment), in chunks."""
    j = A.join_bodies(review_job.run_labels(spark, sf_dir).tickets, max_chars=CHUNK_CHARS)
    return j.select("channel", "sentiment", "chunk", "n_items", *_text_cols("text", "text"))


@query
def summary_chunks(spark, sf_dir):
    """Level-0 summary prompts per (channel, sentiment) chunk."""
    t = review_job.run_labels(spark, sf_dir).tickets
    j = A.join_bodies(t, max_chars=CHUNK_CHARS)
    pct = A.sentiment_pct(t, by=("channel",)).select("channel", "positive_pct")
    p = render_summary_prompt(j.join(bounded_broadcast(pct, known_rows=len(C.CHANNELS)), "channel", "left"), F.col("positive_pct"))
    return p.select("channel", "sentiment", "chunk", "n_items", "positive_pct", *_text_cols("prompt", "prompt"))


@query
def corpus_summary(spark, sf_dir):
    """Hierarchical summary per (channel, sentiment) with a deterministic completer."""
    t = review_job.run_labels(spark, sf_dir).tickets
    s, _ = A.summarise(t, completers.digest_completer, max_chars=SUMMARY_CHARS)
    return s


@query
def summary_report(spark, sf_dir):
    """K6: the six report entries per summarised group."""
    t = review_job.run_labels(spark, sf_dir).tickets
    s, _ = A.summarise(t, completers.digest_completer, by=("channel",), max_chars=SUMMARY_CHARS)
    pct = A.sentiment_pct(t, by=("channel",))
    s = materialize(s, "summary").join(bounded_broadcast(pct, known_rows=len(C.CHANNELS)), "channel", "left")
    return TL.summary_report(s, F.concat(F.lit("app/"), F.col("channel"))).select("channel", "seq", "body")


@query
def summary_parse(spark, sf_dir):
    """Summary envelopes built from labels, with list-valued and broken answers."""
    parsed, _ = N.parse_summary(views.summary_answers(spark, sf_dir))
    return parsed.select("chunk_key", "customer_likings", "customer_pain_points", "focus", "actions")


@query
def category_counts(spark, sf_dir):
    """Tickets per channel and category."""
    return A.category_counts(review_job.run_labels(spark, sf_dir).tickets, by=("channel",))


@query
def category_pivot(spark, sf_dir):
    """One row per channel, one column per category."""
    return A.category_counts(review_job.run_labels(spark, sf_dir).tickets, by=("channel",), pivot=True)


@query
def chart_data(spark, sf_dir):
    """Chart labels and values per channel."""
    c = A.category_counts(review_job.run_labels(spark, sf_dir).tickets, by=("channel",))
    d = A.chart_data(c, by=("channel",))
    return d.select("channel", F.array_join("labels", ",").alias("labels"),
                    F.array_join(F.transform("data", lambda x: x.cast("string")), ",").alias("data"))


@query
def event_flatten(spark, sf_dir):
    """Work-created events (nested JSON) flattened, one row per owner."""
    from voxtide.streaming import jobs as W
    raw = W.webhook_payloads(spark, sf_dir)
    parsed = raw.select(F.from_json("value", W.WEBHOOK_SCHEMA).alias("e")).select("e.*")
    flat = W.flatten_work_created(parsed)
    return flat.withColumn("event_ts", iso_ts(F.col("event_ts"))).withColumn("created_ts", iso_ts(F.col("created_ts")))


# The registered names (``parse_limit`` etc. clash with helper names above).
QUERIES["parse_limit"] = QUERIES.pop("parse_limit_q")
QUERIES["strip_links"] = QUERIES.pop("strip_links_q")
