"""Timeline entries (K2, K4, K6, K7, K8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide.operators.render import js_number, template_expr
from voxtide.session import materialize, path_exists

TIMELINE_COLUMNS = ["entry_id", "object", "body", "body_type", "type", "visibility",
                    "expires_at", "seq", "updated_at"]


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def status_entry(tickets: DataFrame, app_object, created_at, ttl_min: int = C.STATUS_TTL_MINUTES) -> Column:
    """K2 as a timeline-entry struct for the ticket of the current row."""
    created = _lit_or_col(created_at).cast("timestamp")
    cols = {"ticket": "ticket_id", "category": "category"}
    body = F.when(F.col("category") != F.lit(C.FALLBACK_CATEGORY), template_expr(C.STATUS_CATEGORIZED, cols)
                  ).otherwise(template_expr(C.STATUS_FAILED, cols))
    return F.struct(
        F.sha2(F.concat_ws("|", F.lit("status"), F.col("ticket_id")), 256).alias("entry_id"),
        _lit_or_col(app_object).alias("object"),
        body.alias("body"),
        F.lit(C.BODY_TYPE).alias("body_type"),
        F.lit(C.ENTRY_TYPE).alias("type"),
        F.lit(C.VISIBILITY).alias("visibility"),
        (created + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(ttl_min))).alias("expires_at"),
        F.lit(0).cast("bigint").alias("seq"),
        created.alias("updated_at"),
    )


def status_messages(tickets: DataFrame, app_object, created_at, ttl_min: int = C.STATUS_TTL_MINUTES
                    ) -> DataFrame:
    """K2: one status message per ticket on the app object, visible for
    ``ttl_min`` minutes after ``created_at`` (a parameter, never the clock)."""
    return tickets.select(status_entry(tickets, app_object, created_at, ttl_min).alias("e")).select("e.*")


def upsert_timeline(existing: DataFrame, updates: DataFrame) -> DataFrame:
    """K4: latest version per ``entry_id`` (by ``updated_at``, then ``seq``;
    ``body`` breaks exact ties so the result is deterministic).

    Written as ``max_by`` in a hash aggregate rather than a ranking window: the
    partial aggregate keeps one row per entry per map task, so an entry with a
    third of all versions still shuffles one row per task.
    """
    allv = existing.select(*TIMELINE_COLUMNS).unionByName(updates.select(*TIMELINE_COLUMNS))
    order = F.struct(F.col("updated_at"), F.col("seq"), F.col("body"))
    latest = allv.groupBy("entry_id").agg(
        F.max_by(F.struct(*[c for c in TIMELINE_COLUMNS if c != "entry_id"]), order).alias("v"))
    return latest.select("entry_id", *[F.col(f"v.{c}").alias(c) for c in TIMELINE_COLUMNS if c != "entry_id"])


def active_entries(timeline: DataFrame, as_of) -> DataFrame:
    """Entries still visible at ``as_of`` (no expiry, or expiry later)."""
    t = _lit_or_col(as_of).cast("timestamp")
    return timeline.where(F.col("expires_at").isNull() | (F.col("expires_at") > t))


def write_timeline(entries: DataFrame, path: str, skip_existing: bool = False) -> None:
    """K7: append entries to the timeline table; with ``skip_existing`` only
    those whose ``entry_id`` it does not hold, staged before the table changes."""
    rows = entries.select(*TIMELINE_COLUMNS)
    spark = entries.sparkSession
    if skip_existing and path_exists(spark, path):
        rows = rows.join(spark.read.parquet(path).select("entry_id"), "entry_id", "left_anti").select(*TIMELINE_COLUMNS)
    if skip_existing:
        rows = materialize(rows, "timeline-run")
    rows.write.mode("append").parquet(path)


def summary_report(summary: DataFrame, app_object, created_at=None) -> DataFrame:
    """K6: six report entries per summary row, in posting order: positive %,
    negative %, likings, pain points, focus, actions.  ``summary`` holds
    ``positive_pct``, ``negative_pct`` and the four answer fields."""
    created = (_lit_or_col(created_at) if created_at is not None else F.lit(None)).cast("timestamp")
    cols = {"positive_pct": js_number(F.col("positive_pct")), "negative_pct": js_number(F.col("negative_pct")),
            "customer_likings": "customer_likings", "customer_pain_points": "customer_pain_points",
            "focus": "focus", "actions": "actions"}
    bodies = F.array(*[template_expr(t, cols) for t in C.REPORT_TEMPLATES])
    keys = [c for c in ("channel", "sentiment") if c in summary.columns]
    x = summary.select(*keys, F.posexplode(bodies).alias("pos", "body"))
    seq = (F.col("pos") + 1).cast("bigint")
    return x.select(
        *keys,
        F.sha2(F.concat_ws("|", F.lit("report"), *[F.col(k) for k in keys], seq.cast("string")), 256
               ).alias("entry_id"),
        _lit_or_col(app_object).alias("object"),
        "body",
        F.lit(C.BODY_TYPE).alias("body_type"),
        F.lit(C.ENTRY_TYPE).alias("type"),
        F.lit(C.VISIBILITY).alias("visibility"),
        F.lit(None).cast("timestamp").alias("expires_at"),
        seq.alias("seq"),
        created.alias("updated_at"),
    )
