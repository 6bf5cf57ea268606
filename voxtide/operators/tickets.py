"""Tag resolution, tickets and detail comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide.functions.text import spaces, sql_str
from voxtide.operators.joins import bounded_broadcast
from voxtide.operators.outcomes import dead_letter
from voxtide.operators.render import Sql, body_expr, template_expr, title_expr
from voxtide.session import materialize, path_exists

TICKET_EXTRA = ["category", "sentiment", "sub_category", "feature", "insight", "response",
                "severity_norm", "relevance"]


def resolve_tags(annotations: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """N10/N11 (J1, J2): validate the category against the tag names
    (case-sensitive; unknown or NULL → ``failed_to_infer_category``) and
    resolve both tag ids.  A sentiment that names no tag is a dead letter.

    ``tags`` is the per-install dictionary; it is broadcast behind a size check.
    """
    t = bounded_broadcast(tags.select("name", "id"))
    known = t.select(F.col("name").alias("_cname"))
    cid = t.select(F.col("name").alias("_fname"), F.col("id").alias("_cid"))
    snt = t.select(F.col("name").alias("_sname"), F.col("id").alias("_sid"))
    j = (annotations.withColumn("category_raw", F.col("category"))
                    .join(known, F.col("category") == F.col("_cname"), "left")
                    .withColumn("category", F.coalesce(F.col("_cname"), F.lit(C.FALLBACK_CATEGORY)))
                    .join(cid, F.col("category") == F.col("_fname"), "left")
                    .join(snt, F.col("sentiment") == F.col("_sname"), "left"))
    j = j.withColumn("tags", F.array(F.struct(F.col("_cid").alias("id")),
                                     F.struct(F.col("_sid").alias("id"))))
    good = j.where(F.col("_sid").isNotNull())
    dead = dead_letter(j.where(F.col("_sid").isNull()), "resolve_tags", F.col("review_id"),
                       "unknown_sentiment", F.coalesce(F.col("sentiment"), F.lit("null")))
    drop = ["_cname", "_fname", "_cid", "_sname", "_sid"]
    return good.drop(*drop), dead


def ticket_id_expr() -> Column:
    return F.sha2(F.concat_ws("|", F.col("channel"), F.col("review_id")), 256)


def build_tickets(resolved: DataFrame, config: DataFrame, check_severity: bool = False) -> tuple[DataFrame, DataFrame]:
    """K1/J4 + K9: one ticket per accepted review.

    The job config (one row per channel) is broadcast onto every row.  Severities
    pass unchanged; with ``check_severity``, rows whose severity is not one of
    the four levels go to dead letters (stage ``ticket``), as does a row without
    a review id, which could not be told from others.
    Returns (tickets, dead letters).
    """
    cfg = bounded_broadcast(config.select("channel", "default_part_id", "default_owner_id"))
    j = resolved.join(cfg, "channel", "left")
    if "severity_norm" not in j.columns:
        j = j.withColumn("severity_norm", F.lower(F.trim(F.col("severity"))))
    t = j.select(
        ticket_id_expr().alias("ticket_id"),
        "channel", "review_id",
        title_expr().alias("title"),
        "tags",
        body_expr().alias("body"),
        F.lit(C.TICKET_TYPE).alias("type"),
        F.array(F.col("default_owner_id")).alias("owned_by"),
        F.col("default_part_id").alias("applies_to_part"),
        "severity",
        *[F.col(c) for c in TICKET_EXTRA if c in j.columns],
    )
    known = F.col("review_id").isNotNull()
    level = F.coalesce(F.col("severity_norm").isin([s.lower() for s in C.SEVERITIES]), F.lit(False)) if check_severity else F.lit(True)
    dead = dead_letter(t.where(~(known & level)), "ticket", F.when(known, F.col("ticket_id")),
                       F.when(known, F.lit("invalid_severity")).otherwise(F.lit("missing_id")), F.coalesce(F.col("severity"), F.lit("null")))
    return t.where(known & level), dead


def write_tickets(tickets: DataFrame, path: str, skip_existing: bool = False) -> DataFrame:
    """K1 sink: append Parquet partitioned by channel.  ``skip_existing`` drops
    tickets whose id is already stored (left anti join on ``ticket_id``).

    The rows of this run are staged once under the checkpoint root, then
    appended; the staged table is returned, so callers (timeline entries)
    read exactly the tickets written now, not a re-evaluation that would see
    the updated table."""
    spark = tickets.sparkSession
    out = tickets
    if skip_existing:
        out = one_per_ticket(tickets)
        if path_exists(spark, path):
            out = incremental_tickets(out, spark.read.parquet(path))
    staged = materialize(out, "tickets-run")
    staged.write.mode("append").partitionBy("channel").parquet(path)
    return staged


def one_per_ticket(tickets: DataFrame) -> DataFrame:
    """One row per ticket id: of copies within a batch, the smallest by all columns."""
    columns = tickets.columns
    return tickets.groupBy("ticket_id").agg(F.min(F.struct(*[c for c in columns if c != "ticket_id"])).alias("_t")).select(
        *[F.col(c) if c == "ticket_id" else F.col(f"_t.{c}").alias(c) for c in columns])


def incremental_tickets(new: DataFrame, existing: DataFrame) -> DataFrame:
    """K1 ``skip_existing`` as a pure DataFrame step (anti join on ticket_id)."""
    return new.join(existing.select("ticket_id"), "ticket_id", "left_anti")


def tickets_by_tag(tickets: DataFrame, tag_id: str) -> DataFrame:
    """Tickets whose tag array holds ``tag_id`` (a row filter, no join)."""
    return tickets.where(F.exists("tags", lambda t: t["id"] == F.lit(tag_id)))


def comment_bodies() -> Column:
    """K3/K5: the detail comments of one ticket, in posting order."""
    indent = Sql("CASE channel " + " ".join(f"WHEN {sql_str(ch)} THEN {sql_str(spaces(n))}" for ch, n in C.INSIGHT_INDENT.items()) + " END")
    cols = {"sub_category": "sub_category", "sentiment": "sentiment", "feature": "feature",
            "indent": indent, "insight": "insight", "response": "response"}
    first = F.when(F.col("channel") == "product", template_expr(C.PRODUCT_SUBCAT_TEMPLATE, cols)) \
             .otherwise(template_expr(C.COMMENT_TEMPLATES[0], cols))
    chart = F.when(F.col("channel").isin(list(C.CHART_CHANNELS)), F.lit(C.CHART_COMMENT))
    bodies = F.array(first, *[template_expr(t, cols) for t in C.COMMENT_TEMPLATES[1:]], chart)
    return F.filter(bodies, lambda b: b.isNotNull())


def comment_entry(ticket_id: Column, body: Column, pos: Column, created_at: Column) -> Column:
    """One detail comment as a timeline-entry struct (``seq`` = pos + 1)."""
    seq = (pos + 1).cast("bigint")
    return F.struct(
        F.sha2(F.concat_ws("|", ticket_id, seq.cast("string")), 256).alias("entry_id"),
        ticket_id.alias("object"),
        body.alias("body"),
        F.lit(C.BODY_TYPE).alias("body_type"),
        F.lit(C.ENTRY_TYPE).alias("type"),
        F.lit(C.VISIBILITY).alias("visibility"),
        F.lit(None).cast("timestamp").alias("expires_at"),
        seq.alias("seq"),
        created_at.cast("timestamp").alias("updated_at"),
    )


def detail_comments(tickets: DataFrame, created_at: Column | None = None) -> DataFrame:
    """K3/K5: 5 timeline comments per ticket (6 with the chart comment on the
    app-store and domain channels), ``seq`` 1..6 in posting order.  A narrow
    explode; no shuffle."""
    created_at = created_at if created_at is not None else F.lit(None).cast("timestamp")
    entries = F.transform(comment_bodies(), lambda b, i: comment_entry(F.col("ticket_id"), b, i, created_at))
    return tickets.select(F.explode(entries).alias("e")).select("e.*")
