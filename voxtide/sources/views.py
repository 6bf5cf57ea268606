"""Test views derived from the driver tables (``documents``, ``labels``, ``events``).

These give every query real input that grows with the tables: reviews from
documents, ready answers from labels, command events and timeline entries from
events.  All derivations are row-wise expressions, so they scale linearly and
add no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide.session import table_path

# Reviews per landed page in the test payloads (bounds every page's size).
PAGE_SIZE = 64
# After every BROKEN_PAGE_EVERY-th page an extra error response lands (dead-letter path).
BROKEN_PAGE_EVERY = 10

# Vocabularies of the ready answers (test data only).
ANSWER_CATEGORIES = C.CATEGORIES + ["other"]
ANSWER_SUB_CATEGORIES = [
    "blocking", "major", "functional", "usability", "-", "vulnerability",
    "privacy issue", "expensive", "value for money", "unspecified", "great support",
]
ANSWER_SEVERITIES = ["Blocker", "High", "Medium", "Low", "medium", "critical"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def pick(values: list[str], index: Column) -> Column:
    """``values[index]`` as a CASE expression (0-based index)."""
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(index == i, F.lit(v)) if expr is None else expr.when(index == i, F.lit(v)))
    return expr


def _sql_pick(values: list[str], index: str) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical review rows built from ``documents``.

    title: NULL when doc_id%4=1, '' when doc_id%4=0, else 'Review <id>'.
    url: only for odd ids.  text gets a short link appended when doc_id%3=0.
    (One ``selectExpr``: the whole projection is built in a single call.)
    """
    d = read_table(spark, sf_dir, "documents")
    channel = _sql_pick(C.CHANNELS, "CAST(substr(source, 4, 100) AS INT) % 5")
    return d.selectExpr(
        "doc_id",
        f"{channel} AS channel",
        "CAST(doc_id AS STRING) AS review_id",
        "CASE WHEN doc_id % 4 = 1 THEN CAST(NULL AS STRING) WHEN doc_id % 4 = 0 THEN '' "
        "ELSE concat('Review ', CAST(doc_id AS STRING)) END AS title",
        "CASE WHEN doc_id % 2 = 1 THEN concat('https://example.com/r/', CAST(doc_id AS STRING)) END AS url",
        "concat('user_', CAST(doc_id % 50 AS STRING)) AS author",
        f"CASE WHEN doc_id % 3 = 0 THEN concat(text, ' {C.LINK_PREFIX}', CAST(doc_id AS STRING)) "
        "ELSE text END AS text",
        "CAST(1 + n_chars % 5 AS BIGINT) AS rating",
        "CAST(n_chars % 97 AS BIGINT) AS score",
        "lang",
        f"CAST(floor(doc_id / {PAGE_SIZE}) AS BIGINT) AS page",
    )


def label_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ready model answers (one JSON text per labelled document).

    Relevance from ``toxic``, sentiment from ``quality``; the other fields are
    built from doc_id.  doc_id%13=0 gives a truncated answer (not JSON) and
    doc_id%29=0 an unknown sentiment, so both failure paths see data.
    """
    def said(words: str) -> str:
        return f"concat('{words}', CAST(doc_id AS STRING))"

    fields = {
        "Relevance": "toxic = 0",
        "Sentiments": "CASE WHEN doc_id % 29 = 0 THEN 'Neutral' WHEN quality = 1 THEN 'Positive' ELSE 'Negative' END",
        "Category": _sql_pick(ANSWER_CATEGORIES, "doc_id % 9"),
        "sub_category": _sql_pick(ANSWER_SUB_CATEGORIES, "doc_id % 11"),
        "Severity": _sql_pick(ANSWER_SEVERITIES, "doc_id % 6"),
        "Feature": "concat('feature ', CAST(doc_id % 7 AS STRING))",
        "insight": said("insight for "),
        "description": f"CASE WHEN doc_id % 10 = 7 THEN CAST(NULL AS STRING) ELSE {said('description of ')} END",
        "response": said("response to "),
        "review": said("review "),
    }
    js = "to_json(named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + "))"
    lab = read_table(spark, sf_dir, "labels")
    return lab.selectExpr("doc_id", f"CASE WHEN doc_id % 13 = 0 THEN substring({js}, 1, 25) ELSE {js} END AS answer")


def summary_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary answers (one JSON text per labelled document): ``actions`` is a
    list for odd ids, ``focus`` a list when doc_id%3=0, and doc_id%13=0 gives a
    truncated answer."""
    sid = "CAST(doc_id AS STRING)"
    text = (f"concat('{{\"customer_likings\":\"liked ', {sid}, '\",\"customer_pain_points\":\"pain ', CAST(quality AS STRING), '\",\"focus\":', "
            f"CASE WHEN doc_id % 3 = 0 THEN concat('[\"a ', {sid}, '\",\"b\"]') ELSE concat('\"f ', {sid}, '\"') END, ',\"actions\":', "
            f"CASE WHEN doc_id % 2 = 1 THEN concat('[\"x\",\"y ', {sid}, '\"]') ELSE concat('\"act ', {sid}, '\"') END, '}}')")
    return read_table(spark, sf_dir, "labels").selectExpr(
        f"{sid} AS chunk_key", f"CASE WHEN doc_id % 13 = 0 THEN substr({text}, 1, 30) ELSE {text} END AS answer")


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command events from ``events``: the argument text comes from props.k,
    with the argument cases of the original command in rotation."""
    return commands_of(read_table(spark, sf_dir, "events"))


def commands_of(ev: DataFrame) -> DataFrame:
    """``commands`` of the given rows of ``events``."""
    k = F.get_json_object(F.col("props"), "$.k")
    m = F.col("event_id") % 8
    params = (F.when(m == 0, k)
               .when(m == 1, F.lit(""))
               .when(m == 2, F.concat(k, F.lit("abc")))
               .when(m == 3, F.lit("x"))
               .when(m == 4, F.concat(F.lit("  "), k, F.lit(" ")))
               .when(m == 5, F.concat(F.lit(" -"), k))
               .when(m == 6, F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("+"), k)))
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        params.alias("parameters"),
        pick(C.CHANNELS, F.col("user_id") % 5).alias("channel"),
        F.concat(F.lit("app/"), (F.col("user_id") % 5).cast("string")).alias("app_id"),
        k.cast("bigint").alias("k"),
    )


def command_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``commands`` as the JSON events that the jobs receive (column ``value``)."""
    return command_events_of(read_table(spark, sf_dir, "events"))


def command_events_of(ev: DataFrame) -> DataFrame:
    """``command_events`` of the given rows of ``events``."""
    c = commands_of(ev)
    model = F.when(F.col("k") % 3 > 0, F.coalesce(pick(C.ALLOWED_MODELS, F.col("k") % 40), F.concat(F.lit("model-"), F.col("k").cast("string"))))
    values = F.map_filter(F.create_map(
        F.lit("subject"), F.concat(F.lit("subject-"), F.col("user_id").cast("string")),
        F.lit("default_part_id"), F.concat(F.lit("part/"), F.col("channel")), F.lit("default_owner_id"), F.concat(F.lit("owner/"), F.col("channel")),
        F.lit("llm_model_to_use"), model), lambda k, v: v.isNotNull())
    tags = F.create_map(*[x for n, _ in C.TAGS for x in (F.lit(n), F.struct(F.lit(C.TAG_ID_PREFIX + n).alias("id")))])
    event = F.struct(F.struct("parameters").alias("payload"), F.struct(F.col("app_id").alias("snap_in_id")).alias("context"),
                     F.struct(values.alias("global_values"), F.struct(tags.alias("tags")).alias("resources")).alias("input_data"))
    return c.select("event_id", "channel", "ts", F.to_json(event).alias("value"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeline entries from ``events``: one version per event of entry
    ``user_id-event_type``, expiring one minute after it was written."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("event_type")).alias("entry_id"),
        F.concat(F.lit("app/"), (F.col("user_id") % 5).cast("string")).alias("object"),
        F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" "),
                 F.col("event_type")).alias("body"),
        F.lit(C.BODY_TYPE).alias("body_type"),
        F.lit(C.ENTRY_TYPE).alias("type"),
        F.lit(C.VISIBILITY).alias("visibility"),
        (F.col("ts") + F.expr("INTERVAL 1 MINUTE")).alias("expires_at"),
        F.col("event_id").alias("seq"),
        F.col("ts").alias("updated_at"),
    )
