"""Entity schemas (Spark DDL strings and StructTypes)."""

from __future__ import annotations

from pyspark.sql import types as T

# Items of the landed source payloads (one response page per row).
PAYLOAD_ITEM = {
    "social": "tweet_id STRING, text STRING, expanded_url STRING",
    "appstore": "id STRING, title STRING, url STRING, text STRING, rating STRING",     # typed afterwards
    "product": "review_id STRING, review_content STRING",
    "business": "author STRING, comment STRING",
    "domain": "title STRING, text STRING",
}

# Canonical review table (all channels).
REVIEW = T.StructType([
    T.StructField("channel", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("rating", T.LongType()),
    T.StructField("page", T.LongType()),
])
REVIEW_COLUMNS = [f.name for f in REVIEW.fields]

# Model answer: every field parsed as STRING first, typed afterwards.
ANNOTATION_FIELDS = [
    "Relevance", "Sentiments", "Category", "sub_category", "Severity",
    "Feature", "insight", "description", "response", "review",
]
ANNOTATION = T.StructType(
    [T.StructField(f, T.StringType()) for f in ANNOTATION_FIELDS]
    + [T.StructField("_corrupt", T.StringType())]
)
COMPLETION = "choices ARRAY<STRUCT<text: STRING>>"

SUMMARY_FIELDS = ["customer_likings", "customer_pain_points", "focus", "actions"]
SUMMARY = T.StructType(
    [T.StructField(f, T.StringType()) for f in SUMMARY_FIELDS]
    + [T.StructField("_corrupt", T.StringType())]
)

TICKET = (
    "ticket_id STRING, channel STRING, review_id STRING, title STRING, "
    "tags ARRAY<STRUCT<id: STRING>>, body STRING, type STRING, owned_by ARRAY<STRING>, "
    "applies_to_part STRING, severity STRING"
)

TIMELINE = (
    "entry_id STRING, object STRING, body STRING, body_type STRING, type STRING, "
    "visibility STRING, expires_at TIMESTAMP, seq BIGINT, updated_at TIMESTAMP"
)

# Command event (fields the jobs read, names as they arrive).
COMMAND_EVENT = (
    "payload STRUCT<parameters: STRING>, "
    "context STRUCT<snap_in_id: STRING>, "
    "input_data STRUCT<global_values: MAP<STRING, STRING>, "
    "resources: STRUCT<tags: MAP<STRING, STRUCT<id: STRING>>>>"
)

_USER = (
    "STRUCT<display_handle: STRING, display_id: STRING, display_name: STRING, email: STRING, "
    "full_name: STRING, id: STRING, id_v1: STRING, state: STRING, type: STRING>"
)
WEBHOOK_EVENT = (
    "payload STRUCT<id: STRING, timestamp: STRING, type: STRING, unique_key: STRING, "
    "webhook_id: STRING, work_created: STRUCT<work: STRUCT<"
    "applies_to_part: STRUCT<display_id: STRING, id: STRING, id_v1: STRING, name: STRING, type: STRING>, "
    f"created_by: {_USER}, created_date: STRING, custom_fields: STRING, display_id: STRING, "
    f"id: STRING, id_v1: STRING, owned_by: ARRAY<{_USER}>, severity: STRING, "
    "stage: STRUCT<name: STRING, ordinal: INT>, state: STRING, stock_schema_fragment: STRING, "
    "title: STRING, type: STRING>>>, "
    "context STRUCT<dev_oid: STRING, automation_id: STRING, source_id: STRING, snap_in_id: STRING, "
    "snap_in_version_id: STRING>"
)
