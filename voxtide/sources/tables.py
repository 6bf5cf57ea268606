"""Dimension tables and table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide import schemas
from voxtide.operators.joins import local_table


def tags_df(spark: SparkSession) -> DataFrame:
    """The 11-entry tag dictionary ``(name, description, id)``.

    Fixed size (11 rows), so joins against it are always broadcast.
    """
    rows = [(n, d, C.TAG_ID_PREFIX + n) for n, d in C.TAGS]
    return local_table(spark, rows, "name STRING, description STRING, id STRING")


def tag_id(name: str) -> str:
    return C.TAG_ID_PREFIX + name


def config_df(spark: SparkSession, rows=None) -> DataFrame:
    """One row per channel with the job inputs and the channel's fixed text layout."""
    rows = rows or C.JOB_CONFIG
    full = []
    for channel, company, part, owner, model in rows:
        a, b = C.BODY_INDENTS[channel]
        full.append((
            channel, company, part, owner, model, C.TITLE_TEMPLATE[channel], a, b,
            C.INSIGHT_INDENT[channel], channel in C.CHART_CHANNELS,
        ))
    return local_table(
        spark, full,
        "channel STRING, company STRING, default_part_id STRING, default_owner_id STRING, "
        "llm_model STRING, title_template STRING, body_indent_a INT, body_indent_b INT, "
        "insight_indent INT, has_chart BOOLEAN",
    )


def allowed_models_df(spark: SparkSession) -> DataFrame:
    return local_table(spark, [(m,) for m in C.ALLOWED_MODELS], "llm_model STRING")


def sub_category_rules_df(spark: SparkSession) -> DataFrame:
    rows = [(c, s) for c, subs in C.SUB_CATEGORY_RULES.items() for s in subs]
    return local_table(spark, rows, "category STRING, sub_category STRING")


def scan_tickets(spark: SparkSession, path: str) -> DataFrame:
    """Ticket scan; the ``type`` predicate is pushed into the Parquet reader."""
    return spark.read.parquet(path).where(F.col("type") == F.lit(C.TICKET_TYPE))


def read_events(spark: SparkSession, path: str, schema: str = schemas.WEBHOOK_EVENT) -> DataFrame:
    """JSON files that each hold an array of events (explicit schema, no inference)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
