"""Command events → job requests.

A command event carries its argument (``payload.parameters``), the job's
settings (``input_data.global_values``: subject id, part, owner, model) and the
install's tag ids (``input_data.resources.tags``).  ``parse_commands`` turns each
into one typed row; a request for a model that is not allowed is a dead letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide import schemas
from voxtide.functions.text import parse_limit
from voxtide.operators.filters import mark_allowed
from voxtide.operators.outcomes import dead_letter

#: Keys of ``global_values`` that all jobs read.
SETTINGS = {"default_part_id": "default_part_id", "default_owner_id": "default_owner_id", "llm_model_to_use": "llm_model"}


def parse_commands(raw: DataFrame, allowed_models: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows with a JSON command event in ``value`` (and ``channel``, ``event_id``)
    → (jobs, dead letters).  A job has app_id, n (the parsed limit), the
    settings (model: the default where none is asked for), subject (the one
    remaining global value), and tags (name → id)."""
    e = raw.withColumn("_e", F.from_json(value, schemas.COMMAND_EVENT))
    given = F.col("_e.input_data.global_values")
    asked = e.select(
        "channel", "event_id", F.col(value).alias("_raw"),
        F.col("_e.context.snap_in_id").alias("app_id"), parse_limit(F.col("_e.payload.parameters")).alias("n"),
        *[F.get(F.array(given[k]), 0).alias(v) for k, v in SETTINGS.items()],
        F.element_at(F.map_values(F.map_filter(given, lambda k, v: ~k.isin(list(SETTINGS)))), 1).alias("subject"),
        F.transform_values("_e.input_data.resources.tags", lambda k, v: v["id"]).alias("tags"))
    asked = mark_allowed(asked.withColumn("llm_model", F.coalesce("llm_model", F.lit(C.DEFAULT_MODEL))), allowed_models)
    bad = asked.where("not accepted or app_id is null")
    reason = F.when(F.col("app_id").isNull(), F.lit("malformed_event")).otherwise(F.lit("model_not_allowed"))
    dead = dead_letter(bad, "command", F.col("event_id"), reason, F.col("_raw"), F.concat(F.lit("command: model "), F.col("llm_model"), F.lit(" is not allowed")))
    return asked.where("accepted and app_id is not null").drop("accepted", "_raw"), dead


def job_config(jobs: DataFrame, company: DataFrame) -> DataFrame:
    """The jobs' settings in the shape of the channel configuration: one row per
    channel, that of the latest event (``company`` gives each channel's name), and
    the largest limit that any of its jobs asked for as ``n``."""
    latest = jobs.groupBy("channel").agg(F.max_by(F.struct("default_part_id", "default_owner_id", "llm_model"), "event_id").alias("c"), F.max("n").alias("n"))
    return latest.join(company.select("channel", "company"), "channel", "left").select("channel", "company", "c.*", "n")
