"""Per-row outcomes (K9): failures become dead-letter rows, never job failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEAD_COLUMNS = ["stage", "channel", "key", "reason", "message", "raw"]


def dead_letter(df: DataFrame, stage: str, key: Column, reason, raw: Column, message: Column | None = None) -> DataFrame:
    """Project failed rows onto ``dead_letters(stage, channel, key, reason, message, raw)``.

    ``message`` is the outcome's error text where one is known (a failed model
    call); otherwise it says stage and reason."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    said = F.concat(F.lit(f"{stage}: "), reason)
    return df.select(F.lit(stage).alias("stage"),
                     (F.col("channel") if "channel" in df.columns else F.lit(None).cast("string")).alias("channel"),
                     key.cast("string").alias("key"), reason.alias("reason"),
                     (said if message is None else F.coalesce(message, said)).alias("message"), raw.cast("string").alias("raw"))


def split_outcomes(df: DataFrame, ok: Column, stage: str, key: Column, reason, raw: Column
                   ) -> tuple[DataFrame, DataFrame]:
    """Split on a boolean ``ok`` column expression: (good rows, dead letters).

    NULL counts as failure.  Both outputs read the same input, so callers
    materialise ``df`` first when it is expensive or non-deterministic.
    """
    good = df.where(F.coalesce(ok, F.lit(False)))
    bad = df.where(~F.coalesce(ok, F.lit(False)))
    return good, dead_letter(bad, stage, key, reason, raw)


def union_all(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
