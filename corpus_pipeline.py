"""The corpus pipeline: five stages from ``documents`` to coded texts.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet in the checkpoint folder and rereads it as the next stage's ``docs``,
so a lost executor never reaches back over a stage.  The first four return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxtide.llm import exact_dedup, mixing, piece_coding, quality, shingle_join
from voxtide.llm.common import materialize, read
from voxtide.llm.queries import piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field and the base rule keep."""
    return quality.keep(docs, quality.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles."""
    return shingle_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def code_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text of every copy."""
    return piece_coding.code(docs, piece_model())


STAGES = [("quality rules", quality_rules), ("exact dedup", drop_copies), ("near duplicates", drop_near_duplicates),
          ("source mix", mix_sources), ("piece coding", code_pieces)]

#: The line field and the piece coding have no SQL form; tests check the whole
#: run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
