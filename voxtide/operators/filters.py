"""Filters, ordering and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtide.functions.text import parse_limit  # noqa: F401  (F5, re-exported)
from voxtide.operators.joins import bounded_broadcast


def search_subject(reviews: DataFrame, query: str, text: str = "text") -> DataFrame:
    """case-insensitive substring match of the subject in the text."""
    return reviews.where(F.contains(F.lower(F.col(text)), F.lower(F.lit(query))))


def filter_language(reviews: DataFrame, lang: str = "en") -> DataFrame:
    """language equality; pushed into the Parquet scan when ``lang`` is a column there."""
    return reviews.where(F.col("lang") == F.lit(lang))


def relevance_filter(annotated: DataFrame, mode: str = "observed") -> DataFrame:
    """F3.  ``observed``: every row is kept and marked relevant (what the
    original jobs do, since their test assigns instead of comparing).
    ``strict``: rows the model marked not relevant are dropped; rows with an
    unreadable relevance are kept."""
    if mode == "observed":
        return annotated.withColumn("relevance", F.lit(True))
    if mode == "strict":
        return annotated.where(F.coalesce(F.col("relevance"), F.lit(True)))
    raise ValueError(f"unknown relevance mode {mode!r}")


def mark_allowed(config: DataFrame, allowed: DataFrame, column: str = "llm_model") -> DataFrame:
    """F6 in one pass: ``accepted`` = whether ``column`` is in the allow-list
    (left join against the broadcast one-column table)."""
    a = bounded_broadcast(allowed.select(F.col(allowed.columns[0]).alias(column),
                                         F.lit(True).alias("_allowed")).dropDuplicates([column]))
    j = config.join(a, column, "left")
    return j.withColumn("accepted", F.coalesce(F.col("_allowed"), F.lit(False))).drop("_allowed")


def check_model(config: DataFrame, allowed: DataFrame, column: str = "llm_model"
                ) -> tuple[DataFrame, DataFrame]:
    """split rows by membership of ``column`` in the allow-list table
    (semi / anti join against a broadcast one-column table)."""
    a = bounded_broadcast(allowed.select(F.col(allowed.columns[0]).alias(column)))
    return config.join(a, column, "left_semi"), config.join(a, column, "left_anti")


def top_n(reviews: DataFrame, n: int, by=("rating",), per: str | None = None,
          tie: str = "review_id") -> DataFrame:
    """The ``n`` best rows by ``by`` (descending), ties by ``tie``.

    ``per=None`` plans a TakeOrderedAndProject (partial top-n per partition,
    one small final merge).  ``per='channel'`` ranks inside each group; Spark
    plans a partial WindowGroupLimit before the shuffle, so a hot group sends at
    most ``n`` rows per map partition.
    """
    order = [F.col(c).desc_nulls_last() for c in by] + [F.col(tie).asc()]
    if n <= 0:
        return reviews.limit(0)
    if per is None:
        return reviews.orderBy(*order).limit(n)
    w = Window.partitionBy(per).orderBy(*order)
    return (reviews.withColumn("_rank", F.row_number().over(w))
                   .where(F.col("_rank") <= n)
                   .withColumnRenamed("_rank", "rank"))
