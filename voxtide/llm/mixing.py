"""Operator 5, mixing sources to target weights.

Sizes are summed per source, target shares are poured over the sources by weight
(a target stops at ``cap`` times its source's size; what it cannot take is shared
again by weight among the others, until none is above), and each document is
taken ``floor(rate)`` times plus once more where a hash-seeded Bernoulli draw
falls below the fraction of the rate.  A draw depends on a seed, the document id
and, where rows share an id, the row's number among them (by source, text and
the whole row), so reruns agree.  Of ``SEEDS`` seeds, each source uses the one whose
taken words come nearest to its target; all are weighed in the same aggregate.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; rows without an id share the id "null"; rows that share an id,
repeated rows too, draw each on its own; a source or table without words has
target 0 and takes nothing; other columns pass through ``mix`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide.llm.common import materialize, rank_rows, spread_join

WEIGHTS = (1, 2, 3)
CAP = 3
SEEDS = 32
_DRAW = float(2**52)


def size_of(text):
    """Number of words."""
    words = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\x20\\x09-\\x0D]+", "x"), "[\\x20\\x09-\\x0D]+", "")
    return F.length(words).cast("bigint")


def name_of(doc_id):
    """The id as the draws take it."""
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def draw(doc_id, nth, seed):
    """A number in [0, 1): 52 bits of MD5 over the seed, the id and, from the
    second row of an id on, the row's number."""
    key = F.concat(seed.cast("string"), F.lit(":"), name_of(doc_id), F.when(nth > 0, F.concat(F.lit(":"), nth.cast("string"))).otherwise(""))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(_DRAW)


def shared_ids(docs: DataFrame) -> DataFrame:
    """(__name, __rows): the ids that several rows have, and how many."""
    names = docs.select(name_of(F.col("doc_id")).alias("__name")).groupBy("__name").agg(F.count("*").alias("__rows"))
    return materialize(names.where("__rows > 1"), "mix-shared")


def number(docs: DataFrame, shared: DataFrame, total: int) -> DataFrame:
    """``docs`` with ``__nth``: the row's number (from 0) among those of its id, by
    source, text and the whole row.  Only rows of ``shared`` ids are sorted, by
    ranges that cut the rows of one id too; rows alike in everything get their
    numbers in any order."""
    if not shared.limit(1).count():
        return docs.withColumn("__nth", F.lit(0).cast("bigint"))
    out = docs.columns
    told = spread_join(docs.withColumn("__name", name_of(F.col("doc_id"))), shared, "__name", "__rows", total)
    order = {"__named": F.col("source").isNotNull(), "__source": F.coalesce("source", F.lit("")), "__text": F.coalesce(F.md5("text"), F.lit("")),
             "__whole": F.md5(F.to_json(F.struct(*(F.col(f"`{c}`") for c in out))))}
    again = materialize(told.where("__rows is not null").drop("__rows").withColumns(order).withColumn("__row", F.monotonically_increasing_id()), "mix-again")
    by = ["__name", *order, "__row"]
    ranked = materialize(rank_rows(again.select(*by), [F.col(c) for c in by], "__place").select("__name", "__row", "__place"), "mix-places")
    first = ranked.groupBy("__name").agg(F.min("__place").alias("__first"), F.count("*").alias("__rows"))
    nth = spread_join(ranked, first, "__name", "__rows", ranked.count()).select("__row", (F.col("__place") - F.col("__first")).alias("__nth"))
    once = told.where("__rows is null").select(*out, F.lit(0).cast("bigint").alias("__nth"))
    return once.unionByName(again.join(nth, "__row").select(*out, "__nth"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, named, docs, source_size) → the same with weight, target, rate.

    Each round fixes the sources whose share would exceed the cap and pours the
    rest over the others; one aggregate row a round reaches the driver."""
    ranked = rank_rows(sizes, [F.col("named").desc(), F.col("source_key")], "place")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight.cast("bigint")), "mix-sources")
    capped, level = F.lit(False), None
    while True:
        whole = ranked.agg(F.sum("source_size").alias("all"),
                           F.sum(F.when(capped, F.col("source_size") * CAP).otherwise(0)).alias("fixed"),
                           F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("open"),
                           F.sum(capped.cast("int")).alias("n")).first()
        if not whole["open"]:
            break
        level = F.lit(whole["all"] - whole["fixed"]).cast("double") / F.lit(whole["open"]).cast("double")
        # a share stays above the cap once it is: the level only rises
        over = F.col("weight") * level > F.col("source_size") * CAP
        if ranked.where(over).count() == whole["n"]:
            break
        capped = over
    share = F.col("source_size") * F.lit(float(CAP))
    if level is not None:
        share = F.when(capped, share).otherwise(F.col("weight") * level)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(CAP)))).otherwise(0.0)
    return ranked.withColumn("target", share).withColumn("rate", rate)


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The narrow rows (doc_id, nth, source_key, named, size), one row per source
    with target, rate and the chosen seed, and the ids that several rows have."""
    def described(rows: DataFrame, nth) -> DataFrame:
        return materialize(rows.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), nth.cast("bigint").alias("nth"), F.coalesce("source", F.lit("")).alias("source_key"),
            F.col("source").isNotNull().cast("int").alias("named"), size_of(F.col("text")).alias("size")), "mix-docs")
    narrow = described(docs, F.lit(0))
    shared = shared_ids(narrow)
    if shared.limit(1).count():
        narrow = described(number(docs, shared, narrow.count()), F.col("__nth"))
    sizes = narrow.groupBy("source_key", "named").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    rates = materialize(with_key(targets(sizes)), "mix-targets")
    total = narrow.count()
    rated = spread_join(with_key(narrow).select("doc_id", "nth", "size", "source"), rates.select("source", "docs", "rate"), "source", "docs", total)
    fraction = F.col("rate") - F.floor("rate")
    weighed = rated.groupBy("source").agg(*(F.sum(F.when(draw(F.col("doc_id"), F.col("nth"), F.lit(s)) < fraction, F.col("size")).otherwise(0)).alias(f"s{s}") for s in range(SEEDS)))
    gap = [F.struct(F.abs(F.col(f"s{s}") + F.floor("rate") * F.col("source_size") - F.col("target")).alias("gap"), F.lit(s).alias("seed")) for s in range(SEEDS)]
    chosen = weighed.join(rates, "source").withColumn("seed", F.array_min(F.array(*gap))["seed"])
    return narrow, materialize(chosen.select("source", "docs", "source_size", "target", "rate", "seed"), "mix-plan"), shared


def with_key(df: DataFrame) -> DataFrame:
    """Adds ``source``, one never-null join key per source."""
    return df.withColumn("source", F.concat(F.col("named").cast("string"), F.col("source_key")))


def copies_of(doc_id, nth):
    return (F.floor("rate") + (draw(doc_id, nth, F.col("seed")) < F.col("rate") - F.floor("rate")).cast("bigint")).cast("bigint")


def mixture(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken."""
    narrow, sources, _ = plan(docs)
    joined = spread_join(with_key(narrow), sources, "source", "docs", narrow.count())
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies_of(F.col("doc_id"), F.col("nth"))).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    out = docs.columns
    narrow, sources, shared = plan(docs)
    total = narrow.count()
    sources = sources.select(*(F.col(c).alias(f"__mix_{c}") for c in sources.columns))
    keyed = number(docs, shared, total).withColumn("__mix_source", F.concat(F.col("source").isNotNull().cast("int").cast("string"), F.coalesce("source", F.lit(""))))
    joined = spread_join(keyed, sources, "__mix_source", "__mix_docs", total)
    fraction = F.col("__mix_rate") - F.floor("__mix_rate")
    copies = F.floor("__mix_rate") + (draw(F.col("doc_id"), F.col("__nth"), F.col("__mix_seed")) < fraction).cast("bigint")
    again = F.explode(F.array_repeat(F.lit(0), copies.cast("int")))
    return joined.select(*out, again.alias("__mix_again")).select(*out)
