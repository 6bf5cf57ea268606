"""Ticket aggregates and corpus summaries.

Sentiment shares and category counts are single conditional aggregates
(partial + final, one scan).  Joining "all bodies" (A5) and summarising them
(A6) never gathers a whole group in one task: bodies are cut into chunks of
bounded size by a distributed running sum, and summaries are reduced level by
level until one remains per group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtide import constants as C
from voxtide.operators.annotate import Completer, annotate, parse_summary
from voxtide.operators.joins import bounded_broadcast
from voxtide.operators.outcomes import union_all
from voxtide.operators.render import render_summary_prompt
from voxtide.session import materialize, ship_package
from voxtide.sources.tables import tag_id


def _has_tag(tag: str) -> Column:
    return F.exists("tags", lambda t: t["id"] == F.lit(tag))


def pct_expr(part: Column, total: Column) -> Column:
    """``part/total*100`` in that operation order; 0/0 gives NaN (as in the
    original), not an ANSI division error."""
    return F.when(total == 0, F.lit(float("nan"))).otherwise((part / total) * F.lit(100.0))


def sentiment_pct(tickets: DataFrame, by=(), positive: str = tag_id("Positive"),
                  negative: str = tag_id("Negative")) -> DataFrame:
    """Tickets tagged Positive / Negative and their shares.

    Counted over tag arrays (a ticket may count in both).  One scan, one
    aggregate; ``by`` adds grouping keys (e.g. ``('channel',)``).
    """
    agg = tickets.groupBy(*by).agg(
        F.count_if(_has_tag(positive)).alias("positive"),
        F.count_if(_has_tag(negative)).alias("negative"),
    )
    return _shares(agg, by)


def _shares(counted: DataFrame, by) -> DataFrame:
    total = F.col("positive") + F.col("negative")
    return counted.select(*by, "positive", "negative",
                          pct_expr(F.col("positive"), total).alias("positive_pct"),
                          pct_expr(F.col("negative"), total).alias("negative_pct"))


# ------------------------------------------------------------ counts kept up to date
def write_counts(tickets: DataFrame, path: str, batch_id: int) -> None:
    """A1–A4, A7, A9 as state that merges: the counts of one ticket batch per
    channel and category, in a folder of its own.  A new batch reads only itself,
    and one that is written again replaces what it had."""
    counts = tickets.groupBy("channel", "category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_has_tag(tag_id("Positive"))).alias("positive"), F.count_if(_has_tag(tag_id("Negative"))).alias("negative"))
    counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_counts(spark, path: str) -> DataFrame:
    return spark.read.schema("channel string, category string, n bigint, positive bigint, negative bigint, batch_id bigint").parquet(path)


def merged_pct(counts: DataFrame, by=()) -> DataFrame:
    """``sentiment_pct`` from the counts of all batches (``by`` of channel, category):
    as many rows to read as batches have channels and categories, however many tickets."""
    sums = counts.groupBy(*by).agg(F.coalesce(F.sum("positive"), F.lit(0)).alias("positive"), F.coalesce(F.sum("negative"), F.lit(0)).alias("negative"))
    return _shares(sums, by)


def merged_category_counts(counts: DataFrame, by=()) -> DataFrame:
    """``category_counts`` from the counts of all batches."""
    return counts.groupBy(*by, "category").agg(F.sum("n").alias("n"))


def category_counts(tickets: DataFrame, by=(), pivot: bool = False) -> DataFrame:
    """Tickets per category; ``pivot=True`` gives one column per tag name
    from a single conditional aggregate (no pivot shuffle)."""
    if not pivot:
        return tickets.groupBy(*by, "category").agg(F.count(F.lit(1)).alias("n"))
    names = [n for n, _ in C.TAGS if n not in ("Positive", "Negative")]
    return tickets.groupBy(*by).agg(*[F.count_if(F.col("category") == n).alias(n) for n in names])


def chart_data(counts: DataFrame, by=()) -> DataFrame:
    """Bar-chart data per group: ``labels`` and ``data`` arrays ordered by
    label.  Each group has at most one entry per tag name, so the list is bounded."""
    g = counts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("category", "n"))).alias("_b"))
    return g.select(*by, F.transform("_b", lambda x: x["category"]).alias("labels"),
                    F.transform("_b", lambda x: x["n"]).alias("data"))


# ----------------------------------------------------------------- chunking
def _local_offsets(by: list[str], lengths: list[str]):
    """Per-partition exclusive running sums of the columns ``lengths`` within each
    group.

    Rows arrive sorted by (group, order); a group may continue from one Arrow
    batch into the next, so the running totals are carried across batches.
    """
    def run(batches):
        last_key, carry = None, [0] * len(lengths)
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                yield pdf.assign(**{f"_local{c}": pd.Series([], dtype="int64") for c in lengths})
                continue
            keys = [pdf[c].astype(object).where(pdf[c].notna(), "\x00null").astype(str).to_numpy()
                    for c in by]
            new = np.zeros(n, dtype=bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            gid = np.cumsum(new)
            first_key = tuple(k[0] for k in keys)
            goes_on = last_key is not None and first_key == last_key
            local = {}
            for i, c in enumerate(lengths):
                lens = pdf[c].fillna(0).astype("int64").to_numpy()
                incl = pd.Series(lens).groupby(gid).cumsum().to_numpy()
                if goes_on:
                    incl = incl + np.where(gid == 1, carry[i], 0)
                carry[i] = int(incl[-1])
                local[f"_local{c}"] = (incl - lens).astype("int64")
            last_key = tuple(k[-1] for k in keys)
            yield pdf.assign(**local)
    return run


#: Characters of chunk input aimed at per range partition.
PARTITION_CHARS = 32 << 20


def assign_chunks(df: DataFrame, by, order, text: str, max_chars: int | Column,
                  partitions: int | None = None, max_groups: int | None = None, cut: Column | None = None,
                  unique: bool = False) -> DataFrame:
    """Cut each group's texts (ordered by ``order``) into chunks whose running
    offset falls in ``[c*max_chars, (c+1)*max_chars)``.  A text counts its
    characters and one for the separator, so empty and NULL texts fill chunks too.

    With ``cut`` (a condition), a row that meets it also ends a chunk, and offsets
    count from the row behind the last such row: the chunks between two cuts do
    not depend on the rows elsewhere.  ``chunk`` is then a text, in order.

    Distributed prefix sum over narrow rows: the input is written once with a
    number for each row, and only (group, order, number, length) is range-sorted
    on (group, order, number).  A hot group, or one of equal order keys, spans
    many tasks; each task sums locally (Arrow batches); the per-task group totals
    give each task its offset.  No task ever holds a whole group, and no text
    leaves the JVM.  Row numbers are pinned by the write, so a retried task
    cannot move rows between ranges.  Where group and ``order`` are ``unique`` and
    ``df`` reads written tables, they serve as the number, and nothing is written.

    The totals table has at most ``partitions + groups - 1`` rows (range
    partitions hold contiguous groups).  With ``max_groups`` given, that bound
    is proven and the table is broadcast; without it the planner / AQE decide
    from runtime sizes.
    """
    by, order = list(by), list(order)
    spark = df.sparkSession
    ship_package(spark)
    base = df.withColumn("_len", (F.length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("bigint"))
    if cut is not None:
        base = base.withColumn("_cut", F.coalesce(cut, F.lit(False)).cast("bigint"))
    number = order if unique else ["_row"]
    if not unique:
        base = materialize(base.withColumn("_row", F.monotonically_increasing_id()), "chunk-input")
    chars = base.agg(F.sum("_len")).first()[0] or 0
    n = partitions or max(spark.sparkContext.defaultParallelism, -(-chars // PARTITION_CHARS))
    sums = ["_len"] if cut is None else ["_len", "_cut"]
    keys = [*by, *[c for c in order if c != text], *([] if unique else ["_row"])]
    narrow = base.select(*dict.fromkeys([*keys, *sums]))
    ranged = (narrow.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                    .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField(f"_local{c}", T.LongType()) for c in sums])
    local = materialize(ranged.mapInPandas(_local_offsets(by, sums), schema).select("_pid", *by, *number, *sums, *(f"_local{c}" for c in sums)), "chunk-local")
    totals = local.groupBy("_pid", *by).agg(*(F.sum(c).alias(f"_tot{c}") for c in sums))
    w = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.col(c).alias(f"_by_{c}") for c in by], *(F.coalesce(F.sum(f"_tot{c}").over(w), F.lit(0)).alias(f"_off{c}") for c in sums))
    if max_groups is not None:
        offsets = bounded_broadcast(offsets, known_rows=n + max_groups - 1)
    joined = local.alias("l").join(offsets.alias("o"), [F.col("l._pid") == F.col("o._pid"), *[F.col(f"l.{c}").eqNullSafe(F.col(f"o._by_{c}")) for c in by]], "left")
    placed = joined.select(*(F.col(f"l.{c}").alias(f"_number_{c}") for c in number), *(F.col(f"l.{c}").alias(f"_by_{c}") for c in by), *((F.col(f"_off{c}") + F.col(f"_local{c}")).alias(f"_at{c}") for c in sums))
    budget = max_chars if isinstance(max_chars, Column) else F.lit(max_chars)

    def back(found: DataFrame) -> DataFrame:
        on = [F.col(c) == F.col(f"_number_{c}") for c in number] + ([F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] if unique else [])
        return base.join(found, on).drop(*(f"_number_{c}" for c in number), *(f"_by_{c}" for c in by), "_row", "_len", "_cut")
    if cut is None:
        out = back(placed.withColumnRenamed("_at_len", "chunk_start"))
        return out.withColumn("chunk", F.floor(F.col("chunk_start") / budget).cast("bigint"))
    # offsets inside a stretch between cuts: one narrow row per stretch says where it starts
    groups = [f"_by_{c}" for c in by]
    starts = placed.groupBy(*groups, "_at_cut").agg(F.min("_at_len").alias("_from")).select(*(F.col(g).alias(f"{g}_") for g in groups), F.col("_at_cut").alias("_at_cut_"), "_from")
    placed = placed.join(starts, [*(F.col(g).eqNullSafe(F.col(f"{g}_")) for g in groups), F.col("_at_cut") == F.col("_at_cut_")])
    out = back(placed.withColumn("chunk_start", F.col("_at_len") - F.col("_from")).drop("_at_len", "_from", "_at_cut_", *(f"{g}_" for g in groups)))
    part = F.floor(F.col("chunk_start") / budget).cast("bigint")
    return out.withColumn("chunk", F.format_string("%020d.%010d", F.col("_at_cut"), part)).drop("_at_cut")


def join_texts(df: DataFrame, by, order, text: str, max_chars: int,
               partitions: int | None = None, max_groups: int | None = None) -> DataFrame:
    """A5 (re-aimed for any size): texts joined with ',' (NULL as '') per
    ``(group, chunk)``, in ``order``.  Each output row is bounded by
    ``max_chars`` plus one text, separators included."""
    by, order = list(by), list(order)
    ch = assign_chunks(df, by, order, text, max_chars, partitions, max_groups)
    item = F.struct(*[F.col(c) for c in order], F.coalesce(F.col(text), F.lit("")).alias("_t"))
    g = ch.groupBy(*by, "chunk").agg(F.count(F.lit(1)).alias("n_items"),
                                     F.array_sort(F.collect_list(item)).alias("_items"))
    return g.select(*by, "chunk", "n_items",
                    F.array_join(F.transform("_items", lambda x: x["_t"]), ",").alias("text"))


def group_bound(by) -> int | None:
    """Upper bound on the number of groups for keys with a known domain:
    channels are the canonical five, sentiments are tag names (resolve_tags
    keeps no other).  None for any other key."""
    size = {"channel": len(C.CHANNELS), "sentiment": len(C.TAGS)}
    if not set(by) <= set(size):
        return None
    out = 1
    for k in by:
        out *= size[k]
    return out


def join_bodies(tickets: DataFrame, by=("channel", "sentiment"),
                max_chars: int = C.SUMMARY_CHUNK_CHARS) -> DataFrame:
    """A5: ticket bodies per group, comma-joined in ticket order, chunked.
    Groups are channel x sentiment tag: at most channels x tag names."""
    return join_texts(tickets, by, ("ticket_id", "body"), "body", max_chars, max_groups=group_bound(by))


#: Items that a chunk of the summary tree holds on average, where its budget lets it.
FAN = 16


def ends_chunk(item: Column, level: int, fan: int = FAN) -> Column:
    """Whether an item ends a chunk of ``level``, by a hash of its id alone: one in
    ``fan`` does, whatever stands around it."""
    digest = F.md5(F.concat(F.lit(f"{level}:"), item))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % fan == 0


def summarise(tickets: DataFrame, completer: Completer, by=("channel", "sentiment"),
              max_chars: int = C.SUMMARY_CHUNK_CHARS, partitions: int | None = None, fan: int = FAN,
              store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Hierarchical corpus summary per group.

    Level 0 chunks the ticket bodies; every chunk becomes one summary prompt and
    one completion.  A group with one chunk is finished and leaves; the summaries
    of the others (as JSON text) are chunked and summarised again.

    Where a chunk ends is decided by its items: one in ``fan`` ends a chunk, by a
    hash of its ticket id (of the last ticket of a summary's chunk, further up).
    A chunk is also cut at ``max_chars``.  So a ticket more or less changes the
    prompt of one chunk of each level, and with a completions ``store`` (see
    ``annotate``) a second run asks for these alone.  The last call of a group
    states its channel's positive share; calls below state that of their own
    tickets, which other tickets don't change.

    A level above 0 that gives a group no fewer chunks than items entered it
    (answers longer than ``max_chars``) doubles the budget of that group, so every
    text is read and every group ends.  ``n_chunks`` counts the chunks of level
    0, ``n_failed`` the failed calls of all levels; a group none of whose chunks
    was answered has NULL fields.  Returns (summary per group, dead letters).
    """
    by = list(by)
    max_groups = group_bound(by)
    pct_by = [c for c in by if c == "channel"]
    # one row per channel; written once instead of re-aggregating the tickets every level
    pct = materialize(sentiment_pct(tickets, by=pct_by).select(*pct_by, "positive_pct"), "summary-pct")
    share = bounded_broadcast(pct if pct_by else pct.withColumn("_k", F.lit(1)), known_rows=len(C.CHANNELS))
    fields = ["customer_likings", "customer_pain_points", "focus", "actions"]
    items = tickets.select(*by, F.col("ticket_id").alias("_ord"), F.col("ticket_id").alias("_id"), F.col("body").alias("_text"), F.lit(max_chars).cast("bigint").alias("_budget"),
                           _has_tag(tag_id("Positive")).cast("bigint").alias("_pos"), _has_tag(tag_id("Negative")).cast("bigint").alias("_neg"))
    finished, deads, calls = [], [], []
    level = 0
    while True:
        placed = assign_chunks(items, by, ["_ord"], "_text", F.col("_budget"), partitions, max_groups, ends_chunk(F.col("_id"), level, fan), unique=level > 0)
        texts = F.transform(F.array_sort(F.collect_list(F.struct("_ord", F.coalesce("_text", F.lit("")).alias("t")))), lambda x: x["t"])
        chunks = materialize(placed.groupBy(*by, "chunk").agg(
            F.count(F.lit(1)).alias("n_items"), F.max("_id").alias("_id"), F.max("_budget").alias("_budget"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"),
            F.array_join(texts, ",").alias("text")), f"summary-chunks{level}")
        sizes = chunks.groupBy(*by).agg(F.count(F.lit(1)).alias("_asked"), F.sum("n_items").alias("_entered"))
        here = _beside(chunks, bounded_broadcast(sizes, known_rows=max_groups) if max_groups else sizes, by)
        here = here.join(share, pct_by, "left") if pct_by else here.withColumn("_k", F.lit(1)).join(share, "_k", "left").drop("_k")
        own = pct_expr(F.col("_pos"), F.col("_pos") + F.col("_neg"))
        here = here.withColumn("chunk_key", F.concat_ws("|", *[F.col(c) for c in by], F.lit(str(level)), F.col("chunk")))
        prompts = render_summary_prompt(here, F.when(F.col("_asked") == 1, F.col("positive_pct")).otherwise(own), text="text")
        prompts = prompts.withColumn("prompt_key", F.sha2(F.col("prompt"), 256)).drop("text", "positive_pct")
        answered = annotate(prompts, completer, partitions=partitions, store=store)
        parsed, dead = parse_summary(answered.drop("completion", "prompt_key"), key="chunk_key")
        parsed = materialize(parsed, f"summary-level{level}")       # one row per answered chunk; cuts lineage
        deads.append(dead)
        answers = parsed.groupBy(*by).agg(F.count(F.lit(1)).alias("_answers"))
        state = materialize(_beside(sizes, answers, by, "left").select(*by, "_asked", "_entered", F.coalesce("_answers", F.lit(0)).alias("_answers"), F.lit(level).alias("_level")),
                            f"summary-state{level}")
        calls.append(state)
        done = _beside(parsed.drop("_asked", "_entered"), state.where("_answers = 1"), by)
        finished.append(done.select(*by, *fields).withColumn("levels", F.lit(level + 1)))
        more = state.where("_answers > 1")
        if not more.limit(1).count():
            break
        stuck = F.lit(level > 0) & (F.col("_asked") >= F.col("_entered"))
        items = _beside(parsed.drop("_asked", "_entered"), more, by).select(
            *by, F.col("chunk").alias("_ord"), "_id", F.to_json(F.struct(*fields)).alias("_text"),
            F.when(stuck, F.col("_budget") * 2).otherwise(F.col("_budget")).alias("_budget"), "_pos", "_neg")
        level += 1
    # every group, with what its calls came to; a group without any answer keeps its row
    totals = union_all(*calls).groupBy(*by).agg(
        F.max(F.when(F.col("_level") == 0, F.col("_asked"))).alias("n_chunks"), F.sum(F.col("_asked") - F.col("_answers")).alias("n_failed"),
        (F.max("_level") + 1).alias("_levels"))
    out = _beside(totals, union_all(*finished), by, "left").select(
        *by, *fields, F.coalesce("levels", "_levels").cast("int").alias("levels"), "n_chunks", "n_failed")
    return out, union_all(*deads)


def _beside(rows: DataFrame, groups: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with their group's row of ``groups`` (null keys equal)."""
    right = groups.select(*(F.col(c).alias(f"_by_{c}") for c in by), *(c for c in groups.columns if c not in by))
    return rows.join(right, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by], how).drop(*(f"_by_{c}" for c in by))
