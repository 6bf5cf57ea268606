"""Annotation (N1–N14): model, label table or rule table → typed annotations.

Three annotators produce an ``answer`` text per review:

* ``annotate`` (N1): a caller-supplied completer, called in Arrow batches from
  an iterator pandas UDF (client built once per task).  Answers are written
  once (``materialize``) before anything reads them twice.
* ``annotate_labels`` (N14): a join to a table of ready answers.
* ``annotate_rules`` (N12): a token → (field, value, weight, rank) rule table;
  one pass over each text finds all its rule tokens, without a shuffle.

``parse_annotation`` (N2–N9) turns answers into typed columns and dead letters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide import schemas
from voxtide.operators.joins import bounded_broadcast
from voxtide.operators.outcomes import dead_letter
from voxtide.session import materialize, path_exists, scratch_path, ship_package

Completer = Callable[[list[str]], list]


# --------------------------------------------------------------------------- N1
#: A call holds prompts of about ``CALL_TOKENS`` tokens (at ``TOKEN_CHARS``
#: characters each), one at least and ``CALL_SIZE`` at most.
CALL_TOKENS, TOKEN_CHARS, CALL_SIZE = 16_000, 4, 64
#: Prompts per task: a lost task repeats at most so much work.
TASK_SIZE = 2_000


def pack(lengths: list[int], budget: int = CALL_TOKENS * TOKEN_CHARS, most: int = CALL_SIZE) -> list[tuple[int, int]]:
    """Consecutive prompts of the given lengths packed into calls: (first, end).
    A call ends before the prompt that would take it over ``budget`` characters or
    ``most`` prompts; a longer prompt goes alone."""
    calls, first, size = [], 0, 0
    for i, n in enumerate(lengths):
        if i > first and (size + n > budget or i - first == most):
            calls.append((first, i))
            first, size = i, 0
        size += n
    return [*calls, (first, len(lengths))] if lengths else []


def _call(completer: Completer, prompts: list) -> list[tuple]:
    """(completion, error) per prompt.  A call that raises, or that returns
    another number of answers, is repeated prompt by prompt, so one bad prompt
    costs only its own answer and keeps its message."""
    try:
        out = list(completer(prompts))
        if len(out) != len(prompts):
            raise ValueError(f"{len(out)} answers for {len(prompts)} prompts")
        return [(a, None if a is not None else "no completion") for a in out]
    except Exception as e:  # one failing call must not fail the job
        if len(prompts) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        return [r for p in prompts for r in _call(completer, [p])]


def completion_udf(completer: Completer):
    """Iterator pandas UDF around ``completer``: struct of completion and error.

    A NULL completion is routed to dead letters by ``parse_annotation``, with its
    error as message.  Marked non-deterministic so the optimizer never
    duplicates or re-orders the call.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for prompts in batches:
            texts = [None if p is None else str(p) for p in prompts.tolist()]
            rows = [r for a, b in pack([len(t or "") for t in texts]) for r in _call(completer, texts[a:b])]
            yield pd.DataFrame(rows, columns=["completion", "error"], dtype=object)

    return F.pandas_udf(run, "completion string, error string").asNondeterministic()


def request_udf(send: Callable[[list[dict]], list], params: dict | None = None):
    """``completion_udf`` over a client ``send(requests) -> completions`` and the
    columns prompt and model: each request holds its row's model, the settings of
    the original jobs (``params`` overrides them) and the prompt."""
    settings = {**C.INFERENCE_PARAMS, **(params or {})}

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for prompts, models in batches:
            requests = [{**settings, "model": m if isinstance(m, str) else C.DEFAULT_MODEL, "prompt": None if p is None else str(p)} for p, m in zip(prompts.tolist(), models.tolist())]
            rows = [r for a, b in pack([len(q["prompt"] or "") for q in requests]) for r in _call(send, requests[a:b])]
            yield pd.DataFrame(rows, columns=["completion", "error"], dtype=object)

    return F.pandas_udf(run, "completion string, error string").asNondeterministic()


#: Error of a prompt that only the store was asked for, and that it doesn't hold.
NOT_STORED = "no stored answer"


def request_completer(send: Callable[[list[dict]], list], model: str = C.DEFAULT_MODEL, params: dict | None = None) -> Completer:
    """A completer over a client ``send(requests) -> completions`` where all
    prompts go to one ``model`` (see ``request_udf`` for a model per row)."""
    settings = {**C.INFERENCE_PARAMS, **(params or {}), "model": model}

    def complete(prompts: list) -> list:
        return send([{**settings, "prompt": p} for p in prompts])
    return complete


def annotate(prompts: DataFrame, completer: Completer | None = None, partitions: int | None = None,
             prompt_col: str = "prompt", persist: bool = True, store: str | None = None,
             send: Callable[[list[dict]], list] | None = None, bucket_size: int | None = None) -> DataFrame:
    """One completion per distinct prompt, joined back to every row.

    Distinct prompts are inferred once (``prompt_key``, deduplicated map-side
    first); ``partitions`` sets the request parallelism (default: tasks of about
    ``TASK_SIZE`` prompts).  With ``send`` instead of ``completer``, requests carry
    the model in the rows' column ``llm_model``, and the key is that of prompt and
    model.  The answers are materialised so retries and later readers see the same
    text.

    With ``store`` (a completions table ``prompt_key, completion``), prompts already
    answered there are skipped (left anti join); the others are dealt over buckets
    of about ``bucket_size`` prompts (default: what all cores of the cluster take in
    one round), and each bucket's answers are appended as soon as it ends, so a run
    that is killed loses one bucket at most and the next run goes on behind it.
    Failures are never stored, so the next run tries them again, and two runs that
    stored the same key count once.  Without ``completer`` and ``send`` only the
    store answers: a prompt that it doesn't hold has the error ``NOT_STORED``.  The
    completion envelope is kept in ``completion``, a failed call's message in
    ``error``; ``answer`` is ``choices[0].text``.
    """
    spark = prompts.sparkSession
    ship_package(spark)
    keyed = prompts if "prompt_key" in prompts.columns else prompts.withColumn(
        "prompt_key", F.sha2(F.col(prompt_col), 256))
    asked = [prompt_col]
    if send is not None:
        asked.append("llm_model")
        keyed = keyed.withColumn("prompt_key", F.sha2(F.concat_ws("|", "prompt_key", "llm_model"), 256))
    if completer is None and send is None:
        if not store:
            raise ValueError("give a completer, send or store")
        have = _read_store(spark, store)
        told = keyed.drop(prompt_col)
        told = told.withColumn("completion", F.lit(None).cast("string")) if have is None else told.join(have, "prompt_key", "left")
        return (told.withColumn("error", F.when(F.col("completion").isNull(), F.lit(NOT_STORED)))
                .withColumn("answer", parse_completion(F.col("completion"))))
    distinct = keyed.select("prompt_key", *asked).dropDuplicates(["prompt_key"])
    reply = (completion_udf(completer)(F.col(prompt_col)) if send is None else request_udf(send)(*map(F.col, asked))).alias("_c")

    def infer(some: DataFrame, n: int) -> DataFrame:
        # Model calls are slow per row but small in bytes, so AQE would coalesce
        # them into a few tasks; an explicit repartition by the number of prompts
        # fixes the call parallelism.
        return some.repartition(partitions or max(spark.sparkContext.defaultParallelism, -(-n // TASK_SIZE)), "prompt_key").select("prompt_key", reply).select("prompt_key", "_c.*")

    if not store:
        done = infer(distinct, keyed.count())
        done = materialize(done, "completions") if persist else done
    else:
        have = _read_store(spark, store)
        todo = distinct if have is None else distinct.join(have.select("prompt_key"), "prompt_key", "left_anti")
        todo = materialize(todo, "prompts-asked")
        n = todo.count()
        size = bucket_size or TASK_SIZE * spark.sparkContext.defaultParallelism
        buckets = -(-n // size)
        if buckets:
            todo = materialize(todo.withColumn("bucket", F.pmod(F.xxhash64("prompt_key"), F.lit(buckets)).cast("int")), "prompt-buckets", ["bucket"])
        run = scratch_path(spark, "completions")
        for b in range(buckets):
            part = f"{run}/bucket={b}"
            infer(todo.where(F.col("bucket") == b), size).write.parquet(part)
            spark.read.parquet(part).where("completion is not null").write.mode("append").parquet(store)
        have = _read_store(spark, store)
        empty = spark.createDataFrame([], "prompt_key string, completion string, error string")
        done = empty if have is None else have.withColumn("error", F.lit(None).cast("string"))
        if buckets:
            done = done.unionByName(spark.read.parquet(run).where("completion is null").select("prompt_key", "completion", "error"))
    # only the key and the answers meet the rows again; the prompt stays where it is
    out = keyed.drop(prompt_col).join(done, "prompt_key", "left")
    return out.withColumn("answer", parse_completion(F.col("completion")))


def store_answers(prompts: DataFrame, answers: DataFrame, store: str, key: str = "doc_id") -> None:
    """Puts ready answers (``key``, ``answer``) into a completions store, each in a
    completion envelope under the key of its prompt, so that ``annotate`` asks a
    model for the other prompts only.  Prompts that several rows share take the
    answer of the smallest ``key``: one partial aggregate a prompt, no group is
    gathered.  Null answers aren't stored."""
    said = prompts.select("prompt_key", key).join(answers.where("answer is not null").select(key, "answer"), key)
    first = said.groupBy("prompt_key").agg(F.min(F.struct(key, "answer"))["answer"].alias("text"))
    envelope = F.to_json(F.struct(F.array(F.struct("text")).alias("choices")))
    first.select("prompt_key", envelope.alias("completion")).write.mode("append").parquet(store)


def _read_store(spark, path: str):
    """The stored answers, one per prompt (runs at the same time may both have stored one)."""
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).where("completion is not null").groupBy("prompt_key").agg(F.min("completion").alias("completion"))


def parse_completion(c):
    """``choices[0].text`` of a completion envelope (NULL-safe)."""
    return F.get(F.from_json(c, schemas.COMPLETION)["choices"], 0)["text"]


# -------------------------------------------------------------------------- N14
def annotate_labels(reviews: DataFrame, answers: DataFrame, key: str | list[str] = "doc_id") -> DataFrame:
    """Attach ready answers by key (left equi-join; both sides are
    hash-partitioned on the unique key, so no group is hot).  A review without
    an answer keeps its row and becomes a ``no_answer`` dead letter."""
    return reviews.join(answers, key, "left")


# -------------------------------------------------------------------------- N12
#: Text bytes that a task looks through at once.
SCAN_BYTES = 4 << 20


class RuleTable:
    """Rules (token, field, value, weight, rank) by token: a hashed dictionary of
    the tokens, and each token's rules as (value number, weight, rank)."""

    def __init__(self, rules: list[tuple], fields: tuple):
        self.values = sorted({(fields.index(f), v) for _, f, v, _, _ in rules if f in fields})
        slot = {fv: i for i, fv in enumerate(self.values)}
        mine = [(t, slot[fields.index(f), v], float(w), r) for t, f, v, w, r in rules if f in fields]
        self.tokens = sorted({m[0] for m in mine})
        place = {t: i for i, t in enumerate(self.tokens)}
        mine.sort(key=lambda m: place[m[0]])        # stable: the rules of a token stay in their order
        self.first = np.searchsorted([place[m[0]] for m in mine], np.arange(len(self.tokens) + 1))
        self.slot, self.weight, self.rank = (np.array([m[i] for m in mine], k) for i, k in ((1, np.int64), (2, float), (3, np.int64)))
        self.field = np.array([f for f, _ in self.values], np.int64)
        self.n_fields = len(fields)

    def best(self, off: np.ndarray, buf: np.ndarray) -> tuple[np.ndarray, list[list]]:
        """(texts with a hit, per field their best values) of lower-cased texts,
        given as bytes and offsets.  One pass finds the letter runs, one hashed
        lookup the rule tokens among them; what follows costs only per hit."""
        letter = (buf >= 97) & (buf <= 122)
        edge = np.zeros(len(buf) + 1, bool)
        edge[1:-1] = letter[1:] != letter[:-1]
        edge[off] = True
        cut = np.flatnonzero(edge)
        run = letter[cut[:-1]] if len(cut) > 1 else np.zeros(0, bool)
        starts, ends = cut[:-1][run], cut[1:][run]
        ends_at = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends_at), pa.py_buffer(buf[letter]))
        found = pc.index_in(words, value_set=pa.array(self.tokens, pa.large_string())).fill_null(-1).to_numpy(zero_copy_only=False)
        hit = found >= 0
        text = np.searchsorted(off, starts[hit], "right") - 1
        met, times = np.unique(text * len(self.tokens) + found[hit], return_counts=True)
        text, token = met // max(1, len(self.tokens)), met % max(1, len(self.tokens))
        # the rules of each met token, then scores per text and value
        n = self.first[token + 1] - self.first[token]
        rule = np.repeat(self.first[token] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        key = np.repeat(text, n) * len(self.values) + self.slot[rule]
        order = np.argsort(key, kind="stable")
        cells, at = np.unique(key[order], return_index=True)
        score = np.add.reduceat((np.repeat(times, n) * self.weight[rule])[order], at) if len(at) else np.zeros(0)
        rank = np.minimum.reduceat(self.rank[rule][order], at) if len(at) else np.zeros(0, np.int64)
        text, slot = cells // max(1, len(self.values)), cells % max(1, len(self.values))
        # per text and field: highest score, then lowest rank, then last value
        order = np.lexsort((-slot, rank, -score, self.field[slot], text)) if len(cells) else np.zeros(0, np.int64)
        text, slot = text[order], slot[order]
        field = self.field[slot] if len(slot) else np.zeros(0, np.int64)
        top = np.ones(len(text), bool)
        top[1:] = (text[1:] != text[:-1]) | (field[1:] != field[:-1])
        rows, back = np.unique(text[top], return_inverse=True)
        out = [[None] * len(rows) for _ in range(self.n_fields)]
        for i, f, v in zip(back.tolist(), field[top].tolist(), slot[top].tolist()):
            out[f][i] = self.values[v][1]
        return rows, out


def annotate_rules(reviews: DataFrame, rules: list[tuple], keys=("channel", "review_id"),
                   fields=("Sentiments", "Category", "Severity")) -> DataFrame:
    """Deterministic rule annotator, one row per review with a hit.

    Lower-cased text is split on non-letters; the scores of ``rules`` (token,
    field, value, weight, rank) are summed per field and value and the best value
    per field wins (highest score, then lowest rank).  Each text is looked
    through once, whatever the number of rules (``RuleTable``): no explode, no
    join, no shuffle, and equal ids of different channels stay apart.
    """
    ship_package(reviews.sparkSession)
    table, keys, fields = RuleTable(rules, tuple(fields)), list(keys), list(fields)
    kept = reviews.select(*keys, F.lower(F.col("text")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keys)).cast(pa.large_string()).fill_null("")
            off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
            data = texts.buffers()[2]
            raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(off, off[at] + SCAN_BYTES, "right")) - 1)
                rows, best = table.best(off[at:to + 1] - off[at], raw[off[at]:off[to]])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(rows + at)) for i in range(len(keys))), *(pa.array(b, pa.string()) for b in best)], [*keys, *fields])
                at = to

    kinds = ", ".join([*(f"`{c}` {kind}" for c, kind in kept.select(*keys).dtypes), *(f"`{f}` string" for f in fields)])
    return kept.mapInArrow(run, kinds)


def rules_answer(annotated: DataFrame, fields=("Sentiments", "Category", "Severity")) -> DataFrame:
    """Rule-annotator output as an answer text, so it flows through ``parse_annotation``."""
    return annotated.withColumn("answer", F.to_json(F.struct(*[F.col(f) for f in fields])))


# ------------------------------------------------------------------------ N2–N9
#: The typed columns of a parsed answer ``_a``.
TYPED = ("try_cast(_a.Relevance AS BOOLEAN) AS relevance", "_a.Sentiments AS sentiment", "_a.Category AS category", "_a.sub_category AS sub_category",
         "_a.Severity AS severity", "_a.Feature AS feature", "_a.insight AS insight", "_a.description AS description", "_a.response AS response",
         "_a.review AS review_clean")


def parse_annotation(df: DataFrame, answer: str = "answer", key: str = "review_id",
                     missing: str = "inference_failed") -> tuple[DataFrame, DataFrame]:
    """Parse answer text into typed columns.

    A missing answer has the reason ``missing`` (``no_answer`` for ready answers),
    and as message a model call's ``error`` where the row carries one.

    All ten fields are read as STRING (a typed field would flag the whole row
    on one bad value), then typed: relevance by ``try_cast``.  Rows whose
    answer is missing, not a JSON object, or truncated go to dead letters.
    Returns (annotations, dead letters).
    """
    parsed = df.withColumn("_a", F.from_json(
        F.col(answer), schemas.ANNOTATION,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    ok = (F.col(answer).isNotNull() & F.col("_a").isNotNull() & F.col("_a._corrupt").isNull()
          & F.ltrim(F.col(answer)).startswith("{"))
    good = parsed.where(ok)
    bad = parsed.where(~ok)
    reason = F.when(F.col(answer).isNull(), F.lit(missing)).otherwise(F.lit("malformed_answer"))
    dead = dead_letter(bad, "annotate", F.col(key), reason, F.col(answer), F.col("error") if "error" in df.columns else None)
    typed = good.select(*[c for c in df.columns if c not in (answer, "error")], *map(F.expr, TYPED))
    return typed, dead


def normalise_severity(annotations: DataFrame) -> DataFrame:
    """Keep the raw severity; add ``severity_norm`` (lower, trimmed)."""
    return annotations.withColumn("severity_norm", F.lower(F.trim(F.col("severity"))))


def check_sub_category(annotations: DataFrame, rules: DataFrame) -> DataFrame:
    """Flag whether the sub-category is one the prompt allows for the
    category (praise takes any non-empty text).  Never drops rows."""
    r = bounded_broadcast(rules.select("category", "sub_category", F.lit(True).alias("_ok")))
    j = annotations.join(r, ["category", "sub_category"], "left")
    valid = (F.coalesce(F.col("_ok"), F.lit(False))
             | ((F.col("category") == C.FREE_TEXT_SUB_CATEGORY)
                & F.coalesce(F.length(F.trim(F.col("sub_category"))) > 0, F.lit(False))))
    return j.withColumn("sub_category_valid", valid).drop("_ok")


# -------------------------------------------------------------------------- N13
def parse_summary(df: DataFrame, answer: str = "answer", key: str = "chunk_key"
                  ) -> tuple[DataFrame, DataFrame]:
    """The four summary fields as STRING; a field that came back as a
    JSON array is printed comma-joined."""
    parsed = df.withColumn("_s", F.from_json(
        F.col(answer), schemas.SUMMARY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    ok = F.col(answer).isNotNull() & F.col("_s").isNotNull() & F.col("_s._corrupt").isNull()
    good, bad = parsed.where(ok), parsed.where(~ok)
    reason = F.when(F.col(answer).isNull(), F.lit("inference_failed")).otherwise(F.lit("malformed_answer"))
    dead = dead_letter(bad, "summary", F.col(key), reason, F.col(answer), F.col("error") if "error" in df.columns else None)

    def flat(f):
        v = F.col(f"_s.{f}")
        arr = F.from_json(v, "ARRAY<STRING>")
        return F.when(F.ltrim(v).startswith("["), F.array_join(arr, ",", "")).otherwise(v).alias(f)

    keep = [c for c in df.columns if c not in (answer, "error")]
    return good.select(*keep, *[flat(f) for f in schemas.SUMMARY_FIELDS]), dead
