"""Text rendering (R1–R12): titles, bodies, prompts, chat messages.

Every renderer is one ``concat`` of literals and columns; absent values print
as 'undefined' like the template literals they reproduce.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide.functions.text import UNDEFINED, spaces, sql_str, tmpl


class Sql(str):
    """A SQL expression (plain strings name columns)."""


def _by_channel(values: dict[str, str]) -> Column:
    return F.expr("CASE channel " + " ".join(f"WHEN {sql_str(ch)} THEN {v}" for ch, v in values.items()) + " END")


def title_expr() -> Column:
    """The channel's title template filled with its first non-empty
    identifying field."""
    key = {
        "social": "coalesce(nullif(url, ''), review_id)",
        "appstore": "coalesce(nullif(title, ''), url)",
        "product": "review_id",
        "business": "author",
        "domain": "title",
    }
    return _by_channel({c: template_sql(C.TITLE_TEMPLATE[c], {"key": Sql(k)}) for c, k in key.items()})


def body_expr(text: str = "text", description: str = "description") -> Column:
    """The body template with the channel's two indents."""
    return _by_channel({
        c: template_sql(C.BODY_TEMPLATE, {"text": text, "description": description,
                                          "indent_a": Sql(sql_str(spaces(a))), "indent_b": Sql(sql_str(spaces(b)))})
        for c, (a, b) in C.BODY_INDENTS.items()
    })


def _cut(template: str) -> list[tuple[str, bool]]:
    """The template's pieces, cut once on the driver, so inserted values are never
    searched for placeholders: (text, False) and (name, True)."""
    parts: list[tuple[str, bool]] = []
    lit: list[str] = []
    for m in re.finditer(r"\{\{|\}\}|\{(\w+)\}|[^{}]+|[{}]", template):
        tok, name = m.group(0), m.group(1)
        if name is None:
            lit.append({"{{": "{", "}}": "}"}.get(tok, tok))
            continue
        if lit:
            parts.append(("".join(lit), False))
            lit = []
        parts.append((name, True))
    if lit:
        parts.append(("".join(lit), False))
    return parts


def template_sql(template: str, cols: dict[str, str], js_print: bool = True) -> str:
    """``template_expr`` as SQL text, one call to build whatever its length."""
    def value(name: str) -> str:
        v = cols[name] if isinstance(cols[name], Sql) else f"`{cols[name]}`"
        return f"coalesce(CAST({v} AS STRING), {sql_str(UNDEFINED)})" if js_print else v
    return "concat(" + ", ".join(value(p) if named else sql_str(p) for p, named in _cut(template)) + ")"


def template_expr(template: str, cols: dict[str, Column | str], js_print: bool = True) -> Column:
    """Fill ``{name}`` placeholders of a fixed template with columns
    (``{{`` and ``}}`` stand for literal braces)."""
    if not any(isinstance(v, Column) for v in cols.values()):
        return F.expr(template_sql(template, cols, js_print))
    parts = []
    for p, named in _cut(template):
        v = cols[p] if named else F.lit(p)
        v = F.expr(v) if isinstance(v, Sql) else F.col(v) if isinstance(v, str) else v
        parts.append(tmpl(v) if named and js_print else v)
    return F.concat(*parts)


def render_prompt(reviews: DataFrame, company: Column | str = "company",
                  template: str = "default") -> DataFrame:
    """The annotation prompt per review plus ``prompt_key`` (sha256),
    the key used to infer each distinct prompt once."""
    t = {"default": C.ANNOTATION_PROMPT, "product_alt": C.PRODUCT_ALT_PROMPT}[template]
    prompt = template_expr(t, {"company": company, "review": "text"})
    return (reviews.withColumn("prompt", prompt)
                   .withColumn("prompt_key", F.sha2(F.col("prompt"), 256)))


def render_chat(df: DataFrame, system: str, human: str, cols: dict[str, Column | str]) -> DataFrame:
    """System + human chat messages with named variables filled from columns."""
    return df.withColumn("messages", F.array(
        F.struct(F.lit("system").alias("role"), template_expr(system, cols).alias("content")),
        F.struct(F.lit("human").alias("role"), template_expr(human, cols).alias("content")),
    ))


def js_number(c: Column) -> Column:
    """A double of a percentage as a JS template prints it: integral values
    without '.0', NaN as 'NaN', 0.000001 and more as plain decimals, below that
    with a lower-case exponent."""
    text = c.cast("string")
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E-", -1).try_cast("int")
    plain = F.concat(F.lit("0."), F.repeat(F.lit("0"), power - 1), F.regexp_replace(mantissa, r"\.", ""))
    return (F.when(F.isnan(c), F.lit("NaN"))
             .when(c == F.floor(c), F.floor(c).cast("string"))
             .when(~text.contains("E"), text)
             .when(F.abs(c) >= 1e-6, plain)
             .otherwise(F.concat(mantissa, F.lit("e-"), power.cast("string"))))


def render_summary_prompt(chunks: DataFrame, positive_pct: Column, text: str = "text") -> DataFrame:
    """Summary prompt with the positive percentage and the chunk's joined reviews."""
    return chunks.withColumn("prompt", template_expr(
        C.SUMMARY_PROMPT, {"positive_pct": js_number(positive_pct), "reviews": text}))
