"""Landed source payloads → canonical reviews.

Remote fetches are replaced by landed response pages: a table
``raw(channel STRING, page BIGINT, payload STRING)`` with one JSON response per
row.  Each reader parses with an explicit schema (no inference), explodes the
channel's envelope array and maps the channel's fields onto the canonical
review columns.  Pages whose envelope is missing or unparseable go to dead
letters instead of ending the run.  Everything is narrow (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide import schemas
from voxtide.operators.outcomes import dead_letter

_CANON = schemas.REVIEW_COLUMNS


def _envelope_schema(channel: str) -> str:
    return f"STRUCT<{C.ENVELOPE[channel]}: ARRAY<STRUCT<{schemas.PAYLOAD_ITEM[channel]}>>, _corrupt: STRING>"


def _unwrap(raw: DataFrame, channel: str) -> tuple[DataFrame, DataFrame]:
    """Parse one channel's pages; return (exploded items, dead letters)."""
    key = C.ENVELOPE[channel]
    parsed = (raw.where(F.col("channel") == channel)
                 .select("channel", "page", "payload",
                         F.from_json("payload", _envelope_schema(channel),
                                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("p")))
    items = parsed.where(F.col(f"p.{key}").isNotNull())
    bad = parsed.where(F.col(f"p.{key}").isNull())
    dead = dead_letter(
        bad, "source",
        F.concat_ws(":", F.col("channel"), F.col("page").cast("string")),
        F.when(F.col("p").isNull() | F.col("p._corrupt").isNotNull(), F.lit("malformed_payload"))
         .otherwise(F.lit("missing_envelope")),
        F.col("payload"),
    )
    exploded = items.select("channel", "page", F.explode(f"p.{key}").alias("r"))
    empty = dead_letter(exploded.where("r is null"), "source", F.concat_ws(":", F.col("channel"), F.col("page").cast("string")),
                        "null_item", F.lit(None))
    return exploded.where("r is not null"), dead.unionByName(empty)


def _canon(df: DataFrame, **cols) -> DataFrame:
    out = []
    for name in _CANON:
        if name in ("channel", "page"):
            out.append(F.col(name))
        elif name in cols:
            out.append(cols[name].alias(name))
        else:
            out.append(F.lit(None).cast("bigint" if name == "rating" else "string").alias(name))
    return df.select(*out)


def read_social(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelope ``results``; key ``tweet_id``, link ``expanded_url``."""
    x, dead = _unwrap(raw, "social")
    return _canon(x, review_id=F.col("r.tweet_id"), url=F.col("r.expanded_url"),
                  text=F.col("r.text")), dead


def read_appstore(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelope ``data``; id, title, url, text, rating.  A rating that is not a
    whole number leaves the review without one, and a dead letter ``bad_rating``."""
    x, dead = _unwrap(raw, "appstore")
    rating = F.col("r.rating").try_cast("bigint")
    return _canon(x, review_id=F.col("r.id"), title=F.col("r.title"), url=F.col("r.url"),
                  text=F.col("r.text"), rating=rating), dead.unionByName(_bad_ratings(x, F.col("r.id"), F.col("r.rating")))


def read_product(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3: envelope ``initial_reviews``; review_id, review_content."""
    x, dead = _unwrap(raw, "product")
    return _canon(x, review_id=F.col("r.review_id"), text=F.col("r.review_content")), dead


def read_business(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelope ``reviews``; author, comment.  No id in the payload:
    key = sha256 of ``author|comment`` (equal reviews share a key)."""
    x, dead = _unwrap(raw, "business")
    key = F.expr(_content_key("author", "comment"))
    return _canon(x, review_id=key, author=F.col("r.author"), text=F.col("r.comment")), dead


def read_domain(raw: DataFrame, pages: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Envelope ``reviews``; title, text; key = sha256 of ``title|text``.
    ``pages`` restricts to the given landed pages (the original fetched page 1)."""
    if pages is not None:
        raw = raw.where(F.col("page").isin(pages))
    x, dead = _unwrap(raw, "domain")
    key = F.expr(_content_key("title", "text"))
    return _canon(x, review_id=key, title=F.col("r.title"), text=F.col("r.text")), dead


def _bad_ratings(rows: DataFrame, review_id, rating) -> DataFrame:
    bad = rows.where(rating.isNotNull() & rating.try_cast("bigint").isNull())
    return dead_letter(bad, "source", review_id, "bad_rating", rating)


READERS = {
    "social": read_social,
    "appstore": read_appstore,
    "product": read_product,
    "business": read_business,
    "domain": read_domain,
}


def _content_key(a: str, b: str) -> str:
    """SHA-256 of ``a|b``; a NULL first part is left out, a NULL second part is
    marked, so (NULL, x) and (x, NULL) differ; NULL where both are missing."""
    return (f"CASE WHEN r.{a} IS NULL AND r.{b} IS NULL THEN NULL WHEN r.{b} IS NULL THEN sha2(concat(r.{a}, '|', chr(0)), 256) "
            f"ELSE sha2(concat_ws('|', r.{a}, r.{b}), 256) END")


# Canonical review fields per channel, as SQL over one payload item ``r``.
_CANON_SQL = {
    "social": {"review_id": "r.tweet_id", "url": "r.expanded_url", "text": "r.text"},
    "appstore": {"review_id": "r.id", "title": "r.title", "url": "r.url", "text": "r.text", "rating": "try_cast(r.rating AS BIGINT)", "said": "r.rating"},
    "product": {"review_id": "r.review_id", "text": "r.review_content"},
    "business": {"review_id": _content_key("author", "comment"), "author": "r.author",
                 "text": "r.comment"},
    "domain": {"review_id": _content_key("title", "text"), "title": "r.title", "text": "r.text"},
}


def _canon_items_sql(channel: str) -> str:
    """``transform`` of the channel's envelope array into canonical structs
    (one SQL expression: a single call to build, compiled into codegen)."""
    f = _CANON_SQL[channel]
    fields = ", ".join(
        f"'{c}', " + f.get(c, "CAST(NULL AS BIGINT)" if c == "rating" else "CAST(NULL AS STRING)")
        for c in ("review_id", "title", "url", "author", "text", "rating", "said"))
    return f"transform(_p_{channel}.{C.ENVELOPE[channel]}, r -> named_struct({fields}))"


def read_all(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S1–S5, S10, S11 in one pass: every page is parsed with its channel's
    schema, its items mapped to canonical structs and exploded once.  (The
    per-channel readers above would scan the raw table once per channel.)
    Returns (reviews, dead letters)."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    ch = F.col("channel")
    parsed = raw.select("channel", "page", "payload", *[
        F.when(ch == c, F.from_json("payload", _envelope_schema(c), opts)).alias(f"_p_{c}") for c in C.CHANNELS])
    items = F.expr("coalesce(" + ", ".join(_canon_items_sql(c) for c in C.CHANNELS) + ")")
    corrupt = F.coalesce(*[F.col(f"_p_{c}._corrupt") for c in C.CHANNELS])
    known = ch.isin(C.CHANNELS)
    x = parsed.select("channel", "page", "payload", items.alias("_items"), corrupt.alias("_bad"), known.alias("_known"))
    good = x.where(F.col("_items").isNotNull())
    bad = x.where(F.col("_items").isNull())
    reason = (F.when(~F.coalesce(F.col("_known"), F.lit(False)), F.lit("unknown_channel"))
               .when(F.col("_bad").isNotNull(), F.lit("malformed_payload"))
               .otherwise(F.lit("missing_envelope")))
    dead = dead_letter(bad, "source", F.concat_ws(":", F.col("channel"), F.col("page").cast("string")),
                       reason, F.col("payload"))
    rev = good.select("channel", "page", F.explode("_items").alias("r"))
    # a null item gives a struct without id; the readers drop it with a dead letter
    rows = rev.select(*[F.col(c) if c in ("channel", "page") else F.col(f"r.{c}").alias(c) for c in _CANON], F.col("r.said").alias("_said"))
    missing = dead_letter(rows.where("review_id is null"), "source", F.concat_ws(":", F.col("channel"), F.col("page").cast("string")),
                          "missing_id", F.col("text"))
    known_id = rows.where("review_id is not null")
    return known_id.drop("_said"), dead.unionByName(missing).unionByName(_bad_ratings(known_id, F.col("review_id"), F.col("_said")))


# Payload item of a canonical review, as each channel's source sends it (SQL).
_ITEM_SQL = {
    "social": "named_struct('tweet_id', review_id, 'text', text, 'expanded_url', url)",
    "appstore": "named_struct('id', review_id, 'title', title, 'url', url, 'text', text, 'rating', rating)",
    "product": "named_struct('review_id', review_id, 'review_content', text)",
    "business": "named_struct('author', author, 'comment', text)",
    "domain": "named_struct('title', title, 'text', text)",
}


def land_pages(reviews: DataFrame, broken_every: int | None = None) -> DataFrame:
    """Build landed response pages from canonical reviews (test input for S1–S5).

    One page per ``(channel, page)``; a page holds a bounded number of reviews
    (the ``page`` column is assigned upstream), ordered by ``review_id``.  With
    ``broken_every=n``, every page with ``page % n = n-1`` is followed by an
    extra error response without the envelope (page number ``-(page+1)``), so
    the dead-letter path sees data while every review still lands.
    """
    item = "CASE " + " ".join(f"WHEN channel = '{c}' THEN to_json({_ITEM_SQL[c]})" for c in C.CHANNELS) + " END"
    env = "CASE " + " ".join(f"WHEN channel = '{c}' THEN '{C.ENVELOPE[c]}'" for c in C.CHANNELS) + " END"
    rows = reviews.selectExpr("channel", "page", f"named_struct('review_id', review_id, 'j', {item}) AS it")
    pages = rows.groupBy("channel", "page").agg(F.array_sort(F.collect_list("it")).alias("its"))
    real = (f"named_struct('channel', channel, 'page', page, 'payload', "
            f"concat('{{\"', {env}, '\":[', array_join(transform(its, x -> x.j), ','), ']}}'))")
    if not broken_every:
        return pages.selectExpr(f"inline(array({real}))")
    n = int(broken_every)
    error = (f"CASE WHEN page % {n} = {n - 1} THEN named_struct('channel', channel, 'page', -(page + 1), "
             f"'payload', '{{\"error\":\"rate limited\"}}') END")
    # one pass: each page row yields itself and, every n-th page, an error response
    return pages.selectExpr(f"inline(filter(array({real}, {error}), x -> x IS NOT NULL))")
