"""DuckDB SQL for every catalogue query (the correctness oracle).

The SQL re-derives the test views from the driver tables with plain SQL and
computes each query's result independently of Spark.  Fixed strings come from
``voxtide.constants`` so both sides use the same values.
"""

from __future__ import annotations

from voxtide import constants as C
from voxtide.operators import annotate as N
from voxtide.operators import summary as A
from voxtide.plans import catalog as Q
from voxtide.sources import views as V


def s(v: str) -> str:
    """SQL string literal."""
    return "'" + v.replace("'", "''") + "'"


def nl_lit(v: str) -> str:
    """SQL string expression for text that may hold line feeds."""
    parts = v.split("\n")
    out = [s(p) for p in parts]
    return " || chr(10) || ".join(out) if len(out) > 1 else out[0]


def lst(vals) -> str:
    return "[" + ", ".join(s(v) for v in vals) + "]"


def pick(vals, idx: str) -> str:
    return f"({lst(vals)})[({idx}) + 1]"


def inlist(vals) -> str:
    return "(" + ", ".join(s(v) for v in vals) + ")"


def tmpl(e: str) -> str:
    return f"coalesce(CAST({e} AS VARCHAR), 'undefined')"


def by_channel(m: dict[str, str], col: str = "channel") -> str:
    return "CASE " + " ".join(f"WHEN {col} = {s(c)} THEN {v}" for c, v in m.items()) + " END"


def template_sql(template: str, cols: dict[str, str]) -> str:
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(nl_lit(template[pos:m.start()]))
        parts.append(tmpl(cols[m.group(1)]))
        pos = m.end()
    if pos < len(template):
        parts.append(nl_lit(template[pos:]))
    return " || ".join(parts)


TAG_NAMES = [n for n, _ in C.TAGS]

REVIEWS = f"""reviews AS (
  SELECT doc_id,
    {pick(C.CHANNELS, "CAST(substr(source, 4) AS INTEGER) % 5")} AS channel,
    CAST(doc_id AS VARCHAR) AS review_id,
    CASE WHEN doc_id % 4 = 1 THEN NULL WHEN doc_id % 4 = 0 THEN ''
         ELSE 'Review ' || CAST(doc_id AS VARCHAR) END AS title,
    CASE WHEN doc_id % 2 = 1 THEN 'https://example.com/r/' || CAST(doc_id AS VARCHAR) END AS url,
    'user_' || CAST(doc_id % 50 AS VARCHAR) AS author,
    CASE WHEN doc_id % 3 = 0 THEN text || {s(' ' + C.LINK_PREFIX)} || CAST(doc_id AS VARCHAR)
         ELSE text END AS text,
    CAST(1 + n_chars % 5 AS BIGINT) AS rating,
    CAST(n_chars % 97 AS BIGINT) AS score,
    lang,
    CAST(floor(doc_id / {V.PAGE_SIZE}) AS BIGINT) AS page
  FROM documents)"""

CONFIG = "config(channel, company, default_part_id, default_owner_id, llm_model) AS (VALUES " + ", ".join(
    "(" + ", ".join(s(v) for v in row) + ")" for row in C.JOB_CONFIG) + ")"

ANSWERS = f"""answers AS (
  SELECT doc_id,
    (toxic = 0) AS relevance,
    CASE WHEN doc_id % 29 = 0 THEN 'Neutral' WHEN quality = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment,
    {pick(V.ANSWER_CATEGORIES, "doc_id % 9")} AS category,
    {pick(V.ANSWER_SUB_CATEGORIES, "doc_id % 11")} AS sub_category,
    {pick(V.ANSWER_SEVERITIES, "doc_id % 6")} AS severity,
    'feature ' || CAST(doc_id % 7 AS VARCHAR) AS feature,
    'insight for ' || CAST(doc_id AS VARCHAR) AS insight,
    CASE WHEN doc_id % 10 = 7 THEN NULL ELSE 'description of ' || CAST(doc_id AS VARCHAR) END AS description,
    'response to ' || CAST(doc_id AS VARCHAR) AS response,
    'review ' || CAST(doc_id AS VARCHAR) AS review_clean,
    (doc_id % 13 = 0) AS corrupt
  FROM labels)"""

PARSED = """parsed AS (
  SELECT r.*, a.relevance, a.sentiment, a.category, a.sub_category, a.severity, a.feature,
         a.insight, a.description, a.response, a.review_clean,
         lower(trim(a.severity)) AS severity_norm
  FROM reviews r JOIN answers a USING (doc_id) WHERE NOT a.corrupt)"""

RESOLVED = f"""resolved AS (
  SELECT *, category AS category_raw,
    CASE WHEN category IN {inlist(TAG_NAMES)} THEN category ELSE {s(C.FALLBACK_CATEGORY)} END AS category_final
  FROM parsed WHERE sentiment IN {inlist(TAG_NAMES)})"""

_SOCIAL_KEY = "coalesce(nullif(url, ''), review_id)"
_APP_KEY = "coalesce(nullif(title, ''), url)"
_TITLE_KEYS = {"social": _SOCIAL_KEY, "appstore": _APP_KEY, "product": "review_id", "business": "author",
               "domain": "title"}
TITLE = by_channel({c: template_sql(C.TITLE_TEMPLATE[c], {"key": k}) for c, k in _TITLE_KEYS.items()})

BODY = by_channel({
    c: template_sql(C.BODY_TEMPLATE, {"text": "text", "description": "description",
                                      "indent_a": s(" " * a), "indent_b": s(" " * b)})
    for c, (a, b) in C.BODY_INDENTS.items()
})

TICKETS = f"""tickets AS (
  SELECT sha256(channel || '|' || review_id) AS ticket_id, channel, review_id, doc_id, lang,
    {TITLE} AS title,
    'tag/' || category_final || ',' || 'tag/' || sentiment AS tags,
    'tag/' || category_final AS tag_category, 'tag/' || sentiment AS tag_sentiment,
    {BODY} AS body,
    'ticket' AS type,
    'owner/' || channel AS owner, 'part/' || channel AS applies_to_part,
    severity, category_final AS category, sentiment, sub_category, feature, insight, response
  FROM resolved)"""

# Reviews without an answer, with a broken one, or with an unknown sentiment.
DEAD = f"""dead AS (
  SELECT 'annotate' AS stage, r.channel, r.review_id AS key, CASE WHEN a.doc_id IS NULL THEN 'no_answer' ELSE 'malformed_answer' END AS reason
  FROM reviews r LEFT JOIN answers a USING (doc_id) WHERE a.doc_id IS NULL OR a.corrupt
  UNION ALL SELECT 'resolve_tags', channel, review_id, 'unknown_sentiment' FROM parsed WHERE sentiment NOT IN {inlist(TAG_NAMES)})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_(REVIEWS, ANSWERS, PARSED, RESOLVED, TICKETS)


def source_sql(channel: str) -> str:
    m = {
        "social": "review_id, NULL AS title, url, NULL AS author",
        "appstore": "review_id, title, url, NULL AS author",
        "product": "review_id, NULL AS title, NULL AS url, NULL AS author",
        "business": "sha256(concat_ws('|', author, text)) AS review_id, NULL AS title, NULL AS url, author",
        "domain": "sha256(concat_ws('|', title, text)) AS review_id, title, NULL AS url, NULL AS author",
    }[channel]
    rating = "rating" if channel == "appstore" else "CAST(NULL AS BIGINT) AS rating"
    return (with_(REVIEWS) + f"SELECT channel, {m}, md5(text) AS text_md5, length(text) AS text_len, "
            f"{rating}, page FROM reviews WHERE channel = {s(channel)}")


def _pct(p: str, n: str) -> str:
    return f"CASE WHEN {p} + {n} = 0 THEN 'NaN'::DOUBLE ELSE ({p} / ({p} + {n})) * 100.0 END"


def _sent_pct(group: str = "") -> str:
    sel = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    return (f"SELECT {sel}positive, negative, {_pct('CAST(positive AS DOUBLE)', 'negative')} AS positive_pct, "
            f"{_pct('CAST(negative AS DOUBLE)', 'positive')} AS negative_pct FROM ("
            f"SELECT {sel}count(*) FILTER (WHERE tag_category = 'tag/Positive' OR tag_sentiment = 'tag/Positive') "
            f"AS positive, count(*) FILTER (WHERE tag_category = 'tag/Negative' OR tag_sentiment = 'tag/Negative') "
            f"AS negative FROM tickets{{where}}{gb})")


def _chunks(max_chars: int) -> str:
    return f"""chunked AS (
  SELECT channel, sentiment, ticket_id, coalesce(body, '') AS b,
    CAST(floor((sum(length(coalesce(body, '')) + 1) OVER (PARTITION BY channel, sentiment ORDER BY ticket_id, body
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(coalesce(body, '')) - 1) / {max_chars}) AS BIGINT) AS chunk
  FROM tickets),
joined AS (
  SELECT channel, sentiment, chunk, count(*) AS n_items, string_agg(b, ',' ORDER BY ticket_id, b) AS text
  FROM chunked GROUP BY channel, sentiment, chunk)"""


def _summary_levels(by: list[str], levels: int = 6) -> list[str]:
    """The corpus summary with the digest stand-in, ``levels`` levels unrolled:
    ``summary(by, fields, levels, n_chunks, n_failed)``."""
    g = ", ".join(by)
    prompt = template_sql(C.SUMMARY_PROMPT, {"positive_pct": PCT_TEXT, "reviews": "text"})
    tagged = lambda t: f"CAST(tag_category = 'tag/{t}' OR tag_sentiment = 'tag/{t}' AS BIGINT)"
    out = [f"i0 AS (SELECT {g}, ticket_id AS ord, ticket_id AS id, coalesce(body, '') AS b, {tagged('Positive')} AS pos, {tagged('Negative')} AS neg FROM tickets)"]
    for k in range(levels):
        before = f"OVER (PARTITION BY {g} ORDER BY ord, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        out.append(f"""s{k} AS (SELECT *, coalesce(sum(CAST(('0x' || substr(md5('{k}:' || id), 1, 8))::BIGINT % {A.FAN} = 0 AS BIGINT)) {before}, 0) AS seg,
  coalesce(sum(length(b) + 1) {before}, 0) AS start FROM i{k}),
c{k} AS (SELECT *, CAST(floor((start - min(start) OVER (PARTITION BY {g}, seg)) / {Q.SUMMARY_CHARS}) AS BIGINT) AS part FROM s{k}),
t{k} AS (SELECT {g}, seg, part, string_agg(b, ',' ORDER BY ord, b) AS text, max(id) AS id, sum(pos) AS pos, sum(neg) AS neg FROM c{k} GROUP BY {g}, seg, part),
n{k} AS (SELECT *, count(*) OVER (PARTITION BY {g}) AS n FROM t{k}),
p{k} AS (SELECT *, {prompt} AS p FROM (SELECT n{k}.*, CASE WHEN n = 1 THEN pct.positive_pct ELSE {_pct('CAST(pos AS DOUBLE)', 'neg')} END AS positive_pct
  FROM n{k} LEFT JOIN pct USING (channel))),
a{k} AS (SELECT {g}, seg, part, id, pos, neg, CAST(length(p) AS VARCHAR) || ' characters reviewed' AS customer_likings, 'digest ' || substr(md5(p), 1, 12) AS customer_pain_points,
  'topic ' || CAST(length(p) % 7 AS VARCHAR) AS focus, 'action ' || CAST(length(p) % 3 AS VARCHAR) || ',action ' || CAST(length(p) % 5 AS VARCHAR) AS actions, n FROM p{k})""")
        out.append(f"""i{k + 1} AS (SELECT {g}, lpad(CAST(seg AS VARCHAR), 20, '0') || '.' || lpad(CAST(part AS VARCHAR), 10, '0') AS ord, id, '{{"customer_likings":"' || customer_likings || '","customer_pain_points":"'
  || customer_pain_points || '","focus":"' || focus || '","actions":"' || actions || '"}}' AS b, pos, neg FROM a{k} WHERE n > 1)""")
    ends = " UNION ALL ".join(f"SELECT {g}, customer_likings, customer_pain_points, focus, actions, CAST({k + 1} AS INTEGER) AS levels FROM a{k} WHERE n = 1" for k in range(levels))
    same = " AND ".join(f"e.{c} = z.{c}" for c in by)
    out.append(f"summary AS (SELECT e.*, z.n_chunks, CAST(0 AS BIGINT) AS n_failed FROM ({ends}) e JOIN (SELECT {g}, max(n) AS n_chunks FROM a0 GROUP BY {g}) z ON {same})")
    return out


PCT_TEXT = ("CASE WHEN isnan(positive_pct) THEN 'NaN' WHEN positive_pct = floor(positive_pct) "
            "THEN CAST(CAST(floor(positive_pct) AS BIGINT) AS VARCHAR) ELSE CAST(positive_pct AS VARCHAR) END")


def _entries() -> str:
    return """entries AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || event_type AS entry_id,
    'event ' || CAST(event_id AS VARCHAR) || ' ' || event_type AS body,
    ts + INTERVAL 1 MINUTE AS expires_at, event_id AS seq, ts AS updated_at
  FROM events)"""


def iso(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def _rules_ctes() -> list[str]:
    rules = "rules(token, field, value, weight, rank) AS (VALUES " + ", ".join(
        f"({s(t)}, {s(f)}, {s(v)}, {w}, {r})" for t, f, v, w, r in Q.RULES) + ")"
    fields = ["Sentiments", "Category", "Severity"]
    best = ", ".join(
        f"arg_max(value, row(score, -rank)) FILTER (WHERE field = {s(f)}) AS {f}" for f in fields)
    ruled = f"""ruled AS (SELECT channel, review_id, {best} FROM (
  SELECT channel, review_id, field, value, sum(weight) AS score, min(rank) AS rank
  FROM (SELECT channel, review_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS token FROM reviews) t
  JOIN rules USING (token) GROUP BY channel, review_id, field, value) GROUP BY channel, review_id)"""
    return [rules, ruled]


def _rules_sql() -> str:
    return with_(REVIEWS, *_rules_ctes()) + "SELECT review_id, Sentiments, Category, Severity FROM ruled"


def _comments() -> str:
    indent = by_channel({c: s(" " * n) for c, n in C.INSIGHT_INDENT.items()})
    cols = {"sub_category": "sub_category", "sentiment": "sentiment", "feature": "feature",
            "indent": indent, "insight": "insight", "response": "response"}
    first = (f"CASE WHEN channel = 'product' THEN {template_sql(C.PRODUCT_SUBCAT_TEMPLATE, cols)} "
             f"ELSE {template_sql(C.COMMENT_TEMPLATES[0], cols)} END")
    rows = [f"SELECT ticket_id AS object, 1 AS seq, {first} AS body FROM tickets"]
    rows += [f"SELECT ticket_id, {i + 2}, {template_sql(t, cols)} FROM tickets"
             for i, t in enumerate(C.COMMENT_TEMPLATES[1:])]
    rows.append(f"SELECT ticket_id, {len(C.COMMENT_TEMPLATES) + 1}, {s(C.CHART_COMMENT)} FROM tickets "
                f"WHERE channel IN {inlist(C.CHART_CHANNELS)}")
    return "comments AS (SELECT object, CAST(seq AS BIGINT) AS seq, body FROM (" + " UNION ALL ".join(rows) + "))"


def _status() -> str:
    cols = {"ticket": "ticket_id", "category": "category"}
    body = (f"CASE WHEN category != {s(C.FALLBACK_CATEGORY)} THEN {template_sql(C.STATUS_CATEGORIZED, cols)} "
            f"ELSE {template_sql(C.STATUS_FAILED, cols)} END")
    return f"""status AS (
  SELECT sha256('status|' || ticket_id) AS entry_id, 'app/' || channel AS object, {body} AS body,
    TIMESTAMP {s(Q.CREATED_AT)} + INTERVAL 1 MINUTE AS expires_at, CAST(0 AS BIGINT) AS seq,
    TIMESTAMP {s(Q.CREATED_AT)} AS updated_at
  FROM tickets)"""


def _webhook_rows() -> str:
    sev = pick([x.lower() for x in ["Blocker", "High", "Medium", "Low"]], "event_id % 4")
    base = f"""SELECT 'evt/' || CAST(event_id AS VARCHAR) AS event_id,
    'key/' || CAST(event_id // 2 AS VARCHAR) AS unique_key,
    'work/' || CAST(event_id AS VARCHAR) AS work_id, 'TKT-' || CAST(event_id AS VARCHAR) AS display_id,
    'Event ' || CAST(event_id AS VARCHAR) AS title, {sev} AS severity, event_type AS stage,
    CAST(event_id % 4 AS BIGINT) AS stage_ordinal, 'part/' || CAST(user_id % 5 AS VARCHAR) AS part_id,
    'user/' || CAST(user_id AS VARCHAR) AS created_by, 'app/' || CAST(user_id % 5 AS VARCHAR) AS app_id,
    {iso('ts')} AS event_ts, {iso('ts')} AS created_ts"""
    return (f"{base}, 'user/' || CAST(user_id AS VARCHAR) AS owner_id FROM events UNION ALL "
            f"{base}, 'user/' || CAST((user_id + 1) % 150 AS VARCHAR) FROM events WHERE event_id % 2 = 0")


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    for ch in C.CHANNELS:
        o[f"source_{ch}"] = source_sql(ch)
    o["source_dead_letters"] = (with_(REVIEWS) + "SELECT DISTINCT 'source' AS stage, channel || ':' || "
                                f"CAST(-(page + 1) AS VARCHAR) AS key, 'missing_envelope' AS reason FROM reviews "
                                f"WHERE page % {V.BROKEN_PAGE_EVERY} = {V.BROKEN_PAGE_EVERY - 1}")
    o["source_domain_page"] = f"SELECT * FROM ({source_sql('domain')}) WHERE page = 1"
    o["reviews_unified"] = " UNION ALL ".join(f"SELECT * FROM ({source_sql(c)})" for c in C.CHANNELS)
    tags_vals = "tagdim(name, description, id) AS (VALUES " + ", ".join(
        f"({s(n)}, {s(d)}, {s(C.TAG_ID_PREFIX + n)})" for n, d in C.TAGS) + ")"
    o["tag_usage"] = (BASE + f", {tags_vals}, used AS (SELECT id, count(*) AS n FROM ("
                      "SELECT tag_category AS id FROM tickets UNION ALL SELECT tag_sentiment FROM tickets) GROUP BY id) "
                      "SELECT name, description, tagdim.id, coalesce(n, 0) AS n_tickets FROM tagdim LEFT JOIN used USING (id)")
    o["channel_config"] = (with_(REVIEWS, CONFIG) + "SELECT channel, company, default_part_id, default_owner_id, "
                           "llm_model, coalesce(n, 0) AS n_reviews FROM config LEFT JOIN "
                           "(SELECT channel, count(*) AS n FROM reviews GROUP BY channel) USING (channel)")
    o["search_subject"] = with_(REVIEWS) + f"SELECT review_id, channel FROM reviews WHERE contains(lower(text), {s(Q.SEARCH_TERM)})"
    o["filter_language"] = with_(REVIEWS) + "SELECT review_id, channel, lang FROM reviews WHERE lang = 'en'"
    o["relevance_observed"] = BASE + "SELECT review_id, true AS relevance FROM parsed"
    o["relevance_strict"] = BASE + "SELECT review_id, relevance FROM parsed WHERE coalesce(relevance, true)"
    k = "json_extract_string(props, '$.k')"
    params = (f"CASE event_id % 8 WHEN 0 THEN {k} WHEN 1 THEN '' WHEN 2 THEN {k} || 'abc' WHEN 3 THEN 'x' "
              f"WHEN 4 THEN '  ' || {k} || ' ' WHEN 5 THEN ' -' || {k} WHEN 6 THEN NULL ELSE '+' || {k} END")
    o["parse_limit"] = (f"SELECT event_id, parameters, coalesce(TRY_CAST(nullif(regexp_extract(coalesce(parameters, ''), "
                        f"'^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT), {C.DEFAULT_LIMIT}) AS n "
                        f"FROM (SELECT event_id, {params} AS parameters FROM events)")
    model = f"coalesce({pick(C.ALLOWED_MODELS, f'CAST({k} AS BIGINT) % 40')}, 'model-' || {k})"
    o["model_allowlist"] = (f"SELECT event_id, llm_model, llm_model IN {inlist(C.ALLOWED_MODELS)} AS accepted "
                            f"FROM (SELECT event_id, {model} AS llm_model FROM events)")
    asked = (f"asked AS (SELECT event_id, {pick(C.CHANNELS, 'user_id % 5')} AS channel, user_id, {params} AS parameters, "
             f"CASE WHEN CAST({k} AS BIGINT) % 3 > 0 THEN {model} ELSE {s(C.DEFAULT_MODEL)} END AS llm_model FROM events)")
    o["command_jobs"] = (f"WITH {asked} SELECT event_id, channel, 'app/' || CAST(user_id % 5 AS VARCHAR) AS app_id, "
                         f"coalesce(TRY_CAST(nullif(regexp_extract(coalesce(parameters, ''), '^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT), {C.DEFAULT_LIMIT}) AS n, "
                         "'part/' || channel AS default_part_id, 'owner/' || channel AS default_owner_id, llm_model, 'subject-' || CAST(user_id AS VARCHAR) AS subject, "
                         f"{s(C.TAG_ID_PREFIX + 'bug')} AS tag_bug, CAST({len(C.TAGS)} AS BIGINT) AS n_tags FROM asked WHERE llm_model IN {inlist(C.ALLOWED_MODELS)}")
    o["command_refusals"] = (f"WITH {asked} SELECT 'command' AS stage, channel, CAST(event_id AS VARCHAR) AS key, 'model_not_allowed' AS reason, "
                             f"'command: model ' || llm_model || ' is not allowed' AS message FROM asked WHERE llm_model NOT IN {inlist(C.ALLOWED_MODELS)}")
    subjects = ", ".join(f"({s(x)})" for x in Q.SEARCH_SUBJECTS)
    o["search_indexed"] = with_(REVIEWS) + f"SELECT subject, review_id, channel FROM reviews JOIN (VALUES {subjects}) t(subject) ON contains(lower(text), lower(subject))"
    o["top_by_rating"] = with_(REVIEWS) + f"SELECT review_id, channel, rating FROM reviews ORDER BY rating DESC, review_id LIMIT {Q.TOP_N}"
    o["top_by_score"] = with_(REVIEWS) + f"SELECT review_id, channel, score FROM reviews ORDER BY score DESC, review_id LIMIT {Q.TOP_N}"
    o["top_n_per_channel"] = (with_(REVIEWS) + "SELECT channel, review_id, rating, rank FROM (SELECT channel, review_id, rating, "
                              "CAST(row_number() OVER (PARTITION BY channel ORDER BY rating DESC, review_id) AS BIGINT) AS rank "
                              f"FROM reviews) WHERE rank <= {Q.TOP_N}")
    o["titles"] = with_(REVIEWS) + f"SELECT review_id, channel, {TITLE} AS title FROM reviews"
    o["bodies"] = BASE + f"SELECT review_id, channel, md5(b) AS body_md5, length(b) AS body_len FROM (SELECT review_id, channel, {BODY} AS b FROM parsed)"
    o["strip_links"] = (with_(REVIEWS) + "SELECT review_id, md5(c) AS clean_md5, length(c) AS clean_len FROM ("
                        "SELECT review_id, regexp_replace(text, 'https://t\\.co/\\S*', '', 'g') AS c FROM reviews)")
    prompt = template_sql(C.ANNOTATION_PROMPT, {"company": "company", "review": "text"})
    wc = with_(REVIEWS, CONFIG, "rc AS (SELECT reviews.*, config.company FROM reviews LEFT JOIN config USING (channel))")
    o["annotation_prompts"] = (wc + "SELECT review_id, channel, md5(p) AS prompt_md5, length(p) AS prompt_len, "
                               f"sha256(p) AS prompt_key FROM (SELECT review_id, channel, {prompt} AS p FROM rc)")
    alt = template_sql(C.PRODUCT_ALT_PROMPT, {"company": "company", "review": "text"})
    wrapped = f"{s(C.REVIEW_WRAPPER)} || {tmpl('text')}"
    o["product_prompt_alt"] = (wc + "SELECT review_id, md5(p) AS prompt_md5, length(p) AS prompt_len, md5(w) AS wrapped_md5, "
                               f"length(w) AS wrapped_len FROM (SELECT review_id, {alt} AS p, {wrapped} AS w FROM rc "
                               "WHERE channel = 'product')")
    sysm = template_sql(Q.CHAT_SYSTEM, {"company": "company", "review": "text"})
    hum = template_sql(Q.CHAT_HUMAN, {"company": "company", "review": "text"})
    o["chat_messages"] = wc + f"SELECT review_id, md5({sysm}) AS system_md5, md5({hum}) AS human_md5, CAST(2 AS BIGINT) AS n_messages FROM rc"
    # a prompt's answer is that of the smallest labelled document with this prompt
    asked = wc.rstrip() + f""", {ANSWERS},
asked AS (SELECT *, {prompt} AS p FROM rc),
said AS (SELECT p, min(doc_id) AS said_by FROM asked JOIN answers USING (doc_id) GROUP BY p),
told AS (SELECT r.*, a.doc_id AS said_by, a.corrupt, a.relevance, a.sentiment, a.category, a.severity, a.feature, a.description
  FROM asked r LEFT JOIN said USING (p) LEFT JOIN answers a ON a.doc_id = said.said_by),
mparsed AS (SELECT * FROM told WHERE NOT corrupt)"""
    o["annotate_model"] = asked + " SELECT review_id, channel, relevance, sentiment, category, severity, feature, description FROM mparsed"
    o["annotate_rules"] = _rules_sql()
    o["annotate_labels"] = BASE + ("SELECT review_id, channel, relevance, sentiment, category, sub_category, severity, "
                                   "feature, insight, description, response, review_clean FROM parsed")
    o["annotation_parse"] = BASE + "SELECT review_id, sentiment, category, severity FROM parsed"
    o["parse_failures"] = with_(REVIEWS, ANSWERS, PARSED, DEAD) + "SELECT stage, channel, key, reason FROM dead WHERE stage = 'annotate'"
    rules_vals = ", ".join(f"({s(c)}, {s(x)})" for c, subs in C.SUB_CATEGORY_RULES.items() for x in subs)
    o["sub_category_check"] = (BASE + f", subrules(category, sub_category) AS (VALUES {rules_vals}) "
                               "SELECT review_id, category, sub_category, (EXISTS (SELECT 1 FROM subrules r WHERE "
                               "r.category = parsed.category AND r.sub_category = parsed.sub_category) OR "
                               f"(category = {s(C.FREE_TEXT_SUB_CATEGORY)} AND coalesce(length(trim(sub_category)) > 0, false))) "
                               "AS sub_category_valid FROM parsed")
    o["severity_norm"] = BASE + "SELECT review_id, severity, severity_norm FROM parsed"
    o["category_fallback"] = BASE + "SELECT review_id, category_raw, category_final AS category FROM resolved"
    o["tag_ids"] = BASE + "SELECT review_id, 'tag/' || category_final AS tag_category, 'tag/' || sentiment AS tag_sentiment FROM resolved"
    tick_out = ("SELECT ticket_id, channel, review_id, title, tags, md5(body) AS body_md5, length(body) AS body_len, "
                "type, owner, applies_to_part, severity FROM tickets")
    o["tickets"] = BASE + tick_out
    o["ticket_scan"] = BASE + tick_out
    model_resolved = (f"resolved AS (SELECT *, CASE WHEN category IN {inlist(TAG_NAMES)} THEN category "
                      f"ELSE {s(C.FALLBACK_CATEGORY)} END AS category_final FROM mparsed WHERE sentiment IN {inlist(TAG_NAMES)})")
    o["tickets_model"] = (asked + ", " + model_resolved +
                          f" SELECT sha256(channel || '|' || review_id) AS ticket_id, channel, review_id, {TITLE} AS title, "
                          "'tag/' || category_final || ',' || 'tag/' || sentiment AS tags, "
                          f"md5({BODY}) AS body_md5, length({BODY}) AS body_len, 'ticket' AS type, "
                          "'owner/' || channel AS owner, 'part/' || channel AS applies_to_part, severity FROM resolved")
    rparsed = ("rparsed AS (SELECT r.*, x.Sentiments AS sentiment, x.Category AS category, x.Severity AS severity, "
               "CAST(NULL AS VARCHAR) AS description FROM reviews r JOIN ruled x USING (channel, review_id))")
    rresolved = (f"resolved AS (SELECT *, CASE WHEN category IN {inlist(TAG_NAMES)} THEN category "
                 f"ELSE {s(C.FALLBACK_CATEGORY)} END AS category_final FROM rparsed "
                 f"WHERE sentiment IN {inlist(TAG_NAMES)})")
    o["tickets_rules"] = (with_(REVIEWS, *_rules_ctes(), rparsed, rresolved) +
                          f"SELECT sha256(channel || '|' || review_id) AS ticket_id, channel, review_id, {TITLE} AS title, "
                          "'tag/' || category_final || ',' || 'tag/' || sentiment AS tags, "
                          f"md5({BODY}) AS body_md5, length({BODY}) AS body_len, 'ticket' AS type, "
                          "'owner/' || channel AS owner, 'part/' || channel AS applies_to_part, severity FROM resolved")
    o["tickets_incremental"] = BASE + "SELECT ticket_id, channel, review_id FROM tickets WHERE lang != 'en'"
    o["tickets_by_tag"] = BASE + "SELECT ticket_id, channel FROM tickets WHERE tag_category = 'tag/Negative' OR tag_sentiment = 'tag/Negative'"
    o["dead_letters"] = with_(REVIEWS, ANSWERS, PARSED, DEAD) + "SELECT stage, channel, key, reason, stage || ': ' || reason AS message FROM dead"
    o["review_outcomes"] = (BASE + ", " + DEAD + " SELECT channel, outcome, count(*) AS n FROM (SELECT channel, 'ticket' AS outcome FROM tickets "
                            "UNION ALL SELECT channel, reason FROM dead) GROUP BY channel, outcome")
    o["severity_refused"] = (BASE + "SELECT channel, sha256(channel || '|' || review_id) AS key, 'invalid_severity' AS reason FROM resolved "
                             f"WHERE severity_norm IS NULL OR severity_norm NOT IN {inlist([x.lower() for x in C.SEVERITIES])}")
    o["review_limit"] = (with_(REVIEWS) + "SELECT channel, review_id FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY "
                         "CASE channel WHEN 'social' THEN score WHEN 'appstore' THEN rating END DESC, review_id) AS nth FROM reviews) "
                         f"WHERE channel NOT IN ('social', 'appstore') OR nth <= {Q.TOP_N}")
    o["annotate_failures"] = (asked + " SELECT channel, review_id AS key, CASE WHEN corrupt THEN 'malformed_answer' ELSE 'inference_failed' END AS reason, "
                              f"CASE WHEN corrupt THEN 'annotate: malformed_answer' ELSE {s(N.NOT_STORED)} END AS message FROM told WHERE corrupt OR said_by IS NULL")
    o["summary_parse"] = ("SELECT CAST(doc_id AS VARCHAR) AS chunk_key, 'liked ' || CAST(doc_id AS VARCHAR) AS customer_likings, 'pain ' || CAST(quality AS VARCHAR) AS customer_pain_points, "
                          "CASE WHEN doc_id % 3 = 0 THEN 'a ' || CAST(doc_id AS VARCHAR) || ',b' ELSE 'f ' || CAST(doc_id AS VARCHAR) END AS focus, "
                          "CASE WHEN doc_id % 2 = 1 THEN 'x,y ' || CAST(doc_id AS VARCHAR) ELSE 'act ' || CAST(doc_id AS VARCHAR) END AS actions "
                          "FROM labels WHERE doc_id % 13 != 0")
    o["status_messages"] = BASE + ", " + _status() + f" SELECT entry_id, object, body, {iso('expires_at')} AS expires_at FROM status"
    o["detail_comments"] = BASE + ", " + _comments() + " SELECT object, seq, body FROM comments"
    o["chart_comments"] = BASE + ", " + _comments() + " SELECT object, body FROM comments WHERE seq = 6"
    o["timeline_create"] = (BASE + ", " + _status() + ", " + _comments() +
                            f" SELECT entry_id, object, seq, body, 'text' AS body_type, 'timeline_comment' AS type, 'internal' AS visibility, "
                            f"{iso('expires_at')} AS expires_at, {iso('updated_at')} AS updated_at FROM status UNION ALL SELECT sha256(object || '|' || CAST(seq AS VARCHAR)), "
                            f"object, seq, body, 'text', 'timeline_comment', 'internal', NULL, {iso(f'TIMESTAMP {s(Q.CREATED_AT)}')} FROM comments")
    o["timeline_latest"] = (with_(_entries()) + f"SELECT entry_id, arg_max(seq, row(updated_at, seq, body)) AS seq, "
                            f"arg_max(body, row(updated_at, seq, body)) AS body, {iso('max(updated_at)')} AS updated_at "
                            "FROM entries GROUP BY entry_id")
    o["active_entries"] = (with_(_entries()) + f"SELECT entry_id, seq, {iso('expires_at')} AS expires_at FROM entries "
                           f"WHERE expires_at IS NULL OR expires_at > TIMESTAMP {s(Q.AS_OF)}")
    o["sentiment_pct"] = BASE + _sent_pct().replace("{where}", "")
    o["sentiment_pct_by_channel"] = BASE + _sent_pct("channel").replace("{where}", "")
    o["sentiment_pct_merged"] = o["sentiment_pct_by_channel"]
    o["sentiment_pct_empty"] = BASE + _sent_pct().replace("{where}", " WHERE category = 'no_such_category'")
    o["bodies_joined"] = (BASE + ", " + _chunks(Q.CHUNK_CHARS) +
                          " SELECT channel, sentiment, chunk, n_items, md5(text) AS text_md5, length(text) AS text_len FROM joined")
    spct = (f"pct AS (SELECT channel, {_pct('CAST(p AS DOUBLE)', 'n')} AS positive_pct FROM (SELECT channel, "
            "count(*) FILTER (WHERE tag_category = 'tag/Positive' OR tag_sentiment = 'tag/Positive') AS p, "
            "count(*) FILTER (WHERE tag_category = 'tag/Negative' OR tag_sentiment = 'tag/Negative') AS n "
            "FROM tickets GROUP BY channel))")
    sp = template_sql(C.SUMMARY_PROMPT, {"positive_pct": PCT_TEXT, "reviews": "text"})
    o["summary_chunks"] = (BASE + ", " + _chunks(Q.CHUNK_CHARS) + ", " + spct +
                           f" SELECT channel, sentiment, chunk, n_items, positive_pct, md5(p) AS prompt_md5, length(p) AS prompt_len "
                           f"FROM (SELECT joined.*, positive_pct, {sp} AS p FROM joined LEFT JOIN pct USING (channel))")
    fields = "customer_likings, customer_pain_points, focus, actions, levels, n_chunks, n_failed"
    o["corpus_summary"] = BASE + ", " + spct + ", " + ",\n".join(_summary_levels(["channel", "sentiment"])) + f" SELECT channel, sentiment, {fields} FROM summary"
    neg = spct.replace("pct AS (SELECT channel, ", f"pct AS (SELECT channel, {_pct('CAST(n AS DOUBLE)', 'p')} AS negative_pct, ")
    shown = {"positive_pct": PCT_TEXT, "negative_pct": PCT_TEXT.replace("positive_pct", "negative_pct"),
             **{c: c for c in ("customer_likings", "customer_pain_points", "focus", "actions")}}
    o["summary_report"] = (BASE + ", " + neg + ", " + ",\n".join(_summary_levels(["channel"])) + " " + " UNION ALL ".join(
        f"SELECT channel, CAST({i + 1} AS BIGINT) AS seq, {template_sql(t, shown)} AS body FROM summary LEFT JOIN pct USING (channel)"
        for i, t in enumerate(C.REPORT_TEMPLATES)))
    o["category_counts"] = BASE + "SELECT channel, category, count(*) AS n FROM tickets GROUP BY channel, category"
    names = [n for n in TAG_NAMES if n not in ("Positive", "Negative")]
    o["category_pivot"] = BASE + "SELECT channel, " + ", ".join(
        f"count(*) FILTER (WHERE category = {s(n)}) AS {n}" for n in names) + " FROM tickets GROUP BY channel"
    o["chart_data"] = (BASE + "SELECT channel, string_agg(category, ',' ORDER BY category) AS labels, "
                       "string_agg(CAST(n AS VARCHAR), ',' ORDER BY category) AS data FROM "
                       "(SELECT channel, category, count(*) AS n FROM tickets GROUP BY channel, category) GROUP BY channel")
    o["event_flatten"] = _webhook_rows()
    return o
