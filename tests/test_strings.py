"""Exact text of titles, bodies, comments, status and report entries."""

from pyspark.sql import functions as F

from voxtide import constants as C
from voxtide.functions.text import js_trim, parse_limit, strip_links
from voxtide.operators.render import body_expr, js_number, template_expr, title_expr
from voxtide.operators.tickets import detail_comments
from voxtide.operators.timeline import status_messages, summary_report

REVIEW = "channel STRING, review_id STRING, title STRING, url STRING, author STRING, text STRING"


def test_titles_and_undefined(spark):
    rows = [
        ("social", "t1", None, "https://x.co/1", None, "a"),
        ("social", "t2", None, "", None, "a"),
        ("appstore", "a1", "", None, None, "a"),
        ("appstore", "a2", "Great", "u", None, "a"),
        ("appstore", "a3", None, "https://u/3", None, "a"),
        ("product", "p1", None, None, None, "a"),
        ("business", "b1", None, None, None, "a"),
        ("domain", "d1", "", None, None, "a"),
        ("domain", "d2", None, None, None, "a"),
    ]
    df = spark.createDataFrame(rows, REVIEW).select("review_id", title_expr().alias("t"))
    got = dict(df.collect())
    assert got == {
        "t1": "Ticket created from twitter: https://x.co/1",
        "t2": "Ticket created from twitter: t2",
        "a1": "Ticket created from Trustpilot: undefined",
        "a2": "Ticket created from Trustpilot: Great",
        "a3": "Ticket created from Trustpilot: https://u/3",
        "p1": "Ticket created from G2 p1",
        "b1": "Ticket created from google review by undefined",
        "d1": "Ticket created from Trustpilot: ",
        "d2": "Ticket created from Trustpilot: undefined",
    }


def test_body_indents_per_channel(spark):
    rows = [(c, "r", None, None, None, "nice app") for c in C.CHANNELS]
    df = spark.createDataFrame(rows, REVIEW).withColumn("description", F.lit("desc"))
    got = dict(df.select("channel", body_expr().alias("b")).collect())
    assert got["social"] == "The review: nice app \n\n      The description: desc \n\n        "
    assert got["appstore"] == "The review: nice app \n\n    The description: desc \n\n      "
    assert got["product"] == "The review: nice app \n\n  The description: desc \n\n    "
    assert got["business"] == got["domain"] == got["appstore"]
    nodesc = spark.createDataFrame([("social", "r", None, None, None, None)], REVIEW) \
        .withColumn("description", F.lit(None).cast("string"))
    b = nodesc.select(body_expr()).first()[0]
    assert b.startswith("The review: undefined \n\n") and "The description: undefined \n\n" in b


def _tickets(spark):
    rows = [
        ("t-app", "appstore", "minor", "Positive", "login", "fix it", "thanks", "bug"),
        ("t-prod", "product", "-", "Negative", None, "do x", "sorry", "failed_to_infer_category"),
        ("t-biz", "business", "cheap", "Positive", "price", "keep", "ok", "pricing"),
    ]
    return spark.createDataFrame(rows, "ticket_id STRING, channel STRING, sub_category STRING, sentiment STRING, "
                                       "feature STRING, insight STRING, response STRING, category STRING")


def test_detail_comments_exact(spark):
    c = detail_comments(_tickets(spark)).orderBy("object", "seq").collect()
    by = {}
    for r in c:
        by.setdefault(r.object, []).append(r.body)
    assert len(by["t-app"]) == 6 and len(by["t-prod"]) == 5 and len(by["t-biz"]) == 5
    assert by["t-app"][:5] == [
        "<b>Sub-Category</b>: minor ",
        "Overall sentiment: Positive ",
        "Feature discussed: login ",
        "Actionable insight: \n\n    fix it \n",
        "Sample Response: thanks ",
    ]
    assert by["t-app"][5] == C.CHART_COMMENT and by["t-app"][5].endswith("</img> ")
    assert by["t-prod"][0] == "Sub-Category: - "
    assert by["t-prod"][2] == "Feature discussed: undefined "
    assert by["t-biz"][3] == "Actionable insight: \n\n  keep \n"
    assert [r.seq for r in c if r.object == "t-app"] == [1, 2, 3, 4, 5, 6]


def test_status_messages(spark):
    s = status_messages(_tickets(spark), "app/1", F.lit("2024-01-01 00:00:00")) \
        .select("body", F.date_format("expires_at", "yyyy-MM-dd HH:mm:ss").alias("e")).collect()
    bodies = {r.body for r in s}
    assert "Created ticket: <t-app> and it is categorized as bug" in bodies
    assert "Created ticket: <t-prod> and it failed to be categorized" in bodies
    assert {r.e for r in s} == {"2024-01-01 00:01:00"}


def test_summary_report_exact(spark):
    df = spark.createDataFrame(
        [(85.0, 15.0, "likes", "pains", "focus", "acts")],
        "positive_pct DOUBLE, negative_pct DOUBLE, customer_likings STRING, customer_pain_points STRING, "
        "focus STRING, actions STRING")
    got = [r.body for r in summary_report(df, "app/1").orderBy("seq").collect()]
    assert got == [
        "Positive sentiment %: 85 ", "Negative sentiment %: 15 ", "Customer likings: likes",
        "Customer Pain-Points: pains", "Areas to focus on:   \n\nfocus \n", "Actions to take: acts",
    ]


def test_js_number(spark):
    df = spark.createDataFrame([(85.46365914786968,), (100.0,), (float("nan"),), (0.0,)], "x DOUBLE")
    assert [r[0] for r in df.select(js_number(F.col("x"))).collect()] == ["85.46365914786968", "100", "NaN", "0"]


def test_parse_limit_cases(spark):
    cases = [("", 10), ("  ", 10), ("5", 5), ("12abc", 12), (" -3", -3), ("x", 10), (None, 10), ("+7", 7),
             ("99999999999999999999", 10), ("\u00a0 7", 7), ("0x1A", 0)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "p STRING")
    assert [r[0] for r in df.select(parse_limit(F.col("p"))).collect()] == [n for _, n in cases]


def test_js_trim_and_strip_links(spark):
    df = spark.createDataFrame([("\t a b \n",), ("\u00a0\u2003x\ufeff",)], "s STRING")
    assert [r[0] for r in df.select(js_trim(F.col("s"))).collect()] == ["a b", "x"]
    t = spark.createDataFrame([("see https://t.co/abc1 and https://t.co/x now https://example.com/q",)], "s STRING")
    assert t.select(strip_links(F.col("s"))).first()[0] == "see  and  now https://example.com/q"


def test_template_inserts_are_not_rescanned(spark):
    df = spark.createDataFrame([("{b}", "B")], "a STRING, b STRING")
    out = df.select(template_expr("x {a} y {b}", {"a": "a", "b": "b"})).first()[0]
    assert out == "x {b} y B"


def test_prompt_fixed_text():
    assert C.ANNOTATION_PROMPT.count("{company}") == 1 and C.ANNOTATION_PROMPT.endswith("The review: {review}")
    assert C.PRODUCT_ALT_PROMPT.endswith("Review: {review}")
    assert len(C.ALLOWED_MODELS) == 33 and len(C.TAGS) == 11


def test_template_brace_escapes(spark):
    df = spark.createDataFrame([("v",)], "a STRING")
    out = df.select(template_expr('json: {{"k": "{a}"}}', {"a": "a"})).first()[0]
    assert out == 'json: {"k": "v"}'


def test_js_number_small(spark):
    df = spark.createDataFrame([(3.3e-5,), (5.0e-4,), (1.2345e-3,), (1e-6,), (3.3e-7,), (5e-7,)], "x DOUBLE")
    assert [r[0] for r in df.select(js_number(F.col("x"))).collect()] == ["0.000033", "0.0005", "0.0012345", "0.000001", "3.3e-7", "5e-7"]
