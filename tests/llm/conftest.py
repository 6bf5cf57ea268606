"""Fixtures of hard cases shared by the operator tests."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def hard(spark):
    """Null ids, texts and sources, empty and very long texts, ties, repeated
    rows, copies, and columns named like results."""
    base = "the quick brown fox jumps over the lazy dog near the quiet river bank while seven small birds sing in tall trees " * 2
    rows = [
        (1, base, "en", "a", 1), (2, base.replace(" ", "\n"), "en", "a", 1), (2, base.replace(" ", "\n"), "en", "a", 1), (3, base.upper(), None, None, None),
        (4, base + " and one more thing to say", "en", "b", 2), (5, None, "en", "b", 2), (6, "", None, "a", 0), (7, " \t\n ", "de", "c", 3),
        (8, "one", "de", "c", 3), (9, "one", "de", "c", 3), (10, "a b c d", None, "c", 3), (None, "a b c d", None, None, None), (None, None, None, None, None),
        (11, LONG, "en", "a", 5), (12, LONG + " tail", "en", "b", 5), (13, "x" * 20_000, "en", "a", 5), (14, "ab" * 70, "fr", "a", 2), (15, "é▁😀\x00 é  ñ", "fr", "z", 2),
        (16, "### *** | " * 30, "en", "a", 1), (-4, base + " the end", "en", "\u00e9", 1), (17, "same line here\n" * 40, "en", "a", 1),
    ]
    wide = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as size", "1 as kept", "'y' as digest", "2 as n_tokens", "3 as `group`", "4 as token", "5 as k", "6 as id", "7 as row")
    return spark.createDataFrame(wide.collect(), wide.schema).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
