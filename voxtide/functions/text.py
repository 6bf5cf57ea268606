"""Column helpers with the string semantics of the original jobs.

All return ``Column`` expressions built from built-in functions, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxtide import constants as C

UNDEFINED = "undefined"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Unicode-aware whitespace, as JS ``trim`` and ``parseInt`` skip it (incl. NBSP).
_WS = r"[\p{IsWhite_Space}\x{FEFF}]"


def js_trim(c) -> Column:
    """Strip leading/trailing whitespace (Spark ``trim`` strips spaces only)."""
    return F.regexp_replace(col_(c), rf"^{_WS}+|{_WS}+$", "")


def tmpl(c) -> Column:
    """A value as a template literal prints it: absent or null -> 'undefined'."""
    return F.coalesce(col_(c).cast("string"), F.lit(UNDEFINED))


def falsy_or(a, b) -> Column:
    """``a || b`` for strings: empty or null ``a`` falls back to ``b``."""
    return F.coalesce(F.nullif(col_(a), F.lit("")), col_(b))


def strip_links(c, prefix: str = C.LINK_PREFIX) -> Column:
    """Remove every link that starts with ``prefix`` (up to the next whitespace)."""
    return F.regexp_replace(col_(c), re.escape(prefix) + r"\S*", "")


def parse_limit(c, default: int = C.DEFAULT_LIMIT) -> Column:
    """Leading-integer parse of a command argument.

    '12abc' -> 12, ' -3' -> -3, '' / '  ' / 'x' / NULL -> ``default``.
    """
    digits = F.regexp_extract(F.coalesce(col_(c), F.lit("")), rf"^{_WS}*([+-]?[0-9]+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(default).cast("bigint"))


def wrap_review_text(c) -> Column:
    return F.concat(F.lit(C.REVIEW_WRAPPER), tmpl(c))


def iso_ts(c) -> Column:
    """Timestamp as an ISO-8601 UTC string with milliseconds (needs a UTC session)."""
    return F.date_format(col_(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def sql_str(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spaces(n: int) -> str:
    return " " * n
