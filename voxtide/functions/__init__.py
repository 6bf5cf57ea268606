from voxtide.functions.text import (  # noqa: F401
    falsy_or, iso_ts, js_trim, parse_limit, strip_links, tmpl, wrap_review_text,
)
