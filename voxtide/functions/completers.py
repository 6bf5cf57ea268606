"""A deterministic completer of the summary queries.

A completer is any ``Callable[[list[str]], list[str | None]]``: prompts in,
raw completion bodies (``{"choices": [{"text": ...}]}``) out, ``None`` for a
failed call.  Real deployments pass a client for their inference service; this
stand-in derives its answer from the prompt text alone, so the summary queries
can be checked against SQL.  The summary operators are what they test, not it.
"""

from __future__ import annotations

import hashlib
import json


def envelope(text: str) -> str:
    return json.dumps({"choices": [{"text": text}]})


def digest_completer(prompts: list[str | None]) -> list[str | None]:
    """Summary answer derived from the prompt: its length and digest."""
    out = []
    for p in prompts:
        if p is None:
            out.append(None)
            continue
        n = len(p)
        h = hashlib.md5(p.encode("utf-8")).hexdigest()
        out.append(envelope(json.dumps({
            "customer_likings": f"{n} characters reviewed",
            "customer_pain_points": f"digest {h[:12]}",
            "focus": f"topic {n % 7}",
            "actions": [f"action {n % 3}", f"action {n % 5}"],
        })))
    return out
