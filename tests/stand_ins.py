"""A stand-in for a model service: answers derived from the length of a review."""

import json
import sys

from pyspark import cloudpickle

from voxtide import constants as C
from voxtide.functions.completers import envelope

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # workers don't have the tests on their path

# The text that precedes the review in the annotation prompt.
REVIEW_MARK = C.ANNOTATION_PROMPT.rsplit("{review}", 1)[0].rsplit("}", 1)[1]
ANSWER_CATEGORIES = C.CATEGORIES + ["other"]
ANSWER_SEVERITIES = ["Blocker", "High", "Low", "Medium"]


def length_answer(review: str) -> str | None:
    """Annotation of a review derived from its length n (in characters).
    n % 11 == 0 gives an answer that is not JSON."""
    n = len(review)
    if n % 11 == 0:
        return "I cannot label this review."
    return json.dumps({
        "Relevance": n % 5 != 0,
        "Sentiments": "Negative" if n % 4 == 0 else "Positive",
        "Category": ANSWER_CATEGORIES[n % 9],
        "sub_category": "-",
        "Severity": ANSWER_SEVERITIES[n % 4],
        "Feature": f"feature {n % 7}",
        "insight": f"insight {n % 13}",
        "description": f"review of {n} characters",
        "response": "Thank you for the review.",
        "review": None,
    })


def length_rule_completer(prompts: list[str | None]) -> list[str | None]:
    out = []
    for p in prompts:
        if p is None or REVIEW_MARK not in p:
            out.append(None)
            continue
        out.append(envelope(length_answer(p.split(REVIEW_MARK, 1)[1])))
    return out
