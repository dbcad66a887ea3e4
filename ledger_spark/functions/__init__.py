"""Column expressions: text cleansing, scores and keys."""

from .scoring import confidence_score, rule_rank, stable_rule_id
from .text import clean_description, clean_description_simple, clean_merchant, substrings

__all__ = [
    "clean_description",
    "clean_description_simple",
    "clean_merchant",
    "confidence_score",
    "rule_rank",
    "stable_rule_id",
    "substrings",
]
