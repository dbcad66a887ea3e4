"""Text cleansing as native column expressions.

White space is spelled out as ``[ \\t\\n\\f\\r]`` because Java's ``\\s`` also
matches a vertical tab, which the rules' dialect does not. Letters and digits are
written ``\\p{Alnum}`` (ASCII only), which Java matches several times faster than
the ranges a-z, A-Z and 0-9.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_ALPHANUMERIC_RUN = r"\P{Alnum}+"
NOT_SIMPLE_TEXT = r"[^\p{Alnum} \t\n\f\r]"
NOT_MERCHANT_TEXT = r"[^\p{Alnum} \t\n\f\r*#-]"
WHITE_SPACE_RUN = r"[ \t\n\f\r]+"
# Processor prefixes that precede a merchant name, and where the name ends.
MERCHANT_PATTERN = r"^(?:SQ[ \t\n\f\r]*\*|PYPL[ \t\n\f\r]*\*|CL[ \t\n\f\r]*\*|\*[ \t\n\f\r]*)?([^*#-]+)"


def _without_hyphens(raw: Column) -> Column:
    return F.replace(F.coalesce(raw, F.lit("")), F.lit("-"), F.lit(""))


def clean_description(raw: Column) -> Column:
    """Drop hyphens, turn each run of other specials and white space into one space, lower-case, trim.

    NULL gives ''.
    """
    return F.trim(F.lower(F.regexp_replace(_without_hyphens(raw), NOT_ALPHANUMERIC_RUN, " ")))


def merchant_match(raw: Column) -> Column:
    """The part of the text that names the merchant, '' when there is none. The costly half of the cleaner."""
    kept = F.regexp_replace(_without_hyphens(raw), NOT_MERCHANT_TEXT, "")
    return F.regexp_extract(F.regexp_replace(kept, WHITE_SPACE_RUN, " "), MERCHANT_PATTERN, 1)


def merchant_name(match: Column) -> Column:
    return F.trim(F.lower(F.nullif(match, F.lit(""))))


def clean_merchant(raw: Column) -> Column:
    """Merchant name without processor prefix and reference suffix; NULL when nothing is left to match."""
    return merchant_name(merchant_match(raw))


def clean_description_simple(raw: Column) -> Column:
    """Ingest variant: specials vanish instead of becoming spaces. NULL gives ''."""
    kept = F.regexp_replace(F.coalesce(raw, F.lit("")), NOT_SIMPLE_TEXT, "")
    return F.trim(F.regexp_replace(F.lower(kept), WHITE_SPACE_RUN, " "))


def substrings(text: Column, size: int) -> Column:
    """All distinct substrings of ``text`` with exactly ``size`` characters, as an array."""
    starts = F.sequence(F.lit(1), F.length(text) - F.lit(size - 1))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))
    return F.when(F.length(text) >= size, grams)
