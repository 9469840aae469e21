"""String extraction as built-in column expressions (no UDFs).

Spark's ``regexp_extract`` gives ``''`` (not null) when the pattern does not
match; pandas ``str.extract`` gives NaN, so no-match is mapped to null first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_or_null(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def trailing_number(c: Column | str, missing: int = -1) -> Column:
    """Trailing digit run ``(\\d+)$`` as a number; no digits -> ``missing``."""
    return F.coalesce(extract_or_null(c, r"(\d+)$").try_cast("bigint"),
                      F.lit(missing).cast("bigint"))


def prefix_before_number(c: Column | str, missing: str = "M") -> Column:
    """Text before the last ``' <digits>'`` at the end; otherwise ``missing``."""
    return F.coalesce(extract_or_null(c, r"(.*) \d+$"), F.lit(missing))


def first_char(c: Column | str, missing: str = "M") -> Column:
    return F.coalesce(F.substring(_c(c), 1, 1), F.lit(missing))


def last_name(c: Column | str) -> Column:
    """Text before the first comma (``^(.+?),``)."""
    return extract_or_null(c, r"^(.+?),")


def title_by_split(c: Column | str) -> Column:
    """Second piece of a split on ``', '``, then its text before the first
    ``'.'``.  Missing piece -> null (not an ANSI index error)."""
    after = F.try_element_at(F.split(_c(c), ", "), F.lit(2))
    return F.try_element_at(F.split(after, r"\."), F.lit(1))


def title_by_regex(c: Column | str) -> Column:
    """First `` <letters>.`` word; no match -> ``''``."""
    return F.regexp_extract(_c(c), r" ([A-Za-z]+)\.", 1)


# Fixed value: ASCII punctuation, the set removed from family names.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def surname_clean(c: Column | str) -> Column:
    """Cut at the first ``'('``, keep the text before the first ``','``,
    remove every ASCII punctuation character, trim."""
    before_paren = F.split_part(_c(c), F.lit("("), F.lit(1))
    family = F.split_part(before_paren, F.lit(","), F.lit(1))
    return F.trim(F.translate(family, PUNCTUATION, ""))
