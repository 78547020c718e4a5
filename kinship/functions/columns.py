"""Scalar column helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a field is "numeric" when it consists of ASCII digits only
# (the empty string included), the record classifier's test.
DIGITS_PATTERN = "^[0-9]*$"

# Fixed value: text of the not-followed-back report, "<nickname> follows ID
# <followed id> (No follow back)".
FOLLOW_REPORT_MIDDLE = " follows ID "
FOLLOW_REPORT_SUFFIX = " (No follow back)"


def tokens(line: Column | str, sep: str = ",") -> Column:
    """Split like a tokenizer that skips empty tokens: ``a,,b`` -> [a, b].

    One regular-expression pass collecting the maximal runs of non-separator
    characters (code-generated, no per-element lambda)."""
    col = F.col(line) if isinstance(line, str) else line
    return F.regexp_extract_all(col, F.lit(f"[^{re.escape(sep)}]+"), 0)


# Fixed value: characters removed by trimming, U+0000 through U+0020 (space
# and all control characters), as the hobby key is trimmed.
TRIM_PATTERN = "^[\\x00-\\x20]+|[\\x00-\\x20]+$"


def trim_controls(value: Column) -> Column:
    """Strip leading and trailing characters up to U+0020 (not only spaces)."""
    return F.regexp_replace(value, TRIM_PATTERN, "")


def is_digits(value: Column) -> Column:
    return value.rlike(DIGITS_PATTERN)


def epoch_days(value: Column | str) -> Column:
    """A calendar value as a whole number of days since 1970-01-01 (integer time mode)."""
    col = F.col(value) if isinstance(value, str) else value
    return F.unix_date(F.to_date(col)).cast("long")


def render_follow_report(nickname: Column, followed_id: Column) -> Column:
    return F.concat(
        nickname,
        F.lit(FOLLOW_REPORT_MIDDLE),
        followed_id.cast("string"),
        F.lit(FOLLOW_REPORT_SUFFIX),
    )
