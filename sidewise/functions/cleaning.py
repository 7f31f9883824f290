"""Scalar clean-up rules, each a function from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .measures import as_col

# Period spellings that mean the same period.
FULL_MATCH_NAMES = ["all", "match", "full time", "ft", "0", "overall"]
FIRST_HALF_NAMES = ["1st", "first half", "1h", "period1", "1"]
SECOND_HALF_NAMES = ["2nd", "second half", "2h", "period2", "2"]


def normalize_period(c: Column | str) -> Column:
    """ALL / 1ST / 2ND; an unknown or missing spelling counts as the full match."""
    name = F.lower(as_col(c))
    return (
        F.when(name.isin(FIRST_HALF_NAMES), "1ST").when(name.isin(SECOND_HALF_NAMES), "2ND").otherwise("ALL")
    )


def period_label(c: Column | str) -> Column:
    code = as_col(c)
    return (
        F.when(code == "ALL", "Full match")
        .when(code == "1ST", "First half")
        .when(code == "2ND", "Second half")
        .otherwise(code)
    )


def metric_key(key: Column | str, name: Column | str) -> Column:
    """The key, or the display name where the key is missing or empty."""
    return F.coalesce(F.nullif(as_col(key), F.lit("")), as_col(name))


def clean_metric_key(c: Column | str) -> Column:
    """Lower case with every run of other characters turned into one underscore."""
    text = F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit("unknown"))
    return F.lower(F.regexp_replace(text, "[^a-zA-Z0-9]+", "_")).alias("clean_key")


def epoch_date(seconds: Column | str) -> Column:
    """UTC date of an epoch-seconds value; NULL when missing or zero."""
    s = as_col(seconds).cast("bigint")
    return F.to_date(F.timestamp_seconds(F.nullif(s, F.lit(0).cast("bigint"))))


def date_bucket(seconds: Column | str) -> Column:
    """``YYYY-MM-DD`` partition value, ``unknown`` for undated records."""
    return F.coalesce(F.date_format(epoch_date(seconds), "yyyy-MM-dd"), F.lit("unknown"))


def parse_extracted_at(c: Column | str) -> Column:
    """ISO timestamp text, with ``Z`` or a numeric offset; NULL when unreadable."""
    return F.try_to_timestamp(as_col(c))


def fill_second_half(total: Column | str, first: Column | str, second: Column | str) -> Column:
    """Second-half score, derived from the total where only the first half is known."""
    return F.coalesce(as_col(second), as_col(total) - as_col(first))


def advantage(home: Column | str, away: Column | str) -> Column:
    h, a = as_col(home), as_col(away)
    return (
        F.when(h > a, "HOME").when(h < a, "AWAY").when(h == a, "EQUAL").otherwise("UNKNOWN")
    )


def side_share(side: Column | str, other: Column | str) -> Column:
    """Percent of the two-sided total, to two digits; NULL unless the total is positive."""
    s, o = as_col(side), as_col(other)
    total = s + o
    return F.when(total > 0, F.round(s * 100 / F.nullif(total, F.lit(0)), 2))


def result_letter(code: Column | str, own: int, other: int, draw: int) -> Column:
    c = as_col(code)
    return F.when(c == own, "W").when(c == other, "L").when(c == draw, "D")
