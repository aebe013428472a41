"""Names of contrasts and other texts derived from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the contrast names, as written and as read back.
NAME_PATTERNS = {
    "index": "^index_(.*)_(.*)$",
    "estimate": "^estimate_(.*)$",
    "trend": "^trend_(.*)_(.*)$",
    "linear_trend": "^linear_trend$",
    "linear_estimate": "^linear_estimate_(.*)$",
}


def estimate_name(label: Column) -> Column:
    return F.format_string("estimate_%d", label)


def index_name(reference: Column, alternative: Column) -> Column:
    return F.format_string("index_%d_%d", reference, alternative)


def trend_name(midpoint: Column, window: Column) -> Column:
    return F.format_string("trend_%.1f_%d", midpoint, window)


def linear_estimate_name(t: Column) -> Column:
    return F.format_string("linear_estimate_%02d", t)


def slug(name: Column) -> Column:
    """Lower case, spaces to dashes, quotes dropped."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, " ", "-"), "'", ""))


def strip_suffix(name: Column) -> Column:
    """Drop a trailing remark in brackets from a group name."""
    return F.regexp_replace(name, r" \(.*\)", "")


def wrapped_hash(digest: Column, width: int = 20) -> Column:
    """Break a long digest once, after ``width`` characters."""
    return F.regexp_replace(digest, "^(.{%d})" % width, "$1 ")


def cycle_period_label(start: Column, length: int = 3) -> Column:
    """First and last year of a cycle, such as ``2007-2009``."""
    return F.concat_ws("-", start.cast("string"), (start + (length - 1)).cast("string"))
