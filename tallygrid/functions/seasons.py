"""Season windows, season periods and multi-year cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MonthDay = tuple[int, int]


def _same_year(date: Column, day: MonthDay) -> Column:
    return F.make_date(F.year(date), F.lit(day[0]), F.lit(day[1]))


def in_season(date: Column, first: MonthDay, last: MonthDay) -> Column:
    """True from midnight of ``first`` up to and including midnight of ``last``."""
    return date.between(_same_year(date, first), _same_year(date, last))


def season_period(date: Column, starts: Sequence[MonthDay]) -> Column:
    """Number of the part of the season: 1 before the first start, then one more per start."""
    later = [(date >= _same_year(date, day)).cast("int") for day in starts]
    period = F.lit(1)
    for passed in later:
        period = period + passed
    return period


def cycle_of(year: Column, base_year: int, length: int = 3) -> Column:
    """Cycle number of a year; the cycle that starts in ``base_year`` is 1.

    Floors, so years before the base year get 0, -1, ...
    """
    return (F.floor((year - F.lit(base_year)) / F.lit(length)) + 1).cast("int")


def cycle_start(cycle: Column, base_year: int, length: int = 3) -> Column:
    return (F.lit(base_year) + F.lit(length) * (cycle - 1)).cast("int")
