"""Where and when the survey took place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.seasons import cycle_of
from tallygrid.operators.ranking import number_rows
from tallygrid.staging import Staging


def effort(point_effort: DataFrame) -> DataFrame:
    """Visits per stratum, square and year."""
    return point_effort.groupBy("stratum", "square", "year").agg(F.sum("n").alias("visits"))


def square_years(square_effort: DataFrame) -> DataFrame:
    """One row per square with its survey years in order (bounded by the age of the survey)."""
    return square_effort.groupBy("stratum", "square").agg(
        F.array_sort(F.collect_set("year")).alias("years")
    )


def with_usable(squares: DataFrame, base_year: int, cycle_len: int = 3) -> DataFrame:
    """A square can be of use if its first and last visit lie in different cycles."""
    first, last = F.element_at("years", 1), F.element_at("years", -1)
    return squares.withColumn(
        "usable",
        cycle_of(first, base_year, cycle_len) < cycle_of(last, base_year, cycle_len),
    )


def effort_history(
    squares: DataFrame, base_year: int, staging: Staging, cycle_len: int = 3, depth: int = 7
) -> DataFrame:
    """Order of the squares by their history: first and last year, then all years in turn.

    A history that ends earlier comes last, equal histories are ordered by square. ``depth`` is
    the number of years that are shown in columns of their own; it does not affect the order.
    """
    beyond = F.array(F.lit((1 << 31) - 1))  # after every year
    wide = with_usable(squares, base_year, cycle_len).select(
        "stratum",
        "square",
        "usable",
        F.concat("years", beyond).alias("_history"),
        F.element_at("years", 1).alias("first_year"),
        F.element_at("years", -1).alias("last_year"),
        *[F.try_element_at("years", F.lit(k)).alias(f"year_{k}") for k in range(2, depth + 1)],
    )
    order = [F.col(c).asc_nulls_last() for c in ("first_year", "last_year", "_history", "square", "stratum")]
    return number_rows(wide, order, "place", staging).drop("_history")


def effort_histogram(squares: DataFrame, base_year: int, cycle_len: int = 3) -> DataFrame:
    """Squares per stratum, usability and number of years surveyed."""
    return (
        with_usable(squares, base_year, cycle_len)
        .groupBy("stratum", "usable", F.size("years").alias("n_years"))
        .agg(F.count(F.lit(1)).alias("squares"))
    )


def potential_squares(
    squares: DataFrame, base_year: int, cycle_len: int = 3, min_cycle: int = 2
) -> DataFrame:
    """Squares surveyed in enough cycles, per year and stratum, with the strata in order of size."""
    cycles = F.array_distinct(F.transform("years", lambda y: cycle_of(y, base_year, cycle_len)))
    per_year = (
        squares.filter(F.size(cycles) >= min_cycle)
        .select("stratum", F.explode("years").alias("year"))
        .groupBy("stratum", "year")
        .agg(F.count(F.lit(1)).alias("squares"))
    )
    # strata x years: as small as the design
    means = per_year.groupBy("stratum").agg((F.sum("squares") / F.count(F.lit(1))).alias("mean_squares"))
    ranked = means.agg(
        F.array_sort(F.collect_list(F.struct((-F.col("mean_squares")).alias("key"), "stratum"))).alias("all")
    ).select(F.posexplode("all").alias("place", "s"))
    order = ranked.select(F.col("s.stratum").alias("stratum"), (F.col("place") + 1).alias("stratum_order"))
    return per_year.join(order, "stratum")
