"""Which points, squares, strata and periods matter for a species: all species in one go.

The rules look at two kinds of numbers: how often a species was found and how often its points
were visited. Both are summed before anything is joined, so visits without the species are
counted, not stored. Every rule only drops rows, so the number of positive counts can only fall
from rule to rule, and checking it once after the last rule equals checking it after each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.functions.seasons import cycle_of
from tallygrid.schema import require_columns

PLACE = ["species", "stratum", "square"]


def point_effort(visits: DataFrame, points: DataFrame) -> DataFrame:
    """Visits per point, year and period; summed first, so a busy point joins as a few rows."""
    visited = visits.groupBy("point_id", "year", "period").agg(F.count(F.lit(1)).alias("n"))
    return visited.join(points.select("point_id", "square", "stratum"), "point_id")


def point_cells(counts: DataFrame, effort: DataFrame) -> DataFrame:
    """Zero-filled totals per species, point, year and period.

    ``n`` visits (with or without the species) to points where it was ever found, ``n_pos``
    positive counts, their sum ``c`` and sum of squares ``c2``. A row per point and species
    carries its cells in one array, no longer than the years times the periods.
    """
    require_columns(counts, ["species", "point_id", "year", "period", "count"], "counts")
    cell = (F.col("year") * 100 + F.col("period")).alias("cell")
    found = (
        counts.filter(F.col("count") > 0)
        .groupBy("species", "point_id", cell)
        .agg(
            F.count(F.lit(1)).alias("n_pos"),
            F.sum("count").cast("long").alias("c"),
            F.sum(F.col("count") * F.col("count")).cast("long").alias("c2"),
        )
        .repartition("point_id")
        .groupBy("species", "point_id")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("cell", F.struct("n_pos", "c", "c2")))
            ).alias("found")
        )
    )
    visited = (
        effort.select("point_id", "square", "stratum", F.struct(cell, "year", "period", "n").alias("visit"))
        .repartition("point_id")
        .groupBy("point_id", "square", "stratum")
        .agg(F.collect_list("visit").alias("visits"))
    )
    tally = F.try_element_at("found", F.col("visit.cell"))
    return (
        found.join(visited, "point_id")
        .select("species", "stratum", "square", "point_id", "found", F.explode("visits").alias("visit"))
        .select(
            *PLACE,
            "point_id",
            "visit.year",
            "visit.period",
            "visit.n",
            *[F.coalesce(tally[c], F.lit(0).cast("long")).alias(c) for c in ("n_pos", "c", "c2")],
        )
    )


def square_profile(cells: DataFrame, base_year: int, cycle_len: int = 3) -> DataFrame:
    """One row per species and square with its totals per cycle and period."""
    return (
        cells.groupBy(*PLACE, cycle_of(F.col("year"), base_year, cycle_len).alias("cycle"), "period")
        .agg(*[F.sum(c).alias(c) for c in ("n", "n_pos", "c")])
        .groupBy(*PLACE)
        .agg(F.collect_list(F.struct("cycle", "period", "n", "n_pos", "c")).alias("tallies"))
    )


def cycles_found(tallies: Column, periods: Column | None = None) -> Column:
    """Number of cycles with a positive count, in the given periods or in any."""

    def counts(t: Column) -> Column:
        positive = t["n_pos"] > 0
        return positive if periods is None else positive & F.array_contains(periods, t["period"])

    return F.size(F.array_distinct(F.transform(F.filter(tallies, counts), lambda t: t["cycle"])))


def square_min_cycles(profile: DataFrame, min_cycle: int = 2) -> DataFrame:
    """Squares where the species was found in enough cycles."""
    return (
        profile.withColumn("n_cycles", cycles_found(F.col("tallies")))
        .filter(F.col("n_cycles") >= min_cycle)
        .select(*PLACE, F.col("n_cycles").cast("long"))
    )


def stratum_min_squares(squares: DataFrame, min_stratum: int = 3) -> DataFrame:
    """Strata with enough qualifying squares of the species."""
    return (
        squares.groupBy("species", "stratum")
        .agg(F.count(F.lit(1)).alias("n_squares"))
        .filter(F.col("n_squares") >= min_stratum)
    )


def candidate_strata(
    profile: DataFrame, n_periods: int, min_cycle: int, min_stratum: int, proportion: float
) -> DataFrame:
    """Strata after the first square, stratum and period rules, with the periods of the species.

    ``means`` holds the mean count per period over the strata that are left, zeros included;
    periods with a mean below ``proportion`` of the highest are dropped, and the first one with
    the highest mean is the reference. Season periods are numbered 1 to ``n_periods``, so one
    pass over the squares sums them side by side; all that follows has a row per stratum.
    """
    numbers = range(1, n_periods + 1)

    def of_period(p: int, field: str) -> Column:
        own = F.filter("tallies", lambda t: t["period"] == p)
        return F.aggregate(own, F.lit(0).cast("long"), lambda s, t: s + t[field])

    per_stratum = (
        profile.filter(cycles_found(F.col("tallies")) >= min_cycle)
        .groupBy("species", "stratum")
        .agg(
            F.count(F.lit(1)).alias("n_squares"),
            *[F.sum(of_period(p, f)).alias(f"{f}_{p}") for p in numbers for f in ("n", "c")],
        )
        .filter(F.col("n_squares") >= min_stratum)
    )
    of_species = Window.partitionBy("species")
    mean = [
        F.struct(
            F.lit(p).alias("period"),
            F.try_divide(
                F.sum(f"c_{p}").over(of_species), F.sum(f"n_{p}").over(of_species)
            ).alias("mean"),
        )
        for p in numbers
    ]
    # a period without visits has no mean
    visited = F.filter("means", lambda m: m["mean"].isNotNull())
    best = F.array_max(F.transform("means", lambda m: m["mean"]))
    kept = F.filter("means", lambda m: m["mean"] >= F.lit(proportion) * F.col("best"))
    top = F.filter("means", lambda m: m["mean"] == F.col("best"))
    return (
        per_stratum.withColumn("means", F.array(*mean))
        .withColumn("means", visited)
        .withColumn("best", best)
        .select(
            "species",
            "stratum",
            F.transform(kept, lambda m: m["period"]).alias("periods"),
            F.element_at(top, 1)["period"].alias("reference_period"),
            "means",
        )
    )


def period_filter(candidates: DataFrame) -> DataFrame:
    """Kept periods of every species with their means, from its candidate strata."""
    kept = F.filter("means", lambda m: F.array_contains(F.col("periods"), m["period"]))
    return (
        candidates.select("species", "reference_period", F.inline(kept))
        .distinct()
        .select(
            "species",
            "period",
            "mean",
            (F.col("period") == F.col("reference_period")).alias("is_reference"),
        )
    )


def relevant_strata(
    profile: DataFrame,
    candidates: DataFrame,
    min_observation: int,
    min_stratum: int,
    min_cycle: int,
) -> DataFrame:
    """Strata that pass the second square and stratum rule, for species with enough data."""
    in_periods = F.filter("tallies", lambda t: F.array_contains(F.col("periods"), t["period"]))
    positives = F.aggregate(in_periods, F.lit(0).cast("long"), lambda s, t: s + t["n_pos"])
    strata = candidates.select("species", "stratum", "periods", "reference_period")
    totals = (
        second_square_rule(profile, strata, min_cycle)
        .groupBy("species", "stratum", "periods", "reference_period")
        .agg(F.count(F.lit(1)).alias("n_squares"), F.sum(positives).alias("n_pos"))
        .filter(F.col("n_squares") >= min_stratum)
    )
    total = F.sum("n_pos").over(Window.partitionBy("species"))
    return (
        totals.withColumn("total", total)
        .filter(F.col("total") >= min_observation)
        .select("species", "stratum", "periods", "reference_period")
    )


def second_square_rule(profile: DataFrame, strata: DataFrame, min_cycle: int) -> DataFrame:
    """Squares found in enough cycles within the kept periods; implies the first square rule."""
    return profile.join(strata, ["species", "stratum"]).filter(
        cycles_found(F.col("tallies"), F.col("periods")) >= min_cycle
    )


def gate_trace(
    profile: DataFrame,
    candidates: DataFrame,
    min_observation: int,
    min_stratum: int,
    min_cycle: int,
) -> DataFrame:
    """Positive counts of every species at each of six gates, and the first gate it fails at.

    The gates: all counts (0), and what is left after the square rule (1), the stratum rule (2), the
    periods (3), the square rule within the periods (4) and the stratum rule on those squares (5).
    ``pos_1`` to ``pos_5`` are NULL behind the gate that failed; ``gate`` is NULL if none did. One
    pass over the squares: each gate is a sum under its own conditions, first per stratum.
    """

    def positives(tallies: Column) -> Column:
        return F.aggregate(tallies, F.lit(0).cast("long"), lambda s, t: s + t["n_pos"])

    inside = F.filter("tallies", lambda t: F.array_contains(F.col("periods"), t["period"]))
    squares = profile.join(
        candidates.select("species", "stratum", "periods"), ["species", "stratum"], "left"
    ).select(
        "species",
        "stratum",
        positives(F.col("tallies")).alias("all"),
        F.when(F.col("periods").isNotNull(), positives(inside)).otherwise(0).alias("within"),
        (cycles_found(F.col("tallies")) >= min_cycle).alias("first"),
        F.when(F.col("periods").isNotNull(), cycles_found(F.col("tallies"), F.col("periods")) >= min_cycle)
        .otherwise(False)
        .alias("second"),
    )

    def kept(column: str, condition: Column | str) -> Column:
        return F.sum(F.when(F.col(condition) if isinstance(condition, str) else condition, F.col(column)).otherwise(0))

    strata = squares.groupBy("species", "stratum").agg(
        F.sum("all").alias("n0"),
        kept("all", "first").alias("n1"),
        kept("within", "first").alias("n3"),
        kept("within", "second").alias("n4"),
        (F.count_if("first") >= min_stratum).alias("enough"),
        (F.count_if("second") >= min_stratum).alias("enough_within"),
    )
    totals = strata.groupBy("species").agg(
        F.sum("n0").alias("pos_0"),
        F.sum("n1").alias("pos_1"),
        kept("n1", "enough").alias("pos_2"),
        kept("n3", "enough").alias("pos_3"),
        kept("n4", "enough").alias("pos_4"),
        kept("n4", "enough_within").alias("pos_5"),
    )
    gate = F.lit(None).cast("int")
    for i in reversed(range(6)):
        gate = F.when(F.col(f"pos_{i}") < min_observation, i).otherwise(gate)
    reached = [F.when(F.col("gate").isNull() | (F.col("gate") >= i), F.col(f"pos_{i}")).alias(f"pos_{i}") for i in range(6)]
    return totals.withColumn("gate", gate).select("species", *reached, "gate")


def relevant_cells(
    cells: DataFrame, profile: DataFrame, strata: DataFrame, min_cycle: int, base_year: int, cycle_len: int
) -> DataFrame:
    """The cells of relevant squares and periods."""
    squares = second_square_rule(profile, strata, min_cycle).select(
        *PLACE, "periods", "reference_period"
    )
    return (
        cells.join(squares, PLACE)
        .filter(F.array_contains("periods", F.col("period")))
        .withColumn("cycle", cycle_of(F.col("year"), base_year, cycle_len))
        .withColumn("is_reference", F.col("period") == F.col("reference_period"))
        .drop("periods", "reference_period")
    )


def relevant_samples(visits: DataFrame, counts: DataFrame, relevant: DataFrame) -> DataFrame:
    """The zero-filled samples behind the relevant cells, one row per species and sample."""
    wanted = relevant.groupBy(*PLACE, "point_id").agg(
        F.collect_set(F.struct("period", "is_reference")).alias("periods")
    )
    period = F.filter("periods", lambda p: p["period"] == F.col("period"))
    rows = (
        visits.join(wanted, "point_id")
        .withColumn("kept", F.try_element_at(period, F.lit(1)))
        .filter(F.col("kept").isNotNull())
        .withColumn("is_reference", F.col("kept.is_reference"))
        .drop("periods", "kept")
    )
    return rows.join(
        counts.select("species", "sample_id", "count"), ["species", "sample_id"], "left"
    ).withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def year_spans(relevant: DataFrame) -> DataFrame:
    """Years with data per species and stratum, and the first and last year of the species."""
    years = relevant.groupBy("species", "stratum").agg(
        F.collect_set("year").alias("seen"),
        F.min("year").alias("own_first"),
        F.max("year").alias("own_last"),
        F.max(F.when(F.col("is_reference"), F.col("period"))).alias("own_reference"),
    )
    of_species = Window.partitionBy("species")
    return years.select(
        "species",
        "stratum",
        "seen",
        F.min("own_first").over(of_species).alias("first_year"),
        F.max("own_last").over(of_species).alias("last_year"),
        F.max("own_reference").over(of_species).alias("reference_period"),
    )


def padded_rows(spans: DataFrame) -> DataFrame:
    """A row for every year and stratum of a species without data, with a negative id."""
    order = Window.partitionBy("species").orderBy("year", "stratum")
    missing = F.array_except(F.sequence("first_year", "last_year"), F.col("seen"))
    return (
        spans.select("species", "stratum", "reference_period", F.explode(missing).alias("year"))
        .withColumn("sample_id", -F.row_number().over(order).cast("long"))
        .select(
            "species",
            "stratum",
            "sample_id",
            "year",
            F.col("reference_period").alias("period"),
            F.lit(True).alias("padded"),
        )
    )


def complete_grid(
    samples: DataFrame, spans: DataFrame, base_year: int, cycle_len: int = 3
) -> DataFrame:
    """Relevant samples plus a padded row for every year and stratum without any.

    Padded rows have the reference period, no place and no count. They are appended, so the
    samples themselves are not moved; ``spans`` is a table of ``year_spans``, stored so that
    its size is known.
    """
    start = spans.select("species", "first_year").distinct()
    return (
        samples.select(
            "species", "stratum", "square", "point_id", "sample_id", "year", "period", "count"
        )
        .withColumn("padded", F.lit(False))
        .unionByName(padded_rows(spans), allowMissingColumns=True)
        .join(start, "species")
        .withColumn("cycle", cycle_of(F.col("year"), base_year, cycle_len))
        .withColumn("cyear", (F.col("year") - F.col("first_year") + 1).cast("int"))
        .drop("first_year")
    )


def square_summary(relevant: DataFrame) -> DataFrame:
    """Relevant points, visits and positive counts per species and square."""
    return (
        relevant.groupBy(*PLACE, "point_id")
        .agg(F.sum("n").alias("visits"), F.sum("n_pos").alias("n_pos"))
        .groupBy(*PLACE)
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.sum("visits").alias("visits"),
            F.sum("n_pos").alias("n_pos"),
        )
    )


def design_choice(squares: DataFrame, strata: DataFrame) -> DataFrame:
    """Which terms the model of a species needs.

    A period term with more than one period, a point term with more than two points per square,
    slopes per stratum with more than one stratum.
    """
    sizes = (
        squares.groupBy("species", "stratum")
        .agg(F.sum("points").alias("points"), F.count(F.lit(1)).alias("squares"))
        .join(strata.select("species", "stratum", F.size("periods").alias("periods")), ["species", "stratum"])
        .groupBy("species")
        .agg(
            F.max("periods").cast("long").alias("n_periods"),
            F.sum("points").alias("n_points"),
            F.sum("squares").alias("n_squares"),
            F.count(F.lit(1)).alias("n_strata"),
        )
    )
    return sizes.select(
        "*",
        (F.col("n_periods") > 1).alias("period_term"),
        (F.col("n_points") > 2 * F.col("n_squares")).alias("point_term"),
        (F.col("n_strata") > 1).alias("stratum_slopes"),
    )
