"""Effects adjusted for where and when was counted: a log-linear model with crossed factors.

The mean of a count is the product of a level per stratum and time step, a factor per period and a
factor per place, the square or the point. Its maximum likelihood is found by proportional fitting in
turn: given levels and periods, the factor of a place is its total over what is expected of it, which
every place works out for itself from the array of its cells; given the places, levels and periods
only need the sums of the place factors over the visits, a number per stratum, time step and period.
So a round is one exchange of sums, and its result, a row per series, is stored before the next one.
Rounds end when no level moves by more than the tolerance; a series says whether it got there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.seasons import cycle_of, cycle_start
from tallygrid.operators.effects import SERIES
from tallygrid.operators.families import total
from tallygrid.staging import Staging

TOLERANCE, ROUNDS, TURNS = 1e-9, 100, 8


def place_cells(
    relevant: DataFrame, choice: DataFrame, base_year: int, cycle_len: int = 3, places: str = "design"
) -> DataFrame:
    """A row per series, stratum and place with its cells (label, period, n, c).

    ``choice`` decides per species: without a period term all periods are 0; the place is the point
    with a point term, else the square. ``places`` may be ``point`` or ``square`` for all.
    """
    point = F.col("point_term") if places == "design" else F.lit(places == "point")
    place = F.when(point, F.concat_ws("/", "square", F.col("point_id").cast("string"))).otherwise(F.col("square"))
    cycle = cycle_start(cycle_of(F.col("year"), base_year, cycle_len), base_year, cycle_len)
    labels = F.array(
        F.struct(F.lit("year").alias("frequency"), F.col("year").cast("int").alias("label")),
        F.struct(F.lit("cycle").alias("frequency"), cycle.cast("int").alias("label")),
    )
    return (
        relevant.join(choice.select("species", "period_term", "point_term"), "species")
        .select(
            "species",
            "stratum",
            place.cast("string").alias("place"),
            F.when(F.col("period_term"), F.col("period")).otherwise(0).alias("period"),
            "n",
            "c",
            F.inline(labels),
        )
        .groupBy(*SERIES, "stratum", "place", "label", "period")
        .agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
        .groupBy(*SERIES, "stratum", "place")
        .agg(F.collect_list(F.struct("label", "period", "n", "c")).alias("cells"))
    )


def _level(stratum: Column, label: Column) -> Column:
    return F.concat_ws("|", label.cast("string"), stratum)


def _start(cells: DataFrame) -> DataFrame:
    """Mean counts as levels, ones as period factors, and the totals that every round has to meet."""
    rows = cells.select(*SERIES, "stratum", F.inline("cells"))
    levels = (
        rows.groupBy(*SERIES, "stratum", "label")
        .agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
        .groupBy(*SERIES)
        .agg(F.collect_list(F.struct(_level(F.col("stratum"), F.col("label")).alias("key"), "stratum", "label", "n", "c")).alias("levels"))
    )
    periods = (
        rows.groupBy(*SERIES, "period")
        .agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
        .groupBy(*SERIES)
        .agg(F.collect_list(F.struct("period", "n", "c")).alias("periods"))
    )
    return levels.join(periods, SERIES).select(
        *SERIES,
        "levels",
        "periods",
        F.map_from_entries(F.transform("levels", lambda x: F.struct(x["key"], x["c"] / x["n"]))).alias("a"),
        F.map_from_entries(F.transform("periods", lambda x: F.struct(x["period"], F.lit(1.0)))).alias("p"),
        F.lit(1.0).alias("moved"),
    )


def _with_factors(cells: DataFrame, state: DataFrame) -> DataFrame:
    """The places with their factors ``s`` given levels and periods."""
    key = lambda x: _level(F.col("stratum"), x["label"])
    expected = total(F.col("cells"), lambda x: x["n"] * F.col("a")[key(x)] * F.col("p")[x["period"]])
    own = total(F.col("cells"), lambda x: x["c"])
    joined = cells.join(state.select(*SERIES, "a", "p"), SERIES)
    return joined.withColumn("s", F.when(expected > 0, own / expected).otherwise(0.0))


def _sums(placed: DataFrame) -> DataFrame:
    """Visits times place factors per stratum, time step and period, an array per series."""
    return (
        placed.select(*SERIES, "stratum", "s", F.inline("cells"))
        .groupBy(*SERIES, "stratum", "label", "period")
        .agg(F.sum(F.col("n") * F.col("s")).alias("w"))
        .groupBy(*SERIES)
        .agg(F.collect_list(F.struct(_level(F.col("stratum"), F.col("label")).alias("key"), "period", "w")).alias("sums"))
    )


def _turn(state: Column, _: Column) -> Column:
    """New levels given the periods, then new periods given the levels."""

    def levels(p: Column) -> Column:
        def one(x: Column) -> Column:
            own = F.filter("sums", lambda w: w["key"] == x["key"])
            expected = total(own, lambda w: w["w"] * p[w["period"]])
            return F.struct(x["key"], F.when(expected > 0, x["c"] / expected).otherwise(0.0))

        return F.map_from_entries(F.transform("levels", one))

    def periods(a: Column) -> Column:
        def one(x: Column) -> Column:
            own = F.filter("sums", lambda w: w["period"] == x["period"])
            expected = total(own, lambda w: w["w"] * a[w["key"]])
            return F.struct(x["period"], F.when(expected > 0, x["c"] / expected).otherwise(0.0))

        return F.map_from_entries(F.transform("periods", one))

    made = F.transform(F.array(levels(state["p"])), lambda a: F.struct(a.alias("a"), periods(a).alias("p")))
    return F.element_at(made, 1)


def _next(state: DataFrame, sums: DataFrame, turns: int) -> DataFrame:
    first = F.struct(F.col("a").alias("a"), F.col("p").alias("p"))
    fitted = state.join(sums, SERIES).withColumn(
        "new", F.aggregate(F.sequence(F.lit(1), F.lit(turns)), first, _turn)
    )
    fitted = fitted.select(*SERIES, "levels", "periods", F.col("a").alias("old"), "new.a", "new.p")
    shifts = F.transform(
        "levels",
        lambda x: F.when(F.col("old")[x["key"]] > 0, F.abs(F.col("a")[x["key"]] / F.col("old")[x["key"]] - 1)).otherwise(
            F.col("a")[x["key"]]
        ),
    )
    return fitted.withColumn("moved", F.array_max(shifts)).drop("old")


def fit_factors(
    cells: DataFrame, staging: Staging, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """The state of every series after the last round, and the places with their factors."""
    cells = staging.write("place_cells", cells)
    state = staging.write("factors", _start(cells))
    for _ in range(rounds):
        state = staging.write("factors", _next(state, _sums(_with_factors(cells, state)), TURNS))
        if state.filter(F.col("moved") >= tolerance).isEmpty():  # one row per series
            break
    return state, _with_factors(cells, state)


def adjusted_effects(
    cells: DataFrame, staging: Staging, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> DataFrame:
    """Level of every stratum and time step at the mean place and the mean period.

    Factors of places have mean one over the visits of a stratum, those of periods over the visits of
    a species; ``b`` is the logarithm of the level and ``var`` the inverse of its total count, as if
    the factors were known. A level without individuals gets half an individual. Where places and
    time steps fall apart into sets that share no visit, their levels are not comparable.
    """
    state, placed = fit_factors(cells, staging, tolerance, rounds)
    visits = total(F.col("cells"), lambda x: x["n"])
    means = (
        placed.select(*SERIES, "stratum", "s", visits.alias("n"))
        .groupBy(*SERIES, "stratum")
        .agg((F.sum(F.col("n") * F.col("s")) / F.sum("n")).alias("mean_s"))
    )
    mean_p = total(F.col("periods"), lambda x: x["n"] * F.col("p")[x["period"]]) / total(
        F.col("periods"), lambda x: x["n"]
    )
    rows = state.select(
        *SERIES,
        "a",
        mean_p.alias("mean_p"),
        (F.col("moved") < tolerance).alias("converged"),
        F.inline("levels"),
    ).join(means, [*SERIES, "stratum"])
    level = F.when(F.col("c") > 0, F.col("a")[F.col("key")] * F.col("mean_s") * F.col("mean_p")).otherwise(0.5 / F.col("n"))
    return rows.select(
        *SERIES,
        "stratum",
        "label",
        "n",
        "c",
        F.log(level).alias("b"),
        (1 / F.when(F.col("c") > 0, F.col("c").cast("double")).otherwise(0.5)).alias("var"),
        "converged",
    )
