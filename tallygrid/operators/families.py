"""Effects by the distribution of the counts: Poisson, negative binomial, and both with extra zeros.

The model has a mean per stratum and time step, and per species and frequency one size (negative
binomial) and one share of extra zeros. What it needs of the data are the totals of the cells and,
for the size, how many counts lie above each value: samples are read once for the latter and never
leave their tasks. A series is then one row with an array of cells and an array of tails, and is
fitted in array expressions: expectation and maximisation for the zeros and the means, a guarded
Newton step for the logarithm of the size, until nothing moves any more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.operators.effects import LINE, SERIES

# The families and their parameters.
FAMILIES = ("poisson", "nbinomial", "zeroinflatedpoisson1", "zeroinflatednbinomial1")
WITH_SIZE = ("nbinomial", "zeroinflatednbinomial1")
WITH_ZEROS = ("zeroinflatedpoisson1", "zeroinflatednbinomial1")

STEPS, TOLERANCE = 500, 1e-10
LARGEST = 13.815510557964274  # logarithm of a size of a million: no overdispersion to speak of


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """A value that is used more than once, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column, term: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + term(x))


def count_tails(counts: DataFrame, relevant: DataFrame) -> DataFrame:
    """Per species an array of (low, high, above): ``above`` relevant counts exceed each of the
    values from ``low`` to ``high`` - 1."""
    places = relevant.select("species", "point_id", "year", "period")
    histogram = (
        counts.filter(F.col("count") > 0)
        .join(places, ["species", "point_id", "year", "period"], "left_semi")
        .groupBy("species", "count")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A row per species and different count from here on.
    order = Window.partitionBy("species").orderBy("count")
    above = F.sum("n").over(order.rowsBetween(0, Window.unboundedFollowing))
    return (
        histogram.select(
            "species",
            F.struct(
                F.lag("count", 1, 0).over(order).cast("long").alias("low"),
                F.col("count").cast("long").alias("high"),
                above.alias("above"),
            ).alias("tail"),
        )
        .groupBy("species")
        .agg(F.collect_list("tail").alias("tails"))
    )


def _no_count(mean: Column, size: Column | None) -> Column:
    """Probability of a zero that is no extra one."""
    return F.exp(-mean) if size is None else F.exp(size * F.log(size / (size + mean)))


def _step(has_size: bool, has_zeros: bool) -> Callable[[Column, Column], Column]:
    """One round of a fit from its state: zeros, log_size, means, moved, steps."""

    def size_of(s: Column) -> Column | None:
        return F.exp(s["log_size"]) if has_size else None

    def extra(s: Column) -> Column:
        """Expected extra zeros of every cell."""
        if not has_zeros:
            return F.transform("cells", lambda c: F.lit(0.0))

        def one(c: Column, i: Column) -> Column:
            chance = _no_count(s["means"][i], size_of(s))
            return (c["n"] - c["n_pos"]) * s["zeros"] / (s["zeros"] + (1 - s["zeros"]) * chance)

        return F.transform("cells", one)

    def newton(s: Column, seen: Column, means: Column) -> Column:
        """Change of the logarithm of the size."""
        k = size_of(s)
        cells = F.zip_with(seen, means, lambda m, mu: F.struct(m.alias("m"), mu.alias("mu")))

        def over_tails(power: int) -> Column:
            def inside(x: Column) -> Column:
                values = F.sequence(x["low"], x["high"] - 1)
                return x["above"] * total(values, lambda j: 1 / (k + j) if power == 1 else 1 / ((k + j) * (k + j)))

            return total(F.col("tails"), inside)

        first = over_tails(1) + total(cells, lambda c: c["m"] * F.log(k / (k + c["mu"])))
        second = total(cells, lambda c: c["m"] * (1 / k - 1 / (k + c["mu"]))) - over_tails(2)
        slopes = F.struct((k * first).alias("g"), (k * first + k * k * second).alias("h"))
        return let(
            slopes,
            lambda d: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.when(d["h"] < 0, -d["g"] / d["h"]).otherwise(F.signum(d["g"])))),
        )

    def moved_to(s: Column, seen: Column, zeros: Column) -> Column:
        def with_means(means: Column) -> Column:
            def with_size(log_size: Column) -> Column:
                shifts = F.zip_with(
                    means, s["means"], lambda a, b: F.when(b > 0, F.abs(a / b - 1)).otherwise(F.abs(a - b))
                )
                moved = F.greatest(F.array_max(shifts), F.abs(log_size - s["log_size"]), F.abs(zeros - s["zeros"]))
                return F.struct(
                    zeros.alias("zeros"),
                    log_size.alias("log_size"),
                    means.alias("means"),
                    moved.alias("moved"),
                    (s["steps"] + 1).alias("steps"),
                )

            if not has_size:
                return with_size(s["log_size"])
            log_size = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), s["log_size"] + newton(s, seen, means)))
            return let(log_size, with_size)

        return let(F.zip_with("cells", seen, lambda c, m: c["c"] / m), with_means)

    def step(s: Column, _: Column) -> Column:
        def with_extra(w: Column) -> Column:
            seen = F.zip_with("cells", w, lambda c, x: c["n"] - x)
            zeros = total(w, lambda x: x) / total(F.col("cells"), lambda c: c["n"])
            return let(seen, lambda m: moved_to(s, m, zeros))

        return F.when(s["moved"] < TOLERANCE, s).otherwise(let(extra(s), with_extra))

    return step


def fit_families(series: DataFrame, steps: int = STEPS) -> DataFrame:
    """Fit of every series: family, zeros, size, means of its cells, steps and status.

    ``series``: species, frequency, family, cells (stratum, t, n, n_pos, c with n > 0), tails. A
    family that is not known is an error of the row: its status is ``error`` and it has no fit.
    """
    empty = total(F.col("cells"), lambda c: c["n"] - c["n_pos"]) / total(F.col("cells"), lambda c: c["n"])

    def fitted(family: str) -> Column:
        has_size, has_zeros = family in WITH_SIZE, family in WITH_ZEROS
        first = F.struct(
            (empty / 2 if has_zeros else F.lit(0.0)).alias("zeros"),
            F.lit(0.0).alias("log_size"),
            F.transform("cells", lambda c: c["c"].cast("double") / c["n"]).alias("means"),
            F.lit(1.0).alias("moved"),
            F.lit(0).alias("steps"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, _step(has_size, has_zeros))

    fit = F.when(F.col("family") == FAMILIES[0], fitted(FAMILIES[0]))
    for family in FAMILIES[1:]:
        fit = fit.when(F.col("family") == family, fitted(family))
    size = F.when(F.col("family").isin(*WITH_SIZE), F.exp("fit.log_size"))
    status = (
        F.when(F.col("fit").isNull(), "error")
        .when(F.col("fit.moved") < TOLERANCE, "converged")
        .otherwise("not converged")
    )
    return series.withColumn("fit", fit).select(
        *SERIES,
        "family",
        "cells",
        "fit.zeros",
        size.alias("size"),
        F.coalesce("fit.means", F.transform("cells", lambda c: F.lit(None).cast("double"))).alias("means"),
        "fit.steps",
        status.alias("status"),
    )


def family_effects(grid: DataFrame, tails: DataFrame, families: DataFrame, steps: int = STEPS) -> DataFrame:
    """Effect and variance of every cell by the family of its species; NULL where nobody counted.

    The effect is the logarithm of the mean of the counts that are no extra zeros; a cell without
    individuals gets half an individual. Its variance is the inverse of the information on that
    logarithm at the fitted size and zeros, less what is lost as zeros do not tell their kind. A
    negative rest is possible in cells of a few zeros only, which then keep the information on all.
    """
    seen = F.filter(
        F.collect_list(F.struct("stratum", "t", "n", "n_pos", "c")), lambda c: c["n"] > 0
    )
    series = (
        grid.groupBy(*SERIES)
        .agg(F.array_sort(seen).alias("cells"))
        .join(tails, "species")
        .join(families.select("species", "family"), "species")
    )
    fits = fit_families(series, steps)
    cell, mean = F.col("x.cells"), F.col("x.means")
    rows = fits.select(
        *SERIES, "family", "zeros", "size", "steps", "status", F.explode(F.arrays_zip("cells", "means")).alias("x")
    ).select(
        *SERIES, "family", "zeros", "size", "steps", "status",
        cell["stratum"].alias("stratum"), cell["t"].alias("t"), mean.alias("raw"),
        (cell["n"] - cell["n_pos"]).alias("empty"), cell["n"].alias("visits"), cell["c"].alias("count"),
    )
    chance = F.when(F.col("size").isNull(), F.exp(-F.col("raw"))).otherwise(
        F.exp(F.col("size") * F.log(F.col("size") / (F.col("size") + F.col("raw"))))
    )
    share = F.when(F.col("zeros") > 0, F.col("zeros") / (F.col("zeros") + (1 - F.col("zeros")) * chance)).otherwise(0.0)
    rows = rows.withColumn("share", share).withColumn("own", F.col("visits") - F.col("empty") * F.col("share"))
    half = F.when(F.col("raw").isNotNull(), 0.5 / F.col("own"))
    rows = rows.withColumn("mean", F.when(F.col("count") > 0, F.col("raw")).otherwise(half))
    damped = F.when(F.col("size").isNull(), 1.0).otherwise(F.col("size") / (F.col("size") + F.col("mean")))
    full = F.col("own") * F.col("mean") * damped
    pull = F.col("mean") * damped
    lost = F.col("empty") * F.col("share") * (1 - F.col("share")) * pull * pull
    fitted = rows.select(
        *LINE, "t", "family", "zeros", "size", "steps", "status",
        F.log("mean").alias("b"), (1 / F.when(full > lost, full - lost).otherwise(full)).alias("var"),
    )
    return grid.join(fitted, [*LINE, "t"], "left")
