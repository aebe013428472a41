"""Effects per species, stratum and time step, and the linear model through them.

A saturated Poisson model per cell has a closed form: the effect is the log of the mean count
and its variance the inverse of the total count. Totals are summed from the relevant cells in
one pass; all that follows works on species x strata x time steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.functions.seasons import cycle_of, cycle_start

SERIES = ["species", "frequency"]
LINE = ["species", "frequency", "stratum"]
HALVINGS = 20  # of a step of the scoring


def time_cells(relevant: DataFrame, base_year: int, cycle_len: int = 3) -> DataFrame:
    """Totals per species, stratum and time step, by year and by cycle.

    A year counts from the first year of the species (1, 2, ...), a cycle has its own number.
    The totals per year are partitioned by species once; all later steps keep to that.
    """
    names = ("n", "n_pos", "c", "c2")
    years = (
        relevant.groupBy("species", "stratum", "year")
        .agg(*[F.sum(c).alias(c) for c in names])
        .repartition("species")
    )
    first = F.min("year").over(Window.partitionBy("species"))
    cycle = cycle_of(F.col("year"), base_year, cycle_len)
    steps = F.array(
        F.struct(
            F.lit("year").alias("frequency"),
            (F.col("year") - F.col("first") + 1).cast("int").alias("t"),
            F.col("year").alias("year"),
        ),
        F.struct(
            F.lit("cycle").alias("frequency"),
            cycle.alias("t"),
            cycle_start(cycle, base_year, cycle_len).alias("year"),
        ),
    )
    return (
        years.withColumn("first", first)
        .select("species", "stratum", *names, F.inline(steps))
        .groupBy("species", "frequency", "stratum", "t", "year")
        .agg(*[F.sum(c).alias(c) for c in names])
    )


def full_grid(cells: DataFrame, cycle_len: int = 3) -> DataFrame:
    """Every time step between the first and last of a species, in each of its strata."""
    of_series = Window.partitionBy(*SERIES)
    step = F.when(F.col("frequency") == "cycle", cycle_len).otherwise(1)
    lines = (
        cells.withColumn("first", F.min("t").over(of_series))
        .withColumn("last", F.max("t").over(of_series))
        .groupBy(*LINE)
        .agg(
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            # label of time step 0, the same for every row of a series
            F.min(F.col("year") - F.col("t") * step).alias("origin"),
            F.map_from_entries(
                F.collect_list(F.struct("t", F.struct("n", "n_pos", "c", "c2")))
            ).alias("cells"),
        )
    )
    cell = F.try_element_at("cells", F.col("t"))
    zero = F.lit(0).cast("long")
    return lines.withColumn("t", F.explode(F.sequence("first", "last"))).select(
        *LINE,
        "t",
        (F.col("origin") + F.col("t") * step).cast("int").alias("label"),
        *[F.coalesce(cell[c], zero).alias(c) for c in ("n", "n_pos", "c", "c2")],
    )


def fill_gaps(df: DataFrame, keys: list[str], t: str, value: str, variance: str) -> DataFrame:
    """Fill unknown values along a line, as the mean of a random walk between its known points.

    Between two known points by linear interpolation, outside them flat. The variance is the
    larger one of the neighbours. A line is as long as the survey has time steps.
    """
    order = Window.partitionBy(*keys).orderBy(t)
    back = order.rowsBetween(Window.unboundedPreceding, 0)
    ahead = order.rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.struct(t, value, variance))
    before, after = F.last(known, True).over(back), F.first(known, True).over(ahead)
    left, right = F.col("_before"), F.col("_after")
    share = (F.col(t) - left[t]) / (right[t] - left[t])
    between = left[value] + (right[value] - left[value]) * share
    filled = df.withColumn("_before", before).withColumn("_after", after)
    return (
        filled.withColumn("imputed", F.col(value).isNull())
        .withColumn(
            value,
            F.when(~F.col("imputed"), F.col(value))
            .when(left.isNull(), right[value])
            .when(right.isNull(), left[value])
            .otherwise(between),
        )
        .withColumn(
            variance,
            F.when(~F.col("imputed"), F.col(variance)).otherwise(
                F.greatest(left[variance], right[variance])
            ),
        )
        .drop("_before", "_after")
    )


def stratum_effects(grid: DataFrame) -> DataFrame:
    """Effect ``b`` and variance ``var`` of every cell; cells without visits are imputed.

    A cell with visits but no individuals gets half an individual.
    """
    seen = F.col("n") > 0
    total = F.when(F.col("c") > 0, F.col("c").cast("double")).otherwise(0.5)
    cells = grid.withColumn("b", F.when(seen, F.log(total / F.col("n")))).withColumn(
        "var", F.when(seen, 1 / total)
    )
    return fill_gaps(cells, LINE, "t", "b", "var")


def dispersion(grid: DataFrame) -> DataFrame:
    """Evidence against a Poisson distribution per species, on the yearly cells.

    ``phi`` is Pearson's statistic over its degrees of freedom, ``zero_ratio`` the number of
    zeros over the number expected.
    """
    mean = F.col("c") / F.col("n")
    pearson = F.when(F.col("c") > 0, F.col("c2") / mean - F.col("c")).otherwise(0.0)
    sums = (
        grid.filter((F.col("frequency") == "year") & (F.col("n") > 0))
        .groupBy("species")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("cells"),
            F.sum(pearson).alias("pearson"),
            F.sum(F.col("n") - F.col("n_pos")).alias("zeros"),
            F.sum(F.col("n") * F.exp(-mean)).alias("expected_zeros"),
        )
    )
    return sums.select(
        "species",
        "n",
        "cells",
        "zeros",
        F.when(F.col("n") > F.col("cells"), F.col("pearson") / (F.col("n") - F.col("cells"))).alias("phi"),
        (F.col("zeros") / F.col("expected_zeros")).alias("zero_ratio"),
    )


def choose_family(evidence: DataFrame, max_phi: float = 1.5, max_zero_ratio: float = 1.5) -> DataFrame:
    """Poisson unless the data show overdispersion, excess zeros or both."""
    over, zeros = F.col("phi") > max_phi, F.col("zero_ratio") > max_zero_ratio
    return evidence.withColumn(
        "family",
        F.when(over & zeros, "zeroinflatednbinomial1")
        .when(over, "nbinomial")
        .when(zeros, "zeroinflatedpoisson1")
        .otherwise("poisson"),
    )


def inflate_variance(effects: DataFrame, evidence: DataFrame) -> DataFrame:
    """Quasi-Poisson: variances times the overdispersion of the species, if above one.

    ``phi`` stays with the effects, so that lines and criteria are scaled by it as well.
    """
    return (
        effects.join(evidence.select("species", "phi"), "species", "left")
        .withColumn("phi", F.greatest(F.coalesce("phi", F.lit(1.0)), F.lit(1.0)))
        .withColumn("var", F.col("var") * F.col("phi"))
    )


def weighted(effects: DataFrame, weights: DataFrame) -> DataFrame:
    """Effects with the weight of their stratum."""
    return effects.join(weights.select("species", "stratum", "weight"), ["species", "stratum"])


def _line_keys(effects: DataFrame) -> list[str]:
    """A line has one weight and one overdispersion; they are kept if the effects carry them."""
    return LINE + [c for c in ("weight", "phi") if c in effects.columns]


def _phi(df: DataFrame) -> Column:
    """Overdispersion of a row; 1 where none was estimated."""
    return F.col("phi") if "phi" in df.columns else F.lit(1.0)


def line_fits(effects: DataFrame) -> DataFrame:
    """Weighted regression of the observed effects on time, per species and stratum.

    Weights are the totals behind the effects (half an individual for none). ``alpha`` is the
    level at t = 0, ``beta`` the slope, ``mean_t`` the weighted mean time, ``sw`` the inverse
    variance of the level at that time. A stratum with a single time step has slope 0.
    Overdispersion of the effects multiplies both variances.
    """
    w = F.when(F.col("c") > 0, F.col("c").cast("double")).otherwise(0.5)
    x, y = F.col("t"), F.col("b")
    keys = _line_keys(effects)
    sums = (
        effects.filter(~F.col("imputed"))
        .groupBy(*keys)
        .agg(
            F.sum(w).alias("sw"),
            F.sum(w * x).alias("swx"),
            F.sum(w * x * x).alias("swxx"),
            F.sum(w * y).alias("swy"),
            F.sum(w * x * y).alias("swxy"),
        )
    )
    det = F.col("sw") * F.col("swxx") - F.col("swx") * F.col("swx")
    beta = (F.col("sw") * F.col("swxy") - F.col("swx") * F.col("swy")) / F.col("det")
    return (
        sums.withColumn("det", det)
        .withColumn("beta", F.when(F.col("det") > 0, beta).otherwise(0.0))
        .select(
            *keys,
            (F.col("sw") / _phi(effects)).alias("sw"),
            ((F.col("swy") - F.col("beta") * F.col("swx")) / F.col("sw")).alias("alpha"),
            "beta",
            (F.col("swx") / F.col("sw")).alias("mean_t"),
            F.when(F.col("det") > 0, _phi(effects) * F.col("sw") / F.col("det")).otherwise(0.0).alias("var_beta"),
        )
    )


def exact_fits(effects: DataFrame, steps: int = 50, tolerance: float = 1e-9) -> DataFrame:
    """The same lines by maximum likelihood: Fisher scoring from the weighted regression.

    A step that lowers the likelihood is halved, up to ``HALVINGS`` times. ``converged`` says whether
    the last full step was below ``tolerance``; a line without it has the values it had got to, as
    where all individuals were counted at one end. A single time step needs no scoring. The observed
    cells of a line travel as one array, no longer than the time steps.
    """
    start = line_fits(effects)
    keys = _line_keys(effects)
    cells = (
        effects.filter(F.col("n") > 0)
        .groupBy(*LINE)
        .agg(F.collect_list(F.struct("t", "n", "c")).alias("cells"))
    )

    def mu(cell: Column, s: Column) -> Column:
        return cell["n"] * F.exp(s["alpha"] + s["beta"] * cell["t"])

    def total(term) -> Column:
        return F.aggregate("cells", F.lit(0.0), lambda acc, cell: acc + term(cell))

    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def likelihood(s: Column) -> Column:
        return total(lambda d: d["c"] * (s["alpha"] + s["beta"] * d["t"]) - mu(d, s))

    def sums(s: Column) -> Column:
        return F.struct(
            total(lambda d: mu(d, s)).alias("w"),
            total(lambda d: mu(d, s) * d["t"]).alias("wx"),
            total(lambda d: mu(d, s) * d["t"] * d["t"]).alias("wxx"),
            total(lambda d: d["c"] - mu(d, s)).alias("r"),
            total(lambda d: (d["c"] - mu(d, s)) * d["t"]).alias("rx"),
        )

    def direction(x: Column) -> Column:
        det = x["w"] * x["wxx"] - x["wx"] * x["wx"]
        return F.struct(
            F.when(det > 0, (x["wxx"] * x["r"] - x["wx"] * x["rx"]) / det).alias("alpha"),
            F.when(det > 0, (x["w"] * x["rx"] - x["wx"] * x["r"]) / det).alias("beta"),
        )

    def moved(s: Column, d: Column) -> Column:
        """The state after the largest share of a step that does not lower the likelihood."""
        size = F.greatest(F.abs(d["alpha"]), F.abs(d["beta"]))

        def after(share: Column) -> Column:
            return F.struct(
                (s["alpha"] + share * d["alpha"]).alias("alpha"), (s["beta"] + share * d["beta"]).alias("beta")
            )

        now = likelihood(s)
        shares = F.array(*[F.lit(0.5**k) for k in range(HALVINGS + 1)])
        better = let(now, lambda a: F.filter(shares, lambda h: likelihood(after(h)) >= a - 1e-12 * F.abs(a)))
        share = F.try_element_at(better, F.lit(1))

        def state(h: Column) -> Column:
            there = after(F.coalesce(h, F.lit(0.0)))
            # Without a usable step, or with none that helps, there is nothing more to do.
            stuck = h.isNull() | size.isNull()
            return F.struct(
                F.coalesce(there["alpha"], s["alpha"]).alias("alpha"),
                F.coalesce(there["beta"], s["beta"]).alias("beta"),
                F.coalesce(size < tolerance, F.lit(False)).alias("converged"),
                (stuck | (size < tolerance)).alias("done"),
            )

        return let(share, state)

    def step(s: Column, _: Column) -> Column:
        return F.when(s["done"], s).otherwise(let(sums(s), lambda x: let(direction(x), lambda d: moved(s, d))))

    single = F.size("cells") < 2
    first = F.struct(
        F.col("alpha").alias("alpha"),
        F.col("beta").alias("beta"),
        single.alias("converged"),
        single.alias("done"),
    )
    fitted = start.join(cells, LINE).withColumn(
        "fit", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), first, step)
    )
    info = fitted.withColumn("x", sums(F.col("fit"))).select("*", "x.w", "x.wx", "x.wxx")
    det = F.col("w") * F.col("wxx") - F.col("wx") * F.col("wx")
    return info.select(
        *keys,
        (F.col("w") / _phi(effects)).alias("sw"),
        "fit.alpha",
        "fit.beta",
        (F.col("wx") / F.col("w")).alias("mean_t"),
        F.when(~single & (det > 0), _phi(effects) * F.col("w") / det).otherwise(0.0).alias("var_beta"),
        "fit.converged",
    )


def information_criteria(effects: DataFrame, fits: DataFrame) -> DataFrame:
    """Akaike's criterion of both models per species and frequency, up to a shared constant.

    The non-linear model has a parameter per observed cell and no deviance; the linear one has
    two per stratum and the deviance of its lines, divided by the overdispersion if there is one.
    The lines should be those of ``exact_fits``: the deviance is smallest there.
    """
    mu = F.col("n") * F.exp(F.col("alpha") + F.col("beta") * F.col("t"))
    log_part = F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / mu)).otherwise(0.0)
    sums = (
        effects.filter(~F.col("imputed"))
        .join(fits.drop("weight", "phi"), LINE)
        .groupBy(*SERIES)
        .agg(
            F.count(F.lit(1)).alias("cells"),
            F.countDistinct("stratum").alias("lines"),
            F.sum((log_part - (F.col("c") - mu)) / _phi(effects)).alias("half_deviance"),
        )
    )
    return sums.select(
        *SERIES,
        (2.0 * F.col("cells")).alias("ic_non_linear"),
        (4.0 * F.col("lines") + 2.0 * F.col("half_deviance")).alias("ic_linear"),
    )
