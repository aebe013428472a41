"""Random walks through the effects of a line, and contrasts of effects that are not independent.

A line is a random walk that is observed with known variances where there were visits. Its
posterior given the variance of a step is the solution of a tridiagonal system: one pass forward
and one backward over the array of its time steps. Neighbouring effects are then correlated, and
because the walk has no memory beyond its last step, all covariances follow from the variances and
one number per step, the share of a step's deviation that is inherited from the step before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.contrasts import with_limits
from tallygrid.operators.effects import LINE, SERIES
from tallygrid.operators.families import total

LEAST_STEP = 1e-4  # smallest variance of a step


def _lines(effects: DataFrame) -> DataFrame:
    """A row per line with its time steps in order; ``precision`` is 0 where nobody counted."""
    known = ~F.col("imputed") & F.col("b").isNotNull()
    step = F.struct(
        "t",
        "label",
        "n",
        "c",
        F.when(known, F.col("b")).otherwise(0.0).alias("b"),
        F.when(known, 1 / F.col("var")).otherwise(0.0).alias("precision"),
    )
    return effects.groupBy(*LINE).agg(F.array_sort(F.collect_list(step)).alias("steps"))


def step_variance(lines: DataFrame) -> DataFrame:
    """``tau2`` per series: what successive observed effects differ more than their variances say,
    per time step, over all lines of the series; at least ``LEAST_STEP``."""
    seen = F.filter("steps", lambda s: s["precision"] > 0)
    pairs = lines.select(*SERIES, seen.alias("seen")).withColumn(
        "pairs", F.zip_with("seen", F.slice("seen", 2, F.size("seen")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    )
    both = F.filter("pairs", lambda p: p["a"].isNotNull() & p["b"].isNotNull())
    more = total(
        both,
        lambda p: (p["b"]["b"] - p["a"]["b"]) * (p["b"]["b"] - p["a"]["b"])
        - 1 / p["a"]["precision"]
        - 1 / p["b"]["precision"],
    )
    gone = total(both, lambda p: p["b"]["t"] - p["a"]["t"])
    sums = pairs.select(*SERIES, more.alias("more"), gone.alias("gone")).groupBy(*SERIES)
    return sums.agg(F.sum("more").alias("more"), F.sum("gone").alias("gone")).select(
        *SERIES,
        F.greatest(F.when(F.col("gone") > 0, F.col("more") / F.col("gone")).otherwise(0.0), F.lit(LEAST_STEP)).alias("tau2"),
    )


def _pass(steps: Column, tau2: Column) -> Column:
    """Precision and mean of every step given the observations up to it, in the order of ``steps``."""

    def one(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        inherited = F.when(F.size(done) > 0, last["p"] / (1 + last["p"] * tau2)).otherwise(0.0)
        p = inherited + s["precision"]
        mean = F.when(F.size(done) > 0, last["m"]).otherwise(0.0)
        m = F.when(p > 0, (inherited * mean + s["precision"] * s["b"]) / p).otherwise(0.0)
        return F.concat(done, F.array(F.struct(p.alias("p"), m.alias("m"))))

    return F.aggregate(steps, F.array().cast("array<struct<p:double,m:double>>"), one)


def smoothed_effects(effects: DataFrame, tau2: DataFrame | None = None) -> DataFrame:
    """Posterior mean ``b`` and variance ``var`` of every time step, and ``gain``, the share of the
    deviation of the step before that a step inherits (NULL for the first).

    Within a gap the variance grows with the distance from both ends. A time step outside the
    observed ones keeps the mean of the nearest, its variance grows by ``tau2`` a step.
    """
    lines = _lines(effects)
    fitted = lines.join(step_variance(lines) if tau2 is None else tau2, SERIES)
    tau = F.col("tau2")
    fitted = fitted.withColumn("ahead", _pass(F.col("steps"), tau)).withColumn(
        "behind", F.reverse(_pass(F.reverse("steps"), tau))
    )

    def at(s: Column, i: Column) -> Column:
        here, after = F.col("ahead")[i], F.get("behind", i + 1)
        handed = F.coalesce(after["p"] / (1 + after["p"] * tau), F.lit(0.0))
        p = here["p"] + handed
        before, own = F.get("ahead", i - 1), F.col("behind")[i]
        # Covariance with the step before over the variance of the latter.
        shared = tau / ((before["p"] * tau + 1) * (own["p"] * tau + 1) - 1)
        var_before = 1 / (before["p"] + own["p"] / (1 + own["p"] * tau))
        return F.struct(
            s["t"].alias("t"),
            s["label"].alias("label"),
            s["n"].alias("n"),
            s["c"].alias("c"),
            ((here["p"] * here["m"] + handed * F.coalesce(after["m"], F.lit(0.0))) / p).alias("b"),
            (1 / p).alias("var"),
            (s["precision"] == 0).alias("imputed"),
            F.when(i > 0, shared / var_before).alias("gain"),
        )

    return fitted.select(*LINE, "tau2", F.inline(F.transform("steps", at)))


def correlated_contrasts(contrasts: DataFrame, effects: DataFrame) -> DataFrame:
    """Estimate and interval of every contrast on smoothed effects.

    A contrast of a stratum is an array of coefficients by time step. Its variance is a quadratic
    form in the covariances, summed in one pass: with the sum so far goes its covariance with the
    current step. Strata are independent.
    """
    lines = effects.groupBy(*LINE).agg(
        F.array_sort(F.collect_list(F.struct("t", "b", "var", F.coalesce("gain", F.lit(0.0)).alias("gain")))).alias("steps")
    )
    own = contrasts.groupBy(*LINE, "kind", "name").agg(
        F.map_from_entries(F.collect_list(F.struct("t", "coef"))).alias("coefs")
    )
    first = F.struct(
        F.lit(0.0).alias("estimate"), F.lit(0.0).alias("variance"), F.lit(0.0).alias("with_last")
    )

    def add(acc: Column, s: Column) -> Column:
        a = F.coalesce(F.try_element_at("coefs", s["t"]), F.lit(0.0))
        handed = acc["with_last"] * s["gain"]
        return F.struct(
            (acc["estimate"] + a * s["b"]).alias("estimate"),
            (acc["variance"] + 2 * a * handed + a * a * s["var"]).alias("variance"),
            (handed + a * s["var"]).alias("with_last"),
        )

    sums = (
        own.join(lines, LINE)
        .select(*SERIES, "kind", "name", F.aggregate("steps", first, add).alias("x"))
        .groupBy(*SERIES, "kind", "name")
        .agg(F.sum("x.estimate").alias("estimate"), F.sum("x.variance").alias("variance"))
    )
    return with_limits(sums)
