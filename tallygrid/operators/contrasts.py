"""Weighted combinations of stratum effects: estimates, indices and trends.

Two forms. The direct one first weighs the strata into one series per species, keeps each
series as an array of time steps, and derives everything from it without a join. The other
spells out the contrasts as a long table of coefficients that can be applied to any effects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.intervals import Z975
from tallygrid.functions.names import (
    NAME_PATTERNS,
    estimate_name,
    index_name,
    linear_estimate_name,
    trend_name,
)
from tallygrid.operators.effects import LINE, SERIES

# Widths of the moving windows; the full width of a series is always added.
YEAR_WINDOWS = (6, 12)
CYCLE_WINDOWS = (2, 4)


def with_limits(df: DataFrame, z: float = Z975) -> DataFrame:
    """Add the limits of a normal interval, by default 95 %."""
    half = F.lit(z) * F.sqrt("variance")
    return df.withColumn("lcl", F.col("estimate") - half).withColumn("ucl", F.col("estimate") + half)


def estimate(effects: DataFrame) -> DataFrame:
    """Weighted mean effect over the strata, per species and time step."""
    w = F.col("weight")
    sums = effects.groupBy(*SERIES, "t", "label").agg(
        F.sum(w * F.col("b")).alias("estimate"),
        F.sum(w * w * F.col("var")).alias("variance"),
    )
    return with_limits(sums)


def series(estimates: DataFrame) -> DataFrame:
    """One row per species and frequency with its time steps in order."""
    return estimates.groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("t", "label", "estimate", "variance"))).alias("steps")
    )


def pairwise_index(lines: DataFrame) -> DataFrame:
    """Difference between every two time steps of a series, later minus earlier."""
    pairs = (
        lines.select(*SERIES, "steps", F.posexplode("steps").alias("place", "a"))
        .filter(F.col("place") + 1 < F.size("steps"))
        .withColumn("b", F.explode(F.slice("steps", F.col("place") + 2, F.size("steps"))))
    )
    return with_limits(
        pairs.select(
            *SERIES,
            F.col("a.label").alias("reference"),
            F.col("b.label").alias("alternative"),
            (F.col("b.estimate") - F.col("a.estimate")).alias("estimate"),
            (F.col("a.variance") + F.col("b.variance")).alias("variance"),
        )
    )


def _window_widths(n: Column, year_windows: Sequence[int], cycle_windows: Sequence[int]) -> Column:
    """Widths that fit in a series of ``n`` steps, the full one included, each once."""
    fixed = F.when(
        F.col("frequency") == "cycle", F.array(*[F.lit(w) for w in cycle_windows])
    ).otherwise(F.array(*[F.lit(w) for w in year_windows]))
    fitting = F.filter(F.array_append(fixed, n), lambda w: (w <= n) & (w > 1))
    return F.array_distinct(fitting)


def window_coefficient(place: Column, width: Column) -> Column:
    """Weight of step ``place`` (1, 2, ...) in the least squares slope over ``width`` steps."""
    return (place - (width + 1) / 2) / (width * (width * width - 1) / 12)


def _midpoints(first: Column, width: Column, cycle_len: int) -> list[Column]:
    """Middle of a window: in years, or in cycle numbers with the middle year next to it."""
    is_cycle = F.col("frequency") == "cycle"
    label, t = first["label"], first["t"]
    half = (width - 1) / 2
    in_years = label + half
    return [
        F.when(is_cycle, t + half).otherwise(in_years).alias("midpoint"),
        F.when(is_cycle, label + half * cycle_len + (cycle_len - 1) / 2)
        .otherwise(in_years)
        .alias("mid_year"),
        # the first year of the series plus the offset in steps, whatever a step is
        in_years.alias("start_midpoint"),
    ]


def moving_trend(
    lines: DataFrame,
    year_windows: Sequence[int] = YEAR_WINDOWS,
    cycle_windows: Sequence[int] = CYCLE_WINDOWS,
    cycle_len: int = 3,
    label_mode: str = "cycle",
) -> DataFrame:
    """Slope of the series within every window of the given widths.

    A width that exceeds the series is skipped. ``label_mode="reference"`` labels windows of
    cycles by the first year of the series plus the offset in cycles.
    """
    n = F.size("steps")
    windows = (
        lines.withColumn("width", F.explode(_window_widths(n, year_windows, cycle_windows)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), n - F.col("width") + 1)))
        .withColumn("part", F.slice("steps", F.col("start"), F.col("width")))
    )
    width = F.col("width")
    terms = F.transform(
        "part",
        lambda s, i: F.struct(
            (window_coefficient(i + 1, width) * s["estimate"]).alias("e"),
            (window_coefficient(i + 1, width) * window_coefficient(i + 1, width) * s["variance"]).alias("v"),
        ),
    )

    def total(name: str) -> Column:
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x[name])

    first = F.element_at("part", 1)
    origin = F.element_at("steps", 1)["label"]
    trends = windows.select(
        *SERIES,
        width.cast("int").alias("window"),
        *_midpoints(first, width, cycle_len),
        total("e").alias("estimate"),
        total("v").alias("variance"),
        (origin + F.col("start") - 1 + (width - 1) / 2).alias("reference_midpoint"),
    ).drop("start_midpoint")
    if label_mode == "reference":
        trends = trends.withColumn("midpoint", F.col("reference_midpoint"))
    return with_limits(trends.drop("reference_midpoint"))


def linear_trend(fits: DataFrame) -> DataFrame:
    """Weighted mean slope over the strata per species and frequency."""
    w = F.col("weight")
    sums = fits.groupBy(*SERIES).agg(
        F.sum(w * F.col("beta")).alias("estimate"),
        F.sum(w * w * F.col("var_beta")).alias("variance"),
    )
    return with_limits(sums)


def linear_estimate(fits: DataFrame, effects: DataFrame) -> DataFrame:
    """Fitted level of the lines at every time step, weighted over the strata."""
    away = F.col("t") - F.col("mean_t")
    w = F.col("weight")
    sums = (
        effects.select(*LINE, "t", "label")
        .join(fits, LINE)
        .groupBy(*SERIES, "t", "label")
        .agg(
            F.sum(w * (F.col("alpha") + F.col("beta") * F.col("t"))).alias("estimate"),
            F.sum(w * w * (1 / F.col("sw") + away * away * F.col("var_beta"))).alias("variance"),
        )
    )
    return with_limits(sums)


def contrast_table(
    effects: DataFrame,
    year_windows: Sequence[int] = YEAR_WINDOWS,
    cycle_windows: Sequence[int] = CYCLE_WINDOWS,
) -> DataFrame:
    """Coefficients of every estimate, index and trend on the cells, zeros left out."""
    lines = effects.groupBy(*SERIES, "stratum", "weight").agg(
        F.array_sort(F.collect_list(F.struct("t", "label"))).alias("steps")
    )
    keys = [*SERIES, "stratum", "weight"]
    w = F.col("weight")
    own = lines.select(*keys, F.inline("steps")).select(
        *SERIES,
        F.lit("estimate").alias("kind"),
        estimate_name(F.col("label")).alias("name"),
        "stratum",
        "t",
        w.alias("coef"),
    )
    pairs = (
        lines.select(*keys, "steps", F.posexplode("steps").alias("place", "a"))
        .filter(F.col("place") + 1 < F.size("steps"))
        .withColumn("b", F.explode(F.slice("steps", F.col("place") + 2, F.size("steps"))))
    )
    ends = pairs.unpivot(
        [*SERIES, "stratum", "weight", pairs["a.label"].alias("ref"), pairs["b.label"].alias("alt")],
        [pairs["a.t"].alias("from"), pairs["b.t"].alias("to")],
        "direction",
        "t",
    )
    indices = ends.select(
        *SERIES,
        F.lit("index").alias("kind"),
        index_name(F.col("ref"), F.col("alt")).alias("name"),
        "stratum",
        "t",
        F.when(F.col("direction") == "to", w).otherwise(0 - w).alias("coef"),
    )
    n = F.size("steps")
    windows = (
        lines.withColumn("width", F.explode(_window_widths(n, year_windows, cycle_windows)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), n - F.col("width") + 1)))
        .withColumn("part", F.slice("steps", F.col("start"), F.col("width")))
        .withColumn("head", F.element_at("part", 1))
        .select("*", F.posexplode("part").alias("place", "s"))
    )
    width = F.col("width")
    trends = windows.select(
        *SERIES,
        F.lit("trend").alias("kind"),
        trend_name(_midpoints(F.col("head"), width, 3)[0], width).alias("name"),
        "stratum",
        F.col("s.t").alias("t"),
        (w * window_coefficient(F.col("place") + 1, width)).alias("coef"),
    )
    return own.unionByName(indices).unionByName(trends)


def linear_contrasts(effects: DataFrame) -> DataFrame:
    """Coefficients of the linear trend and estimates on intercepts and slopes per stratum."""
    steps = effects.select(*SERIES, "stratum", "t", "weight")
    fitted = steps.select(
        *SERIES,
        F.lit("linear_estimate").alias("kind"),
        linear_estimate_name(F.col("t")).alias("name"),
        "stratum",
        F.explode(
            F.array(
                F.struct(F.lit("intercept").alias("term"), F.col("weight").alias("coef")),
                F.struct(F.lit("slope").alias("term"), (F.col("weight") * F.col("t")).alias("coef")),
            )
        ).alias("x"),
    ).select("*", "x.term", "x.coef").drop("x")
    slope = steps.select(*SERIES, "stratum", "weight").distinct().select(
        *SERIES,
        F.lit("linear_trend").alias("kind"),
        F.lit("linear_trend").alias("name"),
        "stratum",
        F.lit("slope").alias("term"),
        F.col("weight").alias("coef"),
    )
    return (
        fitted.unionByName(slope)
        .groupBy(*SERIES, "kind", "name", "stratum", "term")
        .agg(F.sum("coef").alias("coef"))
    )


def apply_contrasts(contrasts: DataFrame, effects: DataFrame) -> DataFrame:
    """Estimate and interval of every contrast on independent effects."""
    sums = (
        contrasts.join(effects.select(*SERIES, "stratum", "t", "b", "var"), [*SERIES, "stratum", "t"])
        .groupBy(*SERIES, "kind", "name")
        .agg(
            F.sum(F.col("coef") * F.col("b")).alias("estimate"),
            F.sum(F.col("coef") * F.col("coef") * F.col("var")).alias("variance"),
        )
    )
    return with_limits(sums)


def parse_names(df: DataFrame, name: str = "name") -> DataFrame:
    """Kind of a contrast and the numbers in its name; what does not fit the kind is NULL."""
    text = F.col(name)

    def part(kind: str, group: int, as_type: str) -> Column:
        # a pattern that does not match gives '', which does not cast
        return F.regexp_extract(text, NAME_PATTERNS[kind], group).try_cast(as_type)

    kind = F.lit(None).cast("string")
    for known, pattern in NAME_PATTERNS.items():
        kind = F.when(text.rlike(pattern), known).otherwise(kind)
    return df.select(
        "*",
        kind.alias("kind"),
        part("index", 1, "int").alias("reference"),
        part("index", 2, "int").alias("alternative"),
        F.coalesce(part("estimate", 1, "int"), part("linear_estimate", 1, "int")).alias("year"),
        part("trend", 1, "double").alias("midpoint"),
        part("trend", 2, "int").alias("window"),
    )
