"""Result tables on the log scale and the shapes that reports need them in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.effects import class_label, classify
from tallygrid.functions.intervals import Z95, Z975, interval_sd, interval_text, normal_quantile, rescaled
from tallygrid.functions.names import cycle_period_label


def rescale_interval(df: DataFrame, digits: int = 4, z_from: float = Z975, z_to: float = Z95) -> DataFrame:
    """From 95 % to 90 % limits of the same normal distribution, rounded for storage."""
    low, high = rescaled(F.col("estimate"), F.col("lcl"), F.col("ucl"), z_from, z_to)
    return df.withColumns(
        {
            "estimate": F.round("estimate", digits),
            "lcl": F.round(low, digits),
            "ucl": F.round(high, digits),
        }
    )


def result_table(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rescale_interval(df).select(*keys, "estimate", "lcl", "ucl")


def mirror_pairs(index: DataFrame) -> DataFrame:
    """Every comparison in both directions."""
    reversed_pairs = index.withColumns(
        {
            "reference": F.col("alternative"),
            "alternative": F.col("reference"),
            "estimate": 0 - F.col("estimate"),
            "lcl": 0 - F.col("ucl"),
            "ucl": 0 - F.col("lcl"),
        }
    )
    return index.unionByName(reversed_pairs)


def described(df: DataFrame, threshold: Column | float, lang: str = "en") -> DataFrame:
    """Class, label and text of a change on the log scale."""
    effect = classify(F.col("lcl"), F.col("ucl"), threshold)
    return (
        df.withColumn("effect_class", effect)
        .withColumn("label", class_label(F.col("effect_class"), lang))
        .withColumn(
            "change_text",
            interval_text(
                F.col("estimate"), F.col("lcl"), F.col("ucl"), percent=True, sign=True, change=True
            ),
        )
    )


def pair_matrix(index: DataFrame, threshold: float, keys: Sequence[str], lang: str = "en") -> DataFrame:
    """Both directions of every comparison plus each time step against itself."""
    pairs = described(mirror_pairs(index), threshold, lang).select(
        *keys, "reference", "alternative", "estimate", "lcl", "ucl", "effect_class", "label", "change_text"
    )
    ends = F.explode(F.array("reference", "alternative")).alias("reference")
    diagonal = (
        index.select(*keys, ends)
        .distinct()
        .select(
            *keys,
            "reference",
            F.col("reference").alias("alternative"),
            F.lit(0.0).alias("estimate"),
            F.lit("R").alias("effect_class"),
            class_label(F.lit("R"), lang).alias("label"),
            F.lit("").alias("change_text"),
        )
    )
    return pairs.unionByName(diagonal, allowMissingColumns=True)


def fan_bands(df: DataFrame, levels: Sequence[float] = (0.3, 0.6, 0.9)) -> DataFrame:
    """Nested intervals from a 90 % interval, one row per level."""
    from statistics import NormalDist

    sd = interval_sd(F.col("lcl"), F.col("ucl"))
    bands = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("level"),
                F.lit(NormalDist().inv_cdf((1 + p) / 2)).alias("z"),
            )
            for p in levels
        ]
    )
    return (
        df.withColumn("sd", sd)
        .withColumn("band", F.explode(bands))
        .withColumn("level", F.col("band.level"))
        .withColumn("band_lcl", F.col("estimate") - F.col("band.z") * F.col("sd"))
        .withColumn("band_ucl", F.col("estimate") + F.col("band.z") * F.col("sd"))
        .drop("band")
    )


def interval_levels(df: DataFrame, levels: Column) -> DataFrame:
    """Limits of every 90 % interval at each of the levels, an array per row of numbers in (0, 1)."""
    sd, upper = F.col("sd"), (1 + F.col("level")) / 2
    return (
        df.withColumn("sd", interval_sd(F.col("lcl"), F.col("ucl")))
        .withColumn("level", F.explode(levels))
        .drop("lcl", "ucl")
        .withColumn("lcl", normal_quantile(1 - upper, F.col("estimate"), sd))
        .withColumn("ucl", normal_quantile(upper, F.col("estimate"), sd))
    )


def index_steps(pairs: DataFrame, cycle_len: int = 3) -> DataFrame:
    """Left, middle and right end of the step that a comparison covers on a time axis."""
    half = F.when(F.col("frequency") == "cycle", cycle_len / 2 - 0.00001).otherwise(0.49999)
    return (
        pairs.withColumn("sd", interval_sd(F.col("lcl"), F.col("ucl")))
        .withColumn("key", F.format_string("%d-%d", "alternative", "reference"))
        .withColumn("offset", F.explode(F.array(0 - half, F.lit(0.0), half)))
        .withColumn("x", F.col("alternative") + F.col("offset"))
        .drop("offset")
    )


def period_label(frequency: Column, start: Column, cycle_len: int = 3) -> Column:
    """A year, or the first and last year of a cycle."""
    return F.when(frequency == "cycle", cycle_period_label(start, cycle_len)).otherwise(
        start.cast("string")
    )
