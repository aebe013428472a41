"""Indices of groups of species: means on the log scale with propagated variance."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.operators.contrasts import with_limits

THRESHOLD = math.log(0.75)


def composite_members(analyses: DataFrame, groups: DataFrame) -> DataFrame:
    """Analyses of the species of every group, per frequency and type (many to many)."""
    return groups.join(analyses, "species").select(
        "species_group", "frequency", "type", "species", "analysis"
    )


def nested_members(members: DataFrame) -> DataFrame:
    """One row per composite with its members as a sorted array of (species, analysis)."""
    return members.groupBy("species_group", "frequency", "type").agg(
        F.count(F.lit(1)).alias("n_members"),
        F.array_sort(F.collect_list(F.struct("species", "analysis"))).alias("members"),
    )


def composite(results: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean over the species of a group of the same contrast.

    ``results`` has ``estimate`` and ``variance`` per species and contrast ``keys``. The species
    are independent, so the variance is the sum of theirs over the squared number of species.
    """
    n = F.count(F.lit(1))
    sums = (
        results.join(groups.select("species_group", "species"), "species")
        .groupBy("species_group", *keys)
        .agg(
            n.alias("n_species"),
            (F.sum("estimate") / n).alias("estimate"),
            (F.sum("variance") / (n * n)).alias("variance"),
        )
    )
    return with_limits(sums)


def composite_thresholds(groups: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Class bounds of a composite: narrower with more species."""
    scaled = F.lit(threshold) / F.sqrt("n_species")
    return (
        groups.groupBy("species_group")
        .agg(F.count(F.lit(1)).alias("n_species"))
        .select(
            "species_group",
            "n_species",
            scaled.alias("threshold"),
            F.exp(scaled).alias("lower_bound"),
            F.exp(-scaled).alias("upper_bound"),
        )
    )
