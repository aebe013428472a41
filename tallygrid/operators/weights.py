"""Post-stratification weights and the tables about coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def surveyed_squares(effort: DataFrame) -> DataFrame:
    """Squares with at least one visit, per stratum."""
    return effort.groupBy("stratum").agg(F.countDistinct("square").alias("t_surveyed"))


def stratum_weights(squares: DataFrame, surveyed: DataFrame, frame_sizes: DataFrame) -> DataFrame:
    """Weight of a stratum for a species: frame size times the share of relevant squares.

    ``squares`` has a row per species and relevant square. Weights sum to one per species.
    """
    relevant = squares.groupBy("species", "stratum").agg(F.count(F.lit(1)).alias("r_relevant"))
    raw = (
        relevant.join(surveyed, "stratum")
        .join(frame_sizes, "stratum")
        .withColumn("raw", F.col("n_frame") * F.col("r_relevant") / F.col("t_surveyed"))
    )
    total = F.sum("raw").over(Window.partitionBy("species"))
    return raw.select(
        "species", "stratum", "n_frame", "r_relevant", "t_surveyed", (F.col("raw") / total).alias("weight")
    )


def stratum_weight_table(squares: DataFrame, weights: DataFrame, max_points: int = 6) -> DataFrame:
    """Squares by number of relevant points, in one pass; larger squares go to ``points_over``."""
    by_points = [
        F.count_if(F.col("points") == k).alias(f"points_{k}") for k in range(1, max_points + 1)
    ]
    return (
        squares.groupBy("species", "stratum")
        .agg(
            *by_points,
            F.count_if(F.col("points") > max_points).alias("points_over"),
            F.sum("points").alias("points_total"),
            F.count(F.lit(1)).alias("relevant"),
            F.sum("visits").alias("visits"),
        )
        .join(weights.select("species", "stratum", "weight"), ["species", "stratum"])
    )


def coverage_table(
    weight_table: DataFrame, surveyed: DataFrame, frame_sizes: DataFrame, max_points: int = 6
) -> DataFrame:
    """What the weights mean: estimated occupied squares, visits, share of relevant points."""
    share = F.col("points_total") / (F.lit(max_points) * F.col("relevant"))
    return (
        weight_table.join(surveyed, "stratum")
        .join(frame_sizes, "stratum")
        .select(
            "species",
            "stratum",
            F.format_string("%.1f%%", F.round(100 * F.col("weight"), 1)).alias("weight_text"),
            F.round(F.col("relevant") * F.col("n_frame") / F.col("t_surveyed"), 1).alias("present"),
            "relevant",
            F.col("t_surveyed").alias("surveyed"),
            F.col("n_frame").alias("total"),
            "visits",
            F.format_string("%.1f%%", F.round(100 * share, 1)).alias("points_text"),
        )
    )
