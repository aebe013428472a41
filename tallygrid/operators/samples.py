"""From raw samples and observations to visits, counts and zero-filled counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.functions.seasons import MonthDay, in_season, season_period
from tallygrid.schema import require_columns

SEASON = ((3, 1), (7, 16))
PERIOD_STARTS = ((4, 16), (6, 1))


def valid_samples(samples: DataFrame, project: str, end_date=None) -> DataFrame:
    """Counted samples of accepted visits of one project, up to an end date.

    A visit without validation status is dropped, as NULL is not known to differ from -1.
    """
    keep = (
        (F.col("project") == project)
        & (F.col("validation_status") != -1)
        & ~F.col("not_counted")
    )
    if end_date is not None:
        keep = keep & (F.col("start_date") <= F.lit(end_date))
    return samples.filter(keep)


def season_visits(
    valid: DataFrame,
    season: tuple[MonthDay, MonthDay] = SEASON,
    period_starts: Sequence[MonthDay] = PERIOD_STARTS,
    min_year: int | None = None,
) -> DataFrame:
    """Visits within the season, with their year and part of the season."""
    date = F.col("start_date")
    visits = valid.filter(in_season(date, *season)).select(
        "sample_id",
        "point_id",
        F.year(date).cast("int").alias("year"),
        season_period(date, period_starts).alias("period"),
    )
    return visits if min_year is None else visits.filter(F.col("year") >= min_year)


def valid_locations(
    samples: DataFrame, project: str, columns: Sequence[str] = ("square_id", "point_id"), end_date=None
) -> DataFrame:
    """Distinct locations with at least one valid sample, in or out of season."""
    return valid_samples(samples, project, end_date).select(*columns).distinct()


def species_counts(sightings: DataFrame) -> DataFrame:
    """Total per species and sample; partial sums come before the exchange."""
    require_columns(sightings, ["species", "sample_id", "number_min"], "sightings")
    keys = [c for c in ("species", "sample_id", "point_id", "year", "period") if c in sightings.columns]
    return sightings.groupBy(*keys).agg(F.sum("number_min").cast("long").alias("count"))


def common_species(counts: DataFrame, min_observation: int) -> DataFrame:
    """Species with at least ``min_observation`` stored counts."""
    return (
        counts.groupBy("species")
        .agg(F.count(F.lit(1)).alias("samples"))
        .filter(F.col("samples") >= min_observation)
    )


def visit_hierarchy(visits: DataFrame, points: DataFrame) -> DataFrame:
    """Visits with the square and stratum of their point."""
    return visits.join(points, "point_id")


def found_points(counts: DataFrame) -> DataFrame:
    """Points where a species was counted at least once."""
    return counts.filter(F.col("count") > 0).select("species", "point_id").distinct()


def zero_fill(visits: DataFrame, counts: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """A count for every visit to every point where the species was ever found.

    A species that was not recorded during a visit gets zero. Points where it was never found
    are left out: the relevance rules start by dropping them, and with them no table of all
    visits times all species has to be made.
    """
    pairs = found_points(counts) if found is None else found
    return (
        visits.join(pairs, "point_id")
        .join(counts.select("species", "sample_id", "count"), ["species", "sample_id"], "left")
        .withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    )


def zero_fill_species(visits: DataFrame, counts: DataFrame, species) -> DataFrame:
    """A count of one species for every visit, also to points where it was never found."""
    own = counts.filter(F.col("species") == species).select("sample_id", "count")
    return (
        visits.join(own, "sample_id", "left")
        .withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
        .withColumn("species", F.lit(species))
    )


def frame_size(frame: DataFrame) -> DataFrame:
    """Number of squares of the sampling frame per stratum."""
    return (
        frame.filter(F.col("stratum").isNotNull())
        .groupBy("stratum")
        .agg(F.count(F.lit(1)).alias("n_frame"))
    )


def available_species(partitions: DataFrame, members: DataFrame) -> DataFrame:
    """Species of a list for which counts are stored."""
    return members.join(partitions.select("species").distinct(), "species", "left_semi")
