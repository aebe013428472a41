"""Store a survey: its dataset, its result tables and its open data, one folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.operators import lineage
from tallygrid.operators.intervals import result_table
from tallygrid.operators.lineage import analysis_key
from tallygrid.plans.survey import Survey
from tallygrid.schema import describe_columns
from tallygrid.sources.sinks import export_csv, prune_partitions, write_table

LIMITS = {
    "estimate": "estimate on the log scale",
    "lcl": "5% quantile on the log scale",
    "ucl": "95% quantile on the log scale",
}


def dataset_tables(survey: Survey) -> dict[str, tuple[DataFrame, list[str], dict[str, str]]]:
    """Tables of the dataset with their sorting columns and comments, counts excepted."""
    source = survey.source
    points = source.points(survey.design.end_date)
    return {
        "stratum": (
            survey.frame_sizes,
            ["stratum"],
            {"stratum": "name of the stratum", "n_frame": "squares in the sampling frame"},
        ),
        "square": (
            points.select("square", "stratum").distinct(),
            ["square"],
            {"square": "name of the square", "stratum": "stratum of the square"},
        ),
        "point": (
            points.select("point_id", "square"),
            ["point_id"],
            {"point_id": "identifier of the point", "square": "square of the point"},
        ),
        "species": (source.species(survey.design.end_date), ["species"], {"species": "identifier of the species"}),
        "species_group": (source.groups(), ["species_group", "species"], {"species": "member"}),
        "visit": (
            survey.visits,
            ["sample_id"],
            {"year": "year of the visit", "period": "part of the season"},
        ),
    }


def store_dataset(survey: Survey, folder: str, strict: bool = True) -> dict[str, DataFrame]:
    """Write the dataset; counts get a partition per species with enough samples.

    Partitions of species that fell below the minimum are deleted.
    """
    stored = {
        name: write_table(describe_columns(df, comments), f"{folder}/{name}", sorting, strict)
        for name, (df, sorting, comments) in dataset_tables(survey).items()
    }
    counts = describe_columns(
        survey.common_counts.select("species", "sample_id", "count"),
        {"sample_id": "identifier of the sample", "count": "number of individuals"},
    )
    path = f"{folder}/observation"
    stored["observation"] = write_table(counts, path, ["sample_id"], strict, partition_by=["species"])
    prune_partitions(survey.spark, path, "species", survey.common_species)
    return stored


def result_tables(survey: Survey) -> dict[str, tuple[DataFrame, list[str], dict[str, str]]]:
    """The twelve result tables with their keys and comments."""

    def keyed(df: DataFrame, kind: str, keys: list[str], name: str = "species"):
        analysis = analysis_key(F.col(name), F.col("frequency"), F.lit(kind)).alias("analysis")
        return df.select(analysis, *keys, "estimate", "lcl", "ucl"), ["analysis", *keys], LIMITS

    pair, window = ["reference", "alternative"], ["window", "midpoint"]
    year = ["year"]
    levels = survey.estimate_results.withColumnRenamed("label", "year")
    fitted = result_table(survey.linear_estimate, ["species", "frequency", "label"])
    group_trends = result_table(
        survey.composite_moving_trend, ["species_group", "frequency", "window", "midpoint"]
    )
    parents = lineage.analysis_dag(survey.analyses, survey.members)
    weights = survey.weight_table.withColumn(
        "analysis", analysis_key(F.col("species"), F.lit("year"), F.lit("linear"))
    ).drop("species", "points_total")
    return {
        "stratum": (survey.frame_sizes, ["stratum"], {"n_frame": "squares in the frame"}),
        "effort": (
            survey.square_effort,
            ["stratum", "square", "year"],
            {"visits": "number of visited point locations"},
        ),
        "meta": (
            survey.meta,
            ["analysis"],
            {"ic": "information criterion, up to a constant per species and frequency"},
        ),
        "parent": (
            parents.filter("NOT is_root").select("analysis", "parent"),
            ["analysis", "parent"],
            {"parent": "analysis that this one needs"},
        ),
        "index": keyed(survey.index_results, "non linear", pair),
        "estimate": keyed(levels, "non linear", year),
        "moving_trend": keyed(survey.trend_results, "non linear", window),
        "linear_trend": keyed(survey.linear_results, "linear", []),
        "linear_estimate": keyed(fitted.withColumnRenamed("label", "year"), "linear", year),
        "composite_index": keyed(survey.composite_results, "non linear", pair, "species_group"),
        "composite_moving_trend": keyed(group_trends, "non linear", window, "species_group"),
        "stratum_weight": (weights, ["analysis", "stratum"], {"weight": "weight of the stratum"}),
    }


def store_results(survey: Survey, folder: str, strict: bool = True) -> dict[str, DataFrame]:
    return {
        name: write_table(describe_columns(df, comments), f"{folder}/{name}", keys, strict, unique=True)
        for name, (df, keys, comments) in result_tables(survey).items()
    }


def store_exports(survey: Survey, folder: str) -> None:
    """Write the six open-data tables as CSV."""
    keys = ["species_name", "frequency"]
    exports = {
        "estimate": [*keys, "year"],
        "trend": keys,
        "index": [*keys, "reference", "to"],
        "composite": [*keys, "reference", "to"],
        "composite_members": ["indicator", "species"],
        "stratum_weight": ["species", "stratum"],
    }
    for name, sorting in exports.items():
        export_csv(getattr(survey, f"export_{name}"), f"{folder}/{name}", sorting)
