"""Canonical tables of a repeated-count survey, column contracts and column comments."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What a source has to deliver. Identifiers may be numbers or strings.
CANONICAL_COLUMNS = {
    "samples": (
        "sample_id",
        "point_id",
        "project",
        "start_date",
        "validation_status",
        "not_counted",
    ),
    "observations": ("sample_id", "species", "number_min"),
    "points": ("point_id", "square", "stratum"),
    "frame": ("stratum", "square"),
    "species": ("species", "scientific_name", "name", "euring", "reference"),
    "groups": ("species_group", "species"),
    "families": ("species", "family"),
}


class MissingColumns(ValueError):
    """A table lacks columns that an operator needs."""


def require_columns(df: DataFrame, columns: Iterable[str], table: str = "table") -> DataFrame:
    """Fail while the plan is built, not when it runs, if columns are missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"{table} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def describe_columns(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach comments to columns; they are stored with the table and shown by catalogs."""
    require_columns(df, comments)
    for name, text in comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def column_comments(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}


def same_schema(left: DataFrame, right: DataFrame) -> bool:
    """Equal names and types in order; nullability is not part of the contract."""
    return [(f.name, f.dataType) for f in left.schema] == [
        (f.name, f.dataType) for f in right.schema
    ]


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (partial counts first, so hot keys are harmless)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
