"""Dimension tables: strata, keys, groups, species lists and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.functions.names import slug, strip_suffix
from tallygrid.operators.ranking import number_rows
from tallygrid.staging import Staging


def reconcile_strata(stored: DataFrame, frame_sizes: DataFrame, refresh_n: bool = False) -> DataFrame:
    """Strata of a new sampling frame merged into the stored ones.

    A stored stratum keeps its id and, unless ``refresh_n``, its size. New strata get the next
    ids in order of their name. The number of strata is fixed by the survey design.
    """
    new = frame_sizes.select(F.col("stratum").alias("description"), F.col("n_frame").alias("new_n"))
    both = stored.join(new, "description", "full_outer")
    unnumbered = F.col("id").isNull()
    by_name = Window.orderBy("description").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()
    next_id = F.coalesce(F.max("id").over(everything), F.lit(0)) + F.sum(
        unnumbered.cast("int")
    ).over(by_name)
    size = F.coalesce("new_n", "n") if refresh_n else F.coalesce("n", "new_n")
    return both.select(
        "description",
        size.cast("long").alias("n"),
        F.when(unnumbered, next_id).otherwise(F.col("id")).cast("long").alias("id"),
    )


def assign_keys(
    known: DataFrame, incoming: DataFrame, keys: list[str], staging: Staging, id_column: str = "id"
) -> DataFrame:
    """Known keys with their ids, and the other incoming keys with the next ids in key order."""
    fresh = incoming.select(*keys).distinct().join(known, keys, "left_anti")
    numbered = number_rows(fresh, [F.col(k) for k in keys], id_column, staging)
    highest = known.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    shifted = numbered.withColumn(id_column, (F.col(id_column) + highest).cast("long"))
    return known.select(*keys, F.col(id_column).cast("long")).unionByName(
        shifted.select(*keys, id_column)
    )


def latest_version(df: DataFrame, keys: list[str], when: str, tie: str) -> DataFrame:
    """The newest row per key, one row also on ties (the highest ``tie``); no sort per key."""
    others = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(when, tie)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}") for c in others])


def with_family(species: DataFrame, families: DataFrame, default: str = "poisson") -> DataFrame:
    """Chosen distribution family per species, or the default."""
    return species.join(families.select("species", "family"), "species", "left").withColumn(
        "family", F.coalesce("family", F.lit(default))
    )


def species_groups(groups: DataFrame, relation: DataFrame, species: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Group table (groups and single species) and member table.

    Keys are SHA-1 digests of the name. A member row links a group to the key of a species,
    or the key of a species to the species itself (``species`` is true).
    """
    named = groups.select("external_id", strip_suffix(F.col("name")).alias("description"))
    single = species.select(
        F.col("species").cast("string").alias("external_id"), F.col("name").alias("description")
    )
    table = (
        named.select(F.col("external_id").cast("string"), "description", F.lit(False).alias("is_species"))
        .unionByName(single.withColumn("is_species", F.lit(True)), allowMissingColumns=True)
        .withColumn("id", F.sha1("description"))
    )
    group_keys = named.select("external_id", F.sha1("description").alias("speciesgroup_id"))
    species_keys = species.select("species", F.sha1("name").alias("parent_id"))
    members = (
        relation.join(group_keys, "external_id")
        .join(species_keys, "species")
        .select("speciesgroup_id", "parent_id", F.lit(False).alias("species"))
        .unionByName(
            species_keys.select(
                F.col("parent_id").alias("speciesgroup_id"),
                F.col("species").cast("string").alias("parent_id"),
                F.lit(True).alias("species"),
            )
        )
    )
    return table, members


def species_catalogue(names: DataFrame, folder: str = "species") -> DataFrame:
    """One page per name: slug and output path."""
    label = slug(F.col("name"))
    return names.select(
        "name", label.alias("label"), F.concat(F.lit(f"{folder}/"), label, F.lit(".qmd")).alias("output_file")
    )
