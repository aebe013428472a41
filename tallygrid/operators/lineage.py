"""Analyses as rows: keys, descriptions, dependencies, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequencies and types of the analyses of a species, and the model texts.
FREQUENCIES = ("year", "cycle")
TYPES = ("linear", "non linear")
MODEL_TEXTS = {
    "linear": "inla %s: %s:stratum + period + square + point",
    "non linear": "inla %s: RW1(%s|stratum) + period + square + point",
    "composite": "composite index: %s %s",
}
# What the model texts are read back with.
NON_LINEAR_PATTERN = "(RW1|non linear)"
FAMILY_PATTERN = "inla (.*): .*"


def analysis_key(name: Column, frequency: Column, kind: Column) -> Column:
    """Readable key of an analysis; the same definition always gives the same key."""
    return F.concat_ws("/", name.cast("string"), frequency, kind)


def analyses(names: DataFrame, column: str) -> DataFrame:
    """The four analyses of every species or group."""
    options = F.explode(
        F.array(
            *[
                F.struct(F.lit(f).alias("frequency"), F.lit(t).alias("type"))
                for f in FREQUENCIES
                for t in TYPES
            ]
        )
    )
    return names.select(column, options.alias("o")).select(
        column,
        "o.frequency",
        "o.type",
        analysis_key(F.col(column), F.col("o.frequency"), F.col("o.type")).alias("analysis"),
    )


def model_text(family: Column, frequency: Column, kind: Column, composite: Column) -> Column:
    return (
        F.when(composite, F.format_string(MODEL_TEXTS["composite"], frequency, kind))
        .when(kind == "linear", F.format_string(MODEL_TEXTS["linear"], family, frequency))
        .otherwise(F.format_string(MODEL_TEXTS["non linear"], family, frequency))
    )


def analysis_meta(models: DataFrame, criteria: DataFrame) -> DataFrame:
    """What the text of a model says about it, and its information criterion if it has one.

    ``models``: analysis, speciesgroup, model_type, status. ``criteria``: analysis, ic.
    """
    text = F.col("model_type")
    composite = text.contains("composite")
    family = F.regexp_extract(text, FAMILY_PATTERN, 1)
    return models.select(
        "analysis",
        "speciesgroup",
        composite.alias("composite"),
        text.contains("cycle").alias("cycle"),
        (~text.rlike(NON_LINEAR_PATTERN)).alias("linear"),
        F.when(~composite, family).alias("family"),
        F.sha1(F.concat_ws("|", "analysis", "status")).alias("status_fingerprint"),
        "status",
    ).join(criteria, "analysis", "left")


def pending(wanted: DataFrame, done: DataFrame, key: str = "analysis") -> DataFrame:
    """Analyses that are not finished yet."""
    return wanted.join(done.select(key), key, "left_anti")


def analysis_dag(species_analyses: DataFrame, members: DataFrame) -> DataFrame:
    """Analyses and what they wait for: species have no parent, composites one row per member.

    ``n_children`` is the number of analyses that wait for this one.
    """
    composite_key = analysis_key(F.col("species_group"), F.col("frequency"), F.col("type"))
    links = members.select(composite_key.alias("analysis"), F.col("analysis").alias("parent"))
    children = links.groupBy(F.col("parent").alias("analysis")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    return (
        species_analyses.select("analysis")
        .unionByName(links, allowMissingColumns=True)
        .join(children, "analysis", "left")
        .select(
            "analysis",
            "parent",
            F.col("parent").isNull().alias("is_root"),
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        )
    )


def _told_apart(value: Column) -> Column:
    """A value behind its length, so that no text can look like NULL or like two values."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_sum(columns: list[str]) -> Column:
    """Sums of both halves of the MD5 of all rows, as text."""
    row = F.md5(F.concat_ws("|", *[_told_apart(F.col(c)) for c in columns]))
    halves = [
        F.sum(F.conv(F.substring(row, first, 16), 16, 10).cast("decimal(20,0)")).cast("string")
        for first in (1, 17)
    ]
    return F.concat_ws("-", *halves)


def table_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row that changes when any row does, whatever the order of the rows.

    The digests are added up, so executors send a number each and nothing is sorted.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        digest_sum(columns).alias("digest"),
    )


def partition_fingerprints(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows and digest per partition of a table. Digests add up, so that of a table is the sum of them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), digest_sum(columns).alias("digest"))


def fingerprint_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What became of every partition: ``added``, ``removed``, ``changed`` or ``same``."""
    before = old.select(*keys, F.col("n_rows").alias("old_rows"), F.col("digest").alias("_old"))
    after = new.select(*keys, F.col("n_rows").alias("new_rows"), F.col("digest").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when((F.col("_old") == F.col("_new")) & (F.col("old_rows") == F.col("new_rows")), "same")
        .otherwise("changed")
    )
    return before.join(after, keys, "full").select(
        *keys,
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("old_rows", "new_rows")],
        change.alias("change"),
    )


def table_diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """What differs between two versions of a table: partitions by their digests, rows within them.

    Only partitions with different digests are read row by row: equal ones need no second look.
    ``rows_gone`` and ``rows_new`` count rows with their repetitions. Keys are not NULL.
    """
    parts = fingerprint_diff(
        partition_fingerprints(old, keys, columns), partition_fingerprints(new, keys, columns), keys
    )
    touched = parts.filter(F.col("change") != "same").select(*keys)
    signed = [
        df.join(touched, keys, "left_semi").select(*keys, *[c for c in columns if c not in keys], F.lit(sign).alias("_sign"))
        for df, sign in ((old, -1), (new, 1))
    ]
    every = list(dict.fromkeys([*keys, *columns]))
    left = signed[0].unionByName(signed[1]).groupBy(*every).agg(F.sum("_sign").alias("_more"))
    counted = left.groupBy(*keys).agg(
        F.sum(F.greatest(-F.col("_more"), F.lit(0))).alias("rows_gone"),
        F.sum(F.greatest(F.col("_more"), F.lit(0))).alias("rows_new"),
    )
    return parts.join(counted, keys, "left").withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("rows_gone", "rows_new")}
    )


def analysis_fingerprint(definition: DataFrame, data: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Fingerprint of a definition and the data it is applied to, per analysis."""
    digests = data.groupBy(*keys).agg(digest_sum(columns).alias("data_digest"))
    fields = [_told_apart(F.col(c)) for c in definition.columns]
    return definition.join(digests, keys, "left").select(
        *keys,
        F.sha1(
            F.concat_ws("|", *fields, F.coalesce("data_digest", F.lit("0")))
        ).alias("fingerprint"),
    )
