"""Stored result tables: locked schema, unique keys, sorted files, pruned partitions, CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrid import files
from tallygrid.schema import duplicate_keys, require_columns, same_schema


class SchemaDrift(ValueError):
    """The table to write differs from the stored one."""


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    sorting: list[str],
    strict: bool = True,
    unique: bool = False,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Replace a stored table and read it back.

    Rows are sorted within files, so filters on the sorting columns skip row groups.
    With ``strict`` a stored table must have the same columns; with ``unique`` the sorting
    columns must identify a row.
    """
    spark = df.sparkSession
    require_columns(df, sorting)
    if strict and files.exists(spark, path) and not same_schema(
        read_table(spark, path).select(*_stored_order(df, partition_by)),
        df.select(*_stored_order(df, partition_by)),
    ):
        raise SchemaDrift(f"{path} is stored with other columns; pass strict=False to replace it")
    if unique and not duplicate_keys(df, sorting).isEmpty():
        raise ValueError(f"{', '.join(sorting)} do not identify the rows of {path}")
    parts = partition_by or []
    if parts:
        # one partition value per task, with the large ones split over more tasks
        df = df.hint("rebalance", *parts)
    writer = df.sortWithinPartitions(*parts, *sorting).write.mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    return spark.read.schema(_stored_schema(df, parts)).parquet(path).select(*df.columns)


def _stored_order(df: DataFrame, partition_by: list[str] | None) -> list[str]:
    parts = partition_by or []
    return [c for c in df.columns if c not in parts] + parts


def _stored_schema(df: DataFrame, partition_by: list[str]) -> T.StructType:
    return T.StructType([df.schema[c] for c in _stored_order(df, partition_by)])


def replace_partitions(
    df: DataFrame, path: str, partition_by: list[str], sorting: list[str]
) -> None:
    """Replace only the partitions that occur in ``df``; the others stay."""
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, *sorting)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def prune_partitions(spark: SparkSession, path: str, column: str, keep: DataFrame) -> list[str]:
    """Delete the folders of partition values that are not in ``keep``.

    Only folder names pass through the driver, one per partition of the table.
    """
    folders = [f for f in files.folders(spark, path) if f.startswith(f"{column}=")]
    if not folders:
        return []
    found = spark.createDataFrame(
        [(f, f.split("=", 1)[1]) for f in folders], "folder string, value string"
    )
    wanted = keep.select(F.col(column).cast("string").alias("value"))
    decoded = found.withColumn("value", F.url_decode(F.regexp_replace("value", r"\+", "%2B")))
    stale = [r.folder for r in decoded.join(wanted, "value", "left_anti").collect()]
    for folder in stale:
        files.delete(spark, f"{path.rstrip('/')}/{folder}")
    return sorted(stale)


def export_csv(
    df: DataFrame, path: str, sorting: list[str], digits: int = 4, description: str = ""
) -> DataFrame:
    """Write an open-data table: doubles rounded, rows ordered over the files, header in each.

    The column comments and the description go to a JSON table next to it.
    """
    rounded = df.select(
        *[
            F.round(f.name, digits).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
    rounded.orderBy(*sorting).write.mode("overwrite").option("header", "true").csv(path)
    fields = [
        (f.name, f.dataType.simpleString(), f.metadata.get("comment", ""), description)
        for f in df.schema.fields
    ]
    df.sparkSession.createDataFrame(
        fields, "name string, type string, comment string, description string"
    ).coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}_columns")
    return rounded
