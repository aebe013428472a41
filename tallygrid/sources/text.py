"""Versioned tab-separated tables with coded columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.operators.ranking import number_rows
from tallygrid.staging import Staging


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a tab-separated table with a header, ``NA`` for NULL and a fixed schema."""
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", "true")
        .option("nullValue", "NA")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def decode_column(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """Replace the codes of a column by their labels (``code``, ``label``); keep unknown as NULL."""
    coded = labels.select(F.col("code").alias(column), F.col("label"))
    return (
        df.join(coded, column, "left").drop(column).withColumnRenamed("label", column)
    )


def encode_labels(df: DataFrame, column: str, staging: Staging) -> DataFrame:
    """Label table of a column: codes 1, 2, ... in alphabetical order of the distinct values."""
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("label")).distinct()
    numbered = number_rows(values, [F.col("label")], "code", staging)
    # stored, so that joins with it know its size
    return staging.write("labels", numbered.withColumn("code", F.col("code").cast("int")))
