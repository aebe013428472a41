"""Numbering all rows of a table without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.staging import Staging


def number_rows(
    df: DataFrame, order: list[Column], name: str, staging: Staging, start: int = 1
) -> DataFrame:
    """Add ``name`` = place of a row in ``order``, which must identify the rows.

    The rows are range partitioned and sorted, numbered within their partition and stored;
    the sizes of the partitions, a table with one row per partition, give the offsets.
    """
    part, place = F.spark_partition_id(), F.monotonically_increasing_id()
    placed = staging.write(
        f"numbered_{name}",
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", part)
        .withColumn("_place", place - F.shiftleft(F.col("_part").cast("long"), 33)),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + start)
        .drop("_part", "_place", "_offset")
    )
