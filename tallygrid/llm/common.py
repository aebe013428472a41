"""What the operators share: tables, uniform numbers, and buckets of an ordered key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOWEST = -(1 << 63)
SLOTS = 1 << 17  # rows of the table of bits in ``without``, 64 bits each


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of a table has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def uniform(*columns: Column | str) -> Column:
    """A number in (0, 1) that depends on the columns alone, so reruns agree."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def boundaries(df: DataFrame, key: str, buckets: int) -> list[int]:
    """At most ``buckets`` - 1 values that cut an integer key into runs of about equal length.

    Only these numbers reach the driver. They shape the partitions, never the result.
    """
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    cuts = df.select(F.percentile_approx(key, shares, 10000)).first()[0]
    return sorted(set(cuts or []))


def bucket_of(key: Column, cuts: list[int], first: int = 0) -> Column:
    """Number of cuts at or below the key, as a tree of comparisons."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(key < F.lit(cuts[middle]), bucket_of(key, cuts[:middle], first)).otherwise(
        bucket_of(key, cuts[middle + 1 :], first + middle + 1)
    )


def without(docs: DataFrame, keys: list[Column], gone: DataFrame) -> DataFrame:
    """The rows whose keys are not among the rows of ``gone``, columns in the same order; nulls are equal.

    Hashes of what is gone set bits in a table of a fixed size, which is broadcast. A row without
    its bit stays where it is; only the others, those that go and some that share a bit by chance,
    move to the join that decides. ``gone`` is a stored table, the types of the keys are the same.
    """
    (mark, slot, bits) = free(docs, "_mark", "_slot", "_bits")
    names = [f"_gone{i}" for i in range(len(keys))]
    gone = gone.toDF(*names)
    place = F.col(mark).bitwiseAND(F.lit(SLOTS - 1))
    # shifts by a column are there in SQL only
    bit = f"cast(shiftrightunsigned(`{mark}`, 17) & 63 as int)"
    one = F.expr(f"shiftleft(1L, {bit})")
    table = (
        gone.select(F.xxhash64(*names).alias(mark))
        .groupBy(place.alias(slot))
        .agg(F.bit_or(one).alias(bits))
    )
    marked = docs.withColumn(mark, F.xxhash64(*keys))
    marked = marked.join(F.broadcast(table), place == F.col(slot), "left")
    maybe = F.expr(f"shiftrightunsigned(coalesce(`{bits}`, 0L), {bit}) & 1L") == 1
    own = [F.col(f"`{c}`") for c in docs.columns]
    same = None
    for key, name in zip(keys, names, strict=True):
        equal = key.eqNullSafe(F.col(name))
        same = equal if same is None else same & equal
    rest = marked.where(maybe).join(gone, same, "left_anti")
    return marked.where(~maybe).select(*own).unionByName(rest.select(*own))
