"""Files and folders through Hadoop, so any storage that Spark reads works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def locate(spark: SparkSession, path: str):
    """File system and Hadoop path of a location."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = locate(spark, path)
    return fs.exists(location)


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """Length and time of the last change of a file or folder."""
    fs, location = locate(spark, path)
    status = fs.getFileStatus(location)
    return status.getLen(), status.getModificationTime()


def delete(spark: SparkSession, path: str) -> None:
    fs, location = locate(spark, path)
    fs.delete(location, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    fs, location = locate(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(location) if s.isDirectory()]
