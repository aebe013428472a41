"""Tables written once and read back, so that later steps neither repeat nor guess them.

A stage cuts the lineage with a stored table, survives lost executors, and gives the planner
the real size of the data: a small one is broadcast because its files are small, a large one
is shuffled.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrid import files


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names; a temporary one only for a local session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallygrid-")
    return f"file://{folder}"


class Staging:
    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self._folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._paths: list[str] = []

    @property
    def folder(self) -> str:
        if self._folder is None:
            self._folder = f"{shared_folder(self.spark).rstrip('/')}/tallygrid-{uuid.uuid4().hex}"
        return self._folder

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage ``name``, built and written on first use."""
        if name not in self._tables:
            self._tables[name] = self.write(name, build())
        return self._tables[name]

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table under a new name and read it back."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        self._paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def intact(self) -> bool:
        """Whether all stages are still there: a shared folder may be cleaned."""
        return all(files.exists(self.spark, path) for path in self._paths)

    def release(self) -> None:
        """Delete the stages; tables read from them can no longer be used."""
        if self._paths:
            files.delete(self.spark, self.folder)
        self._tables.clear()
        self._paths.clear()
