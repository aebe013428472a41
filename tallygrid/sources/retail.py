"""Retail tables read as a survey: every operator can run on them at any scale.

region or nation = stratum, nation and market segment = square, customer = point, order = sample,
line item = observation, part brand or type = species.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid import files
from tallygrid.sources.base import SurveySource


class RetailSource(SurveySource):
    project = "retail"

    def __init__(
        self, spark: SparkSession, folder: str, species: str = "p_brand", stratum: str = "r_name"
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self.species_column = species
        self.stratum_column = stratum
        self.group_column = "p_type" if species != "p_type" else "p_brand"

    @property
    def identity(self) -> str:
        """Folder, columns and the state of the files, so that replaced files are read anew."""
        names = ("region", "nation", "customer", "part", "orders", "lineitem")
        state = [files.stamp(self.spark, f"{self.folder}/{name}.parquet") for name in names]
        return repr((type(self).__name__, self.folder, self.species_column, self.stratum_column, state))

    def table(self, name: str) -> DataFrame:
        """A table; its schema is read from the files once per source."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def samples(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("sample_id"),
            F.col("o_custkey").alias("point_id"),
            F.lit(self.project).alias("project"),
            F.col("o_orderdate").alias("start_date"),
            F.when(F.col("o_orderstatus") == "P", -1).otherwise(1).alias("validation_status"),
            (F.col("o_orderpriority") == "4-NOT SPECIFIED").alias("not_counted"),
        )

    def _taxon(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col(self.species_column).alias("species")
        )

    def _lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("sample_id"),
            "l_partkey",
            F.col("l_quantity").cast("int").alias("number_min"),
        )

    def observations(self) -> DataFrame:
        return self._lines().join(self._taxon(), "l_partkey").drop("l_partkey")

    def sightings(self, visits: DataFrame) -> DataFrame:
        """The season keeps about a fifth of the samples, so they come before the parts."""
        return self._lines().join(visits, "sample_id").join(self._taxon(), "l_partkey").drop(
            "l_partkey"
        )

    def points(self, end_date=None) -> DataFrame:
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("point_id"),
                F.format_string("%02d-%s", "c_nationkey", "c_mktsegment").alias("square"),
                F.col(self.stratum_column).alias("stratum"),
            )
        )

    def frame(self) -> DataFrame:
        return self.points().select("stratum", "square").distinct()

    def species(self, end_date=None) -> DataFrame:
        taxon = F.col(self.species_column)
        return (
            self.table("part")
            .groupBy(taxon.alias("species"))
            .agg(F.min("p_partkey").alias("first_part"))
            .select(
                "species",
                F.concat(F.lit("Species "), "species").alias("scientific_name"),
                F.col("species").alias("name"),
                F.col("first_part").cast("string").alias("euring"),
                F.col("species").alias("reference"),
            )
        )

    def groups(self) -> DataFrame:
        """Every species of a kind of part and of a size of part, so groups overlap and differ in size."""
        species = F.col(self.species_column).alias("species")
        part = self.table("part")
        kinds = part.select(F.col(self.group_column).alias("species_group"), species)
        sizes = part.select(F.concat(F.lit("Size "), F.col("p_size").cast("string")), species)
        return kinds.union(sizes).distinct()

    def families(self) -> DataFrame:
        """A chosen family for species with an even number; the others keep the default."""
        number = F.regexp_extract("species", "([0-9]+)$", 1).try_cast("int")
        return self.species().filter(number % 2 == 0).select(
            "species", F.lit("nbinomial").alias("family")
        )
