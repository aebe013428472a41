"""An operational survey database: nine tables plus a sampling frame and chosen families.

A reader is any function from a table name to a DataFrame, so the same source runs on
Parquet exports, catalog tables or a JDBC connection; with JDBC Spark pushes the filters
and the column selection of each table down to the database.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.functions.names import strip_suffix
from tallygrid.operators.dimensions import species_groups
from tallygrid.schema import require_columns
from tallygrid.sources.base import SurveySource

# Tables of the database and the columns that are used.
DATABASE_TABLES = {
    "projects_project": ("id", "name"),
    "fieldwork_visit": ("id", "project_id", "location_id", "start_date", "validation_status"),
    "fieldwork_sample": ("id", "visit_id", "location_id", "not_counted"),
    "fieldwork_observation": ("sample_id", "species_id", "number_min"),
    "locations_location": ("id", "name"),
    "species_species": ("id", "scientific_name", "name", "euring_code"),
    "projects_projectspecies": ("project_id", "species_id"),
    "species_group": ("id", "name"),
    "species_speciesgrouprelation": ("group_id", "species_id"),
    "sampling_frame": ("ExternalCode", "Stratum"),
    "distribution": ("species_id", "family"),
}

TableReader = Callable[[str], DataFrame]


def parquet_reader(spark: SparkSession, folder: str) -> TableReader:
    return lambda name: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def catalog_reader(spark: SparkSession, qualifier: str = "") -> TableReader:
    """Tables of a catalog; ``qualifier`` is a catalog and schema such as ``prod.survey``."""
    prefix = f"{qualifier}." if qualifier else ""
    return lambda name: spark.table(prefix + name)


def jdbc_reader(
    spark: SparkSession,
    url: str,
    scheme: str = "",
    partitions: dict[str, dict[str, str]] | None = None,
    **options: str,
) -> TableReader:
    """Tables over JDBC.

    ``partitions`` gives, per large table, the ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` that let executors read it side by side.
    """

    def read(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").option("url", url).options(**options)
        reader = reader.options(**(partitions or {}).get(name, {}))
        return reader.option("dbtable", f"{scheme}.{name}" if scheme else name).load()

    return read


class OperationalSource(SurveySource):
    """A project of a database that also holds other projects.

    ``square_prefix`` turns a code of the sampling frame into the name of a square,
    ``group_suffix`` marks the names of the species groups of the project, and only species
    with a value in ``reference_column`` take part.
    """

    def __init__(
        self,
        read: TableReader,
        project: str,
        square_prefix: str,
        group_suffix: str,
        reference_column: str,
    ):
        self.read = read
        self.project = project
        self.square_prefix = square_prefix
        self.group_suffix = group_suffix
        self.reference_column = reference_column

    def _table(self, name: str, *more: str) -> DataFrame:
        columns = [*DATABASE_TABLES[name], *more]
        return require_columns(self.read(name), columns, name).select(*columns)

    def _visits(self) -> DataFrame:
        project = self._table("projects_project").select(
            F.col("id").alias("project_id"), F.col("name").alias("project")
        )
        return (
            self._table("fieldwork_visit")
            .withColumnsRenamed({"id": "visit_id", "location_id": "square_id"})
            .join(project, "project_id")
        )

    def samples(self) -> DataFrame:
        return (
            self._table("fieldwork_sample")
            .withColumnsRenamed({"id": "sample_id", "location_id": "point_id"})
            .join(self._visits(), "visit_id")
            .select(
                "sample_id",
                "point_id",
                "project",
                "start_date",
                "validation_status",
                "not_counted",
                "square_id",
            )
        )

    def observations(self) -> DataFrame:
        return self._table("fieldwork_observation").withColumnRenamed("species_id", "species")

    def frame(self) -> DataFrame:
        return self._table("sampling_frame").select(
            F.col("Stratum").alias("stratum"),
            F.concat(F.lit(self.square_prefix), F.col("ExternalCode")).alias("square"),
        )

    def points(self, end_date=None) -> DataFrame:
        """Points of valid samples; a square gets its stratum from the frame by its name."""
        from tallygrid.operators.samples import valid_locations

        names = self._table("locations_location").select(
            F.col("id").alias("square_id"), F.col("name").alias("square")
        )
        strata = self.frame().filter(F.col("stratum").isNotNull())
        return (
            valid_locations(self.samples(), self.project, end_date=end_date)
            .join(names, "square_id")
            .join(strata, "square")
            .select("point_id", "square", "stratum")
        )

    def species(self, end_date=None) -> DataFrame:
        """Species of the projects that hold valid observations, whatever the species seen."""
        from tallygrid.operators.samples import valid_samples

        samples = valid_samples(self.samples(), self.project, end_date).select("sample_id", "project")
        active = (
            self.observations().join(samples, "sample_id").select("project").distinct()
        )
        projects = (
            self._table("projects_project")
            .withColumnRenamed("name", "project")
            .join(active, "project", "left_semi")
            .select(F.col("id").alias("project_id"))
        )
        offered = (
            self._table("projects_projectspecies")
            .join(projects, "project_id", "left_semi")
            .select("species_id")
            .distinct()
        )
        return (
            self._table("species_species", self.reference_column)
            .filter(F.col(self.reference_column).isNotNull())
            .withColumnRenamed("id", "species_id")
            .join(offered, "species_id", "left_semi")
            .select(
                F.col("species_id").alias("species"),
                "scientific_name",
                "name",
                F.col("euring_code").alias("euring"),
                F.col(self.reference_column).alias("reference"),
            )
        )

    def groups(self) -> DataFrame:
        names = (
            self._table("species_group")
            .filter(F.col("name").endswith(self.group_suffix))
            .select(F.col("id").alias("group_id"), strip_suffix(F.col("name")).alias("species_group"))
        )
        return (
            self._table("species_speciesgrouprelation")
            .join(names, "group_id")
            .select("species_group", F.col("species_id").alias("species"))
        )

    def group_tables(self) -> tuple[DataFrame, DataFrame]:
        """Group names with keys, and the parent of every group member (two stored tables)."""
        groups = (
            self._table("species_group")
            .filter(F.col("name").endswith(self.group_suffix))
            .select(F.col("id").alias("external_id"), "name")
        )
        relation = self._table("species_speciesgrouprelation").select(
            F.col("group_id").alias("external_id"), F.col("species_id").alias("species")
        )
        return species_groups(groups, relation, self.species())

    def families(self) -> DataFrame:
        return self._table("distribution").withColumnRenamed("species_id", "species")
