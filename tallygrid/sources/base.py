"""The canonical tables of a survey, whatever they are stored in."""

from __future__ import annotations

import uuid
from abc import ABC, abstractmethod
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrid.schema import CANONICAL_COLUMNS


class SurveySource(ABC):
    """Delivers the canonical tables; see ``CANONICAL_COLUMNS`` for their columns."""

    project: str

    @cached_property
    def identity(self) -> str:
        """Tells stored stages of different sources apart. Each object is a source of its own
        unless a kind of source can say which data it reads."""
        return uuid.uuid4().hex

    @abstractmethod
    def samples(self) -> DataFrame:
        """One row per sample (a count at a point during a visit)."""

    @abstractmethod
    def observations(self) -> DataFrame:
        """Records of a species in a sample."""

    @abstractmethod
    def points(self, end_date=None) -> DataFrame:
        """Points with the square and stratum they lie in; only of samples up to an end date
        where the source takes them from the samples."""

    @abstractmethod
    def frame(self) -> DataFrame:
        """Sampling frame: every square that could have been drawn, with its stratum."""

    @abstractmethod
    def species(self, end_date=None) -> DataFrame:
        """Species of the survey; likewise up to an end date."""

    @abstractmethod
    def groups(self) -> DataFrame:
        """Members of species groups, many to many."""

    @abstractmethod
    def families(self) -> DataFrame:
        """Chosen distribution per species, where one was chosen."""

    def sightings(self, visits: DataFrame) -> DataFrame:
        """Observations made during ``visits``, with the columns of the visit.

        A source whose observations need further joins should restrict to the visits first.
        """
        return self.observations().join(visits, "sample_id")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name)() for name in CANONICAL_COLUMNS}

    def table_sizes(self) -> DataFrame:
        """Number of rows per canonical table."""
        sizes = None
        for name, df in self.tables().items():
            size = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), "n_rows"
            )
            sizes = size if sizes is None else sizes.unionByName(size)
        return sizes
