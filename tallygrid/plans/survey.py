"""All tables of a survey, built from its source on demand.

Four tables are stored as stages because later steps read them more than once: the effort per
point, the zero-filled cells, the profile of the squares, and the relevant cells. Next to them
the strata that pass the rules and the effects: tables with a row per species, stratum and time
step, stored so that the planner knows how small they are. Everything else is a lazy DataFrame.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid import session
from tallygrid.operators import (
    adjusted,
    composite,
    contrasts,
    dimensions,
    effects,
    effort,
    families,
    intervals,
    lineage,
    relevance,
    reports,
    samples,
    smoothing,
    weights,
)
from tallygrid.staging import Staging
from tallygrid.sources.base import SurveySource


# Fields of the design that the stored tables before the relevance rules depend on.
VISIT_FIELDS = ("season", "period_starts", "end_date", "min_year")
PROFILE_FIELDS = (*VISIT_FIELDS, "base_year", "cycle_len")


@dataclass(frozen=True)
class SurveyDesign:
    """Constants of a survey and thresholds of its analysis."""

    base_year: int = 2007
    cycle_len: int = 3
    season: tuple = samples.SEASON
    period_starts: Sequence = samples.PERIOD_STARTS
    end_date: datetime | None = None
    min_year: int | None = None
    min_observation: int = 100
    min_stratum: int = 3
    min_cycle: int = 2
    proportion: float = 0.15
    max_points: int = 6
    threshold: float = math.log(0.75)
    year_windows: Sequence[int] = contrasts.YEAR_WINDOWS
    cycle_windows: Sequence[int] = contrasts.CYCLE_WINDOWS
    # None: Poisson for all; "given": the family of the source; "chosen": what the counts show
    family: str | None = None
    # places of the adjusted effects: "point", "square", or "design" for what a species needs
    places: str = "design"
    overdispersion: bool = False
    exact_lines: bool = False
    line_steps: int = 50  # of the scoring of a line; one that needs more has not converged
    lang: str = "en"


@dataclass
class Survey:
    spark: SparkSession
    source: SurveySource
    design: SurveyDesign = field(default_factory=SurveyDesign)
    staging: Staging | None = None
    # Store the counts as well: for tables of single samples, which need them once more.
    keep_counts: bool = False

    def __post_init__(self):
        session.configure(self.spark)
        if self.staging is None:
            self.staging = Staging(self.spark)

    @cached_property
    def _source_identity(self) -> str:
        return self.source.identity

    def stage(self, name: str, build: Callable[[], DataFrame], fields: Sequence[str] | None = None) -> DataFrame:
        """A stored table that depends on the given fields of the design, on all by default.

        Surveys of the same source that share a ``staging`` share the tables that their designs
        have in common.
        """
        design = [getattr(self.design, f) for f in fields] if fields else self.design
        values = (self._source_identity, design)
        return self.staging.table(f"{name}-{hashlib.md5(repr(values).encode()).hexdigest()[:8]}", build)

    # --- samples and counts

    @cached_property
    def valid_samples(self) -> DataFrame:
        return samples.valid_samples(self.source.samples(), self.source.project, self.design.end_date)

    @cached_property
    def visits(self) -> DataFrame:
        d = self.design
        return samples.season_visits(self.valid_samples, d.season, d.period_starts, d.min_year)

    @cached_property
    def counts(self) -> DataFrame:
        """Counts per species and sample."""
        counts = samples.species_counts(self.source.sightings(self.visits))
        return self.stage("counts", lambda: counts, VISIT_FIELDS) if self.keep_counts else counts

    @cached_property
    def common_species(self) -> DataFrame:
        return self.stage(
            "common_species",
            lambda: samples.common_species(self.counts, self.design.min_observation),
        )

    @cached_property
    def common_counts(self) -> DataFrame:
        return self.counts.join(self.common_species.select("species"), "species", "left_semi")

    @cached_property
    def frame_sizes(self) -> DataFrame:
        return samples.frame_size(self.source.frame())

    @cached_property
    def point_effort(self) -> DataFrame:
        return self.stage(
            "point_effort",
            lambda: relevance.point_effort(self.visits, self.source.points(self.design.end_date)),
            VISIT_FIELDS,
        )

    @cached_property
    def square_effort(self) -> DataFrame:
        return effort.effort(self.point_effort)

    @cached_property
    def square_years(self) -> DataFrame:
        return effort.square_years(self.square_effort)

    # --- relevance

    @cached_property
    def cells(self) -> DataFrame:
        return self.stage(
            "cells", lambda: relevance.point_cells(self.counts, self.point_effort), VISIT_FIELDS
        )

    @cached_property
    def profile(self) -> DataFrame:
        d = self.design
        return self.stage(
            "profile",
            lambda: relevance.square_profile(self.cells, d.base_year, d.cycle_len),
            PROFILE_FIELDS,
        )

    @cached_property
    def candidate_strata(self) -> DataFrame:
        d = self.design
        return self.stage(
            "candidate_strata",
            lambda: relevance.candidate_strata(
                self.profile, len(d.period_starts) + 1, d.min_cycle, d.min_stratum, d.proportion
            ),
        )

    @cached_property
    def kept_periods(self) -> DataFrame:
        return relevance.period_filter(self.candidate_strata)

    @cached_property
    def relevant_strata(self) -> DataFrame:
        d = self.design
        return self.stage(
            "relevant_strata",
            lambda: relevance.relevant_strata(
                self.profile, self.candidate_strata, d.min_observation, d.min_stratum, d.min_cycle
            ),
        )

    @cached_property
    def relevant(self) -> DataFrame:
        d = self.design
        return self.stage(
            "relevant",
            lambda: relevance.relevant_cells(
                self.cells, self.profile, self.relevant_strata, d.min_cycle, d.base_year, d.cycle_len
            ),
        )

    @cached_property
    def relevant_samples(self) -> DataFrame:
        return relevance.relevant_samples(self.visits, self.counts, self.relevant)

    @cached_property
    def year_spans(self) -> DataFrame:
        return self.stage("year_spans", lambda: relevance.year_spans(self.relevant))

    @cached_property
    def complete_grid(self) -> DataFrame:
        d = self.design
        return relevance.complete_grid(self.relevant_samples, self.year_spans, d.base_year, d.cycle_len)

    @cached_property
    def squares(self) -> DataFrame:
        return relevance.square_summary(self.relevant)

    @cached_property
    def design_choice(self) -> DataFrame:
        return relevance.design_choice(self.squares, self.relevant_strata)

    @cached_property
    def analysed_species(self) -> DataFrame:
        return self.relevant_strata.select("species").distinct()

    # --- weights

    @cached_property
    def surveyed(self) -> DataFrame:
        return weights.surveyed_squares(self.square_effort)

    @cached_property
    def weights(self) -> DataFrame:
        return weights.stratum_weights(self.squares, self.surveyed, self.frame_sizes)

    @cached_property
    def weight_table(self) -> DataFrame:
        return weights.stratum_weight_table(self.squares, self.weights, self.design.max_points)

    @cached_property
    def coverage(self) -> DataFrame:
        return weights.coverage_table(
            self.weight_table, self.surveyed, self.frame_sizes, self.design.max_points
        )

    # --- effects and contrasts

    @cached_property
    def grid(self) -> DataFrame:
        d = self.design
        return effects.full_grid(
            effects.time_cells(self.relevant, d.base_year, d.cycle_len), d.cycle_len
        )

    @cached_property
    def dispersion(self) -> DataFrame:
        return effects.dispersion(self.grid)

    @cached_property
    def tails(self) -> DataFrame:
        """How many relevant counts of a species exceed each value."""
        return self.stage("tails", lambda: families.count_tails(self.counts, self.relevant))

    @cached_property
    def families(self) -> DataFrame:
        """The family of every analysed species: the one that is given, or what its counts show."""
        if self.design.family == "chosen":
            return effects.choose_family(self.dispersion).select("species", "family")
        return dimensions.with_family(self.analysed_species, self.source.families())

    @cached_property
    def family_effects(self) -> DataFrame:
        """Effects by the families, before time steps without visits are filled."""
        return self.stage(
            "family_effects", lambda: families.family_effects(self.grid, self.tails, self.families)
        )

    @cached_property
    def effects(self) -> DataFrame:
        """Species x strata x time steps with their weights, stored once for all contrasts."""

        def build() -> DataFrame:
            if self.design.family:
                table = effects.fill_gaps(self.family_effects, effects.LINE, "t", "b", "var")
            else:
                table = effects.stratum_effects(self.grid)
            if self.design.overdispersion:
                table = effects.inflate_variance(table, self.dispersion)
            return effects.weighted(table, self.weights)

        return self.stage("effects", build)

    @cached_property
    def adjusted_effects(self) -> DataFrame:
        """Levels adjusted for places and periods, by the terms that the design of a species asks for."""
        d = self.design

        def build() -> DataFrame:
            cells = adjusted.place_cells(self.relevant, self.design_choice, d.base_year, d.cycle_len, d.places)
            return adjusted.adjusted_effects(cells, self.staging)

        return self.stage("adjusted_effects", build)

    @cached_property
    def smoothed_effects(self) -> DataFrame:
        """The effects as random walks, with what neighbouring time steps share."""
        return self.stage(
            "smoothed_effects",
            lambda: effects.weighted(smoothing.smoothed_effects(self.effects.drop("weight")), self.weights),
        )

    @cached_property
    def smoothed_contrasts(self) -> DataFrame:
        """Estimates, indices and trends of the random walks."""
        d = self.design
        table = contrasts.contrast_table(self.smoothed_effects, d.year_windows, d.cycle_windows)
        return smoothing.correlated_contrasts(table, self.smoothed_effects)

    @cached_property
    def estimates(self) -> DataFrame:
        return contrasts.estimate(self.effects)

    @cached_property
    def series(self) -> DataFrame:
        return contrasts.series(self.estimates)

    @cached_property
    def index(self) -> DataFrame:
        return contrasts.pairwise_index(self.series)

    @cached_property
    def moving_trend(self) -> DataFrame:
        d = self.design
        return contrasts.moving_trend(self.series, d.year_windows, d.cycle_windows, d.cycle_len)

    @cached_property
    def exact_lines(self) -> DataFrame:
        """Lines by maximum likelihood, with whether they converged."""
        return self.stage("exact_lines", lambda: effects.exact_fits(self.effects, self.design.line_steps))

    @cached_property
    def lines(self) -> DataFrame:
        return self.exact_lines if self.design.exact_lines else effects.line_fits(self.effects)

    @cached_property
    def criteria(self) -> DataFrame:
        return effects.information_criteria(self.effects, self.exact_lines)

    @cached_property
    def linear_trend(self) -> DataFrame:
        return contrasts.linear_trend(self.lines)

    @cached_property
    def linear_estimate(self) -> DataFrame:
        return contrasts.linear_estimate(self.lines, self.effects)

    @cached_property
    def contrasts(self) -> DataFrame:
        d = self.design
        return contrasts.contrast_table(self.effects, d.year_windows, d.cycle_windows)

    @cached_property
    def linear_contrasts(self) -> DataFrame:
        return contrasts.linear_contrasts(self.effects)

    # --- composites

    @cached_property
    def groups(self) -> DataFrame:
        """Members of groups that could be analysed."""
        return self.stage(
            "groups",
            lambda: self.source.groups().join(self.analysed_species, "species", "left_semi"),
        )

    @cached_property
    def composite_index(self) -> DataFrame:
        return composite.composite(self.index, self.groups, ["frequency", "reference", "alternative"])

    @cached_property
    def composite_moving_trend(self) -> DataFrame:
        keys = ["frequency", "window", "midpoint", "mid_year"]
        return composite.composite(self.moving_trend, self.groups, keys)

    @cached_property
    def composite_thresholds(self) -> DataFrame:
        return composite.composite_thresholds(self.groups, self.design.threshold)

    # --- analyses

    @cached_property
    def analyses(self) -> DataFrame:
        return lineage.analyses(self.analysed_species, "species")

    @cached_property
    def members(self) -> DataFrame:
        return composite.composite_members(self.analyses, self.groups)

    @cached_property
    def gate_trace(self) -> DataFrame:
        """Positive counts at every gate of the relevance rules, and where a species failed."""
        d = self.design
        return relevance.gate_trace(
            self.profile, self.candidate_strata, d.min_observation, d.min_stratum, d.min_cycle
        )

    @cached_property
    def statuses(self) -> DataFrame:
        """All analyses of all species with their status.

        ``insufficient_data``: the species fails at a gate or was never found; ``not converged``: a
        line of a linear analysis, or the family of any analysis, has no fit; else ``converged``.
        """
        wanted = lineage.analyses(self.source.species().select("species"), "species")
        passed = self.gate_trace.filter(F.col("gate").isNull()).select("species", F.lit(True).alias("passed"))
        fits = self.exact_lines.groupBy("species", "frequency").agg(F.min("converged").alias("lines"))
        if self.design.family:
            fitted = F.min(F.col("status") == "converged").alias("fitted")
            fits = fits.join(
                self.family_effects.filter("n > 0").groupBy("species", "frequency").agg(fitted), effects.SERIES
            )
        else:
            fits = fits.withColumn("fitted", F.lit(True))
        done = F.col("fitted") & (F.col("lines") | (F.col("type") != "linear"))
        status = (
            F.when(F.col("passed").isNull(), "insufficient_data").when(done, "converged").otherwise("not converged")
        )
        return wanted.join(passed, "species", "left").join(fits, effects.SERIES, "left").select(
            *wanted.columns, status.alias("status")
        )

    @cached_property
    def models(self) -> DataFrame:
        family = dimensions.with_family(self.statuses, self.source.families())
        single = family.select(
            "analysis",
            F.col("species").cast("string").alias("speciesgroup"),
            lineage.model_text(
                F.col("family"), F.col("frequency"), F.col("type"), F.lit(False)
            ).alias("model_type"),
            "status",
        )
        grouped = lineage.analyses(self.groups.select("species_group").distinct(), "species_group")
        return single.unionByName(
            grouped.select(
                "analysis",
                F.col("species_group").alias("speciesgroup"),
                lineage.model_text(
                    F.lit(None).cast("string"), F.col("frequency"), F.col("type"), F.lit(True)
                ).alias("model_type"),
                F.lit("converged").alias("status"),
            )
        )

    @cached_property
    def meta(self) -> DataFrame:
        both = self.criteria.unpivot(
            ["species", "frequency"], ["ic_linear", "ic_non_linear"], "which", "ic"
        )
        kind = F.when(F.col("which") == "ic_linear", "linear").otherwise("non linear")
        criteria = both.select(
            lineage.analysis_key(F.col("species"), F.col("frequency"), kind).alias("analysis"), "ic"
        )
        return lineage.analysis_meta(self.models, criteria)

    # --- results (90 % limits, rounded) and reports

    @cached_property
    def estimate_results(self) -> DataFrame:
        return intervals.result_table(self.estimates, ["species", "frequency", "t", "label"])

    @cached_property
    def index_results(self) -> DataFrame:
        return intervals.result_table(self.index, ["species", "frequency", "reference", "alternative"])

    @cached_property
    def trend_results(self) -> DataFrame:
        keys = ["species", "frequency", "window", "midpoint", "mid_year"]
        return intervals.result_table(self.moving_trend, keys)

    @cached_property
    def linear_results(self) -> DataFrame:
        return intervals.result_table(self.linear_trend, ["species", "frequency"])

    @cached_property
    def composite_results(self) -> DataFrame:
        keys = ["species_group", "frequency", "reference", "alternative"]
        return intervals.result_table(self.composite_index, keys)

    @cached_property
    def verdicts(self) -> DataFrame:
        return reports.linearity_verdict(self.criteria, self.design.lang)

    @cached_property
    def overview(self) -> DataFrame:
        d = self.design
        done = self.statuses.filter((F.col("status") == "converged") & (F.col("type") == "linear"))
        return reports.trend_overview(
            self.linear_results.join(done.select(*effects.SERIES), effects.SERIES, "left_semi"),
            self.verdicts,
            reports.durations(self.effects),
            d.threshold,
            d.cycle_len,
            d.lang,
        )

    @cached_property
    def endpoints(self) -> DataFrame:
        d = self.design
        return reports.endpoint_change(self.index_results, d.threshold, d.cycle_len, d.lang)

    def with_analysis(self, df: DataFrame, kind: str, name: str = "species") -> DataFrame:
        return df.withColumn(
            "analysis", lineage.analysis_key(F.col(name), F.col("frequency"), F.lit(kind))
        )

    @cached_property
    def export_estimate(self) -> DataFrame:
        return reports.export_estimate(
            self.with_analysis(self.estimate_results, "non linear"), self.meta, self.design.lang
        )

    @cached_property
    def export_trend(self) -> DataFrame:
        return reports.export_trend(
            self.with_analysis(self.overview, "linear"), self.meta, self.design.lang
        )

    @cached_property
    def export_index(self) -> DataFrame:
        d = self.design
        return reports.export_index(
            self.with_analysis(self.index_results, "non linear"), self.meta, d.threshold, d.lang
        )

    @cached_property
    def export_composite(self) -> DataFrame:
        index = self.with_analysis(self.composite_results, "non linear", "species_group").join(
            self.composite_thresholds.select("species_group", "threshold"), "species_group"
        )
        return reports.export_index(index, self.meta, F.col("threshold"), self.design.lang)

    @cached_property
    def export_composite_members(self) -> DataFrame:
        return reports.export_composite_members(self.members, self.composite_thresholds)

    @cached_property
    def export_stratum_weight(self) -> DataFrame:
        return reports.export_stratum_weight(self.weight_table, self.surveyed, self.frame_sizes)
