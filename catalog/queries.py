"""Every registered query: a function of a session and a folder of retail tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.functions import class_label, classify, cycle_of, interval_text
from tallygrid.functions.names import estimate_name, index_name, linear_estimate_name, trend_name
from tallygrid.operators import (
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
)
from tallygrid.operators.ranking import number_rows
from tallygrid.plans import Survey, SurveyDesign
from tallygrid.sources import RetailSource, decode_column, write_table
from tallygrid.sources.text import encode_labels
from tallygrid.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

BASE_YEAR = 1995
STRICT = {"min_cycle": 3, "proportion": 0.95}


_STAGINGS: dict[tuple, Staging] = {}


def survey(
    spark: SparkSession, folder: str, species: str = "p_brand", stratum: str = "r_name", **design
) -> Survey:
    """A survey of a folder; all queries of an application share the stored tables.

    At scale the counts and cells are the expensive part, so they are made once, not once per
    query. Stages that were removed from the shared folder are made again.
    """
    key = (spark.sparkContext.applicationId, folder, species, stratum)
    if key not in _STAGINGS or not _STAGINGS[key].intact():
        _STAGINGS[key] = Staging(spark)
    return Survey(
        spark,
        RetailSource(spark, folder, species, stratum),
        SurveyDesign(base_year=BASE_YEAR, **design),
        staging=_STAGINGS[key],
        keep_counts=True,
    )


def forget() -> None:
    """Delete the stored tables, so that the next query starts from nothing."""
    for staging in _STAGINGS.values():
        staging.release()
    _STAGINGS.clear()


def rounded(df: DataFrame, keys: list[str], *numbers: str, digits: int = 6) -> DataFrame:
    return df.select(*keys, *[F.round(c, digits).alias(c) for c in numbers])


def _contrast(df: DataFrame, *keys: str) -> DataFrame:
    return rounded(df, list(keys), "estimate", "variance", "lcl", "ucl")


# --- sources and dimensions


def scan_survey_tables(spark, folder):
    return survey(spark, folder).source.table_sizes()


def dictionary_decode(spark, folder):
    customers = RetailSource(spark, folder).table("customer").select("c_custkey", "c_mktsegment")
    labels = encode_labels(customers, "c_mktsegment", Staging(spark))
    coded = customers.join(labels, F.col("c_mktsegment") == F.col("label")).select(
        "c_custkey", F.col("code").alias("c_mktsegment"), "code"
    )
    return decode_column(coded, "c_mktsegment", labels).select("c_custkey", "code", "c_mktsegment")


def sorted_sink_roundtrip(spark, folder):
    sv = survey(spark, folder)
    counts = sv.common_counts.select("species", "sample_id", "count")
    return write_table(
        counts, f"{sv.staging.folder}/observation", sorting=["sample_id"], partition_by=["species"]
    )


def available_species(spark, folder):
    sv = survey(spark, folder)
    return samples.available_species(sv.common_species, sv.source.groups()).select(
        "species_group", "species"
    )


def surrogate_key_assign(spark, folder):
    sv = survey(spark, folder)
    pairs = (
        sv.source.table("part").groupBy("p_type", "p_brand").agg(F.min("p_size").alias("smallest"))
    )
    order = [F.col("p_type"), F.col("p_brand")]
    known = number_rows(
        pairs.filter(F.col("smallest") <= 1).select("p_type", "p_brand"), order, "known_id", sv.staging
    ).withColumnRenamed("known_id", "id")
    return dimensions.assign_keys(known, pairs, ["p_type", "p_brand"], sv.staging)


def latest_version(spark, folder):
    orders = RetailSource(spark, folder).table("orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    newest = dimensions.latest_version(orders, ["o_custkey"], "o_orderdate", "o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    return newest.select("o_custkey", "o_orderkey", day, "o_totalprice")


def species_catalogue(spark, folder):
    sv = survey(spark, folder)
    names = sv.meta.filter(F.col("status") == "converged").select(
        F.col("speciesgroup").alias("name"), "composite"
    ).distinct()
    return dimensions.species_catalogue(names.filter("NOT composite")).unionByName(
        dimensions.species_catalogue(names.filter("composite"), "index")
    )


def table_fingerprint(spark, folder):
    return lineage.table_fingerprint(survey(spark, folder).counts, ["species", "sample_id", "count"])


def analysis_fingerprint(spark, folder):
    sv = survey(spark, folder)
    models = sv.models.join(sv.analyses.select("analysis", "species"), "analysis").select(
        "analysis", "model_type", "species"
    )
    data = effects.time_cells(sv.relevant, BASE_YEAR).filter("frequency = 'year'")
    cells = data.select("species", "stratum", "year", "n", "c")
    definition = models.select("species", "analysis", "model_type")
    digests = cells.join(definition.select("species", "analysis"), "species")
    return lineage.analysis_fingerprint(
        definition.select("analysis", "model_type"),
        digests,
        ["analysis"],
        ["species", "stratum", "year", "n", "c"],
    )


# --- samples


def valid_samples(spark, folder):
    return survey(spark, folder).valid_samples.select(
        "sample_id", "point_id", F.date_format("start_date", "yyyy-MM-dd").alias("day")
    )


def season_visits(spark, folder):
    return survey(spark, folder).visits


def cycle_assign(spark, folder):
    return (
        survey(spark, folder)
        .visits.groupBy("year", cycle_of(F.col("year"), BASE_YEAR).alias("cycle"))
        .agg(F.count(F.lit(1)).alias("visits"))
    )


def species_counts(spark, folder):
    return survey(spark, folder).common_counts.select("species", "sample_id", "count")


def valid_locations(spark, folder):
    source = RetailSource(spark, folder)
    points = samples.valid_locations(source.samples(), source.project, ["point_id"])
    return points.join(source.points(), "point_id").select("square", "point_id")


def frame_size(spark, folder):
    return survey(spark, folder).frame_sizes


def visit_hierarchy(spark, folder):
    sv = survey(spark, folder)
    return samples.visit_hierarchy(sv.visits, sv.source.points()).select(
        "sample_id", "point_id", "square", "stratum", "year", "period"
    )


def zero_fill(spark, folder):
    sv = survey(spark, folder)
    return samples.zero_fill(sv.visits, sv.counts).select(
        "species", "sample_id", "point_id", "year", "period", "count"
    )


def species_groups(spark, folder):
    source = RetailSource(spark, folder)
    relation = source.groups().select(F.col("species_group").alias("external_id"), "species")
    groups = relation.select(
        "external_id", F.concat("external_id", F.lit(" (retail)")).alias("name")
    ).distinct()
    return dimensions.species_groups(groups, relation, source.species())[1]


def species_family(spark, folder):
    source = RetailSource(spark, folder)
    return dimensions.with_family(source.species().select("species"), source.families())


def reconcile_strata(spark, folder):
    source = RetailSource(spark, folder)
    nation = source.table("nation")
    suppliers = nation.filter(F.col("n_regionkey") < 3).join(
        source.table("supplier"), F.col("n_nationkey") == F.col("s_nationkey")
    )
    stored = suppliers.groupBy(F.col("n_name").alias("description")).agg(
        F.count(F.lit(1)).alias("n")
    ).withColumn("id", F.row_number().over(Window.orderBy("description")))
    frame = source.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sizes = samples.frame_size(frame.select(F.col("n_name").alias("stratum")))
    return dimensions.reconcile_strata(stored, sizes)


# --- relevance


def square_min_cycles(spark, folder):
    sv = survey(spark, folder)
    enough = _enough_positives(sv)
    return relevance.square_min_cycles(sv.profile.join(enough, "species", "left_semi"), 2)


def _enough_positives(sv: Survey) -> DataFrame:
    """Species that pass the check on positive counts before any rule."""
    positives = F.aggregate("tallies", F.lit(0).cast("long"), lambda s, t: s + t["n_pos"])
    return sv.stage(
        "enough",
        lambda: sv.profile.groupBy("species")
        .agg(F.sum(positives).alias("n_pos"))
        .filter(F.col("n_pos") >= sv.design.min_observation)
        .select("species"),
    )


def stratum_min_squares(spark, folder):
    sv = survey(spark, folder)
    squares = relevance.square_min_cycles(sv.profile, 2)
    positives = F.aggregate("tallies", F.lit(0).cast("long"), lambda s, t: s + t["n_pos"])
    kept = sv.profile.join(squares, relevance.PLACE, "left_semi")
    enough = (
        kept.groupBy("species")
        .agg(F.sum(positives).alias("n_pos"))
        .filter(F.col("n_pos") >= sv.design.min_observation)
    )
    strata = relevance.stratum_min_squares(squares, 3)
    return strata.join(enough, "species", "left_semi")


def period_filter(spark, folder):
    periods = survey(spark, folder, proportion=0.95).kept_periods
    return rounded(periods, ["species", "period", "is_reference"], "mean")


def _relevant(spark, folder, **design):
    return survey(spark, folder, **design).relevant_samples.select(
        "species", "stratum", "square", "point_id", "sample_id", "year", "period", "is_reference", "count"
    )


def select_relevant(spark, folder):
    return _relevant(spark, folder)


def select_relevant_strict(spark, folder):
    return _relevant(spark, folder, **STRICT)


def complete_grid(spark, folder):
    """With the nations as strata, some of which lack a year for some species."""
    grid = survey(spark, folder, stratum="n_name").complete_grid
    # columns that are NULL in padded rows
    return grid.withColumns({c: F.col(c).cast("double") for c in ("point_id", "count")})


def design_choice(spark, folder):
    return survey(spark, folder).design_choice


def gate_trace(spark, folder):
    trace = survey(spark, folder, **STRICT).gate_trace
    return trace.withColumns({c: F.col(c).cast("double") for c in trace.columns if c != "species"})


def analysis_status(spark, folder):
    """With the nations as strata few data are left: some species fail, and three steps of the
    scoring are too few for some lines."""
    return survey(spark, folder, stratum="n_name", proportion=0.95, line_steps=3).meta.drop("ic")


def pending_analyses(spark, folder):
    sv = survey(spark, folder, **STRICT)
    wanted = lineage.analyses(sv.source.species().select("species"), "species")
    return lineage.pending(wanted, sv.analyses)


# --- weights and effort


def stratum_weights(spark, folder):
    return rounded(
        survey(spark, folder).weights,
        ["species", "stratum", "n_frame", "r_relevant", "t_surveyed"],
        "weight",
    )


def stratum_weight_table(spark, folder):
    return survey(spark, folder).weight_table.withColumn("weight", F.round("weight", 5))


def coverage_table(spark, folder):
    return survey(spark, folder).coverage


def effort_table(spark, folder):
    return survey(spark, folder).square_effort


def effort_history(spark, folder):
    sv = survey(spark, folder)
    history = effort.effort_history(sv.square_years, BASE_YEAR, sv.staging)
    return history.withColumns({f"year_{k}": F.col(f"year_{k}").cast("double") for k in range(2, 8)})


def effort_histogram(spark, folder):
    return effort.effort_histogram(survey(spark, folder).square_years, BASE_YEAR)


def potential_squares(spark, folder):
    return effort.potential_squares(survey(spark, folder).square_years, BASE_YEAR)


# --- effects and contrasts


def stratum_effects(spark, folder):
    keys = ["species", "frequency", "stratum", "t", "label", "n", "c", "imputed"]
    return rounded(survey(spark, folder).effects, keys, "b", "var")


def gap_fill(spark, folder):
    """Effects per square instead of per stratum: many squares are not visited every year."""
    sv = survey(spark, folder)
    squares = sv.relevant.withColumn("stratum", F.col("square"))
    grid = effects.full_grid(effects.time_cells(squares, BASE_YEAR))
    filled = effects.stratum_effects(grid).withColumnRenamed("stratum", "square")
    keys = ["species", "frequency", "square", "t", "label", "n", "c", "imputed"]
    return rounded(filled, keys, "b", "var")


def _by_number(species: DataFrame) -> DataFrame:
    """The four families in turn, by the number at the end of a name."""
    number = F.regexp_extract("species", "([0-9]+)$", 1).try_cast("int") % 4
    family = F.element_at(F.array(*map(F.lit, families.FAMILIES)), number + 1)
    return species.select("species", family.alias("family"))


def _family_effects(sv: Survey) -> DataFrame:
    return sv.stage(
        "family_effects_by_number",
        lambda: families.family_effects(sv.grid, sv.tails, _by_number(sv.analysed_species)),
    )


def family_effects(spark, folder):
    found = _family_effects(survey(spark, folder)).filter("n > 0")
    keys = ["species", "frequency", "stratum", "t", "label", "family", "status"]
    return rounded(found, keys, "b", "var")


def family_fits(spark, folder):
    fits = _family_effects(survey(spark, folder)).filter("n > 0")
    fits = fits.select("species", "frequency", "family", "status", "zeros", "size").distinct()
    return rounded(fits, ["species", "frequency", "family", "status"], "zeros", "size")


def estimate(spark, folder):
    return _contrast(survey(spark, folder).estimates, "species", "frequency", "t", "label")


def pairwise_index(spark, folder):
    return _contrast(survey(spark, folder).index, "species", "frequency", "reference", "alternative")


def moving_trend(spark, folder):
    keys = ["species", "frequency", "window", "midpoint", "mid_year"]
    return _contrast(survey(spark, folder).moving_trend, *keys)


def linear_trend(spark, folder):
    return _contrast(survey(spark, folder).linear_trend, "species", "frequency")


def linear_estimate(spark, folder):
    return _contrast(survey(spark, folder).linear_estimate, "species", "frequency", "t", "label")


def linear_trend_overdispersed(spark, folder):
    sv = survey(spark, folder, overdispersion=True)
    return _contrast(sv.linear_trend, "species", "frequency")


def linear_estimate_overdispersed(spark, folder):
    sv = survey(spark, folder, overdispersion=True)
    return _contrast(sv.linear_estimate, "species", "frequency", "t", "label")


def linearity_verdict_overdispersed(spark, folder):
    keys = ["species", "frequency", "difference", "verdict"]
    return rounded(survey(spark, folder, overdispersion=True).verdicts, keys, "ic_linear", "ic_non_linear")


def exact_lines(spark, folder):
    fits = survey(spark, folder).exact_lines.withColumn("var_beta", F.round("var_beta", 8))
    return rounded(fits, ["species", "frequency", "stratum", "var_beta", "converged"], "alpha", "beta")


def adjusted_effects(spark, folder):
    keys = ["species", "frequency", "stratum", "label", "n", "c", "converged"]
    return rounded(survey(spark, folder, places="square").adjusted_effects, keys, "b", "var", digits=5)


def smoothed_effects(spark, folder):
    """With the nations as strata, where some time steps have no visits."""
    keys = ["species", "frequency", "stratum", "t", "label", "n", "c", "imputed"]
    return rounded(survey(spark, folder, stratum="n_name").smoothed_effects, keys, "b", "var", "tau2", "gain")


def contrast_variances(spark, folder):
    sv = survey(spark, folder, stratum="n_name")
    return _contrast(sv.smoothed_contrasts, "species", "frequency", "kind", "name")


def contrast_table(spark, folder):
    keys = ["species", "frequency", "kind", "name", "stratum", "t"]
    return rounded(survey(spark, folder).contrasts, keys, "coef")


def contrast_estimates(spark, folder):
    sv = survey(spark, folder)
    applied = contrasts.apply_contrasts(sv.contrasts, sv.effects)
    return rounded(applied, ["species", "frequency", "kind", "name"], "estimate", "variance")


def linear_contrasts(spark, folder):
    keys = ["species", "frequency", "kind", "name", "stratum", "term"]
    return rounded(survey(spark, folder).linear_contrasts, keys, "coef")


def parse_contrast_names(spark, folder):
    sv = survey(spark, folder)
    names = (
        sv.estimates.select(
            F.explode(F.array(estimate_name(F.col("label")), linear_estimate_name(F.col("t")))).alias("name")
        )
        .unionByName(sv.index.select(index_name(F.col("reference"), F.col("alternative")).alias("name")))
        .unionByName(sv.moving_trend.select(trend_name(F.col("midpoint"), F.col("window")).alias("name")))
        .unionByName(sv.linear_trend.select(F.lit("linear_trend").alias("name")))
        .distinct()
    )
    parsed = contrasts.parse_names(names)
    numbers = ("reference", "alternative", "year", "midpoint", "window")
    return parsed.withColumns({c: F.col(c).cast("double") for c in numbers})


def choose_family(spark, folder):
    chosen = effects.choose_family(survey(spark, folder).dispersion)
    return rounded(chosen, ["species", "n", "cells", "zeros", "family"], "phi", "zero_ratio")


def linearity_verdict(spark, folder):
    keys = ["species", "frequency", "difference", "verdict"]
    return rounded(survey(spark, folder).verdicts, keys, "ic_linear", "ic_non_linear")


# --- composites


def composite_members(spark, folder):
    nested = composite.nested_members(survey(spark, folder).members)
    names = F.array_join(F.transform("members", lambda m: m["species"]), ";").alias("members")
    return nested.select("species_group", "frequency", "type", "n_members", names)


def composite_index(spark, folder):
    keys = ["species_group", "frequency", "reference", "alternative", "n_species"]
    return _contrast(survey(spark, folder).composite_index, *keys)


def composite_moving_trend(spark, folder):
    keys = ["species_group", "frequency", "window", "midpoint", "mid_year", "n_species"]
    return _contrast(survey(spark, folder).composite_moving_trend, *keys)


def composite_thresholds(spark, folder):
    return rounded(
        survey(spark, folder).composite_thresholds,
        ["species_group", "n_species"],
        "threshold",
        "lower_bound",
        "upper_bound",
    )


def composite_results(spark, folder):
    sv = survey(spark, folder)
    return sv.index_results.join(sv.groups, "species", "left_semi")


# --- results and reports


def rescale_interval(spark, folder):
    return survey(spark, folder).trend_results


def classify_effect(spark, folder):
    sv = survey(spark, folder)
    effect = classify(F.col("lcl"), F.col("ucl"), sv.design.threshold)
    return sv.index_results.select(
        "species", "frequency", "reference", "alternative", effect.alias("effect_class")
    ).withColumn("label", class_label(F.col("effect_class")))


def format_interval(spark, folder):
    text = interval_text(F.col("estimate"), F.col("lcl"), F.col("ucl"))
    return survey(spark, folder).estimate_results.select(
        "species", "frequency", "label", text.alias("text")
    )


def mirror_pairs(spark, folder):
    return intervals.mirror_pairs(survey(spark, folder).index_results)


def _matrix(sv: Survey) -> DataFrame:
    return intervals.pair_matrix(sv.index_results, sv.design.threshold, ["species", "frequency"])


def pair_matrix(spark, folder):
    return _matrix(survey(spark, folder))


def fan_bands(spark, folder):
    bands = intervals.fan_bands(survey(spark, folder).estimate_results)
    keys = ["species", "frequency", "label", "estimate", "level"]
    return rounded(bands, keys, "sd", "band_lcl", "band_ucl")


def interval_levels(spark, folder):
    """At every percent from 1 to 99."""
    levels = F.transform(F.sequence(F.lit(1), F.lit(99)), lambda i: i / 100)
    found = intervals.interval_levels(survey(spark, folder).estimate_results, levels)
    return rounded(found, ["species", "frequency", "label", "level"], "lcl", "ucl", digits=9)


def composite_order(spark, folder):
    """Labels of all members of a group, sizes and names of species in one order."""
    sv = survey(spark, folder)
    sizes = sv.groups.filter("species_group LIKE 'Size %'")
    number = F.regexp_replace("species_group", "^Size ", "")
    labels = sizes.select("species", F.explode(F.array(number, "species_group")).alias("label"))
    return reports.numbers_first(labels, "label", ["species"])


def table_diff(spark, folder):
    """Counts until the summer of 1997 against all counts, by species and year."""
    new = survey(spark, folder)
    old = survey(spark, folder, end_date=datetime(1997, 6, 15))
    columns = ["species", "sample_id", "year", "count"]
    return lineage.table_diff(old.counts.select(*columns), new.counts.select(*columns), ["species", "year"], columns)


def index_steps(spark, folder):
    steps = intervals.index_steps(_matrix(survey(spark, folder)))
    keys = ["species", "frequency", "reference", "alternative", "estimate", "effect_class", "key"]
    return steps.select(*keys, F.round("sd", 6).alias("sd"), F.round("x", 5).alias("x"))


def index_vs_first(spark, folder):
    return reports.index_vs_first(survey(spark, folder).index_results, ["species", "frequency"])


def drop_incomplete_cycle(spark, folder):
    return reports.drop_incomplete_cycle(survey(spark, folder).estimate_results, BASE_YEAR).select(
        "species", "frequency", "label", "estimate"
    )


def endpoint_change(spark, folder):
    return reports.endpoint_text(survey(spark, folder).endpoints)


def trend_overview(spark, folder):
    return survey(spark, folder).overview.withColumn("total", F.round("total", 6))


def analysis_meta(spark, folder):
    return survey(spark, folder).meta.withColumn("ic", F.round("ic", 6))


def analysis_dag(spark, folder):
    sv = survey(spark, folder)
    return lineage.analysis_dag(sv.analyses, sv.members)


def _export(name: str) -> Query:
    return lambda spark, folder: getattr(survey(spark, folder), name)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_survey_tables,
        dictionary_decode,
        sorted_sink_roundtrip,
        available_species,
        surrogate_key_assign,
        latest_version,
        species_catalogue,
        table_fingerprint,
        analysis_fingerprint,
        valid_samples,
        season_visits,
        cycle_assign,
        species_counts,
        valid_locations,
        frame_size,
        visit_hierarchy,
        zero_fill,
        species_groups,
        species_family,
        reconcile_strata,
        square_min_cycles,
        stratum_min_squares,
        period_filter,
        select_relevant,
        select_relevant_strict,
        complete_grid,
        design_choice,
        gate_trace,
        analysis_status,
        pending_analyses,
        stratum_weights,
        stratum_weight_table,
        coverage_table,
        effort_history,
        effort_histogram,
        potential_squares,
        stratum_effects,
        gap_fill,
        family_effects,
        family_fits,
        estimate,
        pairwise_index,
        moving_trend,
        linear_trend,
        linear_estimate,
        linear_trend_overdispersed,
        linear_estimate_overdispersed,
        exact_lines,
        adjusted_effects,
        smoothed_effects,
        contrast_variances,
        contrast_table,
        contrast_estimates,
        linear_contrasts,
        parse_contrast_names,
        choose_family,
        linearity_verdict,
        linearity_verdict_overdispersed,
        composite_members,
        composite_index,
        composite_moving_trend,
        composite_thresholds,
        composite_results,
        rescale_interval,
        classify_effect,
        format_interval,
        mirror_pairs,
        pair_matrix,
        fan_bands,
        interval_levels,
        composite_order,
        table_diff,
        index_steps,
        index_vs_first,
        drop_incomplete_cycle,
        endpoint_change,
        trend_overview,
        analysis_meta,
        analysis_dag,
    )
} | {
    "effort": effort_table,
    **{
        name: _export(name)
        for name in (
            "export_estimate",
            "export_trend",
            "export_index",
            "export_composite",
            "export_composite_members",
            "export_stratum_weight",
        )
    },
}
