import math

import numpy as np
import pytest
from fixtures import random_survey
from pyspark.sql import functions as F

from tallygrid import Survey, SurveyDesign
from tallygrid.operators import composite, contrasts, effects, intervals, reports


@pytest.fixture(scope="module")
def survey(spark):
    return Survey(spark, random_survey(spark, 11, n_samples=700), SurveyDesign(min_observation=20, min_stratum=2))


def series_of(spark, values, frequency="year", start=2007):
    step = 3 if frequency == "cycle" else 1
    rows = [("a", frequency, i + 1, start + i * step, float(v), 0.01) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "species string, frequency string, t int, label int, estimate double, variance double")
    return contrasts.series(df)


def test_window_slope_of_a_line(spark):
    lines = series_of(spark, [0.1 * i for i in range(7)])
    rows = contrasts.moving_trend(lines, year_windows=(2, 6, 12)).collect()
    assert sorted((r.window, r.midpoint) for r in rows) == sorted(
        [(2, 2007.5 + i) for i in range(6)] + [(6, 2009.5), (6, 2010.5)] + [(7, 2010.0)]
    )
    assert all(r.estimate == pytest.approx(0.1) for r in rows)


def test_full_window_is_the_regression_slope(spark):
    values = [0.3, 0.1, 0.7, 0.2, 0.9, 1.4, 0.8]
    slope = np.polyfit(range(7), values, 1)[0]
    rows = contrasts.moving_trend(series_of(spark, values)).filter("window = 7").collect()
    assert rows[0].estimate == pytest.approx(slope)
    assert rows[0].variance == pytest.approx(0.01 / 28)


def test_cycle_windows_and_labels(spark):
    lines = series_of(spark, [0, 1, 2, 3, 4], "cycle")
    rows = contrasts.moving_trend(lines).filter("window = 2").orderBy("midpoint").collect()
    assert [r.midpoint for r in rows] == [1.5, 2.5, 3.5, 4.5]
    assert [r.mid_year for r in rows] == [2009.5, 2012.5, 2015.5, 2018.5]
    old = contrasts.moving_trend(lines, label_mode="reference").filter("window = 2").orderBy("midpoint")
    assert [r.midpoint for r in old.collect()] == [2007.5, 2008.5, 2009.5, 2010.5]


def test_short_series_has_no_trend(spark):
    assert contrasts.moving_trend(series_of(spark, [1.0])).count() == 0
    assert contrasts.pairwise_index(series_of(spark, [1.0])).count() == 0


def test_pair_algebra(survey):
    estimates = {(r.species, r.frequency, r.label): r.estimate for r in survey.estimates.collect()}
    index = {(r.species, r.frequency, r.reference, r.alternative): r.estimate for r in survey.index.collect()}
    steps = {}
    for s, f, label in estimates:
        steps.setdefault((s, f), []).append(label)
    assert len(index) == sum(len(x) * (len(x) - 1) // 2 for x in steps.values())
    for (s, f, a, b), value in index.items():
        assert value == pytest.approx(estimates[s, f, b] - estimates[s, f, a])
        for c in steps[s, f]:
            if c > b:
                assert index[s, f, a, c] == pytest.approx(value + index[s, f, b, c])


def test_contrast_table_gives_the_same(survey):
    applied = {
        (r.species, r.frequency, r["name"]): (r.estimate, r.variance)
        for r in contrasts.apply_contrasts(survey.contrasts, survey.effects).collect()
    }
    direct = {}
    for r in survey.estimates.collect():
        direct[r.species, r.frequency, f"estimate_{r.label}"] = (r.estimate, r.variance)
    for r in survey.index.collect():
        direct[r.species, r.frequency, f"index_{r.reference}_{r.alternative}"] = (r.estimate, r.variance)
    for r in survey.moving_trend.collect():
        direct[r.species, r.frequency, f"trend_{r.midpoint:.1f}_{r.window}"] = (r.estimate, r.variance)
    assert applied.keys() == direct.keys()
    for k, v in direct.items():
        assert applied[k] == pytest.approx(v, abs=1e-12)


def test_linear_contrasts_give_trend_and_estimates(survey):
    lines = {(r.species, r.frequency, r.stratum): r for r in survey.lines.collect()}
    sums = {}
    for r in survey.linear_contrasts.collect():
        line = lines[r.species, r.frequency, r.stratum]
        value = r.coef * (line.alpha if r.term == "intercept" else line.beta)
        key = (r.species, r.frequency, r["name"])
        sums[key] = sums.get(key, 0) + value
    for r in survey.linear_trend.collect():
        assert sums[r.species, r.frequency, "linear_trend"] == pytest.approx(r.estimate)
    for r in survey.linear_estimate.collect():
        assert sums[r.species, r.frequency, f"linear_estimate_{r.t:02d}"] == pytest.approx(r.estimate)


def test_exact_fits_solve_the_score_equations(survey):
    fits = effects.exact_fits(survey.effects)
    mu = F.col("n") * F.exp(F.col("alpha") + F.col("beta") * F.col("t"))
    score = (
        survey.effects.filter("n > 0").join(fits.drop("weight"), effects.LINE)
        .groupBy(*effects.LINE)
        .agg(F.sum(F.col("c") - mu).alias("s"), F.sum((F.col("c") - mu) * F.col("t")).alias("st"))
    )
    rows = score.collect()
    assert rows and all(abs(r.s) < 1e-6 and abs(r.st) < 1e-6 for r in rows)
    weighted = {tuple(r[k] for k in effects.LINE): r.beta for r in survey.lines.collect()}
    for r in fits.collect():
        assert r.beta == pytest.approx(weighted[tuple(r[k] for k in effects.LINE)], abs=0.15)


def test_gap_fill(spark):
    rows = [("a", 1, None, None), ("a", 2, 1.0, 0.1), ("a", 3, None, None), ("a", 4, None, None), ("a", 5, 4.0, 0.3), ("a", 6, None, None)]
    df = spark.createDataFrame(rows, "k string, t int, b double, v double")
    got = effects.fill_gaps(df, ["k"], "t", "b", "v").orderBy("t").collect()
    assert [r.b for r in got] == pytest.approx([1, 1, 2, 3, 4, 4])
    assert [r.v for r in got] == pytest.approx([0.1, 0.1, 0.3, 0.3, 0.3, 0.3])
    assert [r.imputed for r in got] == [True, False, True, True, False, True]


def test_rescale_and_fan(spark):
    df = spark.createDataFrame([(0.0, -1.959964, 1.959964)], "estimate double, lcl double, ucl double")
    row = intervals.rescale_interval(df).first()
    assert (row.estimate, row.lcl, row.ucl) == (0.0, -1.6449, 1.6449)
    bands = intervals.fan_bands(intervals.rescale_interval(df)).orderBy("level").collect()
    assert [b.level for b in bands] == [0.3, 0.6, 0.9]
    assert bands[2].band_ucl == pytest.approx(1.6449)
    assert bands[0].band_ucl < bands[1].band_ucl < bands[2].band_ucl


def test_mirror_twice_is_identity(survey):
    once = intervals.mirror_pairs(survey.index_results)
    reverse = once.filter("reference > alternative")
    back = intervals.mirror_pairs(reverse).filter("reference < alternative")
    assert back.exceptAll(survey.index_results).count() == 0
    assert back.count() == survey.index_results.count()


def test_composite_mean_and_thresholds(spark):
    results = spark.createDataFrame(
        [("a", 1, 0.1, 0.04), ("b", 1, 0.3, 0.04), ("c", 1, 9.0, 9.0)], "species string, k int, estimate double, variance double"
    )
    groups = spark.createDataFrame([("g", "a"), ("g", "b")], "species_group string, species string")
    row = composite.composite(results, groups, ["k"]).first()
    assert (row.n_species, row.estimate, row.variance) == (2, pytest.approx(0.2), pytest.approx(0.02))
    bound = composite.composite_thresholds(groups).first()
    assert bound.threshold == pytest.approx(math.log(0.75) / math.sqrt(2))
    assert bound.lower_bound * bound.upper_bound == pytest.approx(1)


def test_composites_have_one_row_per_window(survey):
    rows = survey.composite_moving_trend.collect()
    groups = {r.species_group for r in survey.groups.collect()}
    assert {r.species_group for r in rows} == groups
    per_group = [sum(r.species_group == g for r in rows) for g in groups]
    assert len(set(per_group)) == 1


def test_incomplete_cycle_is_dropped(spark):
    def kept(last_year):
        rows = [("a", "year", y) for y in range(2007, last_year + 1)]
        rows += [("a", "cycle", y) for y in range(2007, last_year + 1, 3)]
        df = spark.createDataFrame(rows, "species string, frequency string, label int")
        out = reports.drop_incomplete_cycle(df, 2007).filter("frequency = 'cycle'")
        return sorted(r.label for r in out.collect())

    assert kept(2012) == [2007, 2010]
    assert kept(2013) == [2007, 2010]


def test_endpoint_change_compares_the_newest(survey):
    changes = survey.endpoints.collect()
    index = survey.index_results.collect()
    for s, f in {(r.species, r.frequency) for r in index}:
        own = [r for r in index if (r.species, r.frequency) == (s, f)]
        newest = max(r.alternative for r in own)
        refs = [r.reference for r in own if r.alternative == newest]
        got = [c for c in changes if (c.species, c.frequency) == (s, f)]
        assert sorted(c.reference for c in got) == sorted({min(refs), max(refs)})
        assert all(c.alternative == newest and c.sentence.startswith("The state in") for c in got)


def test_overdispersion_widens_intervals(spark):
    source = random_survey(spark, 11, n_samples=700)
    plain = Survey(spark, source, SurveyDesign(min_observation=20, min_stratum=2))
    wide = Survey(spark, source, SurveyDesign(min_observation=20, min_stratum=2, overdispersion=True))
    phi = {r.species: max(r.phi, 1.0) for r in plain.dispersion.collect()}
    v = {(r.species, r.frequency, r.label): r.variance for r in plain.estimates.collect()}
    for r in wide.estimates.collect():
        assert r.variance == pytest.approx(phi[r.species] * v[r.species, r.frequency, r.label])
    for exact in (False, True):
        fit = effects.exact_fits if exact else effects.line_fits
        slope = {(r.species, r.frequency): r for r in contrasts.linear_trend(fit(plain.effects)).collect()}
        for r in contrasts.linear_trend(fit(wide.effects)).collect():
            one = slope[r.species, r.frequency]
            assert r.estimate == pytest.approx(one.estimate)
            assert r.variance == pytest.approx(phi[r.species] * one.variance)
    level = {(r.species, r.frequency, r.t): r.variance for r in plain.linear_estimate.collect()}
    for r in wide.linear_estimate.collect():
        assert r.variance == pytest.approx(phi[r.species] * level[r.species, r.frequency, r.t])
    ic = {(r.species, r.frequency): r for r in plain.criteria.collect()}
    n_lines = {(r.species, r.frequency): r["count"] for r in plain.lines.groupBy("species", "frequency").count().collect()}
    for r in wide.criteria.collect():
        one, lines = ic[r.species, r.frequency], n_lines[r.species, r.frequency]
        assert r.ic_non_linear == one.ic_non_linear
        assert r.ic_linear - 4 * lines == pytest.approx((one.ic_linear - 4 * lines) / phi[r.species])


def test_choose_family(spark):
    evidence = spark.createDataFrame(
        [("a", 1.0, 1.0), ("b", 2.0, 1.0), ("c", 1.0, 2.0), ("d", 2.0, 2.0), ("e", None, 1.0)], "species string, phi double, zero_ratio double"
    )
    got = {r.species: r.family for r in effects.choose_family(evidence).collect()}
    assert got == {"a": "poisson", "b": "nbinomial", "c": "zeroinflatedpoisson1", "d": "zeroinflatednbinomial1", "e": "poisson"}


def test_dutch_texts(spark):
    source = random_survey(spark, 11, n_samples=700)
    survey = Survey(spark, source, SurveyDesign(min_observation=20, min_stratum=2, lang="nl"))
    assert all(r.sentence.startswith("De toestand in") for r in survey.endpoints.collect())
    assert {r.verdict for r in survey.verdicts.collect()} <= {"niet-lineair", "mogelijk niet-lineair", "lineair"}


def test_single_time_step_has_no_slope(spark):
    """One stratum seen in one year only: slope 0, no division by zero, in both fits."""
    rows = [("a", "year", "s", 1, 2007, 4, 2, 6, 20, 0.4, 0.2, False, 1.0)]
    df = spark.createDataFrame(
        rows,
        "species string, frequency string, stratum string, t int, label int, n long, n_pos long, c long,"
        "c2 long, b double, var double, imputed boolean, weight double",
    )
    for fit in (effects.line_fits, effects.exact_fits):
        row = fit(df).first()
        assert (row.beta, row.var_beta) == (0.0, 0.0)
        assert row.alpha == pytest.approx(0.4)
        trend = contrasts.linear_trend(fit(df)).first()
        assert (trend.estimate, trend.lcl, trend.ucl) == (0.0, 0.0, 0.0)


def test_cells_without_individuals_count_half(spark):
    grid = spark.createDataFrame(
        [("a", "year", "s", 1, 2007, 4, 0, 0, 0), ("a", "year", "s", 2, 2008, 4, 2, 6, 20), ("a", "year", "s", 3, 2009, 0, 0, 0, 0)],
        "species string, frequency string, stratum string, t int, label int, n long, n_pos long, c long, c2 long",
    )
    got = effects.stratum_effects(grid).orderBy("t").collect()
    assert [r.b for r in got] == pytest.approx([math.log(0.5 / 4), math.log(1.5), math.log(1.5)])
    assert [r.var for r in got] == pytest.approx([2, 1 / 6, 1 / 6])
    assert [r.imputed for r in got] == [False, False, True]
    row = effects.dispersion(grid).first()
    assert row.zeros == 6 and row.phi == pytest.approx((20 / 1.5 - 6) / (8 - 2))
