import itertools

import pytest
from fixtures import brute_force, random_survey

from tallygrid import Survey, SurveyDesign
from tallygrid.operators import relevance


def relevant_rows(survey):
    rows = survey.relevant_samples.select("species", "sample_id", "count", "period", "is_reference").collect()
    found = {(r.species, r.sample_id): (r["count"], r.period, r.is_reference) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(
    "seed, design",
    [
        (1, dict(min_observation=30, min_stratum=2, min_cycle=2, proportion=0.15)),
        (2, dict(min_observation=10, min_stratum=3, min_cycle=3, proportion=0.95)),
        (3, dict(min_observation=1, min_stratum=1, min_cycle=1, proportion=1.0)),
        (4, dict(min_observation=90, min_stratum=4, min_cycle=3, proportion=0.9)),
    ],
)
def test_rules_match_brute_force(spark, seed, design):
    source = random_survey(spark, seed)
    survey = Survey(spark, source, SurveyDesign(**design))
    assert relevant_rows(survey) == brute_force(source, 2007, **design)


def test_minimum_is_monotone_at_the_gate(spark):
    """The last positive count decides: the total itself passes, one more does not."""
    source = random_survey(spark, 5)
    base = dict(min_stratum=2, min_cycle=2, proportion=0.8)
    rows = brute_force(source, 2007, 1, **base)
    totals = {s: sum(v[0] > 0 for (n, _), v in rows.items() if n == s) for s in {n for n, _ in rows}}
    species, total = max(totals.items(), key=lambda x: x[1])
    for least, present in ((total, True), (total + 1, False)):
        survey = Survey(spark, source, SurveyDesign(min_observation=least, **base))
        kept = {r.species for r in survey.analysed_species.collect()}
        assert (species in kept) is present


def test_cells_add_up_to_samples(spark):
    source = random_survey(spark, 6)
    survey = Survey(spark, source, SurveyDesign(min_observation=5, min_stratum=1))
    cells = {r.species: (r.n, r.n_pos, r.c, r.c2) for r in survey.relevant.groupBy("species").agg(
        *[__import__("pyspark.sql.functions", fromlist=["x"]).sum(x).alias(x) for x in ("n", "n_pos", "c", "c2")]
    ).collect()}
    rows = relevant_rows(survey)
    for name in {n for n, _ in rows}:
        counts = [v[0] for (n, _), v in rows.items() if n == name]
        want = (len(counts), sum(c > 0 for c in counts), sum(counts), sum(c * c for c in counts))
        assert cells[name] == want


def test_complete_grid_pads_missing_cells(spark):
    source = random_survey(spark, 7, n_samples=60)
    design = SurveyDesign(min_observation=1, min_stratum=1, min_cycle=1)
    survey = Survey(spark, source, design)
    rows = survey.complete_grid.collect()
    assert any(r.padded for r in rows)
    by_species = lambda r: r.species
    for _, group in itertools.groupby(sorted(rows, key=by_species), by_species):
        group = list(group)
        real = [r for r in group if not r.padded]
        padded = [r for r in group if r.padded]
        years = range(min(r.year for r in real), max(r.year for r in real) + 1)
        strata = {r.stratum for r in real}
        assert {(r.year, r.stratum) for r in group} == set(itertools.product(years, strata))
        assert not {(r.year, r.stratum) for r in real} & {(r.year, r.stratum) for r in padded}
        assert sorted(r.sample_id for r in padded) == list(range(-len(padded), 0))
        assert all(r.square is None and r.point_id is None and r["count"] is None for r in padded)
        assert all(r.cyear == r.year - years[0] + 1 for r in group)


def test_period_tie_takes_the_first(spark):
    tally = "array<struct<cycle:int,period:int,n:long,n_pos:long,c:long>>"
    profile = spark.createDataFrame(
        [("a", "s", f"q{i}", [(1, 1, 2, 1, 4), (2, 2, 2, 1, 4), (2, 3, 2, 1, 1)]) for i in range(3)],
        f"species string, stratum string, square string, tallies {tally}",
    )
    row = relevance.candidate_strata(profile, 3, 2, 3, 0.5).first()
    assert row.reference_period == 1 and row.periods == [1, 2]


def test_min_cycle_needs_different_cycles(spark):
    tally = "array<struct<cycle:int,period:int,n:long,n_pos:long,c:long>>"
    profile = spark.createDataFrame(
        [
            ("a", "s", "one cycle", [(1, 1, 1, 1, 1), (1, 2, 1, 1, 1), (2, 1, 1, 0, 0)]),
            ("a", "s", "two cycles", [(1, 1, 1, 1, 1), (2, 1, 1, 1, 1)]),
        ],
        f"species string, stratum string, square string, tallies {tally}",
    )
    assert [r.square for r in relevance.square_min_cycles(profile, 2).collect()] == ["two cycles"]


def test_weights(spark):
    from tallygrid.operators.weights import stratum_weights

    squares = spark.createDataFrame(
        [("a", "x", f"q{i}") for i in range(2)] + [("a", "y", f"r{i}") for i in range(5)] + [("b", "y", "r1")],
        "species string, stratum string, square string",
    )
    surveyed = spark.createDataFrame([("x", 10), ("y", 5)], "stratum string, t_surveyed long")
    frame = spark.createDataFrame([("x", 100), ("y", 10)], "stratum string, n_frame long")
    got = {(r.species, r.stratum): r.weight for r in stratum_weights(squares, surveyed, frame).collect()}
    assert got == pytest.approx({("a", "x"): 20 / 30, ("a", "y"): 10 / 30, ("b", "y"): 1.0})


def test_weight_table_invariants(spark):
    survey = Survey(spark, random_survey(spark, 8), SurveyDesign(min_observation=10, min_stratum=1, max_points=2))
    rows = survey.weight_table.collect()
    assert rows
    for r in rows:
        assert r.points_1 + r.points_2 + r.points_over == r.relevant
        assert r.points_over > 0 or r.points_total == r.points_1 + 2 * r.points_2
    for name in {r.species for r in rows}:
        assert sum(r.weight for r in rows if r.species == name) == pytest.approx(1)
