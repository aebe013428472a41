"""Plans and results that must hold when tables are large and keys are hot."""

import re

import pytest
from fixtures import brute_force, random_survey

from catalog.queries import QUERIES
from tallygrid import Survey, SurveyDesign
from tallygrid.operators import relevance, samples
from tallygrid.sources import RetailSource

FOLDER = "/root/testdata/sf0.001"


def retail_survey(spark, folder, species="p_brand", **design):
    return Survey(spark, RetailSource(spark, folder, species), SurveyDesign(base_year=1995, **design))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Every join is a shuffled one, and anything above a few bytes counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["hot_species", "hot_point"])
def test_hot_keys_give_the_same_rows(shuffled, hot):
    design = dict(min_observation=20, min_stratum=2, min_cycle=2, proportion=0.5)
    source = random_survey(shuffled, 21, n_samples=600, **{hot: True})
    survey = Survey(shuffled, source, SurveyDesign(**design))
    rows = survey.relevant_samples.collect()
    got = {(r.species, r.sample_id): (r["count"], r.period, r.is_reference) for r in rows}
    assert len(rows) == len(got)
    assert got == brute_force(source, 2007, **design)


def test_hot_key_of_a_raw_join_is_split(shuffled):
    """A third of all visits at one point: adaptive execution reads that partition in parts."""
    visits = shuffled.range(0, 9000, 1, 6).selectExpr(
        "id AS sample_id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS point_id", "2010 AS year", "1 AS period"
    )
    points = shuffled.range(0, 9000, 1, 2).selectExpr("id AS point_id", "'q' AS square", "'s' AS stratum")
    joined = samples.visit_hierarchy(visits, points)
    assert len(joined.collect()) == 9000
    assert "skew=true" in plan(joined)


def test_busy_point_joins_as_totals(shuffled):
    """A point with a third of all visits reaches every join as one row per year and period."""
    source = random_survey(shuffled, 22, n_samples=600, hot_point=True)
    survey = Survey(shuffled, source, SurveyDesign(min_observation=20, min_stratum=2))
    effort = survey.point_effort
    assert effort.groupBy("point_id", "year", "period").count().filter("count > 1").count() == 0
    text = plan(relevance.point_effort(survey.visits, source.points()))
    join, aggregate = text.index("Join"), text.index("HashAggregate")
    assert join < aggregate  # the aggregate is below the join


def test_large_sides_are_split_not_broadcast(shuffled):
    survey = retail_survey(shuffled, FOLDER, species="p_type", min_observation=10)
    text = plan(survey.counts)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_scans_read_only_what_they_need(spark):
    survey = retail_survey(spark, FOLDER)
    text = survey.counts._jdf.queryExecution().toString()
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    columns = {re.sub(r"#\d+L?", "", c) for s in schemas for c in s.split(",")}
    assert columns == {
        "l_orderkey", "l_partkey", "l_quantity", "p_partkey", "p_brand",
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
    }


def test_samples_are_filtered_before_the_parts(spark):
    survey = retail_survey(spark, FOLDER)
    text = survey.counts._jdf.queryExecution().optimizedPlan().toString()
    outer, inner = re.findall(r"Join Inner, \(([^)]*)\)", text)
    assert "l_partkey" in outer and "sample_id" in inner


@pytest.mark.parametrize("name", ["zero_fill", "estimate", "pairwise_index", "moving_trend", "contrast_table", "export_composite"])
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_no_python_in_the_plans(spark):
    survey = retail_survey(spark, FOLDER, species="p_type", min_observation=10)
    for df in (survey.overview, survey.export_index, survey.complete_grid, survey.coverage):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


def test_effects_follow_one_partitioning(spark):
    """After the totals, everything per species happens without another exchange."""
    survey = retail_survey(spark, FOLDER, species="p_type", min_observation=10)
    assert plan(survey.grid).count("Exchange hashpartitioning") == 2


def test_zero_fill_species_keeps_all_visits(spark):
    survey = retail_survey(spark, FOLDER, species="p_type")
    filled = samples.zero_fill_species(survey.visits, survey.counts, "SMALL")
    assert filled.count() == survey.visits.count()
