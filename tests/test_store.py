import pytest
from fixtures import random_survey

from tallygrid import Survey, SurveyDesign
from tallygrid.plans import store_dataset, store_exports, store_results
from tallygrid.schema import column_comments
from tallygrid.sources import read_table


@pytest.fixture(scope="module")
def survey(spark):
    source = random_survey(spark, 31, n_samples=500)
    return Survey(spark, source, SurveyDesign(min_observation=20, min_stratum=2), keep_counts=True)


def test_dataset(spark, survey, tmp_path):
    store_dataset(survey, str(tmp_path))
    assert read_table(spark, f"{tmp_path}/visit").count() == survey.visits.count()
    counts = read_table(spark, f"{tmp_path}/observation")
    assert counts.count() == survey.common_counts.count()
    names = {r.species for r in counts.select("species").distinct().collect()}
    assert names == {r.species for r in survey.common_species.collect()}
    # again, with a higher minimum: rare species disappear from the store
    stricter = Survey(spark, survey.source, SurveyDesign(min_observation=120), keep_counts=True)
    store_dataset(stricter, str(tmp_path))
    left = {p.name for p in (tmp_path / "observation").glob("species=*")}
    assert left == {f"species={r.species}" for r in stricter.common_species.collect()}
    assert len(left) < len(names)


def test_results(spark, survey, tmp_path):
    stored = store_results(survey, str(tmp_path))
    assert len(stored) == 12
    assert all(df.count() > 0 for df in stored.values())
    assert column_comments(read_table(spark, f"{tmp_path}/index"))["lcl"] == "5% quantile on the log scale"
    species = survey.analysed_species.count()
    assert stored["linear_trend"].count() == 2 * species
    assert stored["meta"].count() == 4 * species + 4 * survey.groups.select("species_group").distinct().count()


def test_exports(spark, survey, tmp_path):
    store_exports(survey, str(tmp_path))
    index = spark.read.option("header", "true").csv(f"{tmp_path}/index")
    assert index.count() == 2 * survey.index_results.count()
    assert spark.read.json(f"{tmp_path}/index_columns").count() == len(index.columns)
