"""The nine tables of an operational database, as Parquet files and as catalog tables."""

import datetime

import pytest

from tallygrid import Survey, SurveyDesign
from tallygrid.plans.store import dataset_tables
from tallygrid.schema import CANONICAL_COLUMNS, MissingColumns
from tallygrid.session import configure
from tallygrid.sources import OperationalSource, catalog_reader, jdbc_reader, parquet_reader

D = datetime.datetime


def tables(spark):
    make = spark.createDataFrame
    visits, samples, observations = [], [], []
    for i, year in enumerate([2007, 2008, 2010, 2011, 2013]):
        for square in (100, 101, 102):
            visit = i * 10 + square
            visits.append((visit, 1, square, D(year, 5, 1), 1))
            for point in (square * 10 + 1, square * 10 + 2):
                sample = visit * 100 + point % 10
                samples.append((sample, visit, point, False))
                observations.append((sample, 7, 2 + i))
    visits += [(9001, 1, 100, D(2010, 5, 1), None), (9002, 1, 100, D(2010, 5, 1), -1), (9003, 2, 100, D(2010, 5, 1), 1)]
    samples += [(90011, 9001, 1001, False), (90021, 9002, 1001, False), (90031, 9003, 1001, False), (90041, 107, 1001, True)]
    observations += [(90011, 7, 50), (90021, 7, 50), (90031, 7, 50), (90041, 7, 50)]
    locations = [(s, f"GRID_{s}") for s in (100, 101, 102)] + [(s * 10 + p, f"P{s}{p}") for s in (100, 101, 102) for p in (1, 2)]
    return {
        "projects_project": make([(1, "birds"), (2, "moths")], "id long, name string"),
        "fieldwork_visit": make(visits, "id long, project_id long, location_id long, start_date timestamp_ntz, validation_status int"),
        "fieldwork_sample": make(samples, "id long, visit_id long, location_id long, not_counted boolean"),
        "fieldwork_observation": make(observations, "sample_id long, species_id long, number_min int"),
        "locations_location": make(locations, "id long, name string"),
        "species_species": make(
            [(7, "Troglodytes troglodytes", "wren", "10660", "x"), (8, "Larus canus", "gull", "5900", None), (9, "Parus major", "tit", "14640", "y")],
            "id long, scientific_name string, name string, euring_code string, catalogue_code string",
        ),
        "projects_projectspecies": make([(1, 7), (1, 8), (2, 9)], "project_id long, species_id long"),
        "species_group": make([(1, "Farmland (birds)"), (2, "Rare"), (3, "Odd(birds)")], "id long, name string"),
        "species_speciesgrouprelation": make([(1, 7), (1, 8), (2, 7)], "group_id long, species_id long"),
        "sampling_frame": make(
            [("100", "low"), ("101", "low"), ("102", "low"), ("103", "low"), ("104", None)], "ExternalCode string, Stratum string"
        ),
        "distribution": make([(7, "nbinomial")], "species_id long, family string"),
    }


@pytest.fixture(scope="module", params=["parquet", "catalog"])
def source(request, spark, tmp_path_factory):
    if request.param == "parquet":
        folder = tmp_path_factory.mktemp("db")
        for name, df in tables(spark).items():
            df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        read = parquet_reader(spark, str(folder))
    else:
        spark.sql("CREATE DATABASE IF NOT EXISTS field")
        for name, df in tables(spark).items():
            df.coalesce(1).write.mode("overwrite").saveAsTable(f"field.{name}")
        read = catalog_reader(spark, "spark_catalog.field")
    return OperationalSource(read, "birds", "GRID_", " (birds)", "catalogue_code")


def test_canonical_columns(source):
    for name, df in source.tables().items():
        assert set(CANONICAL_COLUMNS[name]) <= set(df.columns), name


def test_points_species_and_groups(source):
    assert {tuple(r) for r in source.points().select("square", "stratum").distinct().collect()} == {
        (f"GRID_{s}", "low") for s in (100, 101, 102)
    }
    # a species without reference and one of a project without valid observations are left out;
    # the rejected visit of the other project was accepted, so its species stays out by project
    assert [r.species for r in source.species().collect()] == [7]
    assert [tuple(r) for r in source.groups().orderBy("species").collect()] == [("Farmland", 7), ("Farmland", 8)]
    table, members = source.group_tables()
    assert {r.description for r in table.collect()} == {"Farmland", "wren"}
    assert members.count() == 2


def test_survey_from_the_database(spark, source):
    design = SurveyDesign(min_observation=10, min_stratum=3, min_cycle=2)
    survey = Survey(spark, source, design)
    assert survey.visits.count() == 30
    weights = survey.weights.collect()
    assert [(r.stratum, r.n_frame, r.r_relevant, r.t_surveyed, r.weight) for r in weights] == [("low", 4, 3, 3, 1.0)]
    import math

    years = {r.label: r.estimate for r in survey.estimates.filter("frequency = 'year'").collect()}
    assert years == pytest.approx(
        {2007: math.log(2), 2008: math.log(3), 2009: math.log(12) / 2, 2010: math.log(4),
         2011: math.log(5), 2012: math.log(30) / 2, 2013: math.log(6)}
    )
    assert survey.meta.filter("family = 'nbinomial'").count() == 4


def test_missing_column_is_reported(spark):
    own = tables(spark)
    own["fieldwork_visit"] = own["fieldwork_visit"].drop("validation_status")
    with pytest.raises(MissingColumns, match="fieldwork_visit lacks validation_status"):
        OperationalSource(own.__getitem__, "birds", "GRID_", " (birds)", "catalogue_code").samples()


def test_jdbc_reader_needs_a_driver(spark):
    read = jdbc_reader(spark, "jdbc:nodb://host/db", scheme="public", user="me")
    with pytest.raises(Exception, match="(?i)driver"):
        read("projects_project")


def test_nothing_after_the_end_date(spark):
    own = tables(spark)
    more = {
        "fieldwork_visit": [(9100, 1, 103, D(2015, 1, 1, 0, 0, 1), 1)],
        "fieldwork_sample": [(91001, 9100, 1031, False)],
        "fieldwork_observation": [(91001, 7, 3)],
        "locations_location": [(103, "GRID_103")],
    }
    for name, rows in more.items():
        own[name] = own[name].unionAll(spark.createDataFrame(rows, own[name].schema))
    source = OperationalSource(own.__getitem__, "birds", "GRID_", " (birds)", "catalogue_code")
    squares = lambda end: {r.square for r in source.points(end).select("square").distinct().collect()}
    assert "GRID_103" in squares(None) and "GRID_103" in squares(D(2015, 1, 1, 0, 0, 1))
    assert "GRID_103" not in squares(D(2015, 1, 1))
    assert source.species(D(2015, 1, 1)).count() == 1 and source.species(D(2000, 1, 1)).count() == 0
    end = SurveyDesign(min_observation=10, end_date=D(2015, 1, 1))
    stored = dataset_tables(Survey(spark, source, end))
    assert stored["square"][0].filter("square = 'GRID_103'").count() == 0
    assert stored["point"][0].filter("point_id = 1031").count() == 0


def test_session_zone_is_set(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert configure(other).conf.get("spark.sql.session.timeZone") == "UTC"
