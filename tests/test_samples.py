import datetime

from fixtures import MemorySource

from tallygrid.operators import dimensions, samples
from tallygrid.staging import Staging

DAY = datetime.datetime(2010, 5, 1)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_validity_drops_null_status_and_other_projects(spark):
    source = MemorySource(
        spark,
        [
            (1, 1, "birds", DAY, 1, False),
            (2, 1, "birds", DAY, None, False),
            (3, 1, "birds", DAY, -1, False),
            (4, 1, "birds", DAY, 0, True),
            (5, 1, "moths", DAY, 1, False),
            (6, 1, "birds", DAY + datetime.timedelta(days=400), 1, False),
            (7, 1, "birds", DAY, 1, None),
        ],
        [],
        [],
        [],
    )
    assert rows(samples.valid_samples(source.samples(), "birds"), "sample_id") == [(1,), (6,)]
    ended = samples.valid_samples(source.samples(), "birds", datetime.datetime(2011, 1, 1))
    assert rows(ended, "sample_id") == [(1,)]


def test_zero_fill(spark):
    visits = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, 2)], "sample_id long, point_id long")
    counts = spark.createDataFrame(
        [("a", 1, 1, 5), ("a", 3, 2, 2), ("b", 4, 2, 1), ("c", 1, 1, 0)],
        "species string, sample_id long, point_id long, count long",
    )
    filled = samples.zero_fill(visits, counts)
    assert rows(filled, "species", "sample_id", "count") == [
        ("a", 1, 5), ("a", 2, 0), ("a", 3, 2), ("a", 4, 0), ("b", 3, 0), ("b", 4, 1),
    ]
    one = samples.zero_fill_species(visits, counts, "b")
    assert rows(one, "sample_id", "count") == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_common_species_and_available(spark):
    counts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "species string, sample_id long")
    common = samples.common_species(counts, 2)
    assert rows(common, "species", "samples") == [("a", 2)]
    members = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "a")], "species_group string, species string")
    assert rows(samples.available_species(common, members), "species_group", "species") == [("g", "a"), ("h", "a")]


def test_reconcile_strata_keeps_old_and_numbers_new(spark):
    stored = spark.createDataFrame([("B", 5, 1), ("D", 7, 2)], "description string, n long, id long")
    frame = spark.createDataFrame([("C", 3), ("A", 4), ("B", 9)], "stratum string, n_frame long")
    kept = dimensions.reconcile_strata(stored, frame)
    assert rows(kept, "description", "n", "id") == [("A", 4, 3), ("B", 5, 1), ("C", 3, 4), ("D", 7, 2)]
    fresh = dimensions.reconcile_strata(stored, frame, refresh_n=True)
    assert ("B", 9, 1) in rows(fresh, "description", "n", "id")
    first = dimensions.reconcile_strata(stored.limit(0), frame)
    assert rows(first, "description", "id") == [("A", 1), ("B", 2), ("C", 3)]


def test_assign_keys(spark):
    known = spark.createDataFrame([("t", "f", 4), ("t", "g", 9)], "table string, field string, id long")
    incoming = spark.createDataFrame(
        [("t", "f"), ("a", "z"), ("u", "f"), ("a", "z")], "table string, field string"
    )
    keys = dimensions.assign_keys(known, incoming, ["table", "field"], Staging(spark))
    assert rows(keys, "table", "field", "id") == [("a", "z", 10), ("t", "f", 4), ("t", "g", 9), ("u", "f", 11)]
    first = dimensions.assign_keys(known.limit(0), incoming, ["table", "field"], Staging(spark))
    assert rows(first, "table", "field", "id") == [("a", "z", 1), ("t", "f", 2), ("u", "f", 3)]


def test_latest_version_breaks_ties_once(spark):
    df = spark.createDataFrame(
        [("f", 1, "a"), ("f", 3, "b"), ("f", 3, "c"), ("g", 2, "d")], "file string, day int, id string"
    )
    assert rows(dimensions.latest_version(df, ["file"], "day", "id"), "file", "day", "id") == [
        ("f", 3, "c"), ("g", 2, "d"),
    ]


def test_family_default(spark):
    species = spark.createDataFrame([("a",), ("b",), ("c",)], "species string")
    chosen = spark.createDataFrame([("a", "nbinomial"), ("b", None)], "species string, family string")
    assert rows(dimensions.with_family(species, chosen), "species", "family") == [
        ("a", "nbinomial"), ("b", "poisson"), ("c", "poisson"),
    ]


def test_species_groups_link_groups_and_species(spark):
    import hashlib

    sha = lambda x: hashlib.sha1(x.encode()).hexdigest()
    groups = spark.createDataFrame([(1, "Farmland (birds)")], "external_id long, name string")
    relation = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "external_id long, species long")
    species = spark.createDataFrame([(10, "wren"), (11, "tit")], "species long, name string")
    table, members = dimensions.species_groups(groups, relation, species)
    assert rows(table, "id", "description") == sorted((sha(n), n) for n in ("Farmland", "wren", "tit"))
    assert rows(members, "speciesgroup_id", "parent_id", "species") == sorted(
        [(sha("Farmland"), sha("wren"), False), (sha("Farmland"), sha("tit"), False),
         (sha("wren"), "10", True), (sha("tit"), "11", True)]
    )
