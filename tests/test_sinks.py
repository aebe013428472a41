import pytest
from fixtures import random_survey
from pyspark.sql import functions as F

from tallygrid import Survey, files
from tallygrid.operators.effort import effort_history
from tallygrid.operators.lineage import analysis_fingerprint, table_fingerprint
from tallygrid.operators.ranking import number_rows
from tallygrid.schema import MissingColumns, column_comments, describe_columns, require_columns
from tallygrid.sources import (
    SchemaDrift,
    decode_column,
    export_csv,
    prune_partitions,
    read_table,
    read_tsv,
    replace_partitions,
    write_table,
)
from tallygrid.sources.text import encode_labels
from tallygrid.staging import Staging


@pytest.fixture
def counts(spark):
    rows = [("wren", 3, 1), ("tit", 1, 2), ("wren", 1, 5), ("grey wagtail/x=1", 2, 1)]
    return spark.createDataFrame(rows, "species string, sample_id long, count long")


def same(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


def test_roundtrip_plain_and_partitioned(spark, counts, tmp_path):
    assert same(counts, write_table(counts, f"{tmp_path}/a", ["species", "sample_id"], unique=True))
    back = write_table(counts, f"{tmp_path}/b", ["sample_id"], partition_by=["species"])
    assert back.columns == counts.columns and back.dtypes == counts.dtypes
    assert same(counts, back)
    assert same(counts, write_table(counts, f"{tmp_path}/b", ["sample_id"], partition_by=["species"]))


def test_strict_refuses_drift(spark, counts, tmp_path):
    write_table(counts, f"{tmp_path}/a", ["sample_id"])
    changed = counts.withColumn("count", F.col("count").cast("double"))
    with pytest.raises(SchemaDrift):
        write_table(changed, f"{tmp_path}/a", ["sample_id"])
    write_table(changed, f"{tmp_path}/a", ["sample_id"], strict=False)
    assert dict(read_table(spark, f"{tmp_path}/a").dtypes)["count"] == "double"


def test_unique_refuses_duplicates(counts, tmp_path):
    with pytest.raises(ValueError, match="do not identify"):
        write_table(counts, f"{tmp_path}/a", ["sample_id"], unique=True)


def test_files_are_sorted(spark, counts, tmp_path):
    write_table(counts.coalesce(1), f"{tmp_path}/a", ["species", "sample_id"])
    rows = [tuple(r) for r in read_table(spark, f"{tmp_path}/a").collect()]
    assert rows == sorted(rows)


def test_replace_and_prune_partitions(spark, counts, tmp_path):
    path = f"{tmp_path}/a"
    replace_partitions(counts, path, ["species"], ["sample_id"])
    replace_partitions(counts.filter("species = 'tit'").withColumn("count", F.lit(9).cast("long")), path, ["species"], ["sample_id"])
    got = {(r.species, r.sample_id): r["count"] for r in read_table(spark, path).collect()}
    assert got[("tit", 1)] == 9 and got[("wren", 3)] == 1 and len(got) == 4
    keep = counts.filter("species <> 'tit'").select("species").distinct()
    assert prune_partitions(spark, path, "species", keep) == ["species=tit"]
    assert {r.species for r in read_table(spark, path).select("species").collect()} == {"wren", "grey wagtail/x=1"}
    assert prune_partitions(spark, path, "species", keep) == []


def test_export_csv_rounds_and_documents(spark, tmp_path):
    df = spark.createDataFrame([("b", 0.123456), ("a", 2.0)], "name string, value double")
    df = describe_columns(df, {"value": "a number"})
    export_csv(df, f"{tmp_path}/out", ["name"], description="test")
    back = spark.read.option("header", "true").csv(f"{tmp_path}/out").orderBy("name").collect()
    assert [tuple(r) for r in back] == [("a", "2.0"), ("b", "0.1235")]
    fields = {r.name: (r.comment, r.description) for r in spark.read.json(f"{tmp_path}/out_columns").collect()}
    assert fields["value"] == ("a number", "test")


def test_comments_survive_a_write(spark, counts, tmp_path):
    described = describe_columns(counts, {"count": "individuals", "species": "key"})
    write_table(described, f"{tmp_path}/a", ["sample_id"])
    assert column_comments(read_table(spark, f"{tmp_path}/a")) == {"count": "individuals", "species": "key"}


def test_missing_columns_fail_early(counts):
    with pytest.raises(MissingColumns, match="lacks year"):
        require_columns(counts, ["species", "year"], "counts")


def test_tsv_with_codes(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("id\tstratum\tn\n1\t2\t5\n2\tNA\t7\n3\t1\tNA\n")
    table = read_tsv(spark, str(tmp_path / "t.tsv"), "id int, stratum int, n int")
    labels = spark.createDataFrame([(1, "forest"), (2, "urban")], "code int, label string")
    got = {r.id: (r.stratum, r.n) for r in decode_column(table, "stratum", labels).collect()}
    assert got == {1: ("urban", 5), 2: (None, 7), 3: ("forest", None)}


def test_label_codes_are_alphabetical(spark, counts):
    labels = encode_labels(counts, "species", Staging(spark))
    assert {r.label: r.code for r in labels.collect()} == {"grey wagtail/x=1": 1, "tit": 2, "wren": 3}


def test_number_rows_is_a_global_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"), (F.col("id") % 3).alias("k"))
    got = number_rows(df, [F.col("k").desc(), F.col("v")], "place", Staging(spark)).collect()
    want = sorted(((r.k, r.v) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.k, r.v) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 5001))


def test_fingerprint_ignores_order_and_sees_changes(spark, counts):
    columns = counts.columns
    digest = lambda df: tuple(table_fingerprint(df, columns).first())
    assert digest(counts) == digest(counts.orderBy(F.desc("sample_id")).repartition(3))
    assert digest(counts) != digest(counts.withColumn("count", F.col("count") + 1))
    assert digest(counts) != digest(counts.unionAll(counts.limit(1)))
    null = counts.withColumn("species", F.lit(None).cast("string"))
    assert digest(null) != digest(counts.withColumn("species", F.lit("")))
    assert digest(null) != digest(counts.withColumn("species", F.lit("\\N")))
    assert digest(null) != digest(counts.withColumn("species", F.lit("-")))
    pair = lambda a, b: table_fingerprint(spark.createDataFrame([(a, b)], "a string, b string"), ["a", "b"]).first().digest
    assert pair("a|b", "c") != pair("a", "b|c") and pair("a|1:b", "c") != pair("a", "b|1:c")


def test_stages_of_two_sources_are_told_apart(spark):
    staging = Staging(spark)
    counts = [
        Survey(spark, random_survey(spark, seed, n_samples=n), staging=staging, keep_counts=True).counts.count()
        for seed, n in ((1, 60), (2, 120), (1, 60))
    ]
    assert counts[0] == counts[2] != counts[1]


def test_whole_history_orders_squares(spark):
    long = list(range(2000, 2010))
    rows = [("s", "a", [*long, 2012, 2014]), ("s", "b", [*long, 2011, 2014]), ("s", "c", [*long, 2014]), ("s", "d", [2000, 2014])]
    squares = spark.createDataFrame(rows, "stratum string, square string, years array<int>")
    got = effort_history(squares, 2000, Staging(spark)).orderBy("place").collect()
    assert [r.square for r in got] == ["b", "a", "c", "d"]


def test_analysis_fingerprint_depends_on_definition_and_data(spark, counts):
    def prints(family, bonus):
        definition = spark.createDataFrame([("wren", family), ("tit", family)], "species string, family string")
        data = counts.withColumn("count", F.col("count") + bonus * F.when(F.col("species") == "tit", 1).otherwise(0))
        rows = analysis_fingerprint(definition, data, ["species"], ["sample_id", "count"]).collect()
        return {r.species: r.fingerprint for r in rows}

    one, again, other, changed = prints("poisson", 0), prints("poisson", 0), prints("nbinomial", 0), prints("poisson", 1)
    assert one == again and not set(one.values()) & set(other.values())
    assert one["wren"] == changed["wren"] and one["tit"] != changed["tit"]


def test_staging_uses_the_named_folder_and_releases(spark):
    staging = Staging(spark)
    table = staging.table("t", lambda: spark.range(3).toDF("id"))
    assert staging.folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert staging.table("t", lambda: 1 / 0) is table and table.count() == 3
    assert "Range" not in table._jdf.queryExecution().optimizedPlan().toString()
    assert staging.intact()
    files.delete(spark, staging.folder)
    assert not staging.intact()
    staging.write("u", spark.range(2).toDF("id"))
    staging.release()
    assert staging.intact() and not files.exists(spark, staging.folder)
