"""The pipeline on odd rows, and the helper that drops rows without moving the others."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallygrid.llm import common, decontamination, simhash
from tallygrid.llm.common import without
from tallygrid.staging import Staging
from tests.llm.fixtures import corpus, frame, row


def write(spark, folder, rows, labels):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    passage = " ".join(f"word{i}" for i in range(14))
    items = spark.createDataFrame([("b1", passage), ("b2", None), ("b3", "")], "item_id string, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return passage


def test_pipeline_on_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    prose = [row(1000 + i, " ".join(rng.choices(["stone", "river", "and", "the", "light"], k=60))) for i in range(30)]
    passage = " ".join(f"word{i}" for i in range(14))
    rows = corpus(3, 40) + prose + [row(2000, f"before {passage} after"), row(2001, prose[0][1])]
    labels = [(r[0], 1, 0) for r in rows if r[0] is not None] + [(None, 1, 0), (5, None, None)]
    folder = f"file://{tmp_path}/in"
    write(spark, folder, rows, labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = Staging(spark).write(name, stage(spark, docs, folder))
        assert left.columns == docs.columns
        docs = left
        if name == "decontamination":
            ids = {r[0] for r in docs.select("doc_id").collect()}
            assert 2000 not in ids and 2001 not in ids and 1000 in ids
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(r[0] or -1 for r in found.collect()) == sorted(r[0] or -1 for r in docs.select("doc_id").collect())


def test_pipeline_on_an_empty_table(spark, tmp_path):
    folder = f"file://{tmp_path}/in"
    write(spark, folder, [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0


@pytest.mark.parametrize("slots", [1, 8, common.SLOTS])
def test_rows_go_exactly_however_few_bits_there_are(spark, monkeypatch, slots):
    monkeypatch.setattr(common, "SLOTS", slots)
    docs = frame(spark, corpus(9, 60))
    ids = sorted({r[0] for r in docs.select("doc_id").collect() if r[0] is not None})
    gone = spark.createDataFrame([(i,) for i in ids[::3]] + [(None,)], "doc_id long")
    left = without(docs, [docs["doc_id"]], gone)
    assert left.columns == docs.columns
    expected = docs.where(F.col("doc_id").isNotNull() & ~F.col("doc_id").isin(ids[::3]))
    assert sorted(map(str, left.collect())) == sorted(map(str, expected.collect()))
    assert without(docs, [docs["doc_id"]], gone.limit(0)).count() == docs.count()


def test_a_component_of_half_the_rows_is_split(spark):
    words = [f"w{i}" for i in range(40)]
    # One changed word far apart from the others leaves most bits alone.
    rows = [row(i, " ".join(words * 30 + [f"tail{i}"])) for i in range(60)]
    rows += [row(1000 + i, " ".join(random.Random(i).choices(words, k=50))) for i in range(60)]
    found = simhash.near_duplicates(frame(spark, rows), Staging(spark)).collect()
    prints = {r["doc_id"]: r["fp"] & (2**64 - 1) for r in found}
    parent = {d: d for d in prints}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= simhash.DISTANCE:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {r["doc_id"]: r["component_id"] for r in found} == {d: root(d) for d in prints}
    kept = simhash.deduplicated(frame(spark, rows), Staging(spark))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({root(d) for d in prints})


def test_clean_keeps_only_documents_without_a_hit(spark):
    passage = " ".join(f"word{i}" for i in range(14))
    rows = [row(1, passage), row(1, "another text of this id"), row(None, f"x {passage}"), row(None, None), row(2, "")]
    items = spark.createDataFrame([("b1", passage)], "item_id string, text string")
    left = decontamination.clean(frame(spark, rows), items, Staging(spark)).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in left) == sorted(
        str(x) for x in [(1, "another text of this id"), (None, None), (2, "")]
    )
