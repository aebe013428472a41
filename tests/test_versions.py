"""Differences between two versions of a table, label order, and the gates of the relevance rules."""

from collections import Counter

from tallygrid.operators import lineage, relevance, reports

ROWS = "k string, a long, b string"


def test_diff_finds_partitions_and_rows(spark):
    old = [("p", 1, "x"), ("p", 1, "x"), ("q", 2, None), ("r", 3, "y"), ("s", 4, "z"), ("t", 5, "1|2")]
    new = [("p", 1, "x"), ("q", 2, None), ("r", 3, "Y"), ("u", 6, ""), ("s", 4, "z"), ("t", 5, "1|2"), ("p", 1, "w")]
    found = lineage.table_diff(spark.createDataFrame(old, ROWS), spark.createDataFrame(new, ROWS), ["k"], ["k", "a", "b"])
    got = {r["k"]: (r["change"], r["old_rows"], r["new_rows"], r["rows_gone"], r["rows_new"]) for r in found.collect()}
    assert got == {
        "p": ("changed", 2, 2, 1, 1),
        "q": ("same", 1, 1, 0, 0),
        "r": ("changed", 1, 1, 1, 1),
        "s": ("same", 1, 1, 0, 0),
        "t": ("same", 1, 1, 0, 0),
        "u": ("added", 0, 1, 0, 1),
    }
    gone = lineage.table_diff(spark.createDataFrame(old, ROWS), spark.createDataFrame([], ROWS), ["k"], ["k", "a", "b"])
    assert {r["change"] for r in gone.collect()} == {"removed"}


def test_numbers_come_before_texts(spark):
    labels = ["10", "9", "b", "9.5", None, "a", "-1", "9"]
    table = spark.createDataFrame([(x,) for x in labels], "label string")
    got = reports.numbers_first(table, "label").orderBy("place").collect()
    assert [r["label"] for r in got] == ["-1", "9", "9", "9.5", "10", "a", "b", None]
    assert [r["place"] for r in got] == [1, 2, 2, 3, 4, 5, 6, 7]


def profile(spark, squares):
    """Squares: species, stratum, square, and tallies of (cycle, period, n, n_pos, c)."""
    kind = "species string, stratum string, square string, tallies array<struct<cycle:int,period:int,n:long,n_pos:long,c:long>>"
    return spark.createDataFrame(squares, kind)


def test_every_gate_is_told(spark):
    two = [(1, 1, 4, 4, 40), (2, 1, 4, 4, 40)]
    weak = [*two, (1, 2, 9, 1, 1)]

    def squares(species, stratum, tallies):
        return [(species, stratum, f"{stratum}{i}", t) for i, t in enumerate(tallies)]

    rows = [
        *squares("ok", "A", [two, two]),
        *squares("few", "A", [[(1, 1, 2, 2, 9)]]),
        *squares("once", "A", [two, [(1, 1, 4, 9, 9)]]),
        *squares("lone", "A", [two]) + squares("lone", "B", [two]),
        *squares("off", "A", [weak[:2] + [(1, 2, 90, 4, 4)], [(1, 1, 4, 1, 40), (2, 2, 90, 2, 4)]]),
    ]
    table = profile(spark, rows)
    candidates = relevance.candidate_strata(table, 3, 2, 2, 0.5)
    got = {r["species"]: r for r in relevance.gate_trace(table, candidates, 12, 2, 2).collect()}
    assert got["ok"]["gate"] is None and [got["ok"][f"pos_{i}"] for i in range(6)] == [16] * 6
    assert got["few"]["gate"] == 0 and got["few"]["pos_1"] is None
    assert got["once"]["gate"] == 1 and got["once"]["pos_1"] == 8
    assert got["lone"]["gate"] == 2 and got["lone"]["pos_2"] == 0 and got["lone"]["pos_3"] is None
    assert got["off"]["gate"] == 3 and got["off"]["pos_2"] == 15 and got["off"]["pos_3"] == 9
    assert Counter(r["gate"] is None for r in got.values()) == {True: 1, False: 4}
