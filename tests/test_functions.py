import datetime
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallygrid.functions import (
    CLASS_LABELS,
    EFFECT_CLASSES,
    class_label,
    class_order,
    classify,
    cycle_of,
    cycle_period_label,
    in_season,
    interval_text,
    linearity,
    normal_quantile,
    season_period,
    slug,
    strip_suffix,
    wrapped_hash,
)
from tallygrid.functions.intervals import Z95, Z975
from tallygrid.operators.contrasts import parse_names
from tallygrid.operators.samples import PERIOD_STARTS, SEASON


def test_normal_score_at_any_probability(spark):
    from statistics import NormalDist

    from tallygrid.functions.intervals import normal_score

    inner = [1e-300, 1e-20, 1e-9, 0.001, 0.0249, 0.075, 0.076, 0.3, 0.5, 0.7, 0.925, 0.9999999, 1 - 1e-15]
    rows = spark.createDataFrame([(p,) for p in [*inner, 0.0, 1.0, -1.0, None]], "p double")
    got = {r["p"]: r["z"] for r in rows.select("p", normal_score(F.col("p")).alias("z")).collect()}
    for p in inner:
        assert got[p] == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-14)
    assert got[0.0] is got[1.0] is got[-1.0] is got[None] is None


def test_season_edges(spark):
    d = datetime.datetime
    rows = [
        (d(2010, 2, 28, 23, 59), None),
        (d(2010, 3, 1), 1),
        (d(2010, 4, 15, 23, 59), 1),
        (d(2010, 4, 16), 2),
        (d(2010, 5, 31, 12), 2),
        (d(2010, 6, 1), 3),
        (d(2010, 7, 16), 3),
        (d(2010, 7, 16, 0, 1), None),
        (d(2012, 2, 29), None),
    ]
    df = spark.createDataFrame(rows, "t timestamp_ntz, want int")
    got = F.when(in_season(F.col("t"), *SEASON), season_period(F.col("t"), PERIOD_STARTS))
    assert df.filter(~got.eqNullSafe(F.col("want"))).count() == 0


def test_cycle_floors(spark):
    df = spark.createDataFrame([(2003, -1), (2004, 0), (2006, 0), (2007, 1), (2009, 1), (2010, 2)], "y int, want int")
    assert df.filter(cycle_of(F.col("y"), 2007) != F.col("want")).count() == 0


def test_prototype_intervals_have_their_classes(spark):
    prototypes = [
        (0.0, 0.25, "~"), (1.0, 0.25, "+"), (-1.0, 0.25, "-"), (1.5, 0.25, "++"), (-1.5, 0.25, "--"),
        (0.5, 0.25, "+~"), (-0.5, 0.25, "-~"), (0.5, 0.5, "?+"), (-0.5, 0.5, "?-"), (0.0, 1.0, "?"),
    ]
    df = spark.createDataFrame(prototypes, "mean double, sd double, want string")
    low = normal_quantile(0.05, F.col("mean"), F.col("sd"))
    high = normal_quantile(0.95, F.col("mean"), F.col("sd"))
    got = df.select("want", classify(low, high, 1.0).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def brute_class(low, high, b):
    if low > 0:
        return "++" if low > b else "+" if high > b else "+~"
    if high < 0:
        return "--" if high < -b else "-" if low < -b else "-~"
    if low < -b and high > b:
        return "?"
    return "?-" if low < -b else "?+" if high > b else "~"


MIRROR = {"++": "--", "+": "-", "+~": "-~", "~": "~", "?+": "?-", "?": "?"}
MIRROR |= {v: k for k, v in MIRROR.items()}


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.floats(-2, 2).map(lambda x: round(x, 1)), st.floats(0, 2).map(lambda x: round(x, 1))),
        min_size=20,
        max_size=60,
    )
)
def test_classes_are_total_and_mirror(spark, pairs):
    rows = [(m - w, m + w) for m, w in pairs]
    df = spark.createDataFrame(rows, "l double, u double")
    got = df.select(
        "l",
        "u",
        classify(F.col("l"), F.col("u"), math.log(0.75)).alias("c"),
        classify(-F.col("u"), -F.col("l"), math.log(0.75)).alias("m"),
    ).collect()
    for r in got:
        assert r.c == brute_class(r.l, r.u, -math.log(0.75))
        assert r.m == MIRROR[r.c]


def test_class_order_and_labels(spark):
    df = spark.createDataFrame([(c,) for c in reversed(EFFECT_CLASSES)], "c string")
    rows = df.orderBy(class_order(F.col("c"))).select("c", class_label(F.col("c"), "nl").alias("nl")).collect()
    assert [r.c for r in rows] == EFFECT_CLASSES
    assert [r.nl for r in rows] == [CLASS_LABELS["nl"][c] for c in EFFECT_CLASSES]


def test_linearity_breaks(spark):
    df = spark.createDataFrame([(-2.5,), (-2.0,), (-1.0,), (0.0,), (0.1,)], "d double")
    got = [r[0] for r in df.select(linearity(F.col("d"))).collect()]
    assert got == ["non-linear"] * 2 + ["possibly non-linear"] * 2 + ["linear"]


def test_interval_text(spark):
    df = spark.createDataFrame([(math.log(1.123), math.log(0.96), math.log(1.301)), (-1e-9, -1e-9, 0.0)], "e double, l double, u double")
    change = interval_text(F.col("e"), F.col("l"), F.col("u"), percent=True, sign=True, change=True)
    level = interval_text(F.col("e"), F.col("l"), F.col("u"))
    plain = interval_text(F.col("e"), F.col("l"), F.col("u"), link="identity", digits=2)
    rows = df.select(change.alias("c"), level.alias("l"), plain.alias("p")).collect()
    assert rows[0].c == "+12.3% (-4.0%; +30.1%)"
    assert rows[0].l == "1.1 (1.0; 1.3)"
    assert rows[0].p == "0.12 (-0.04; 0.26)"
    assert rows[1].c == "+0.0% (+0.0%; +0.0%)"


def test_quantile_constants(spark):
    row = spark.range(1).select(
        normal_quantile(0.95, F.lit(0.0), F.lit(1.0)).alias("a"),
        normal_quantile(0.975, F.lit(1.0), F.lit(2.0)).alias("b"),
    ).first()
    assert row.a == pytest.approx(Z95, abs=1e-12) and row.b == pytest.approx(1 + 2 * Z975, abs=1e-12)


def test_texts(spark):
    row = spark.range(1).select(
        slug(F.lit("Cetti's Warbler XL")).alias("slug"),
        strip_suffix(F.lit("Farmland (birds)")).alias("name"),
        wrapped_hash(F.lit("a" * 20 + "b" * 20)).alias("hash"),
        cycle_period_label(F.lit(2007)).alias("period"),
    ).first()
    assert tuple(row) == ("cettis-warbler-xl", "Farmland", "a" * 20 + " " + "b" * 20, "2007-2009")


def test_parse_names_is_total(spark):
    names = ["index_2007_2010", "estimate_2008", "trend_2010.5_6", "linear_trend", "linear_estimate_07", "WAIC", "trend_x_y"]
    rows = {r["name"]: r for r in parse_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert (rows["index_2007_2010"].reference, rows["index_2007_2010"].alternative) == (2007, 2010)
    assert rows["estimate_2008"].year == 2008 and rows["linear_estimate_07"].year == 7
    assert (rows["trend_2010.5_6"].midpoint, rows["trend_2010.5_6"].window) == (2010.5, 6)
    assert rows["linear_trend"].kind == "linear_trend" and rows["WAIC"].kind is None
    assert rows["trend_x_y"].kind == "trend" and rows["trend_x_y"].midpoint is None
