"""Adjusted effects against a dense Poisson fit."""

import math
import random

import numpy as np
import pytest

from tallygrid.operators import adjusted
from tallygrid.staging import Staging

RELEVANT = "species string, stratum string, square string, point_id long, year int, period int, n long, c long"
CHOICE = "species string, period_term boolean, point_term boolean"


def visits(seed=4):
    rng = random.Random(seed)
    rows = []
    for stratum in "AB":
        for k in range(6):
            place = rng.uniform(0.3, 3)
            for year in range(2001, 2006):
                for period in (1, 2):
                    n = rng.randrange(4)
                    mean = n * place * (1 + 0.2 * (year - 2001)) * (1.5 if period == 2 else 1) * (2 if stratum == "A" else 1)
                    c = int(np.random.default_rng(rng.randrange(1 << 30)).poisson(5 * mean))
                    if n:
                        rows.append(("s", stratum, f"{stratum}{k}", 10 * k + (n % 2), year, period, n, c))
    return rows


def dense(rows, place_of):
    """Newton's method on all coefficients, with the factors scaled like those of the operator."""
    levels = sorted({(r[1], r[4]) for r in rows})
    places = sorted({place_of(r) for r in rows})
    periods = sorted({r[5] for r in rows})
    # The first place of each stratum and the first period are the references.
    first = {}
    for r in sorted(rows, key=place_of):
        first.setdefault(r[1], place_of(r))
    free_places = [p for p in places if p not in first.values()]
    x = np.zeros((len(rows), len(levels) + len(free_places) + len(periods) - 1))
    for i, r in enumerate(rows):
        x[i, levels.index((r[1], r[4]))] = 1
        if place_of(r) in free_places:
            x[i, len(levels) + free_places.index(place_of(r))] = 1
        if r[5] != periods[0]:
            x[i, len(levels) + len(free_places) + periods.index(r[5]) - 1] = 1
    n, c = np.array([r[6] for r in rows]), np.array([r[7] for r in rows])
    beta = np.zeros(x.shape[1])
    beta[: len(levels)] = math.log(c.sum() / n.sum())
    for _ in range(60):
        mu = n * np.exp(x @ beta)
        beta += np.linalg.lstsq(x.T @ (mu[:, None] * x), x.T @ (c - mu), rcond=None)[0]
    s = {p: math.exp(beta[len(levels) + free_places.index(p)]) if p in free_places else 1.0 for p in places}
    t = {p: math.exp(beta[len(levels) + len(free_places) + i - 1]) if i else 1.0 for i, p in enumerate(periods)}
    mean_t = sum(r[6] * t[r[5]] for r in rows) / n.sum()
    out = {}
    for i, (stratum, year) in enumerate(levels):
        own = [r for r in rows if r[1] == stratum]
        mean_s = sum(r[6] * s[place_of(r)] for r in own) / sum(r[6] for r in own)
        out[stratum, year] = beta[i] + math.log(mean_s * mean_t)
    return out


@pytest.mark.parametrize("places", ["square", "design"])
def test_levels_are_those_of_the_dense_fit(spark, places):
    rows = visits()
    choice = spark.createDataFrame([("s", True, True)], CHOICE)
    cells = adjusted.place_cells(spark.createDataFrame(rows, RELEVANT), choice, 2001, 3, places)
    found = adjusted.adjusted_effects(cells, Staging(spark)).collect()
    assert all(r["converged"] for r in found)
    expected = dense(rows, (lambda r: r[2]) if places == "square" else (lambda r: f"{r[2]}/{r[3]}"))
    got = {(r["stratum"], r["label"]): r["b"] for r in found if r["frequency"] == "year"}
    assert got == pytest.approx(expected, abs=1e-6)


def test_without_terms_levels_are_mean_counts(spark):
    rows = [("s", "A", "x", 1, 2001, p, 2, c) for p, c in ((1, 3), (2, 9))] + [("s", "A", "x", 1, 2002, 1, 4, 0)]
    choice = spark.createDataFrame([("s", False, False)], CHOICE)
    cells = adjusted.place_cells(spark.createDataFrame(rows, RELEVANT), choice, 2001)
    got = {r["label"]: r["b"] for r in adjusted.adjusted_effects(cells, Staging(spark)).collect() if r["frequency"] == "year"}
    assert got[2001] == pytest.approx(math.log(3)) and got[2002] == pytest.approx(math.log(0.5 / 4))
