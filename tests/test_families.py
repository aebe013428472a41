"""Fits of the families and random walks against dense likelihoods and matrices."""

import math
import random

import numpy as np
import pytest
from tallygrid.operators import contrasts, effects, families, smoothing

EFFECTS = "species string, frequency string, stratum string, t int, label int, n long, c long, b double, var double, imputed boolean"


def log_likelihood(cells, family, zeros, size, means):
    out = 0.0
    for counts, mu in zip(cells, means):
        for y in counts:
            if mu == 0:
                p = 1.0 if y == 0 else 0.0
            elif family in families.WITH_SIZE:
                p = math.exp(
                    math.lgamma(y + size) - math.lgamma(size) - math.lgamma(y + 1)
                    + size * math.log(size / (size + mu)) + y * math.log(mu / (size + mu))
                )
            else:
                p = math.exp(-mu + y * math.log(mu) - math.lgamma(y + 1))
            if family in families.WITH_ZEROS:
                p = zeros * (y == 0) + (1 - zeros) * p
            out += math.log(p)
    return out


def draws(rng, family, mu, n):
    out = []
    for _ in range(n):
        rate = mu * rng.gammavariate(1.5, 1 / 1.5) if family in families.WITH_SIZE else mu
        y = int(np.random.default_rng(rng.randrange(1 << 30)).poisson(rate))
        out.append(0 if family in families.WITH_ZEROS and rng.random() < 0.4 else y)
    return out


def tables(spark, counts):
    """Samples, relevant cells and grid of one species per entry of ``counts`` (cells of lists)."""
    samples, cells, grid = [], [], []
    for species, lists in counts.items():
        for t, ys in enumerate(lists):
            n, pos, c = len(ys), sum(y > 0 for y in ys), sum(ys)
            grid += [(species, f, "A", t + 1, 2000 + t, n, pos, c, sum(y * y for y in ys)) for f in ("year", "cycle")]
            cells.append((species, t, 2000 + t, 1, n))
            samples += [(species, t, 2000 + t, 1, y) for y in ys]
    return (
        spark.createDataFrame(samples, "species string, point_id long, year int, period int, count long"),
        spark.createDataFrame(cells, "species string, point_id long, year int, period int, n long"),
        spark.createDataFrame(
            grid, "species string, frequency string, stratum string, t int, label int, n long, n_pos long, c long, c2 long"
        ),
    )


def test_fits_are_at_the_maximum_of_the_likelihood(spark):
    rng = random.Random(7)
    counts = {f: [draws(rng, f, mu, 60) for mu in (0.8, 2.0, 6.0)] for f in families.FAMILIES}
    counts["poisson"].append([])  # a time step without visits
    samples, cells, grid = tables(spark, counts)
    tails = families.count_tails(samples, cells)
    chosen = spark.createDataFrame([(f, f) for f in counts], "species string, family string")
    found = families.family_effects(grid, tails, chosen).collect()
    assert {r["status"] for r in found if r["n"]} == {"converged"}
    assert all(r["b"] is None and r["var"] is None for r in found if not r["n"])
    for family in families.FAMILIES:
        rows = sorted((r for r in found if r["species"] == family and r["frequency"] == "year" and r["n"]), key=lambda r: r["t"])
        lists = [ys for ys in counts[family] if ys]
        zeros, size = rows[0]["zeros"], rows[0]["size"] or 1.0
        means = [math.exp(r["b"]) for r in rows]
        best = log_likelihood(lists, family, zeros, size, means)
        for h in (1e-3, -1e-3):
            if family in families.WITH_ZEROS:
                assert log_likelihood(lists, family, zeros * (1 + h), size, means) < best
            if family in families.WITH_SIZE:
                assert log_likelihood(lists, family, zeros, size * (1 + h), means) < best
            for i in range(len(means)):
                moved = [m * (1 + h * (i == j)) for j, m in enumerate(means)]
                assert log_likelihood(lists, family, zeros, size, moved) < best
        if family in ("poisson", "zeroinflatedpoisson1"):
            # Observed information on the logarithm of each mean, by differences.
            for i, r in enumerate(rows):
                d = 1e-3
                up, down = (
                    log_likelihood(lists, family, zeros, size, [m * math.exp(s * d * (i == j)) for j, m in enumerate(means)])
                    for s in (1, -1)
                )
                assert r["var"] == pytest.approx(-d * d / (up - 2 * best + down), rel=1e-3)


def test_odd_series(spark):
    counts = {"none": [[0, 0, 0], [0]], "same": [[3, 3, 3], [3, 3]], "one": [[5]], "unknown": [[1, 2]]}
    samples, cells, grid = tables(spark, counts)
    tails = families.count_tails(samples, cells)
    names = {"none": "zeroinflatednbinomial1", "same": "nbinomial", "one": "zeroinflatedpoisson1", "unknown": "gamma"}
    chosen = spark.createDataFrame([*names.items()], "species string, family string")
    found = {(r["species"], r["t"]): r for r in families.family_effects(grid, tails, chosen).collect() if r["frequency"] == "year"}
    assert found["none", 1]["b"] is None  # without an individual there is no series
    assert found["same", 1]["b"] == pytest.approx(math.log(3)) and found["same", 1]["status"] == "converged"
    # No overdispersion: the size is at its bound, the variance that of a Poisson count.
    assert found["same", 1]["var"] == pytest.approx(1 / 9, rel=1e-4)
    assert found["one", 1]["b"] == pytest.approx(math.log(5))
    assert found["unknown", 1]["status"] == "error" and found["unknown", 1]["b"] is None


def test_one_step_does_not_pass_for_a_fit(spark):
    rng = random.Random(1)
    samples, cells, grid = tables(spark, {"a": [draws(rng, "nbinomial", 3.0, 50)]})
    chosen = spark.createDataFrame([("a", "zeroinflatednbinomial1")], "species string, family string")
    found = families.family_effects(grid, families.count_tails(samples, cells), chosen, steps=1).collect()
    assert {r["status"] for r in found} == {"not converged"}


def walks(seed=3):
    rng = random.Random(seed)
    rows = []
    for stratum, known in (("A", [1, 2, 5, 6, 7]), ("B", [3]), ("C", list(range(1, 9)))):
        level = 0.0
        for t in range(1, 9):
            level += rng.gauss(0, 0.4)
            seen = t in known
            v = rng.uniform(0.01, 0.3)
            rows.append(("s", "year", stratum, t, 2000 + t, 3 * seen, 4 * seen, level if seen else None, v if seen else None, not seen))
    return rows


def dense(rows, tau2):
    """Means and covariances of the walk of one stratum, by solving the whole system."""
    n = len(rows)
    q, h = np.zeros((n, n)), np.zeros(n)
    for i in range(n - 1):
        q[i : i + 2, i : i + 2] += np.array([[1, -1], [-1, 1]]) / tau2
    for i, r in enumerate(rows):
        if not r[9]:
            q[i, i] += 1 / r[8]
            h[i] += r[7] / r[8]
    cov = np.linalg.inv(q)
    return cov @ h, cov


def test_walk_equals_the_dense_solution(spark):
    rows = walks()
    table = spark.createDataFrame(rows, EFFECTS)
    got = smoothing.smoothed_effects(table).collect()
    tau2 = got[0]["tau2"]
    more = gone = 0.0
    for stratum in "ABC":
        seen = [r for r in rows if r[2] == stratum and not r[9]]
        for a, b in zip(seen, seen[1:]):
            more += (b[7] - a[7]) ** 2 - a[8] - b[8]
            gone += b[3] - a[3]
    assert tau2 == pytest.approx(max(more / gone, smoothing.LEAST_STEP))
    covs = {}
    for stratum in "ABC":
        mean, cov = dense([r for r in rows if r[2] == stratum], tau2)
        covs[stratum] = cov
        own = sorted((r for r in got if r["stratum"] == stratum), key=lambda r: r["t"])
        assert [r["b"] for r in own] == pytest.approx(mean.tolist())
        assert [r["var"] for r in own] == pytest.approx(np.diag(cov).tolist())
        assert [r["gain"] for r in own[1:]] == pytest.approx([cov[i, i + 1] / cov[i, i] for i in range(7)])
    steep = spark.createDataFrame([("s", "year", 0.5)], "species string, frequency string, tau2 double")
    inside = {r["t"]: r["var"] for r in smoothing.smoothed_effects(table, steep).collect() if r["stratum"] == "A"}
    assert inside[3] > inside[2] and inside[4] > inside[5] and inside[8] > inside[7]

    weights = spark.createDataFrame([("s", x, w) for x, w in zip("ABC", (0.5, 0.2, 0.3))], "species string, stratum string, weight double")
    smooth = effects.weighted(smoothing.smoothed_effects(table), weights)
    table_of = contrasts.contrast_table(smooth, (3,), (2,))
    found = {r["name"]: r for r in smoothing.correlated_contrasts(table_of, smooth).collect()}
    coefs = {}
    for r in table_of.collect():
        coefs.setdefault(r["name"], {}).setdefault(r["stratum"], np.zeros(8))[r["t"] - 1] += r["coef"]
    assert set(found) == set(coefs) and len(coefs) > 30
    for name, by_stratum in coefs.items():
        variance = sum(a @ covs[x] @ a for x, a in by_stratum.items())
        assert found[name]["variance"] == pytest.approx(variance)
    plain = {r["name"]: r["variance"] for r in contrasts.apply_contrasts(table_of, smooth).collect()}
    assert plain["index_2003_2004"] > 1.2 * found["index_2003_2004"]["variance"]


def test_exact_lines_say_whether_they_converged(spark):
    rows = []
    rng = random.Random(2)
    for stratum, cs in (("A", [5, 9, 12, 30, 41]), ("B", [1, 0, 0, 0, 200]), ("C", [7])):
        for t, c in enumerate(cs, 1):
            n = rng.randrange(3, 20)
            rows.append(("s", "year", stratum, t, 2000 + t, n, c, math.log(max(c, 0.5) / n), 1 / max(c, 0.5), False))
    table = spark.createDataFrame(rows, EFFECTS)
    found = {r["stratum"]: r for r in effects.exact_fits(table).collect()}
    assert found["A"]["converged"] and found["B"]["converged"] and found["C"]["converged"]
    for stratum in "AB":
        own = [r for r in rows if r[2] == stratum]

        def score(a, b):
            rest = [(r[6] - r[5] * math.exp(a + b * r[3]), r[3]) for r in own]
            return sum(x for x, _ in rest), sum(x * t for x, t in rest)

        assert score(found[stratum]["alpha"], found[stratum]["beta"]) == pytest.approx((0, 0), abs=1e-6)
    assert not any(r["converged"] for r in effects.exact_fits(table.filter("stratum <> 'C'"), steps=1).collect())
    assert found["C"]["beta"] == 0


def test_a_line_without_a_maximum_does_not_converge(spark):
    rows = [("s", "year", "A", t, 2000 + t, 9, 0, math.log(0.5 / 9), 2.0, False) for t in range(1, 5)]
    rows += [("s", "year", "B", t, 2000 + t, 9, 30 * (t == 4), math.log(max(30 * (t == 4), 0.5) / 9), 1.0, False) for t in range(1, 5)]
    found = effects.exact_fits(spark.createDataFrame(rows, EFFECTS)).collect()
    assert [r["converged"] for r in found] == [False, False]
    assert all(math.isfinite(r["alpha"]) and math.isfinite(r["beta"]) for r in found)
