"""The same results in SQL, written from the definitions rather than from the library.

Every statement is a chain of named tables; ``statement`` keeps those that the last one needs.
The relevance rules are spelled out on zero-filled samples, one table and one check of the
number of positive counts per rule.
"""

from __future__ import annotations

import math
import re
from statistics import NormalDist

Z95 = 1.6448536269514722
Z975 = 1.959963984540054
THRESHOLD = math.log(0.75)
BASE = 1995


def _classify(low: str, high: str, threshold: str) -> str:
    b = f"abs({threshold})"
    return f"""CASE
      WHEN {low} > 0 THEN CASE WHEN {low} > {b} THEN '++' WHEN {high} > {b} THEN '+' ELSE '+~' END
      WHEN {high} < 0 THEN CASE WHEN {high} < -{b} THEN '--' WHEN {low} < -{b} THEN '-' ELSE '-~' END
      WHEN {low} < -{b} AND {high} > {b} THEN '?'
      WHEN {low} < -{b} THEN '?-'
      WHEN {high} > {b} THEN '?+'
      ELSE '~' END"""


def _label(effect: str) -> str:
    return f"""CASE {effect} WHEN '++' THEN 'strong increase' WHEN '+' THEN 'increase'
      WHEN '+~' THEN 'moderate increase' WHEN '~' THEN 'stable' WHEN '-~' THEN 'moderate decrease'
      WHEN '-' THEN 'decrease' WHEN '--' THEN 'strong decrease' WHEN '?+' THEN 'potential increase'
      WHEN '?-' THEN 'potential decrease' WHEN '?' THEN 'unclear' WHEN 'R' THEN 'reference' END"""


def _number(x: str, sign: bool, percent: bool) -> str:
    r = f"round({x}{' * 100' if percent else ''}, 1)"
    pattern = f"%{'+' if sign else ''}.1f" + ("%%" if percent else "")
    return f"printf('{pattern}', CASE WHEN {r} = 0 THEN 0::DOUBLE ELSE {r} END)"


def _change(x: str) -> str:
    return _number(f"(exp({x}) - 1)", True, True)


def _change_text(e: str, low: str, high: str) -> str:
    return f"{_change(e)} || ' (' || {_change(low)} || '; ' || {_change(high)} || ')'"


def _level_text(e: str, low: str, high: str) -> str:
    return (
        f"{_number(f'exp({e})', False, False)} || ' (' || {_number(f'exp({low})', False, False)}"
        f" || '; ' || {_number(f'exp({high})', False, False)} || ')'"
    )


def _limits(e: str = "estimate", v: str = "variance") -> str:
    return f"{e} - {Z975} * sqrt({v}) AS lcl, {e} + {Z975} * sqrt({v}) AS ucl"


def _results(keys: str, source: str) -> str:
    s = f"(ucl - lcl) / (2 * {Z975}) * {Z95}"
    return f"""SELECT {keys}, round(estimate, 4) AS estimate, round(estimate - {s}, 4) AS lcl,
      round(estimate + {s}, 4) AS ucl FROM {source}"""


def _cycle(year: str) -> str:
    return f"CAST(floor(({year} - {BASE}) / 3.0) + 1 AS INTEGER)"


def _gate(table: str, k: int) -> str:
    return f"""species IN (SELECT species FROM {table} WHERE count > 0
      GROUP BY species HAVING count(*) >= {k})"""


def _fill(source: str, keys: str) -> str:
    """Known b and v before and after every cell of a line, in order of t."""
    back = f"OVER (PARTITION BY {keys} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER (PARTITION BY {keys} ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"""SELECT * EXCLUDE (b, v, t0, b0, v0, t1, b1, v1),
      b IS NULL AS imputed,
      CASE WHEN b IS NOT NULL THEN b WHEN b0 IS NULL THEN b1 WHEN b1 IS NULL THEN b0
        ELSE b0 + (b1 - b0) * ((t - t0)::DOUBLE / (t1 - t0)) END AS b,
      CASE WHEN b IS NOT NULL THEN v ELSE greatest(coalesce(v0, v1), coalesce(v1, v0)) END AS var
    FROM (SELECT *,
      last_value(CASE WHEN b IS NOT NULL THEN t END IGNORE NULLS) {back} AS t0,
      last_value(b IGNORE NULLS) {back} AS b0,
      last_value(CASE WHEN b IS NOT NULL THEN v END IGNORE NULLS) {back} AS v0,
      first_value(CASE WHEN b IS NOT NULL THEN t END IGNORE NULLS) {ahead} AS t1,
      first_value(b IGNORE NULLS) {ahead} AS b1,
      first_value(CASE WHEN b IS NOT NULL THEN v END IGNORE NULLS) {ahead} AS v1
      FROM {source})"""


def _grid(cells: str, line: str) -> str:
    """All time steps of a species in all of its lines, with totals and known effects."""
    return f"""SELECT l.species, l.frequency, l.{line}, s.t,
      CAST(CASE WHEN l.frequency = 'cycle' THEN {BASE} + 3 * (s.t - 1) ELSE m.first_year + s.t - 1 END
        AS INTEGER) AS label,
      coalesce(c.n, 0) AS n, coalesce(c.n_pos, 0) AS n_pos, coalesce(c.c, 0) AS c, coalesce(c.c2, 0) AS c2,
      CASE WHEN coalesce(c.n, 0) > 0 THEN
        ln((CASE WHEN c.c > 0 THEN c.c::DOUBLE ELSE 0.5::DOUBLE END) / c.n) END AS b,
      CASE WHEN coalesce(c.n, 0) > 0 THEN
        1 / (CASE WHEN c.c > 0 THEN c.c::DOUBLE ELSE 0.5::DOUBLE END) END AS v
    FROM (SELECT DISTINCT species, frequency, {line} FROM {cells}) l
    JOIN (SELECT species, frequency, min(t) AS lo, max(t) AS hi, min(year) AS first_year
          FROM {cells} GROUP BY species, frequency) m
      ON l.species = m.species AND l.frequency = m.frequency
    JOIN (SELECT CAST(unnest(range(-100, 200)) AS INTEGER) AS t) s ON s.t BETWEEN m.lo AND m.hi
    LEFT JOIN {cells} c ON c.species = l.species AND c.frequency = l.frequency
      AND c.{line} = l.{line} AND c.t = s.t"""


def _time_cells(source: str, line: str) -> str:
    sums = "CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_pos) AS BIGINT) AS n_pos, CAST(sum(c) AS BIGINT) AS c, CAST(sum(c2) AS BIGINT) AS c2"
    return f"""SELECT species, 'year' AS frequency, {line}, year,
      CAST(year - min(year) OVER (PARTITION BY species) + 1 AS INTEGER) AS t,
      n, n_pos, c, c2
    FROM (SELECT species, {line}, year, {sums} FROM {source} GROUP BY ALL)
    UNION ALL
    SELECT species, 'cycle', {line}, {BASE} + 3 * (t - 1), t, n, n_pos, c, c2
    FROM (SELECT species, {line}, {_cycle('year')} AS t, {sums} FROM {source} GROUP BY ALL)"""


def _family_steps() -> str:
    """Fits of the families, a row per step: zeros and means in turn with a step of the size."""
    mean = "means[i]"
    chance = f"CASE WHEN has_size THEN pow(exp(lambda_) / (exp(lambda_) + {mean}), exp(lambda_)) ELSE exp(-{mean}) END"
    return f"""WITH RECURSIVE walk AS (
      SELECT *, CASE WHEN has_zeros THEN list_sum(list_transform(cells, lambda x: x.z))
          / list_sum(list_transform(cells, lambda x: x.n)) / 2 ELSE 0::DOUBLE END AS zeros,
        0::DOUBLE AS lambda_, list_transform(cells, lambda x: x.c / x.n) AS means, 1::DOUBLE AS moved, 0 AS step
      FROM family_series
      UNION ALL
      SELECT species, frequency, family, tails, cells, has_zeros, has_size, zeros1, lambda1, means1,
        greatest(abs(zeros1 - zeros), abs(lambda1 - lambda_), list_max(list_transform(means1, lambda x, i:
          CASE WHEN means[i] > 0 THEN abs(x / means[i] - 1) ELSE abs(x - means[i]) END))), step + 1
      FROM (SELECT *, CASE WHEN NOT has_size THEN lambda_ ELSE greatest(-13.815510557964274, least(13.815510557964274,
          lambda_ + greatest(-1, least(1, CASE WHEN h < 0 THEN -g / h ELSE sign(g) END)))) END AS lambda1
      FROM (SELECT *, k * d1 AS g, k * d1 + k * k * d2 AS h
      FROM (SELECT *,
          list_sum(list_transform(tails, lambda x, j: x / (k + j - 1)))
            + list_sum(list_transform(means1, lambda x, i: seen[i] * ln(k / (k + x)))) AS d1,
          list_sum(list_transform(means1, lambda x, i: seen[i] * (1 / k - 1 / (k + x))))
            - list_sum(list_transform(tails, lambda x, j: x / ((k + j - 1) * (k + j - 1)))) AS d2
      FROM (SELECT *, exp(lambda_) AS k, list_transform(cells, lambda x, i: x.c / seen[i]) AS means1,
          list_sum(extra) / list_sum(list_transform(cells, lambda x: x.n)) AS zeros1
      FROM (SELECT *, list_transform(cells, lambda x, i: x.n - extra[i]) AS seen
      FROM (SELECT *, list_transform(cells, lambda x, i: CASE WHEN has_zeros
          THEN x.z * zeros / (zeros + (1 - zeros) * ({chance})) ELSE 0::DOUBLE END) AS extra
      FROM walk WHERE moved >= 1e-10 AND step < 500))))))
    ) SELECT * FROM walk"""


def tables(
    species: str = "p_brand",
    stratum: str = "r_name",
    min_observation: int = 100,
    min_stratum: int = 3,
    min_cycle: int = 2,
    proportion: float = 0.15,
    line_steps: int = 50,
) -> dict[str, str]:
    group = "p_type" if species != "p_type" else "p_brand"
    k = min_observation
    t: dict[str, str] = {}
    t["places"] = f"""SELECT c_custkey AS point_id, printf('%02d-%s', c_nationkey, c_mktsegment) AS square,
      {stratum} AS stratum
      FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
    t["valid"] = """SELECT o_orderkey AS sample_id, o_custkey AS point_id, o_orderdate AS start_date
      FROM orders WHERE o_orderstatus <> 'P' AND NOT (o_orderpriority = '4-NOT SPECIFIED')"""
    t["visits"] = """SELECT sample_id, point_id, CAST(year(start_date) AS INTEGER) AS year,
      CASE WHEN start_date < make_date(year(start_date), 4, 16) THEN 1
           WHEN start_date < make_date(year(start_date), 6, 1) THEN 2 ELSE 3 END AS period
      FROM valid
      WHERE make_date(year(start_date), 3, 1) <= start_date
        AND start_date <= make_date(year(start_date), 7, 16)"""
    t["all_counts"] = f"""SELECT {species} AS species, sample_id, point_id, year, period,
      CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS count
      FROM visits JOIN lineitem ON l_orderkey = sample_id JOIN part ON l_partkey = p_partkey
      GROUP BY ALL"""
    t["frame"] = """SELECT stratum, count(*) AS n_frame
      FROM (SELECT DISTINCT stratum, square FROM places) GROUP BY stratum"""
    t["taxa"] = f"SELECT DISTINCT {species} AS species FROM part"
    t["all_groups"] = f"""SELECT {group} AS species_group, {species} AS species FROM part
      UNION SELECT 'Size ' || CAST(p_size AS VARCHAR), {species} FROM part"""
    t["families"] = """SELECT species, 'nbinomial' AS family FROM taxa
      WHERE TRY_CAST(regexp_extract(species, '([0-9]+)$', 1) AS INTEGER) % 2 = 0"""
    t["common"] = f"""SELECT species FROM all_counts GROUP BY species HAVING count(*) >= {k}"""
    # the relevance rules, one by one, on zero-filled samples
    t["found"] = "SELECT DISTINCT species, point_id FROM all_counts WHERE count > 0"
    t["filled"] = """SELECT f.species, v.sample_id, v.point_id, v.year, v.period, coalesce(c.count, 0) AS count
      FROM visits v JOIN found f ON v.point_id = f.point_id
      LEFT JOIN all_counts c ON c.species = f.species AND c.sample_id = v.sample_id"""
    t["placed"] = f"""SELECT z.*, p.square, p.stratum, {_cycle('year')} AS cycle
      FROM filled z JOIN places p ON z.point_id = p.point_id"""
    t["r0"] = f"SELECT * FROM placed WHERE {_gate('all_counts', k)}"
    t["square1"] = f"""SELECT species, stratum, square, count(DISTINCT cycle) AS n_cycles FROM r0
      WHERE count > 0 GROUP BY ALL HAVING count(DISTINCT cycle) >= {min_cycle}"""
    t["r1"] = "SELECT r0.* FROM r0 SEMI JOIN square1 USING (species, square)"
    t["r1g"] = f"SELECT * FROM r1 WHERE {_gate('r1', k)}"
    t["stratum1"] = f"""SELECT species, stratum, count(DISTINCT square) AS n_squares FROM r1g
      WHERE count > 0 GROUP BY ALL HAVING count(DISTINCT square) >= {min_stratum}"""
    t["r2"] = "SELECT r1g.* FROM r1g SEMI JOIN stratum1 USING (species, stratum)"
    t["r2g"] = f"SELECT * FROM r2 WHERE {_gate('r2', k)}"
    t["period_mean"] = "SELECT species, period, sum(count)::DOUBLE / count(*) AS mean FROM r2g GROUP BY ALL"
    t["period_kept"] = f"""SELECT species, period, mean,
      period = first_value(period) OVER (PARTITION BY species ORDER BY mean DESC, period) AS is_reference
      FROM period_mean
      QUALIFY mean >= {proportion}::DOUBLE * max(mean) OVER (PARTITION BY species)"""
    t["r3"] = "SELECT r2g.*, is_reference FROM r2g JOIN period_kept USING (species, period)"
    t["r3g"] = f"SELECT * FROM r3 WHERE {_gate('r3', k)}"
    t["square2"] = f"""SELECT species, square FROM r3g WHERE count > 0
      GROUP BY ALL HAVING count(DISTINCT cycle) >= {min_cycle}"""
    t["r4"] = "SELECT r3g.* FROM r3g SEMI JOIN square2 USING (species, square)"
    t["r4g"] = f"SELECT * FROM r4 WHERE {_gate('r4', k)}"
    t["stratum2"] = f"""SELECT species, stratum FROM r4g WHERE count > 0
      GROUP BY ALL HAVING count(DISTINCT square) >= {min_stratum}"""
    t["r5"] = "SELECT r4g.* FROM r4g SEMI JOIN stratum2 USING (species, stratum)"
    t["relevant"] = f"SELECT * FROM r5 WHERE {_gate('r5', k)}"
    t["analysed"] = "SELECT DISTINCT species FROM relevant"
    # weights
    t["effort"] = """SELECT stratum, square, year, count(*) AS visits
      FROM visits JOIN places USING (point_id) GROUP BY ALL"""
    t["surveyed"] = "SELECT stratum, count(DISTINCT square) AS t_surveyed FROM effort GROUP BY stratum"
    t["weights"] = """SELECT species, stratum, n_frame, r_relevant, t_surveyed,
      (n_frame * r_relevant / t_surveyed) / sum(n_frame * r_relevant / t_surveyed)
        OVER (PARTITION BY species) AS weight
      FROM (SELECT species, stratum, count(DISTINCT square) AS r_relevant FROM relevant GROUP BY ALL)
      JOIN surveyed USING (stratum) JOIN frame USING (stratum)"""
    t["per_square"] = """SELECT species, stratum, square, count(DISTINCT point_id) AS points, count(*) AS visits
      FROM relevant GROUP BY ALL"""
    t["weight_table"] = f"""SELECT species, stratum,
      {', '.join(f'count(*) FILTER (points = {i}) AS points_{i}' for i in range(1, 7))},
      count(*) FILTER (points > 6) AS points_over, CAST(sum(points) AS BIGINT) AS points_total,
      count(*) AS relevant, CAST(sum(visits) AS BIGINT) AS visits, any_value(weight) AS weight
      FROM per_square JOIN weights USING (species, stratum) GROUP BY species, stratum"""
    # effects
    t["totals"] = """SELECT species, stratum, square, year, 1 AS n, CAST(count > 0 AS INTEGER) AS n_pos,
      count AS c, count * count AS c2 FROM relevant"""
    t["cells"] = _time_cells("totals", "stratum")
    t["grid"] = _grid("cells", "stratum")
    t["effects"] = _fill("grid", "species, frequency, stratum")
    t["numbered"] = """SELECT species, ['poisson', 'nbinomial', 'zeroinflatedpoisson1', 'zeroinflatednbinomial1']
        [TRY_CAST(regexp_extract(species, '([0-9]+)$', 1) AS INTEGER) % 4 + 1] AS family FROM analysed"""
    t["above"] = """SELECT species, list(n ORDER BY j) AS tails FROM (
      SELECT species, j, count(*)::DOUBLE AS n FROM (
        SELECT species, unnest(range(count)) AS j FROM relevant WHERE count > 0) GROUP BY species, j)
      GROUP BY species"""
    t["family_series"] = """SELECT species, frequency, family, tails, cells,
        contains(family, 'zero') AS has_zeros, contains(family, 'nbinom') AS has_size
      FROM (SELECT species, frequency, list({'stratum': stratum, 't': t, 'n': n::DOUBLE, 'z': (n - n_pos)::DOUBLE,
              'c': c::DOUBLE} ORDER BY stratum, t) AS cells FROM grid WHERE n > 0 GROUP BY species, frequency)
      JOIN above USING (species) JOIN numbered USING (species)"""
    t["family_steps"] = _family_steps()
    t["family_fit"] = """SELECT * FROM family_steps
      QUALIFY row_number() OVER (PARTITION BY species, frequency ORDER BY step DESC) = 1"""
    t["family_cells"] = """SELECT *, m * mu * damped AS info, z * w * (1 - w) * mu * mu * damped * damped AS lost
      FROM (SELECT *, CASE WHEN has_size THEN k / (k + mu) ELSE 1 END AS damped
      FROM (SELECT *, CASE WHEN c > 0 THEN raw ELSE 0.5::DOUBLE / m END AS mu
      FROM (SELECT *, n - z * w AS m
      FROM (SELECT *, CASE WHEN has_zeros THEN zeros / (zeros + (1 - zeros) * CASE WHEN has_size
          THEN pow(k / (k + raw), k) ELSE exp(-raw) END) ELSE 0 END AS w
      FROM (SELECT species, frequency, family, zeros, exp(lambda_) AS k, has_size, has_zeros,
          CASE WHEN moved < 1e-10 THEN 'converged' ELSE 'not converged' END AS status,
          unnest(means) AS raw, unnest(cells, recursive := true) FROM family_fit)))))"""
    t["estimates"] = f"""SELECT *, {_limits()} FROM (
      SELECT species, frequency, t, label, sum(weight * b) AS estimate, sum(weight * weight * var) AS variance
      FROM effects JOIN weights USING (species, stratum) GROUP BY species, frequency, t, label)"""
    t["pairs"] = f"""SELECT *, {_limits()} FROM (
      SELECT a.species, a.frequency, a.label AS reference, b.label AS alternative,
        b.estimate - a.estimate AS estimate, a.variance + b.variance AS variance
      FROM estimates a JOIN estimates b
        ON a.species = b.species AND a.frequency = b.frequency AND a.t < b.t)"""
    t["widths"] = """SELECT DISTINCT species, frequency, window_width FROM (
      SELECT species, frequency, count(*) AS n,
        unnest(CASE WHEN frequency = 'cycle' THEN [2, 4, count(*)] ELSE [6, 12, count(*)] END) AS window_width
      FROM estimates GROUP BY species, frequency) WHERE window_width <= n"""
    t["window_steps"] = """SELECT w.species, w.frequency, w.window_width, a.t AS t0, a.label AS label0, b.t,
        (b.t - a.t + 1 - (w.window_width + 1) / 2.0::DOUBLE)
          / (w.window_width * (w.window_width * w.window_width - 1) / 12.0::DOUBLE) AS coef,
        b.estimate, b.variance
      FROM widths w JOIN estimates a USING (species, frequency)
      JOIN estimates b ON b.species = w.species AND b.frequency = w.frequency
        AND b.t BETWEEN a.t AND a.t + w.window_width - 1
      WHERE a.t + w.window_width - 1 <=
        (SELECT max(t) FROM estimates e WHERE e.species = w.species AND e.frequency = w.frequency)"""
    t["trends"] = f"""SELECT *, {_limits()} FROM (
      SELECT species, frequency, CAST(window_width AS INTEGER) AS "window",
        CASE WHEN frequency = 'cycle' THEN t0 ELSE label0 END + (window_width - 1) / 2.0::DOUBLE AS midpoint,
        CASE WHEN frequency = 'cycle' THEN label0 + 3 * (window_width - 1) / 2.0::DOUBLE + 1
          ELSE label0 + (window_width - 1) / 2.0::DOUBLE END AS mid_year,
        sum(coef * estimate) AS estimate, sum(coef * coef * variance) AS variance
      FROM window_steps GROUP BY species, frequency, window_width, t0, label0)"""
    t["line_sums"] = """SELECT species, frequency, stratum, sum(w) AS sw, sum(w * t) AS swx, sum(w * t * t) AS swxx,
        sum(w * b) AS swy, sum(w * t * b) AS swxy
      FROM (SELECT *, CASE WHEN c > 0 THEN c::DOUBLE ELSE 0.5::DOUBLE END AS w FROM effects WHERE NOT imputed)
      GROUP BY ALL"""
    t["lines"] = """SELECT species, frequency, stratum, sw, (swy - beta * swx) / sw AS alpha, beta,
        swx / sw AS mean_t, CASE WHEN det > 0 THEN sw / det ELSE 0 END AS var_beta
      FROM (SELECT *, CASE WHEN det > 0 THEN (sw * swxy - swx * swy) / det ELSE 0 END AS beta
            FROM (SELECT *, sw * swxx - swx * swx AS det FROM line_sums))"""
    t["line_steps"] = f"""WITH RECURSIVE walk AS (
      SELECT species, frequency, stratum, any_value(alpha) AS alpha, any_value(beta) AS beta,
        list({{'t': t, 'n': n, 'c': c}}) AS cells, 1::DOUBLE AS moved, 0 AS step
      FROM lines JOIN effects USING (species, frequency, stratum) WHERE n > 0 GROUP BY species, frequency, stratum
      UNION ALL
      SELECT species, frequency, stratum, alpha + da, beta + db, cells, greatest(abs(da), abs(db)), step + 1
      FROM (SELECT *, (wxx * r - wx * rx) / (w * wxx - wx * wx) AS da, (w * rx - wx * r) / (w * wxx - wx * wx) AS db
      FROM (SELECT *, list_sum(mu) AS w, list_sum(list_transform(mu, lambda x, i: x * cells[i].t)) AS wx,
          list_sum(list_transform(mu, lambda x, i: x * cells[i].t * cells[i].t)) AS wxx,
          list_sum(list_transform(mu, lambda x, i: cells[i].c - x)) AS r,
          list_sum(list_transform(mu, lambda x, i: (cells[i].c - x) * cells[i].t)) AS rx
      FROM (SELECT *, list_transform(cells, lambda x: x.n * exp(alpha + beta * x.t)) AS mu
      FROM walk WHERE moved >= 1e-9 AND step < {line_steps} AND len(cells) > 1)))
    ) SELECT * FROM walk"""
    t["best_lines"] = """SELECT species, frequency, stratum, alpha, beta, moved < 1e-9 OR len(cells) < 2 AS converged,
        CASE WHEN len(cells) < 2 THEN 0 ELSE w / (w * wxx - wx * wx) END AS var_beta, wx / w AS mean_t, w AS sw
      FROM (SELECT *, list_sum(list_transform(cells, lambda x: x.n * exp(alpha + beta * x.t))) AS w,
          list_sum(list_transform(cells, lambda x: x.t * x.n * exp(alpha + beta * x.t))) AS wx,
          list_sum(list_transform(cells, lambda x: x.t * x.t * x.n * exp(alpha + beta * x.t))) AS wxx
        FROM line_steps QUALIFY row_number() OVER (PARTITION BY species, frequency, stratum ORDER BY step DESC) = 1)"""
    t["seen_steps"] = """SELECT species, frequency, stratum, t, b, var,
        lead(t) OVER w AS t1, lead(b) OVER w AS b1, lead(var) OVER w AS var1
      FROM effects WHERE NOT imputed WINDOW w AS (PARTITION BY species, frequency, stratum ORDER BY t)"""
    t["walk_steps"] = """SELECT species, frequency,
        greatest(coalesce(sum((b1 - b) * (b1 - b) - var - var1) / sum(t1 - t), 0), 1e-4::DOUBLE) AS tau2
      FROM seen_steps GROUP BY species, frequency"""
    t["walk_input"] = """SELECT species, frequency, stratum, t, label, n, c, imputed, tau2,
        CASE WHEN imputed THEN 0::DOUBLE ELSE 1 / var END AS o, CASE WHEN imputed THEN 0::DOUBLE ELSE b END AS y,
        min(t) OVER (PARTITION BY species, frequency, stratum) AS lo,
        max(t) OVER (PARTITION BY species, frequency, stratum) AS hi
      FROM effects JOIN walk_steps USING (species, frequency)"""
    for name, side, start in (("walk_ahead", 1, "lo"), ("walk_behind", -1, "hi")):
        t[name] = f"""WITH RECURSIVE way AS (
          SELECT species, frequency, stratum, t, o AS p, y AS m FROM walk_input WHERE t = {start}
          UNION ALL
          SELECT species, frequency, stratum, t, handed + o,
            CASE WHEN handed + o > 0 THEN (handed * m + o * y) / (handed + o) ELSE 0 END
          FROM (SELECT i.*, w.m, w.p / (1 + w.p * tau2) AS handed FROM way w JOIN walk_input i
            ON i.species = w.species AND i.frequency = w.frequency AND i.stratum = w.stratum AND i.t = w.t + {side})
        ) SELECT * FROM way"""
    t["walk"] = """SELECT *, CASE WHEN t > lo THEN tau2 / ((p_before * tau2 + 1) * (q * tau2 + 1) - 1)
          / lag(var) OVER (PARTITION BY species, frequency, stratum ORDER BY t) END AS gain
      FROM (SELECT *, (p * m + handed * coalesce(m_after, 0)) / (p + handed) AS b, 1 / (p + handed) AS var
      FROM (SELECT i.* EXCLUDE (o, y, hi), a.p, a.m, z.p AS q,
          lag(a.p) OVER w AS p_before, lead(z.m) OVER w AS m_after,
          coalesce(lead(z.p) OVER w / (1 + lead(z.p) OVER w * tau2), 0) AS handed
        FROM walk_input i JOIN walk_ahead a USING (species, frequency, stratum, t)
        JOIN walk_behind z USING (species, frequency, stratum, t)
        WINDOW w AS (PARTITION BY species, frequency, stratum ORDER BY t)))"""
    t["walk_covariances"] = """SELECT x.species, x.frequency, x.stratum, x.t AS s, y.t,
        CASE WHEN x.t <= y.t THEN x.var * exp(y.g - x.g) ELSE y.var * exp(x.g - y.g) END AS cov
      FROM (SELECT *, sum(ln(coalesce(gain, 1))) OVER (PARTITION BY species, frequency, stratum ORDER BY t) AS g FROM walk) x
      JOIN (SELECT *, sum(ln(coalesce(gain, 1))) OVER (PARTITION BY species, frequency, stratum ORDER BY t) AS g FROM walk) y
        ON x.species = y.species AND x.frequency = y.frequency AND x.stratum = y.stratum"""
    t["linear"] = f"""SELECT *, {_limits()} FROM (
      SELECT species, frequency, sum(weight * beta) AS estimate, sum(weight * weight * var_beta) AS variance
      FROM lines JOIN weights USING (species, stratum) GROUP BY species, frequency)"""
    t["linear_levels"] = f"""SELECT *, {_limits()} FROM (
      SELECT species, frequency, e.t, e.label, sum(weight * (alpha + beta * e.t)) AS estimate,
        sum(weight * weight * (1 / sw + (e.t - mean_t) * (e.t - mean_t) * var_beta)) AS variance
      FROM lines JOIN weights USING (species, stratum) JOIN estimates e USING (species, frequency)
      GROUP BY species, frequency, e.t, e.label)"""
    t["criteria"] = """SELECT species, frequency, 2.0::DOUBLE * count(*) AS ic_non_linear,
        4.0::DOUBLE * count(DISTINCT stratum) + 2 * sum(
          CASE WHEN c > 0 THEN c * ln(c / mu) ELSE 0 END - (c - mu)) AS ic_linear
      FROM (SELECT e.*, n * exp(alpha + beta * t) AS mu FROM effects e JOIN best_lines l
            USING (species, frequency, stratum) WHERE NOT imputed)
      GROUP BY species, frequency"""
    t["verdicts"] = """SELECT *, CASE WHEN difference <= -2 THEN 'non-linear'
        WHEN difference <= 0 THEN 'possibly non-linear' ELSE 'linear' END AS verdict
      FROM (SELECT *, round(ic_non_linear - ic_linear, 6) AS difference FROM criteria)"""
    # results, composites, reports
    t["estimate_results"] = _results("species, frequency, t, label", "estimates")
    t["index_results"] = _results("species, frequency, reference, alternative", "pairs")
    t["trend_results"] = _results('species, frequency, "window", midpoint, mid_year', "trends")
    t["linear_results"] = _results("species, frequency", "linear")
    t["groups"] = "SELECT * FROM all_groups SEMI JOIN analysed USING (species)"
    t["group_index"] = f"""SELECT *, {_limits()} FROM (
      SELECT species_group, frequency, reference, alternative, count(*) AS n_species,
        sum(estimate) / count(*) AS estimate, sum(variance) / (count(*) * count(*)) AS variance
      FROM pairs JOIN groups USING (species) GROUP BY ALL)"""
    t["group_trend"] = f"""SELECT *, {_limits()} FROM (
      SELECT species_group, frequency, "window", midpoint, mid_year, count(*) AS n_species,
        sum(estimate) / count(*) AS estimate, sum(variance) / (count(*) * count(*)) AS variance
      FROM trends JOIN groups USING (species) GROUP BY ALL)"""
    t["group_results"] = _results("species_group, frequency, reference, alternative", "group_index")
    t["thresholds"] = f"""SELECT species_group, n_species, ({THRESHOLD}) / sqrt(n_species) AS threshold,
        exp(({THRESHOLD}) / sqrt(n_species)) AS lower_bound, exp(-({THRESHOLD}) / sqrt(n_species)) AS upper_bound
      FROM (SELECT species_group, count(*) AS n_species FROM groups GROUP BY ALL)"""
    t["mirrored"] = """SELECT species, frequency, reference, alternative, estimate, lcl, ucl FROM index_results
      UNION ALL
      SELECT species, frequency, alternative, reference, 0 - estimate, 0 - ucl, 0 - lcl FROM index_results"""
    t["group_mirrored"] = """SELECT species_group, frequency, reference, alternative, estimate, lcl, ucl
      FROM group_results
      UNION ALL
      SELECT species_group, frequency, alternative, reference, 0 - estimate, 0 - ucl, 0 - lcl FROM group_results"""
    t["matrix"] = f"""SELECT *, {_label('effect_class')} AS label FROM (
      SELECT *, {_classify('lcl', 'ucl', f'({THRESHOLD})')} AS effect_class,
        {_change_text('estimate', 'lcl', 'ucl')} AS change_text FROM mirrored)
      UNION ALL
      SELECT DISTINCT species, frequency, reference, reference, 0::DOUBLE, NULL, NULL, 'R', '', 'reference'
      FROM mirrored"""
    t["options"] = """SELECT * FROM (VALUES ('year'), ('cycle')) f(frequency),
      (VALUES ('linear'), ('non linear')) k(type)"""
    t["analyses"] = """SELECT species, frequency, type, species || '/' || frequency || '/' || type AS analysis
      FROM analysed, options"""
    t["group_analyses"] = """SELECT species_group, frequency, type,
        species_group || '/' || frequency || '/' || type AS analysis
      FROM (SELECT DISTINCT species_group FROM groups), options"""
    t["members"] = "SELECT * FROM groups JOIN analyses USING (species)"
    t["astray"] = "SELECT DISTINCT species, frequency, 'linear' AS type FROM best_lines WHERE NOT converged"
    t["models"] = """SELECT m.*, CASE WHEN m.speciesgroup NOT IN (SELECT species FROM analysed) THEN 'insufficient_data'
        WHEN (m.speciesgroup, m.frequency, m.type) IN (SELECT (species, frequency, type) FROM astray)
        THEN 'not converged' ELSE 'converged' END AS status
      FROM (SELECT species || '/' || frequency || '/' || type AS analysis, species AS speciesgroup, frequency, type,
        'inla ' || coalesce(family, 'poisson') || ': ' ||
        CASE type WHEN 'linear' THEN frequency || ':stratum' ELSE 'RW1(' || frequency || '|stratum)' END
        || ' + period + square + point' AS model_type
      FROM (SELECT * FROM taxa, options) LEFT JOIN families USING (species)) m
      UNION ALL
      SELECT analysis, species_group, frequency, type, 'composite index: ' || frequency || ' ' || type, 'converged'
      FROM group_analyses"""
    steps = [("placed", 0), ("r1", 1), ("r2", 2), ("r3", 3), ("r4", 4), ("r5", 5)]
    t["positives"] = " UNION ALL ".join(
        f"SELECT species, {i} AS gate, count(*) AS n FROM {name} WHERE count > 0 GROUP BY species" for name, i in steps
    )
    nested = "SELECT *, n0 AS pos_0 FROM (SELECT species, " + ", ".join(
        f"coalesce(max(n) FILTER (gate = {i}), 0) AS n{i}" for _, i in steps
    ) + " FROM positives GROUP BY species)"
    for i in range(1, 6):
        nested = f"SELECT *, CASE WHEN pos_{i - 1} >= {k} THEN n{i} END AS pos_{i} FROM ({nested})"
    fails = " ".join(f"WHEN pos_{i} < {k} THEN {i}" for i in range(6))
    t["gates"] = f"SELECT *, CASE {fails} END AS gate FROM ({nested})"
    t["meta"] = """SELECT m.analysis, speciesgroup, contains(model_type, 'composite') AS composite,
        contains(model_type, 'cycle') AS cycle,
        NOT (contains(model_type, 'RW1') OR contains(model_type, 'non linear')) AS linear,
        CASE WHEN contains(model_type, 'composite') THEN NULL
          ELSE regexp_extract(model_type, 'inla (.*): .*', 1) END AS family,
        sha1(m.analysis || '|' || status) AS status_fingerprint, status, i.ic
      FROM models m LEFT JOIN (
        SELECT species || '/' || frequency || '/linear' AS analysis, ic_linear AS ic FROM criteria
        UNION ALL
        SELECT species || '/' || frequency || '/non linear', ic_non_linear FROM criteria) i
        ON m.analysis = i.analysis"""
    t["duration"] = "SELECT species, CAST(max(t) - 1 AS BIGINT) AS duration FROM effects GROUP BY species"
    t["scaled"] = """SELECT species, frequency,
        CASE WHEN frequency = 'cycle' THEN estimate / 3 ELSE estimate END AS estimate,
        CASE WHEN frequency = 'cycle' THEN lcl / 3 ELSE lcl END AS lcl,
        CASE WHEN frequency = 'cycle' THEN ucl / 3 ELSE ucl END AS ucl, duration, verdict
      FROM linear_results JOIN verdicts USING (species, frequency) JOIN duration USING (species)"""
    t["overview"] = f"""SELECT *, {_label('effect_class')} AS label,
        list_position(['++','+','+~','~','-~','-','--','?+','?-','?'], effect_class) AS class_ord
      FROM (SELECT species, frequency, verdict, duration,
        {_classify('lcl * duration', 'ucl * duration', f'({THRESHOLD})')} AS effect_class,
        {_change_text('estimate', 'lcl', 'ucl')} AS yearly_text,
        {_change_text('estimate * duration', 'lcl * duration', 'ucl * duration')} AS total_text,
        estimate * duration AS total FROM scaled)"""
    t["square_years"] = """SELECT stratum, square, list_sort(list(year)) AS years,
        floor((min(year) - 1995) / 3.0) < floor((max(year) - 1995) / 3.0) AS usable
      FROM effort GROUP BY stratum, square"""
    t["dispersion"] = """SELECT species, CAST(sum(n) AS BIGINT) AS n, count(*) AS cells,
        CAST(sum(n - n_pos) AS BIGINT) AS zeros,
        CASE WHEN sum(n) > count(*) THEN
          sum(CASE WHEN c > 0 THEN c2 / (c / n) - c ELSE 0 END) / (sum(n) - count(*)) END AS phi,
        sum(n - n_pos) / sum(n * exp(-(c / n))) AS zero_ratio
      FROM effects WHERE frequency = 'year' AND n > 0 GROUP BY species"""
    t["contrasts"] = """SELECT species, frequency, 'estimate' AS kind, printf('estimate_%d', label) AS name,
        stratum, t, weight AS coef
      FROM effects JOIN weights USING (species, stratum)
      UNION ALL
      SELECT a.species, a.frequency, 'index', printf('index_%d_%d', a.label, b.label), a.stratum,
        d.t, CASE WHEN d.t = b.t THEN weight ELSE -weight END
      FROM effects a JOIN effects b ON a.species = b.species AND a.frequency = b.frequency
          AND a.stratum = b.stratum AND a.t < b.t
        JOIN effects d ON d.species = a.species AND d.frequency = a.frequency AND d.stratum = a.stratum
          AND d.t IN (a.t, b.t)
        JOIN weights w ON w.species = a.species AND w.stratum = a.stratum
      UNION ALL
      SELECT s.species, s.frequency, 'trend', printf('trend_%.1f_%d',
          CASE WHEN s.frequency = 'cycle' THEN t0 ELSE label0 END + (window_width - 1) / 2.0::DOUBLE,
          window_width), stratum, t, weight * coef
      FROM window_steps s JOIN weights USING (species)"""
    return t


def statement(final: str, **design) -> str:
    """``final`` preceded by the named tables that it needs."""
    available = tables(**design)
    needed: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in available:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|,)\s*{name}\b", text):
                needed.add(name)
                todo.append(available[name])
    chain = ",\n".join(f"{n} AS MATERIALIZED ({available[n]})" for n in available if n in needed)
    return f"WITH {chain}\n{final}" if chain else final


R6 = "round({0}, 6) + 0::DOUBLE AS {0}"  # a rounded negative number is not -0


def _six(*columns: str) -> str:
    return ", ".join(R6.format(c) for c in columns)


def _apart(*columns: str) -> str:
    """Values behind their lengths."""
    return " || '|' || ".join(f"coalesce(length({c}::VARCHAR) || ':' || {c}, '-')" for c in columns)


def _digest(*columns: str) -> str:
    """Sums of both halves of the MD5 of all rows."""
    halves = [
        f"CAST(sum(('0x' || substr(md5({_apart(*columns)}), {first}, 16))::UBIGINT::HUGEINT) AS VARCHAR)"
        for first in (1, 17)
    ]
    return " || '-' || ".join(halves)


PHI = "(SELECT species, greatest(coalesce(phi, 1), 1) AS phi FROM dispersion)"
STRICT = {"min_cycle": 3, "proportion": 0.95}
SQUARE_LINES = f"""SELECT species, frequency, square, t, label, n, c, imputed, {_six('b', 'var')}
FROM ({_fill('square_grid', 'species, frequency, square')})"""


def _adjusted_effects(rounds: int = 80) -> str:
    """Proportional fitting written out: places, then levels, then periods, round by round."""
    line = "species, frequency, stratum, label"
    parts = [f"""crossed AS MATERIALIZED (SELECT species, f.frequency, stratum, square,
        CAST(CASE f.frequency WHEN 'year' THEN year ELSE {BASE} + 3 * ({_cycle('year')} - 1) END AS INTEGER) AS label,
        CASE WHEN periods > 1 THEN period ELSE 0 END AS period, count(*) AS n, sum(count)::DOUBLE AS c
      FROM relevant JOIN (SELECT species, count(DISTINCT period) AS periods FROM relevant GROUP BY species) USING (species),
        (VALUES ('year'), ('cycle')) f(frequency) GROUP BY ALL)""",
      f"a0 AS MATERIALIZED (SELECT {line}, sum(c) / sum(n) AS a FROM crossed GROUP BY ALL)",
      "p0 AS MATERIALIZED (SELECT DISTINCT species, frequency, period, 1::DOUBLE AS p FROM crossed)"]
    for i in range(1, rounds + 1):
        j = i - 1
        parts += [
            f"""s{i} AS MATERIALIZED (SELECT species, frequency, stratum, square,
              CASE WHEN sum(n * a * p) > 0 THEN sum(c) / sum(n * a * p) ELSE 0 END AS s
              FROM crossed JOIN a{j} USING ({line}) JOIN p{j} USING (species, frequency, period) GROUP BY ALL)""",
            f"""w{i} AS MATERIALIZED (SELECT {line}, period, sum(n * s) AS w, sum(c) AS c
              FROM crossed JOIN s{i} USING (species, frequency, stratum, square) GROUP BY ALL)""",
            f"""a{i} AS MATERIALIZED (SELECT {line}, CASE WHEN sum(w * p) > 0 THEN sum(c) / sum(w * p) ELSE 0 END AS a
              FROM w{i} JOIN p{j} USING (species, frequency, period) GROUP BY ALL)""",
            f"""p{i} AS MATERIALIZED (SELECT species, frequency, period,
              CASE WHEN sum(w * a) > 0 THEN sum(c) / sum(w * a) ELSE 0 END AS p
              FROM w{i} JOIN a{i} USING ({line}) GROUP BY ALL)""",
        ]
    k = rounds
    tail = f"""SELECT {line}, n, CAST(c AS BIGINT) AS c, true AS converged,
      round(ln(CASE WHEN c > 0 THEN a * mean_s * mean_p ELSE 0.5::DOUBLE / n END), 5) + 0::DOUBLE AS b,
      round(1 / CASE WHEN c > 0 THEN c ELSE 0.5::DOUBLE END, 5) AS var
    FROM (SELECT {line}, CAST(sum(n) AS BIGINT) AS n, sum(c) AS c FROM crossed GROUP BY ALL)
    JOIN a{k} USING ({line})
    JOIN (SELECT species, frequency, stratum, sum(n * s) / sum(n) AS mean_s
      FROM crossed JOIN s{k} USING (species, frequency, stratum, square) GROUP BY ALL) USING (species, frequency, stratum)
    JOIN (SELECT species, frequency, sum(n * p) / sum(n) AS mean_p
      FROM crossed JOIN p{k} USING (species, frequency, period) GROUP BY ALL) USING (species, frequency)"""
    base = statement("SELECT * FROM relevant")
    head = base[: base.rindex("\nSELECT * FROM relevant")]
    return f"{head},\n" + ",\n".join(parts) + f"\n{tail}"


def oracle() -> dict[str, str]:
    s = statement
    sql: dict[str, str] = {}
    sql["scan_survey_tables"] = s("""SELECT 'samples' AS table_name, count(*) AS n_rows FROM orders
      UNION ALL SELECT 'observations', count(*) FROM lineitem JOIN part ON l_partkey = p_partkey
      UNION ALL SELECT 'points', count(*) FROM places
      UNION ALL SELECT 'frame', CAST(sum(n_frame) AS BIGINT) FROM frame
      UNION ALL SELECT 'species', count(*) FROM taxa
      UNION ALL SELECT 'groups', count(*) FROM all_groups
      UNION ALL SELECT 'families', count(*) FROM families""")
    sql["dictionary_decode"] = """SELECT c_custkey,
      CAST(dense_rank() OVER (ORDER BY c_mktsegment) AS INTEGER) AS code, c_mktsegment FROM customer"""
    sql["sorted_sink_roundtrip"] = s(
        "SELECT species, sample_id, count FROM all_counts SEMI JOIN common USING (species)"
    )
    sql["available_species"] = s("SELECT species_group, species FROM all_groups SEMI JOIN common USING (species)")
    sql["surrogate_key_assign"] = """WITH pairs AS (SELECT p_type, p_brand, min(p_size) AS smallest FROM part GROUP BY ALL),
      known AS (SELECT p_type, p_brand, row_number() OVER (ORDER BY p_type, p_brand) AS id
                FROM pairs WHERE smallest <= 1)
      SELECT p_type, p_brand, id FROM known
      UNION ALL
      SELECT p_type, p_brand, row_number() OVER (ORDER BY p_type, p_brand) + (SELECT max(id) FROM known)
      FROM pairs WHERE smallest > 1"""
    sql["latest_version"] = """SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_totalprice
      FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
    sql["species_catalogue"] = s("""SELECT name, label, folder || label || '.qmd' AS output_file FROM (
      SELECT speciesgroup AS name, lower(replace(replace(speciesgroup, ' ', '-'), '''', '')) AS label,
        CASE WHEN composite THEN 'index/' ELSE 'species/' END AS folder
      FROM (SELECT DISTINCT speciesgroup, composite FROM meta WHERE status = 'converged'))""")
    sql["table_fingerprint"] = s(f"""SELECT count(*) AS n_rows, {_digest('species', 'sample_id', 'count')} AS digest
      FROM all_counts""")
    sql["analysis_fingerprint"] = s(f"""SELECT analysis,
        sha1({_apart('analysis', 'model_type')} || '|' || digest) AS fingerprint
      FROM models m JOIN analyses a USING (analysis) JOIN (
        SELECT species, {_digest('species', 'stratum', 'year', 'n', 'c')} AS digest
        FROM cells WHERE frequency = 'year' GROUP BY species) d USING (species)""")
    sql["valid_samples"] = s("SELECT sample_id, point_id, strftime(start_date, '%Y-%m-%d') AS day FROM valid")
    sql["season_visits"] = s("SELECT * FROM visits")
    sql["cycle_assign"] = s(f"SELECT year, {_cycle('year')} AS cycle, count(*) AS visits FROM visits GROUP BY ALL")
    sql["species_counts"] = s("SELECT species, sample_id, count FROM all_counts SEMI JOIN common USING (species)")
    sql["valid_locations"] = s("SELECT DISTINCT square, point_id FROM valid JOIN places USING (point_id)")
    sql["frame_size"] = s("SELECT * FROM frame")
    sql["visit_hierarchy"] = s("SELECT sample_id, point_id, square, stratum, year, period FROM visits JOIN places USING (point_id)")
    sql["zero_fill"] = s("SELECT * FROM filled")
    sql["species_groups"] = s("""SELECT sha1(species_group) AS speciesgroup_id, sha1(species) AS parent_id, false AS species
      FROM all_groups
      UNION ALL SELECT sha1(species), species, true FROM taxa""")
    sql["species_family"] = s("SELECT species, coalesce(family, 'poisson') AS family FROM taxa LEFT JOIN families USING (species)")
    sql["reconcile_strata"] = """WITH old AS (
        SELECT n_name AS description, count(*) AS n, row_number() OVER (ORDER BY n_name) AS id
        FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey < 3 GROUP BY n_name),
      fresh AS (SELECT n_name AS description, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name)
      SELECT description, n, id FROM old
      UNION ALL
      SELECT description, n, row_number() OVER (ORDER BY description) + (SELECT max(id) FROM old)
      FROM fresh ANTI JOIN old USING (description)"""
    # relevance
    sql["square_min_cycles"] = s("SELECT * FROM square1")
    sql["stratum_min_squares"] = s("SELECT * FROM stratum1")
    sql["period_filter"] = s("SELECT species, period, round(mean, 6) AS mean, is_reference FROM period_kept", proportion=0.95)
    select = """SELECT species, stratum, square, point_id, sample_id, year, period, is_reference, count FROM relevant"""
    sql["select_relevant"] = s(select)
    sql["select_relevant_strict"] = s(select, **STRICT)
    sql["complete_grid"] = s(f"""SELECT species, stratum, square, point_id::DOUBLE AS point_id, sample_id, year, period,
        count::DOUBLE AS count, false AS padded,
        {_cycle('year')} AS cycle, CAST(year - min(year) OVER (PARTITION BY species) + 1 AS INTEGER) AS cyear
      FROM relevant
      UNION ALL
      SELECT species, stratum, NULL, NULL, -row_number() OVER (PARTITION BY species ORDER BY year, stratum), year,
        reference, NULL, true, {_cycle('year')}, CAST(year - first_year + 1 AS INTEGER)
      FROM (SELECT g.species, g.stratum, CAST(unnest(range(first_year, last_year + 1)) AS INTEGER) AS year, first_year, reference
        FROM (SELECT DISTINCT species, stratum FROM relevant) g
        JOIN (SELECT species, min(year) AS first_year, max(year) AS last_year,
                any_value(period) FILTER (is_reference) AS reference FROM relevant GROUP BY species) m USING (species))
      ANTI JOIN (SELECT DISTINCT species, stratum, year FROM relevant) USING (species, stratum, year)""", stratum="n_name")
    sql["design_choice"] = s("""SELECT *, n_periods > 1 AS period_term, n_points > 2 * n_squares AS point_term,
        n_strata > 1 AS stratum_slopes
      FROM (SELECT species, count(DISTINCT period) AS n_periods, count(DISTINCT point_id) AS n_points,
        count(DISTINCT square) AS n_squares, count(DISTINCT stratum) AS n_strata FROM relevant GROUP BY species)""")
    sql["pending_analyses"] = s("""SELECT species, frequency, type, species || '/' || frequency || '/' || type AS analysis
      FROM taxa, options WHERE species NOT IN (SELECT species FROM analysed)""", **STRICT)
    numbers = ", ".join(f"pos_{i}::DOUBLE AS pos_{i}" for i in range(6))
    sql["gate_trace"] = s(f"SELECT species, {numbers}, gate::DOUBLE AS gate FROM gates", **STRICT)
    sql["analysis_status"] = s("""SELECT analysis, speciesgroup, composite, cycle, linear, family, status_fingerprint, status
      FROM meta""", stratum="n_name", proportion=0.95, line_steps=3)
    # weights and effort
    sql["stratum_weights"] = s("SELECT species, stratum, n_frame, r_relevant, t_surveyed, round(weight, 6) AS weight FROM weights")
    sql["stratum_weight_table"] = s("SELECT * EXCLUDE (weight), round(weight, 5) AS weight FROM weight_table")
    sql["coverage_table"] = s("""SELECT species, stratum, printf('%.1f%%', round(100 * weight, 1)) AS weight_text,
        round(relevant * n_frame / t_surveyed, 1) AS present, relevant, t_surveyed AS surveyed, n_frame AS total, visits,
        printf('%.1f%%', round(100 * (points_total / (6 * relevant)), 1)) AS points_text
      FROM weight_table JOIN surveyed USING (stratum) JOIN frame USING (stratum)""")
    sql["effort"] = s("SELECT * FROM effort")
    sql["effort_history"] = s(f"""SELECT stratum, square, usable, years[1] AS first_year, years[-1] AS last_year,
        {', '.join(f'years[{i}]::DOUBLE AS year_{i}' for i in range(2, 8))},
        row_number() OVER (ORDER BY years[1], years[-1], list_append(years, 2147483647), square, stratum) AS place
      FROM square_years""")
    sql["effort_histogram"] = s("SELECT stratum, usable, CAST(len(years) AS INTEGER) AS n_years, count(*) AS squares FROM square_years GROUP BY ALL")
    sql["potential_squares"] = s(f"""WITH n AS (
        SELECT stratum, year, count(*) AS squares FROM effort WHERE square IN (
          SELECT square FROM effort GROUP BY square HAVING count(DISTINCT {_cycle('year')}) >= 2) GROUP BY ALL)
      SELECT n.*, CAST(stratum_order AS INTEGER) AS stratum_order FROM n JOIN (
        SELECT stratum, row_number() OVER (ORDER BY avg(squares) DESC, stratum) AS stratum_order
        FROM n GROUP BY stratum) USING (stratum)""".replace("WITH n AS", "SELECT * FROM (WITH n AS", 1) + ")")
    # effects and contrasts
    sql["stratum_effects"] = s(f"SELECT species, frequency, stratum, t, label, n, c, imputed, {_six('b', 'var')} FROM effects")
    sql["family_effects"] = s(f"""SELECT species, frequency, stratum, t, label, family, status, {_six('b', 'var')}
      FROM (SELECT species, frequency, stratum, t, family, status, ln(mu) AS b,
        1 / CASE WHEN info > lost THEN info - lost ELSE info END AS var FROM family_cells)
      JOIN (SELECT species, frequency, stratum, t, label FROM grid) USING (species, frequency, stratum, t)""")
    sql["family_fits"] = s(f"""SELECT DISTINCT species, frequency, family, status, {_six('zeros')},
        CASE WHEN has_size THEN round(k, 6) END AS size FROM family_cells""")
    extra = {"square_cells": _time_cells("totals", "square"), "square_grid": _grid("square_cells", "square")}
    base = s("SELECT * FROM totals")
    head = base[: base.rindex("\nSELECT * FROM totals")]
    chain = ",\n".join(f"{n} AS MATERIALIZED ({q})" for n, q in extra.items())
    sql["gap_fill"] = f"{head},\n{chain}\n{SQUARE_LINES}"
    four = _six("estimate", "variance", "lcl", "ucl")
    sql["estimate"] = s(f"SELECT species, frequency, t, label, {four} FROM estimates")
    sql["pairwise_index"] = s(f"SELECT species, frequency, reference, alternative, {four} FROM pairs")
    sql["moving_trend"] = s(f'SELECT species, frequency, "window", midpoint, mid_year, {four} FROM trends')
    sql["linear_trend"] = s(f"SELECT species, frequency, {four} FROM linear")
    sql["linear_trend_overdispersed"] = s(f"""SELECT species, frequency, {four} FROM (SELECT *, {_limits()} FROM (
        SELECT species, frequency, sum(weight * beta) AS estimate, sum(weight * weight * var_beta * phi) AS variance
        FROM lines JOIN weights USING (species, stratum) JOIN {PHI} USING (species) GROUP BY species, frequency))""")
    sql["linear_estimate_overdispersed"] = s(f"""SELECT species, frequency, t, label, {four} FROM (
      SELECT *, {_limits()} FROM (
        SELECT species, frequency, e.t, e.label, sum(weight * (alpha + beta * e.t)) AS estimate,
          sum(weight * weight * phi * (1 / sw + (e.t - mean_t) * (e.t - mean_t) * var_beta)) AS variance
        FROM lines JOIN weights USING (species, stratum) JOIN {PHI} USING (species)
        JOIN estimates e USING (species, frequency) GROUP BY species, frequency, e.t, e.label))""")
    sql["linearity_verdict_overdispersed"] = s(f"""SELECT species, frequency, difference,
        CASE WHEN difference <= -2 THEN 'non-linear'
          WHEN difference <= 0 THEN 'possibly non-linear' ELSE 'linear' END AS verdict,
        {_six('ic_linear', 'ic_non_linear')}
      FROM (SELECT *, round(ic_non_linear - ic_linear, 6) AS difference FROM (
        SELECT species, frequency, 2.0::DOUBLE * count(*) AS ic_non_linear, 4.0::DOUBLE * count(DISTINCT stratum)
          + 2 * sum((CASE WHEN c > 0 THEN c * ln(c / mu) ELSE 0 END - (c - mu)) / phi) AS ic_linear
        FROM (SELECT e.*, n * exp(alpha + beta * t) AS mu FROM effects e JOIN best_lines l
              USING (species, frequency, stratum) WHERE NOT imputed) JOIN {PHI} USING (species)
        GROUP BY species, frequency))""")
    sql["linear_estimate"] = s(f"SELECT species, frequency, t, label, {four} FROM linear_levels")
    sql["exact_lines"] = s(f"""SELECT species, frequency, stratum, {_six('alpha', 'beta')},
        round(var_beta, 8) AS var_beta, converged FROM best_lines""")
    sql["adjusted_effects"] = _adjusted_effects()
    own = "species, frequency, stratum, t, label, n, c, imputed"
    sql["smoothed_effects"] = s(f"SELECT {own}, {_six('b', 'var', 'tau2', 'gain')} FROM walk", stratum="n_name")
    sql["contrast_variances"] = s(f"""SELECT species, frequency, kind, name, {four} FROM (SELECT *, {_limits()} FROM (
        SELECT m.species, m.frequency, m.kind, m.name, estimate, variance FROM (
          SELECT species, frequency, kind, name, sum(coef * b) AS estimate
          FROM contrasts JOIN walk USING (species, frequency, stratum, t) GROUP BY ALL) m
        JOIN (SELECT x.species, x.frequency, x.kind, x.name, sum(x.coef * y.coef * cov) AS variance
          FROM contrasts x JOIN contrasts y
            ON x.species = y.species AND x.frequency = y.frequency AND x.kind = y.kind AND x.name = y.name
              AND x.stratum = y.stratum
          JOIN walk_covariances v ON v.species = x.species AND v.frequency = x.frequency AND v.stratum = x.stratum
            AND v.s = x.t AND v.t = y.t
          GROUP BY x.species, x.frequency, x.kind, x.name) q
        ON m.species = q.species AND m.frequency = q.frequency AND m.kind = q.kind AND m.name = q.name))""", stratum="n_name")
    sql["contrast_table"] = s("SELECT species, frequency, kind, name, stratum, t, round(coef, 6) AS coef FROM contrasts")
    sql["contrast_estimates"] = s("""SELECT species, frequency, kind, name, round(sum(coef * b), 6) AS estimate,
        round(sum(coef * coef * var), 6) AS variance
      FROM contrasts JOIN effects USING (species, frequency, stratum, t) GROUP BY ALL""")
    sql["linear_contrasts"] = s("""SELECT species, frequency, kind, name, stratum, term, round(coef, 6) AS coef FROM (
      SELECT species, frequency, 'linear_estimate' AS kind, printf('linear_estimate_%02d', t) AS name, stratum,
        'intercept' AS term, weight AS coef FROM effects JOIN weights USING (species, stratum)
      UNION ALL
      SELECT species, frequency, 'linear_estimate', printf('linear_estimate_%02d', t), stratum, 'slope', weight * t
      FROM effects JOIN weights USING (species, stratum)
      UNION ALL
      SELECT DISTINCT species, frequency, 'linear_trend', 'linear_trend', stratum, 'slope', weight
      FROM effects JOIN weights USING (species, stratum))""")
    sql["parse_contrast_names"] = s("""SELECT DISTINCT name, kind, reference::DOUBLE AS reference,
        alternative::DOUBLE AS alternative, year::DOUBLE AS year, midpoint::DOUBLE AS midpoint,
        width::DOUBLE AS "window"
      FROM (
      SELECT printf('estimate_%d', label) AS name, 'estimate' AS kind, NULL AS reference,
        NULL AS alternative, label AS year, NULL AS midpoint, NULL AS width
      FROM estimates
      UNION ALL
      SELECT printf('index_%d_%d', reference, alternative), 'index', reference, alternative, NULL, NULL, NULL FROM pairs
      UNION ALL
      SELECT printf('trend_%.1f_%d', midpoint, "window"), 'trend', NULL, NULL, NULL, midpoint, "window" FROM trends
      UNION ALL
      SELECT printf('linear_estimate_%02d', t), 'linear_estimate', NULL, NULL, t, NULL, NULL FROM estimates
      UNION ALL
      SELECT 'linear_trend', 'linear_trend', NULL, NULL, NULL, NULL, NULL FROM linear)""")
    sql["choose_family"] = s(f"""SELECT species, n, cells, zeros, {_six('phi', 'zero_ratio')},
      CASE WHEN phi > 1.5 AND zero_ratio > 1.5 THEN 'zeroinflatednbinomial1' WHEN phi > 1.5 THEN 'nbinomial'
        WHEN zero_ratio > 1.5 THEN 'zeroinflatedpoisson1' ELSE 'poisson' END AS family FROM dispersion""")
    sql["linearity_verdict"] = s(f"SELECT species, frequency, difference, verdict, {_six('ic_linear', 'ic_non_linear')} FROM verdicts")
    # composites
    sql["composite_members"] = s("""SELECT species_group, frequency, type, count(*) AS n_members,
      string_agg(species, ';' ORDER BY species) AS members FROM members GROUP BY ALL""")
    sql["composite_index"] = s(f"SELECT species_group, frequency, reference, alternative, n_species, {four} FROM group_index")
    sql["composite_moving_trend"] = s(f'SELECT species_group, frequency, "window", midpoint, mid_year, n_species, {four} FROM group_trend')
    sql["composite_thresholds"] = s(f"SELECT species_group, n_species, {_six('threshold', 'lower_bound', 'upper_bound')} FROM thresholds")
    sql["composite_results"] = s("SELECT * FROM index_results SEMI JOIN groups USING (species)")
    # result tables
    sql["rescale_interval"] = s("SELECT * FROM trend_results")
    sql["classify_effect"] = s(f"""SELECT *, {_label('effect_class')} AS label FROM (
      SELECT species, frequency, reference, alternative, {_classify('lcl', 'ucl', f'({THRESHOLD})')} AS effect_class
      FROM index_results)""")
    sql["format_interval"] = s(f"""SELECT species, frequency, label, {_level_text('estimate', 'lcl', 'ucl')} AS text
      FROM estimate_results""")
    sql["mirror_pairs"] = s("SELECT * FROM mirrored")
    sql["pair_matrix"] = s("SELECT * FROM matrix")
    sql["fan_bands"] = s(f"""SELECT species, frequency, label, estimate, level, {_six('sd', 'band_lcl', 'band_ucl')} FROM (
      SELECT *, estimate - z * sd AS band_lcl, estimate + z * sd AS band_ucl FROM (
        SELECT *, (ucl - lcl) / (2 * {Z95}) AS sd FROM estimate_results),
        (VALUES (0.3::DOUBLE, 0.38532046640756773::DOUBLE), (0.6::DOUBLE, 0.8416212335729143::DOUBLE),
                (0.9::DOUBLE, {Z95}::DOUBLE)) v(level, z))""")
    levels = [i / 100 for i in range(1, 100)]
    scores = ", ".join(f"({v}::DOUBLE, {NormalDist().inv_cdf((1 + v) / 2)}::DOUBLE)" for v in levels)
    sql["interval_levels"] = s(f"""SELECT species, frequency, label, level,
        round(estimate - z * sd, 9) AS lcl, round(estimate + z * sd, 9) AS ucl
      FROM (SELECT *, (ucl - lcl) / (2 * {Z95}) AS sd FROM estimate_results)
      CROSS JOIN (VALUES {scores}) v(level, z)""")
    sql["composite_order"] = s("""SELECT species, label, CAST(dense_rank() OVER (PARTITION BY species
        ORDER BY CASE WHEN TRY_CAST(label AS DOUBLE) IS NULL THEN 1 ELSE 0 END, TRY_CAST(label AS DOUBLE), label)
        AS INTEGER) AS place
      FROM (SELECT species, unnest([replace(species_group, 'Size ', ''), species_group]) AS label
        FROM groups WHERE species_group LIKE 'Size %')""")
    sql["table_diff"] = s("""SELECT species, year, count(*) FILTER (o) AS old_rows, count(*) AS new_rows,
        CASE WHEN count(*) FILTER (o) = 0 THEN 'added' WHEN bool_and(o) THEN 'same' ELSE 'changed' END AS change,
        0::BIGINT AS rows_gone, count(*) FILTER (NOT o) AS rows_new
      FROM (SELECT c.species, c.year, v.start_date <= TIMESTAMP '1997-06-15' AS o
        FROM all_counts c JOIN valid v USING (sample_id)) GROUP BY species, year""")
    sql["index_steps"] = s(f"""SELECT species, frequency, reference, alternative, estimate, effect_class,
        printf('%d-%d', alternative, reference) AS key, round((ucl - lcl) / (2 * {Z95}), 6) AS sd,
        round(alternative + side * CASE WHEN frequency = 'cycle' THEN 1.49999 ELSE 0.49999 END::DOUBLE, 5) AS x
      FROM matrix, (VALUES (-1), (0), (1)) v(side)""")
    sql["index_vs_first"] = s("""SELECT * FROM index_results QUALIFY reference =
      min(reference) OVER (PARTITION BY species, frequency)""")
    sql["drop_incomplete_cycle"] = s("""SELECT species, frequency, label, estimate FROM estimate_results
      QUALIFY frequency <> 'cycle' OR label < max(label) OVER (PARTITION BY species)
        OR (max(label) OVER (PARTITION BY species) - 1995) % 3 = 2""")
    period = "CASE WHEN frequency = 'cycle' THEN 'the period ' || {0} || '-' || ({0} + 2) ELSE CAST({0} AS VARCHAR) END"
    sql["endpoint_change"] = s(f"""SELECT species, frequency, string_agg(sentence, chr(10) ORDER BY reference) AS text FROM (
      SELECT *, 'The state in ' || {period.format('alternative')} || ' differs by ' ||
        {_change_text('estimate', 'lcl', 'ucl')} || ' from ' || {period.format('reference')} || ' (' ||
        {_label('effect_class')} || ').' AS sentence
      FROM (SELECT *, {_classify('lcl', 'ucl', f'({THRESHOLD})')} AS effect_class FROM (
        SELECT species, frequency, reference, alternative,
          CASE WHEN frequency = 'cycle' THEN estimate / 3 ELSE estimate END AS estimate,
          CASE WHEN frequency = 'cycle' THEN lcl / 3 ELSE lcl END AS lcl,
          CASE WHEN frequency = 'cycle' THEN ucl / 3 ELSE ucl END AS ucl
        FROM (SELECT * FROM index_results QUALIFY alternative = max(alternative) OVER (PARTITION BY species, frequency))
        QUALIFY reference IN (min(reference) OVER (PARTITION BY species, frequency),
                              max(reference) OVER (PARTITION BY species, frequency)))))
      GROUP BY species, frequency""")
    sql["trend_overview"] = s("SELECT * EXCLUDE (total), round(total, 6) AS total FROM overview")
    # analyses
    sql["analysis_meta"] = s("SELECT * EXCLUDE (ic), round(ic, 6) AS ic FROM meta")
    sql["analysis_dag"] = s("""SELECT l.analysis, l.parent, l.parent IS NULL AS is_root, coalesce(n.n, 0) AS n_children
      FROM (SELECT analysis, CAST(NULL AS VARCHAR) AS parent FROM analyses
            UNION ALL SELECT species_group || '/' || frequency || '/' || type, analysis FROM members) l
      LEFT JOIN (SELECT analysis, count(*) AS n FROM members GROUP BY analysis) n ON n.analysis = l.analysis""")
    # exports
    freq = "CASE frequency WHEN 'cycle' THEN 'three-yearly' ELSE 'yearly' END AS frequency"
    exps = ", ".join(f"round(exp({c}), 4) AS {c}" for c in ("estimate", "lcl", "ucl"))
    key = "|| '/' || frequency || '/{0}'"
    own = f"species AS species_name, {freq}"
    ids = lambda name, kind: (
        f"{name} {key.format(kind)} AS analysis, sha1({name} {key.format(kind)} || '|converged') AS status"
    )
    sql["export_estimate"] = s(f"""SELECT {own}, label AS year, {exps}, {_level_text('r.estimate', 'r.lcl', 'r.ucl')} AS text,
      {ids('species', 'non linear')} FROM estimate_results r""".replace("frequency ||", "r.frequency ||").replace("|| frequency", "|| r.frequency"))
    sql["export_trend"] = s(f"""SELECT {own}, yearly_text AS yearly, total_text AS total, verdict AS course,
      {ids('species', 'linear')} FROM overview r""".replace("|| frequency", "|| r.frequency"))
    sql["export_index"] = s(f"""SELECT {own}, reference, alternative AS "to", {exps},
      {_classify('r.lcl', 'r.ucl', f'({THRESHOLD})')} AS effect_class, {_change_text('r.estimate', 'r.lcl', 'r.ucl')} AS change_text,
      {ids('species', 'non linear')} FROM mirrored r""".replace("|| frequency", "|| r.frequency"))
    sql["export_composite"] = s(f"""SELECT species_group AS species_name, {freq}, reference, alternative AS "to", {exps},
      {_classify('r.lcl', 'r.ucl', 'threshold')} AS effect_class, {_change_text('r.estimate', 'r.lcl', 'r.ucl')} AS change_text,
      {ids('species_group', 'non linear')}
      FROM group_mirrored r JOIN thresholds USING (species_group)""".replace("|| frequency", "|| r.frequency"))
    sql["export_composite_members"] = s("""SELECT species_group AS indicator, species,
      round(lower_bound, 4) AS lower_bound, round(upper_bound, 4) AS upper_bound
      FROM groups JOIN thresholds USING (species_group)""")
    sql["export_stratum_weight"] = s("""SELECT species, stratum, round(weight, 3) AS weight,
        round(relevant * n_frame / t_surveyed, 1) AS present, relevant, t_surveyed AS surveyed, n_frame AS total, visits
      FROM weight_table JOIN surveyed USING (stratum) JOIN frame USING (stratum)""")
    return sql
