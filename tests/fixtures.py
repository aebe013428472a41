"""A small survey in memory, and the relevance rules by brute force in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from tallygrid.sources import SurveySource

SAMPLES = (
    "sample_id long, point_id long, project string, start_date timestamp_ntz, "
    "validation_status int, not_counted boolean"
)


@dataclass
class MemorySource(SurveySource):
    spark: object
    sample_rows: list
    observation_rows: list
    point_rows: list
    frame_rows: list
    group_rows: list = field(default_factory=list)
    family_rows: list = field(default_factory=list)
    project: str = "birds"

    def samples(self):
        return self.spark.createDataFrame(self.sample_rows, SAMPLES)

    def observations(self):
        return self.spark.createDataFrame(
            self.observation_rows, "sample_id long, species string, number_min int"
        )

    def points(self, end_date=None):
        return self.spark.createDataFrame(
            self.point_rows, "point_id long, square string, stratum string"
        )

    def frame(self):
        return self.spark.createDataFrame(self.frame_rows, "stratum string, square string")

    def species(self, end_date=None):
        names = self.observations().select("species").distinct()
        return names.select("species", *[F.col("species").alias(c) for c in ("scientific_name", "name", "euring", "reference")])

    def groups(self):
        return self.spark.createDataFrame(self.group_rows, "species_group string, species string")

    def families(self):
        return self.spark.createDataFrame(self.family_rows, "species string, family string")


def random_survey(spark, seed: int, n_samples: int = 400, hot_species: bool = False, hot_point: bool = False):
    """Two strata, eight squares, three points each; some species are rare."""
    import datetime

    rng = random.Random(seed)
    points = [(s * 10 + p, f"q{s}", "low" if s < 5 else "high") for s in range(8) for p in range(3)]
    samples, observations = [], []
    for i in range(n_samples):
        point = 0 if hot_point and rng.random() < 0.4 else rng.choice(points)[0]
        day = datetime.datetime(2007, 3, 1) + datetime.timedelta(days=rng.randrange(138))
        day = day.replace(year=2007 + rng.randrange(9))
        samples.append((i, point, "birds", day, 1, False))
        for k, name in enumerate(["robin", "wren", "tit", "owl"]):
            chance = 0.9 if hot_species and k == 0 else 0.5 / (k + 1)
            if rng.random() < chance:
                for _ in range(rng.randrange(1, 3)):
                    observations.append((i, name, rng.randrange(0, 6)))
    frame = [(st, q) for st, q in {(p[2], p[1]) for p in points}] + [("low", "q90"), ("high", "q91")]
    groups = [("all", n) for n in ("robin", "wren", "tit", "owl")] + [("small", "wren"), ("small", "tit")]
    return MemorySource(spark, samples, observations, points, frame, groups)


def season(date):
    """Year and period of a date, None outside the season."""
    edge = lambda m, d: date.replace(month=m, day=d, hour=0, minute=0, second=0, microsecond=0)
    if not edge(3, 1) <= date <= edge(7, 16):
        return None
    return date.year, 1 + (date >= edge(4, 16)) + (date >= edge(6, 1))


def brute_force(source: MemorySource, base_year, min_observation, min_stratum, min_cycle, proportion):
    """Relevant rows as {(species, sample_id): (count, period, is_reference)}, rule by rule."""
    places = {p: (q, s) for p, q, s in source.point_rows}
    visits = {}
    for sid, point, project, date, status, skipped in source.sample_rows:
        if project == source.project and status is not None and status != -1 and not skipped:
            if (when := season(date)) and point in places:
                visits[sid] = (point, *places[point], *when, 1 + (when[0] - base_year) // 3)
    counts = defaultdict(int)
    for sid, name, number in source.observation_rows:
        if sid in visits:
            counts[name, sid] += number
    result = {}
    for name in {n for n, _ in counts}:
        rows = [(sid, *v, counts.get((name, sid), 0)) for sid, v in visits.items()]

        def enough():
            return sum(r[-1] > 0 for r in rows) >= min_observation

        def keep(column, distinct, least):
            seen = defaultdict(set)
            for r in rows:
                if r[-1] > 0:
                    seen[r[column]].add(r[distinct])
            return [r for r in rows if len(seen[r[column]]) >= least]

        # sid, point, square, stratum, year, period, cycle, count
        if not enough():
            continue
        rows = keep(1, 1, 1)
        rows = keep(2, 6, min_cycle)
        if not enough():
            continue
        rows = keep(3, 2, min_stratum)
        if not enough():
            continue
        by_period = defaultdict(list)
        for r in rows:
            by_period[r[5]].append(r[-1])
        means = {p: sum(x) / len(x) for p, x in sorted(by_period.items())}
        best = max(means.values())
        reference = min(p for p, m in means.items() if m == best)
        rows = [r for r in rows if means[r[5]] >= proportion * best]
        if not enough():
            continue
        rows = keep(2, 6, min_cycle)
        if not enough():
            continue
        rows = keep(3, 2, min_stratum)
        if not enough():
            continue
        for r in rows:
            result[name, r[0]] = (r[-1], r[5], r[5] == reference)
    return result
