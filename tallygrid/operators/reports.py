"""Tables behind the report pages and the open-data exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallygrid.functions.effects import class_label, class_order, classify, linearity
from tallygrid.functions.intervals import interval_text
from tallygrid.operators.contrasts import SERIES
from tallygrid.operators.intervals import described, mirror_pairs, period_label

# Frequency labels of the exports.
FREQUENCY_LABELS = {
    "en": {"year": "yearly", "cycle": "three-yearly"},
    "nl": {"year": "jaarlijks", "cycle": "driejaarlijks"},
}
# Sentence about a change between two times.
CHANGE_SENTENCES = {
    "en": {
        "text": "The state in %s differs by %s from %s (%s).",
        "cycle": "the period %s",
    },
    "nl": {
        "text": "De toestand in %s verschilt met %s t.o.v. %s (%s).",
        "cycle": "de periode %s",
    },
}


def frequency_label(frequency: Column, lang: str = "en") -> Column:
    names = FREQUENCY_LABELS[lang]
    return F.when(frequency == "cycle", names["cycle"]).otherwise(names["year"])


def per_year(x: Column, cycle_len: int) -> Column:
    """A change per time step as a change per year."""
    return F.when(F.col("frequency") == "cycle", x / cycle_len).otherwise(x)


def linearity_verdict(criteria: DataFrame, lang: str = "en", digits: int = 6) -> DataFrame:
    """Whether the linear model does as well as the non-linear one."""
    difference = F.round(F.col("ic_non_linear") - F.col("ic_linear"), digits)
    return criteria.withColumn("difference", difference).withColumn(
        "verdict", linearity(F.col("difference"), lang)
    )


def durations(estimates: DataFrame) -> DataFrame:
    """Years between the first and last time step of a species, over both frequencies."""
    return estimates.groupBy("species").agg((F.max("t") - 1).cast("long").alias("duration"))


def trend_overview(
    linear: DataFrame,
    verdicts: DataFrame,
    duration: DataFrame,
    threshold: float,
    cycle_len: int = 3,
    lang: str = "en",
) -> DataFrame:
    """Yearly change and change over the whole survey per species and frequency, in class order."""
    yearly = {c: per_year(F.col(c), cycle_len) for c in ("estimate", "lcl", "ucl")}
    table = (
        linear.withColumns(yearly)
        .join(verdicts.select(*SERIES, "verdict"), SERIES)
        .join(duration, "species")
    )

    def text(factor) -> Column:
        return interval_text(
            *[F.col(c) * factor for c in ("estimate", "lcl", "ucl")], percent=True, sign=True, change=True
        )

    span = F.col("duration")
    return (
        table.withColumn("yearly_text", text(1))
        .withColumn("total_text", text(span))
        .withColumn("effect_class", classify(F.col("lcl") * span, F.col("ucl") * span, threshold))
        .withColumn("class_ord", class_order(F.col("effect_class")))
        .withColumn("label", class_label(F.col("effect_class"), lang))
        .withColumn("total", F.col("estimate") * span)
        .select(
            *SERIES,
            "verdict",
            "duration",
            "effect_class",
            "class_ord",
            "label",
            "yearly_text",
            "total_text",
            "total",
        )
        .orderBy("class_ord", F.desc("total"), *SERIES)
    )


def index_vs_first(index: DataFrame, keys: list[str]) -> DataFrame:
    """Comparisons with the oldest reference only."""
    oldest = F.min("reference").over(Window.partitionBy(*keys))
    return index.withColumn("oldest", oldest).filter("reference = oldest").drop("oldest")


def drop_incomplete_cycle(
    estimates: DataFrame, base_year: int, time: str = "label", cycle_len: int = 3
) -> DataFrame:
    """Leave out a cycle that started in the last year of the species, unless it ends there too.

    The last year is that of both frequencies together.
    """
    last = F.max(time).over(Window.partitionBy("species"))
    complete = F.pmod(F.col("_last") - base_year, F.lit(cycle_len)) == cycle_len - 1
    return (
        estimates.withColumn("_last", last)
        .filter((F.col("frequency") != "cycle") | (F.col(time) < F.col("_last")) | complete)
        .drop("_last")
    )


def endpoint_change(
    index: DataFrame,
    threshold: float,
    cycle_len: int = 3,
    lang: str = "en",
    per_year_scaling: bool = True,
) -> DataFrame:
    """The newest time step against the first and the last reference, as rows with a sentence."""
    series = Window.partitionBy(*SERIES)
    newest = index.withColumn("_last", F.max("alternative").over(series)).filter("alternative = _last")
    ends = newest.withColumn("_min", F.min("reference").over(series)).withColumn(
        "_max", F.max("reference").over(series)
    ).filter("reference = _min OR reference = _max").drop("_last", "_min", "_max")
    if per_year_scaling:
        ends = ends.withColumns({c: per_year(F.col(c), cycle_len) for c in ("estimate", "lcl", "ucl")})
    words = CHANGE_SENTENCES[lang]

    def when(c: str) -> Column:
        label = period_label(F.col("frequency"), F.col(c), cycle_len)
        return F.when(F.col("frequency") == "cycle", F.format_string(words["cycle"], label)).otherwise(label)

    return described(ends, threshold, lang).withColumn(
        "sentence",
        F.format_string(words["text"], when("alternative"), F.col("change_text"), when("reference"), F.col("label")),
    )


def endpoint_text(changes: DataFrame) -> DataFrame:
    """The sentences of a series in one text, oldest reference first."""
    return changes.groupBy(*SERIES).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("reference", "sentence"))), lambda s: s["sentence"]),
            "\n",
        ).alias("text")
    )


def _identified(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Rows of finished analyses with the name of their species and the fingerprint of their status."""
    return df.join(
        meta.filter(F.col("status") == "converged").select("analysis", F.col("speciesgroup").alias("species_name"), "status_fingerprint"), "analysis"
    )


def export_estimate(estimates: DataFrame, meta: DataFrame, lang: str = "en") -> DataFrame:
    """Mean numbers per point, on the natural scale."""
    text = interval_text(F.col("estimate"), F.col("lcl"), F.col("ucl"))
    return _identified(estimates, meta).select(
        "species_name",
        frequency_label(F.col("frequency"), lang).alias("frequency"),
        F.col("label").alias("year"),
        *[F.round(F.exp(c), 4).alias(c) for c in ("estimate", "lcl", "ucl")],
        text.alias("text"),
        "analysis",
        F.col("status_fingerprint").alias("status"),
    )


def export_trend(overview: DataFrame, meta: DataFrame, lang: str = "en") -> DataFrame:
    return _identified(overview, meta).select(
        "species_name",
        frequency_label(F.col("frequency"), lang).alias("frequency"),
        F.col("yearly_text").alias("yearly"),
        F.col("total_text").alias("total"),
        F.col("verdict").alias("course"),
        "analysis",
        F.col("status_fingerprint").alias("status"),
    )


def export_index(
    index: DataFrame, meta: DataFrame, threshold: Column | float, lang: str = "en"
) -> DataFrame:
    """Ratios between all time steps, both directions."""
    return _identified(described(mirror_pairs(index), threshold, lang), meta).select(
        "species_name",
        frequency_label(F.col("frequency"), lang).alias("frequency"),
        "reference",
        F.col("alternative").alias("to"),
        *[F.round(F.exp(c), 4).alias(c) for c in ("estimate", "lcl", "ucl")],
        "effect_class",
        "change_text",
        "analysis",
        F.col("status_fingerprint").alias("status"),
    )


def numbers_first(df: DataFrame, column: str, keys: list[str] | None = None, place: str = "place") -> DataFrame:
    """Number labels within their keys: those that are numbers by value, then the others as texts.

    Equal labels have equal places without gaps; a NULL comes last. Keys without rows beyond memory
    are the caller's: a window over one partition numbers the labels of a group, not of a table.
    """
    number = F.col(column).cast("string").try_cast("double")
    order = Window.partitionBy(*(keys or [])).orderBy(
        number.isNull(), F.col(column).isNull(), number, F.col(column).cast("string")
    )
    return df.withColumn(place, F.dense_rank().over(order))


def export_composite_members(members: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Species of every composite with its class bounds."""
    return (
        members.select("species_group", "species")
        .distinct()
        .join(thresholds, "species_group")
        .select(
            F.col("species_group").alias("indicator"),
            "species",
            F.round("lower_bound", 4).alias("lower_bound"),
            F.round("upper_bound", 4).alias("upper_bound"),
        )
    )


def export_stratum_weight(weight_table: DataFrame, surveyed: DataFrame, frame_sizes: DataFrame) -> DataFrame:
    return (
        weight_table.join(surveyed, "stratum")
        .join(frame_sizes, "stratum")
        .select(
            "species",
            "stratum",
            F.round("weight", 3).alias("weight"),
            F.round(F.col("relevant") * F.col("n_frame") / F.col("t_surveyed"), 1).alias("present"),
            "relevant",
            F.col("t_surveyed").alias("surveyed"),
            F.col("n_frame").alias("total"),
            "visits",
        )
    )
