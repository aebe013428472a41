"""Classes of effects: where an interval lies against a reference and a threshold."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The classes in report order, and their labels per language.
EFFECT_CLASSES = ["++", "+", "+~", "~", "-~", "-", "--", "?+", "?-", "?"]
CLASS_LABELS = {
    "en": {
        "++": "strong increase",
        "+": "increase",
        "+~": "moderate increase",
        "~": "stable",
        "-~": "moderate decrease",
        "-": "decrease",
        "--": "strong decrease",
        "?+": "potential increase",
        "?-": "potential decrease",
        "?": "unclear",
        "R": "reference",
    },
    "nl": {
        "++": "sterke toename",
        "+": "toename",
        "+~": "matige toename",
        "~": "stabiel",
        "-~": "matige afname",
        "-": "afname",
        "--": "sterke afname",
        "?+": "mogelijke toename",
        "?-": "mogelijke afname",
        "?": "onduidelijk",
        "R": "referentie",
    },
}
LINEARITY_LABELS = {
    "en": ("non-linear", "possibly non-linear", "linear"),
    "nl": ("niet-lineair", "mogelijk niet-lineair", "lineair"),
}


def classify(lcl: Column, ucl: Column, threshold: Column | float, reference: float = 0.0) -> Column:
    """One of ten classes; a limit equal to a bound falls to the weaker class.

    The bounds lie ``abs(threshold)`` above and below zero; the reference is usually zero.
    """
    bound = F.abs(threshold if isinstance(threshold, Column) else F.lit(float(threshold)))
    low = -bound
    ref = F.lit(float(reference))
    above = (
        F.when(lcl > bound, "++").when(ucl > bound, "+").otherwise("+~")
    )
    below = F.when(ucl < low, "--").when(lcl < low, "-").otherwise("-~")
    around = (
        F.when((lcl < low) & (ucl > bound), "?")
        .when(lcl < low, "?-")
        .when(ucl > bound, "?+")
        .otherwise("~")
    )
    return F.when(lcl > ref, above).when(ucl < ref, below).otherwise(around)


def class_order(effect_class: Column) -> Column:
    """Rank of a class in report order, strongest increase first."""
    ranked = F.array(*[F.lit(c) for c in EFFECT_CLASSES])
    return F.array_position(ranked, effect_class).cast("int")


def class_label(effect_class: Column, lang: str = "en") -> Column:
    pairs = chain.from_iterable(CLASS_LABELS[lang].items())
    return F.create_map(*[F.lit(x) for x in pairs])[effect_class]


def linearity(difference: Column, lang: str = "en") -> Column:
    """Verdict on criterion(non-linear) - criterion(linear); breaks -2 and 0, right-closed."""
    non_linear, possible, linear = LINEARITY_LABELS[lang]
    return (
        F.when(difference <= -2, non_linear)
        .when(difference <= 0, possible)
        .when(difference > 0, linear)
    )
