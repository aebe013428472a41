"""Column expressions: seasons, intervals, effect classes and texts."""

from tallygrid.functions.effects import (
    CLASS_LABELS,
    EFFECT_CLASSES,
    class_label,
    class_order,
    classify,
    linearity,
)
from tallygrid.functions.intervals import (
    Z95,
    Z975,
    interval_sd,
    interval_text,
    natural,
    normal_quantile,
    rescaled,
)
from tallygrid.functions.names import (
    cycle_period_label,
    estimate_name,
    index_name,
    linear_estimate_name,
    slug,
    strip_suffix,
    trend_name,
    wrapped_hash,
)
from tallygrid.functions.seasons import cycle_of, cycle_start, in_season, season_period

__all__ = [
    "CLASS_LABELS",
    "EFFECT_CLASSES",
    "Z95",
    "Z975",
    "class_label",
    "class_order",
    "classify",
    "cycle_of",
    "cycle_period_label",
    "cycle_start",
    "estimate_name",
    "in_season",
    "index_name",
    "interval_sd",
    "interval_text",
    "linear_estimate_name",
    "linearity",
    "natural",
    "normal_quantile",
    "rescaled",
    "season_period",
    "slug",
    "strip_suffix",
    "trend_name",
    "wrapped_hash",
]
