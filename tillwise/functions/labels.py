"""Report labels and custom sort orders."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order in which reports list age groups and lengths of stay.
AGE_GROUPS = ["0-17", "18-25", "26-35", "36-45", "46-50", "51-55", "55+"]
STAY_YEARS = ["0", "1", "2", "3", "4+"]

# Label words by lower bound (the value must exceed it), then the
# word for everything below the last bound, then the word for a missing value.
MONTH_TREND_UP = [(10, "UP"), (0, "up")]
MONTH_TREND_DOWN = [(10, "DOWN"), (0, "down")]
MONTH_TREND_FLAT, MONTH_TREND_MISSING = "flat", "-"
CATEGORY_PERFORMANCE = (
    [(5, "Strong Growth"), (0, "Moderate Growth"), (-5, "Slight Decline")], "Declining", "-")
QUARTER_TREND = ([(10, "Strong"), (0, "Growth"), (-10, "Decline")], "Sharp", "Baseline")
STORE_RATING = (
    [(15, "Excellent"), (5, "Good"), (0, "Moderate"), (-5, "Needs Attention")],
    "Critical", "Insufficient Data")
VOLATILITY = ([(50, "EXTREME"), (25, "HIGH"), (10, "Moderate")], "Stable", "Baseline")
RISK_LEVEL = ([(30, "HIGH"), (15, "Medium")], "Low", "Low")
EXTREME_SPIKE, HIGH_SPIKE = "EXTREME SPIKE (3x+)", "HIGH SPIKE (2x-3x)"


def listed_order(value: Column, listing: Sequence[str]) -> Column:
    """Sort key: position in ``listing``, with unknown values after all of it."""
    position = F.array_position(F.array(*[F.lit(v) for v in listing]), value)
    return F.coalesce(F.nullif(position, F.lit(0)), F.lit(len(listing) + 1))


def above(value: Column, bounds, lowest: str, missing: str) -> Column:
    """Label of the first bound that ``value`` exceeds."""
    label = F.when(value.isNull(), F.lit(missing))
    for bound, word in bounds:
        label = label.when(value > F.lit(bound), F.lit(word))
    return label.otherwise(F.lit(lowest))


def month_trend(growth: Column) -> Column:
    falling = above(-growth, MONTH_TREND_DOWN, MONTH_TREND_FLAT, MONTH_TREND_MISSING)
    return F.when(growth > 0, above(growth, MONTH_TREND_UP, "", "")).otherwise(falling)


def larger_of(left: Column, left_word: str, right: Column, right_word: str,
              tie_word: str = "Equal") -> Column:
    return (F.when(left > right, F.lit(left_word))
             .when(right > left, F.lit(right_word))
             .otherwise(F.lit(tie_word)))
