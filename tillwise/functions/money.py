"""Money and ratios.

Amounts are added up as whole cents in a 64-bit integer, which keeps the sum
inside generated code (a decimal sum wider than 18 digits allocates an object
per row), and become a decimal only after the aggregation. Ratios are decimal
divisions of those totals, so rounding is half away from zero and does not
depend on the order in which partitions are merged.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"
WHOLE = "decimal(20,0)"


def to_cents(price: Column) -> Column:
    return (price * F.lit(100)).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast(WHOLE) / F.lit(100)).cast(MONEY)


def mean_money(cents: Column, n: Column) -> Column:
    """``cents / n`` as money, rounded to the cent; NULL when ``n`` is zero."""
    return from_cents(F.round(F.try_divide(cents.cast(WHOLE), n.cast(WHOLE)), 0))


def mean_money_fine(cents: Column, n: Column) -> Column:
    """``cents / n`` as money with the six decimals an SQL average carries."""
    per_unit = F.try_divide(cents.cast(WHOLE), n.cast(WHOLE) * F.lit(100))
    return F.round(per_unit, 6).cast("decimal(24,6)")


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100), whole), digits).cast("double")


def share_or_zero(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, percent(part, whole, digits)).otherwise(F.lit(0.0))


def change_percent(now: Column, before: Column) -> Column:
    """Percentage change to two decimals; NULL without a non-zero predecessor."""
    return percent(now - before, before, 2)


def change_ratio(now: Column, before: Column) -> Column:
    """Relative change to six decimals, for averaging; NULL unless ``before > 0``."""
    return F.when(before > 0, F.round(F.try_divide(now - before, before), 6))


def mean_ratio_percent(ratio: Column) -> Column:
    """Average of a ratio column over the non-NULL rows, as a percentage."""
    total = F.sum(ratio.cast("decimal(24,6)"))
    return F.round(F.try_divide(total * F.lit(100), F.count(ratio)), 2).cast("double")
