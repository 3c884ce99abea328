"""Aggregates shared by the reports, over the columns of ``RetailTables.sold``."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.money import from_cents, mean_money
from tillwise.operators.bitmaps import counted, states


def orders(name: str = "total_orders", where: Column | None = None) -> Column:
    order = F.col("orderID") if where is None else F.when(where, F.col("orderID"))
    return F.count_distinct(order).alias(name)


def buyers(name: str = "unique_customers") -> Column:
    return F.count_distinct("Customer_ID").alias(name)


def distinct(column: str, name: str) -> Column:
    return F.count_distinct(column).alias(name)


def units(name: str = "total_quantity", where: Column | None = None) -> Column:
    quantity = F.col("quantity").cast("bigint")
    if where is not None:
        quantity = F.when(where, quantity).otherwise(F.lit(0))
    return F.sum(quantity).alias(name)


def revenue(name: str, where: Column | None = None) -> Column:
    cents = F.col("amount_cents")
    if where is not None:
        cents = F.when(where, cents).otherwise(F.lit(0))
    return from_cents(F.sum(cents)).alias(name)


def mean_amount(name: str = "avg_per_transaction") -> Column:
    cents = F.col("amount_cents")
    return mean_money(F.sum(cents), F.count(cents)).alias(name)


def revenue_per(column: str, name: str) -> Column:
    return mean_money(F.sum("amount_cents"), F.count_distinct(column)).alias(name)


# --- several distinct counts at once ---

SUMS = ["quantity", "amount_cents", "n_lines"]


def line_states(lines: DataFrame, keys: list[str], **ids: str) -> DataFrame:
    """Mergeable states of the distinct counts ``ids`` (name=column) per group of ``keys``, with units,
    cents and the number of lines with an amount."""
    amounts = F.when(F.col("amount_cents").isNotNull(), 1)
    return states(lines, keys, {name: F.col(column) for name, column in ids.items()},
                  dict(zip(SUMS, [F.col("quantity"), F.col("amount_cents"), amounts], strict=True)))


def counted_lines(lines: DataFrame, keys: list[str], **ids: str) -> DataFrame:
    """Per group of ``keys`` the distinct counts ``ids`` and the ``SUMS``, without copying lines."""
    return counted(line_states(lines, keys, **ids), keys, list(ids), SUMS)


def added_revenue(name: str) -> Column:
    return from_cents(F.col("amount_cents")).alias(name)


def added_mean(name: str = "avg_per_transaction") -> Column:
    return mean_money(F.col("amount_cents"), F.col("n_lines")).alias(name)
