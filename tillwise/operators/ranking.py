"""Top-k reports with a total order, so ties do not depend on the partitioning."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.session import written


def ranked(df: DataFrame, within: list[str], order: list[Column], name: str) -> DataFrame:
    number = F.row_number().over(W.partitionBy(*within).orderBy(*order))
    return df.withColumn(name, number)


def top_k_per_group(df: DataFrame, within: list[str], order: list[Column], k: int,
                    name: str) -> DataFrame:
    """First ``k`` rows of each group; each task keeps only its own first ``k``
    before the shuffle, so one large group does not travel whole."""
    return ranked(df, within, order, name).where(F.col(name) <= k)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def with_order_counts(top: DataFrame, lines: DataFrame, keys: list[str],
                      name: str) -> DataFrame:
    """Count the distinct orders of the winners only.

    ``top`` holds at most k rows for each of a fixed number of groups. It is written
    first, so the ranking runs once and Spark sees how small it is; the second look at
    the bare ``lines`` then keeps those of the winners before anything else is joined or
    shuffled. ``keys`` name the winners in ``lines``; the first is never null there.
    """
    top = written(top, "winners")
    winners = top.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
    first, *others = keys
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in others],
                  F.col(first) == F.col(f"_{first}"))
    counts = (lines.join(winners, same, "left_semi").groupBy(*keys)
              .agg(F.count_distinct("orderID").alias(name))
              .withColumnsRenamed({c: f"_{c}" for c in keys}))
    return top.join(counts, same).drop(*[f"_{c}" for c in keys])


def numbered(top: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add 1, 2, 3 … to the few rows that a ``top_k`` has left."""
    return top.withColumn(name, F.row_number().over(W.orderBy(*order)))
