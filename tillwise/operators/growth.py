"""Comparison of a period with the one before it.

Two notions exist and differ on gaps: the previous period that has data
(``with_previous``) and the previous calendar period (``with_previous_month``).
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_previous(df: DataFrame, within: list[str], order: list[str],
                  **columns: str) -> DataFrame:
    """Add columns of the previous existing period, ``new_name="source"``."""
    window = W.partitionBy(*within).orderBy(*order)
    return df.withColumns({new: F.lag(src).over(window) for new, src in columns.items()})


def with_previous_month(df: DataFrame, within: list[str], month: str,
                        **columns: str) -> DataFrame:
    """Add columns of the row whose month number is one less, NULL on a gap.

    ``within`` and ``month`` identify a row, so looking one row back and checking
    its month gives what a self-join on ``month - 1`` would, without the join.
    """
    window = W.partitionBy(*within).orderBy(month)
    adjacent = F.lag(month).over(window) == F.col(month) - 1
    return df.withColumns({
        new: F.when(adjacent, F.lag(src).over(window)) for new, src in columns.items()})
