"""Cross-tabs with a declared value list, row totals and a grand total row."""

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOTAL, OTHER = "TOTAL", "other"
MOST_COLUMNS = 1000  # a table of more columns needs a list of them


def slug(value) -> str:
    return re.sub(r"[^0-9a-z]+", "_", str(value).lower()).strip("_")


def crosstab(df: DataFrame, row: str, column: str, values: list, prefix: str,
             cell, row_total: str | None = None) -> DataFrame:
    """One row per ``row`` value, one ``prefix`` + value column per listed value, and a column
    ``prefix`` + OTHER for all rows with another value or none, so nothing is lost.

    ``cell`` maps a condition to an aggregate, so the whole table is one
    aggregation without a pass to discover the values. Empty cells are zero.
    """
    of = F.col(column)
    listed = F.coalesce(of.isin(list(values)), F.lit(False))
    names = [prefix + slug(v) for v in values] + [prefix + OTHER]
    cells = [cell(of == F.lit(v)) for v in values] + [cell(~listed)]
    table = df.groupBy(row).agg(*[
        F.coalesce(c, F.lit(0)).alias(name) for name, c in zip(names, cells)])
    if row_total:
        total = sum((F.col(name) for name in names[1:]), F.col(names[0]))
        table = table.withColumn(row_total, total.cast(table.schema[names[0]].dataType))
    return table


def values_of(df: DataFrame, column: str) -> list:
    """The known values of a column of few values, in order: columns of a cross-tab."""
    found = [r[0] for r in df.select(column).where(F.col(column).isNotNull())
             .distinct().orderBy(column).limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"{column} has more than {MOST_COLUMNS} values: list those wanted")
    return found


def with_total_row(df: DataFrame, label: str, sums: list[str]) -> DataFrame:
    """Append a row labelled TOTAL with the sums of ``sums``, marked by ``is_total``.

    ``df`` holds one row per ``label``. Each of its rows is counted once for itself
    and once for the total, so whatever produced ``df`` runs only once. Columns
    outside ``sums`` are NULL in the total row; the sums keep their type.
    """
    types = {f.name: f.dataType for f in df.schema}
    is_total = F.col("is_total")
    columns = [F.sum(c).cast(types[c]).alias(c) if c in sums
               else F.max(F.when(~is_total, F.col(c))).alias(c)
               for c in df.columns if c != label]
    return (df.withColumn("is_total", F.explode(F.array(F.lit(False), F.lit(True))))
            .withColumn(label, F.when(is_total, F.lit(TOTAL)).otherwise(F.col(label)))
            .groupBy(label, "is_total").agg(*columns))
