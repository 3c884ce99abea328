"""Surrogate keys and key checks."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY_BUCKETS = 1024


def with_surrogate_key(rows: DataFrame, key: str, natural: list[str],
                       buckets: int = KEY_BUCKETS) -> DataFrame:
    """Number distinct rows 1..n without sending them through one task.

    Rows fall into hash buckets, are numbered inside their bucket, and each bucket
    starts where the ones before it end. Only the bucket sizes (at most
    ``buckets`` rows) meet in one place. Everything depends on the data alone, so
    a recomputed task assigns the same numbers. ``natural`` must identify a row.
    """
    bucketed = rows.withColumn(
        "_bucket", F.pmod(F.xxhash64(*natural), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_bucket"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(W.partitionBy("_bucket").orderBy(*natural))
    return (bucketed.withColumn("_number", within)
            .join(starts, "_bucket")
            .withColumn(key, F.col("_start") + F.col("_number"))
            .select(key, *rows.columns))


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """Keys that occur more than once, which a primary key would reject."""
    return (df.groupBy(key).agg(F.count("*").alias("copies"))
            .where("copies > 1")
            .select(F.lit(table).alias("table_name"),
                    F.col(key).cast("string").alias("key_value"), "copies"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` without a parent; a NULL key is not a violation."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        df.agg(F.count("*").alias("row_count"))
          .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()])


def any_missing(*columns: str) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


# --- keys that outlast a load ---

def extend_key_map(rows: DataFrame, folder: str, key: str, natural: list[str]) -> DataFrame:
    """The key map stored under ``folder`` after the members in ``rows`` have joined it.

    Members that have a key keep it; new ones are numbered after the highest key given so far. A
    member is its ``natural`` columns (nulls are equal). Only the new members are written, so the
    map grows by appending, and a load that runs again adds nothing.
    """
    spark = rows.sparkSession
    members = rows.select(*natural).distinct()
    empty = spark.createDataFrame([], members.schema).select(F.lit(0).cast("bigint").alias(key), "*")
    empty.limit(0).write.mode("ignore").parquet(f"{folder}/load=0")
    known = read_key_map(spark, folder)
    same = reduce(Column.__and__, [members[c].eqNullSafe(known[c]) for c in natural])
    new = members.join(known, same, "left_anti")
    last = known.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    loads = known.agg(F.coalesce(F.max("load"), F.lit(0))).first()[0]
    numbered = with_surrogate_key(new, key, natural).withColumn(key, F.col(key) + F.lit(last))
    numbered.write.mode("overwrite").parquet(f"{folder}/load={loads + 1}")
    return read_key_map(spark, folder).drop("load")


def read_key_map(spark, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(f"{folder}/load=*")


# --- constraints that act at load ---

def enforce_key(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a ``key`` that is unique and known, and the rejected rows with their ``rule`` and number
    (``copies``). Of several rows with one key the first in the order of all columns stays.

    Equal rows are counted and the first row is a minimum, both inside the tasks first, so a key
    that holds a third of all rows is not gathered anywhere.
    """
    columns = rows.columns
    distinct = rows.groupBy(*columns).agg(F.count("*").alias("copies"))
    ordered = F.struct(*columns)
    first = (distinct.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
             .agg(F.min(ordered).alias("_first")))
    met = distinct.join(first, F.col(key) == F.col("_key"), "left")
    stays = F.coalesce(ordered.eqNullSafe(F.col("_first")), F.lit(False)) & F.col("_key").isNotNull()
    rule = F.when(F.col(key).isNull(), f"{key} is missing").otherwise(f"{key} is repeated")
    rejected = (met.withColumn("copies", F.col("copies") - F.when(stays, 1).otherwise(0))
                .where("copies > 0").select(*columns, rule.alias("rule"), "copies"))
    return first.select("_first.*"), rejected


def enforce_parent(rows: DataFrame, parent: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` is null or one of ``parent``, and the others with their rule."""
    known = parent.select(F.col(key).alias("_parent")).distinct()
    met = rows.join(known, F.col(key) == F.col("_parent"), "left")
    fits = F.col(key).isNull() | F.col("_parent").isNotNull()
    return (met.where(fits).select(*rows.columns),
            met.where(~fits).select(*rows.columns, F.lit(f"{key} is unknown").alias("rule"),
                                    F.lit(1).cast("bigint").alias("copies")))
