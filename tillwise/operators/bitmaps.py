"""Exact distinct counts as bitmaps that can be added up.

A whole number is a bit in a word of 64: ``id >> 6`` says which word, ``id & 63`` which bit. A word of one
group is the OR of its lines' bits, which partial aggregation makes before the shuffle, so what is
shuffled is one row for up to 64 neighbouring ids of a group, not one for each id. Dense ids fill
their words; ids far apart cost a row each, as a plain distinct count would, and so do ids that are
no whole numbers (``label``). Words are a state: OR of two groups' words is the word of both groups together, so totals, subtotals and later
days follow from stored states without the lines.

Each count (``kind``) is a pass of its own over the columns it needs, and the first also adds up the sums; so
no line is copied. What comes out of a pass is small, and the passes meet there.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE = ["kind", "bucket", "label"]


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(63).cast("int"))


def states(lines: DataFrame, keys: list[str], ids: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """``keys``, kind, bucket, label, word and the ``sums`` (whole numbers) of each group. A missing id
    counts nowhere, its line's sums are kept."""
    kinds = lines.select(*[c.alias(name) for name, c in ids.items()]).schema
    parts = []
    for kind, (name, value) in enumerate(ids.items()):
        whole = isinstance(kinds[name].dataType, T.IntegralType)
        number = value.cast("bigint") if whole else F.lit(0).cast("bigint")
        word = _bit(number) if whole else F.when(value.isNotNull(), F.lit(1).cast("bigint"))
        added = [F.sum(v.cast("bigint") if kind == 0 else F.lit(None).cast("bigint")).alias(n)
                 for n, v in sums.items()]
        label = F.lit(None) if whole else value
        parts.append(lines.groupBy(*keys, F.shiftright(number, 6).alias("bucket"),
                                   label.cast("string").alias("label"))
                     .agg(F.bit_or(word).alias("word"), *added)
                     .select(*keys, F.lit(kind).alias("kind"), "bucket", "label", "word", *sums))
    return reduce(DataFrame.union, parts)


def merged(found: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """States of coarser groups, from lines or from states of finer ones."""
    return found.groupBy(*keys, *STATE).agg(
        F.bit_or("word").alias("word"), *[F.sum(name).alias(name) for name in sums])


def counted(found: DataFrame, keys: list[str], ids: list[str], sums: list[str]) -> DataFrame:
    """One row per group: its distinct counts, named like ``ids``, and its sums."""
    return found.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bit_count("word"))), F.lit(0))
          .cast("bigint").alias(name) for kind, name in enumerate(ids)],
        *[F.sum(name).alias(name) for name in sums])


def rolled_up(found: DataFrame, keys: list[str], ids: list[str], sums: list[str]) -> DataFrame:
    """Counts and sums at every level of ``keys``, from the states of the finest one: each level's states
    are merged from those of the level below. ``depth`` is how many keys, from the last, are added
    up; those are null."""
    levels = []
    for depth in range(len(keys) + 1):
        kept = keys[:len(keys) - depth]
        if depth:
            found = merged(found, kept, sums)
        row = counted(found, kept, ids, sums)
        nulls = [F.lit(None).cast("string").alias(k) for k in keys[len(kept):]]
        levels.append(row.select(*kept, *nulls, F.lit(depth).alias("depth"), *ids, *sums))
    return reduce(DataFrame.unionByName, levels)
