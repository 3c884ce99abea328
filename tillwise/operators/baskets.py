"""Items bought together: exact top pairs, one way for baskets of every size.

A pair cannot count more than what either of its items can reach: the sum over the item's
baskets of its weight times the heaviest weight there. Let ``floor`` be the k-th best
count among pairs of the ``PILOT`` items that reach most: k pairs have it, so an item that
reaches less is in none of the first k pairs. The items left are paired, basket by basket.

That search pays for itself where baskets are large. Where all pairs together are at most ``CHEAP`` times the
lines, they are counted at once; the result is the same.

Pairs of two items that are in at least one of ``SHARE`` baskets are counted from vertical bitmaps: an item is a
word of bits for each 64 baskets, and a pair's count is the number of bits in the AND of two words. Weights
are split into binary digits, a word for each. An average basket holds at least a ``SHARE``-th of these items, so
64 baskets would make at least as many pairs as their one word does.

All other pairs meet basket by basket. A basket is dealt into blocks of about ``block`` items by a hash, and each
two of its blocks meet in a group of their own. So no task holds a basket whole, and a group makes at most
``2 * block ** 2`` pairs of its ``2 * block`` rows however large the basket is.

What remains is the number of those pairs: large baskets of rarer items that all reach the floor
are paired in full, and their pairs grow with the square of their size. A higher ``at_least``
raises the floor.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.session import written

BLOCK = 128
PILOT = 64
CHEAP = 8
SHARE = 8
BUCKET = 4096  # baskets whose bits are numbered together
TASK_PAIRS = 1_000_000  # pairs that a task makes, on average
MOST_TASKS = 20_000


def basket_lines(df: DataFrame, basket: list[str], item: str) -> DataFrame:
    """``(basket, item)`` rows with both known."""
    return (df.dropna(subset=[*basket, item])
            .select(F.struct(*basket).alias("basket"), F.col(item).alias("item")))


def top_pairs(lines: DataFrame, k: int, weighted: bool = False, at_least: int = 1,
              block: int = BLOCK, pilot: int = PILOT) -> DataFrame:
    """The ``k`` pairs with the highest count (then by item), ``item_1 < item_2``.

    The count is the number of baskets, or of line pairs when ``weighted``.
    """
    held = written(_weigh(lines, weighted), "basket-items")
    baskets, pairs, size = (held.groupBy("basket").agg(F.count("*").cast("double").alias("n")).agg(
        F.count("*"), F.coalesce(F.sum(F.col("n") * (F.col("n") - 1) / 2), F.lit(0.0)),
        F.coalesce(F.sum("n"), F.lit(0.0))).first())
    common = written(held.groupBy("item").agg(F.count("*").alias("n"))
                     .where(F.col("n") * SHARE >= baskets).select("item"), "common-items")
    # the pairs of a task are many for the bytes it reads, so their number says how many tasks there are
    tasks = int(min(max(pairs / TASK_PAIRS, lines.sparkSession.sparkContext.defaultParallelism), MOST_TASKS))
    if pairs > CHEAP * size:
        reach = written(_reach(held, weighted), "item-reach")
        leaders = reach.orderBy(F.desc("reach"), "item").limit(pilot).select("item")
        best = (_count_pairs(held.join(leaders, "item", "left_semi"), common, baskets, block, tasks)
                .orderBy(F.desc("times")).limit(k))
        floor = best.agg(F.when(F.count("*") == k, F.min("times")).alias("kth")).scalar()
        hopeful = reach.where(F.col("reach") >= F.greatest(floor, F.lit(at_least))).select("item")
        held = held.join(hopeful, "item", "left_semi")
    return (_count_pairs(held, common, baskets, block, tasks).where(F.col("times") >= at_least)
            .orderBy(F.desc("times"), "item_1", "item_2").limit(k))


def _weigh(lines: DataFrame, weighted: bool) -> DataFrame:
    """One row per basket and item; the weight is its number of lines, or 1."""
    weight = F.count("*") if weighted else F.lit(1).cast("bigint")
    return lines.groupBy("basket", "item").agg(weight.alias("weight"))


def _reach(held: DataFrame, weighted: bool) -> DataFrame:
    """The most a pair with the item can count."""
    if not weighted:
        return held.groupBy("item").agg(F.count("*").alias("reach"))
    heaviest = held.groupBy("basket").agg(F.max("weight").alias("heaviest"))
    return (held.join(heaviest, "basket").groupBy("item")
            .agg(F.sum(F.col("weight") * F.col("heaviest")).alias("reach")))


def _count_pairs(held: DataFrame, common: DataFrame, baskets: int, block: int,
                 tasks: int) -> DataFrame:
    """Counts of all pairs of ``held`` (basket, item, weight); ``common`` are the items to take as bitmaps."""
    marked = held.join(common.withColumn("common", F.lit(True)), "item", "left").withColumn(
        "common", F.coalesce("common", F.lit(False)))
    if common.isEmpty():
        return _pairs_by_basket(marked, block, tasks)
    by_word = _pairs_by_word(marked.where("common"), baskets)
    if held.join(common, "item", "left_anti").isEmpty():
        return by_word
    return by_word.unionByName(_pairs_by_basket(marked, block, tasks))


def _pairs_by_word(held: DataFrame, baskets: int) -> DataFrame:
    """Counts of all pairs, from words of 64 baskets."""
    bucket = F.pmod(F.xxhash64("basket"), F.lit(baskets // BUCKET + 1)).alias("bucket")
    place = F.dense_rank().over(W.partitionBy("bucket").orderBy("basket")) - 1
    digits = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda d: F.call_function(
        "shiftright", F.col("weight"), d).bitwiseAND(1) == 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(63))
    words = (held.select(bucket, "basket", "item", "weight").withColumn("place", place)
             .select("bucket", F.shiftright("place", 6).alias("nth"), "item", bit.alias("bit"),
                     F.explode(digits).alias("digit"))
             .groupBy("bucket", "nth", "item", "digit").agg(F.bit_or("bit").alias("word")))
    groups = words.groupBy("bucket", "nth").agg(
        F.sort_array(F.collect_list(F.struct("item", "digit", "word"))).alias("items"))
    firsts = groups.select("items", F.posexplode("items").alias("at", "a"))
    met = firsts.select("a", F.explode(F.slice("items", F.col("at") + 2, F.size("items"))).alias("b"))
    both = F.bit_count(F.col("a.word").bitwiseAND(F.col("b.word"))).cast("bigint")
    times = F.call_function("shiftleft", both, F.col("a.digit") + F.col("b.digit"))
    return (met.where("a.item < b.item")
            .groupBy(F.col("a.item").alias("item_1"), F.col("b.item").alias("item_2"))
            .agg(F.sum(times).alias("times")).where("times > 0"))


def _pairs_by_basket(held: DataFrame, block: int, tasks: int | None = None) -> DataFrame:
    """Counts of all pairs but those of two ``common`` items, basket by basket, made in ``tasks`` tasks."""
    blocks = held.groupBy("basket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    dealt = (held.join(blocks, "basket").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    dealt = dealt.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    groups = (dealt.repartition(*filter(None, [tasks]), "basket", "low", "high").groupBy("basket", "low", "high")
              .agg(F.sort_array(F.collect_list(F.struct("common", "item", "weight", "own"))).alias("items")))
    # common items come last, so those that are not have all their partners after them
    firsts = groups.where(F.size("items") > 1).select(
        "low", "high", "items", F.posexplode("items").alias("at", "a")).where("NOT a.common")
    later = F.slice("items", F.col("at") + 2, F.size("items"))
    pairs = firsts.select("low", "high", "a", F.explode(later).alias("b"))
    # two items of one block meet in the block's own group only
    met = pairs.where((F.col("low") == F.col("high")) | (F.col("a.own") != F.col("b.own")))
    first, second = F.least("a.item", "b.item"), F.greatest("a.item", "b.item")
    return (met.groupBy(first.alias("item_1"), second.alias("item_2"))
            .agg(F.sum(F.col("a.weight") * F.col("b.weight")).alias("times")))
