"""Top pairs against brute force, with baskets too large to enumerate."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillwise.operators.baskets import basket_lines, top_pairs


def brute_force(lines, k, weighted, at_least):
    baskets = {}
    for basket, item in lines:
        baskets.setdefault(basket, Counter())[item] += 1
    times = Counter()
    for items in baskets.values():
        for a, b in combinations(sorted(items), 2):
            times[a, b] += items[a] * items[b] if weighted else 1
    kept = [(a, b, n) for (a, b), n in times.items() if n >= at_least]
    return sorted(kept, key=lambda r: (-r[2], r[0], r[1]))[:k]


def lines_of(sizes, items, seed):
    chance = random.Random(seed)
    return [(basket, f"P{chance.randrange(items):03d}")
            for basket, size in enumerate(sizes) for _ in range(size)]


ORDINARY = [1, 2, 3, 4, 5] * 8
CASES = {
    "no large basket": lines_of(ORDINARY, 30, 1),
    "large among frequent pairs": lines_of(ORDINARY + [30, 40], 25, 2),
    "large among rare pairs": lines_of(ORDINARY + [40, 60, 80], 400, 3),
    "only large": lines_of([50, 60, 70], 100, 4),
    "one basket holds a third of the lines": lines_of(ORDINARY + [sum(ORDINARY) // 2], 200, 5),
    "many different large baskets": lines_of(ORDINARY + [60] * 24, 120, 6),
    "a few common items": lines_of([2, 3, 6] * 90, 6, 8) + lines_of([2, 1, 3] * 90, 60, 9),
    "only common items": lines_of([2, 3, 6, 9] * 60, 5, 10),
    "identical large baskets": [(b, f"P{i:03d}") for b in range(3) for i in range(60)],
}


@pytest.mark.parametrize("weighted,at_least", [(False, 1), (False, 2), (True, 1)])
@pytest.mark.parametrize("case", CASES)
def test_top_pairs(spark, case, weighted, at_least):
    lines = CASES[case]
    df = spark.createDataFrame(lines, "basket int, product string")
    got = top_pairs(basket_lines(df, ["basket"], "product"), 10, weighted, at_least,
                    block=9, pilot=12)
    assert [tuple(r) for r in got.collect()] == brute_force(lines, 10, weighted, at_least)


def test_unknown_basket_or_item_is_left_out(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (None, "A"), (None, "B")], "b int, p string")
    assert top_pairs(basket_lines(df, ["b"], "p"), 5).count() == 0


def test_bitmaps_over_several_buckets_and_digits(spark, monkeypatch):
    """Common items with many lines in a basket, and the search for a floor, at every size."""
    from tillwise.operators import baskets
    lines = [(b, f"P{i}") for b in range(300) for i in range(5) for _ in range((b * (i + 3)) % 7)]
    lines += lines_of([4] * 200, 50, 11)
    df = spark.createDataFrame(lines, "basket int, product string")
    monkeypatch.setattr(baskets, "BUCKET", 70)
    for cheap in (0, 1000):
        monkeypatch.setattr(baskets, "CHEAP", cheap)
        for weighted in (False, True):
            got = top_pairs(basket_lines(df, ["basket"], "product"), 12, weighted, pilot=3)
            assert [tuple(r) for r in got.collect()] == brute_force(lines, 12, weighted, 1)


def test_one_plan_for_all_sizes(spark):
    """The plan does not look at the sizes of baskets."""
    from tillwise.operators import baskets
    plans = []
    for sizes in (ORDINARY, ORDINARY + [500]):
        df = spark.createDataFrame(lines_of(sizes, 600, 7), "basket int, product string")
        lines = basket_lines(df, ["basket"], "product")
        held = baskets._weigh(lines, False)
        text = baskets._pairs_by_basket(held.withColumn("common", F.lit(False)), 16)._jdf.queryExecution().optimizedPlan().toString()
        plans.append([line.strip(" +-:").split(" ")[0] for line in text.split("\n")])
    assert plans[0] == plans[1]


def test_tasks_follow_the_pairs_and_not_the_bytes(spark, monkeypatch):
    from tillwise.operators import baskets

    monkeypatch.setattr(baskets, "TASK_PAIRS", 100)
    lines = spark.range(4000).select(F.struct((F.col("id") % 1000).alias("b")).alias("basket"),
                                     F.concat(F.lit("i"), F.col("id") % 997).alias("item"))
    top = baskets.top_pairs(lines, 5)
    # 1,000 baskets of four items
    assert "RepartitionByExpression [basket" in (plan := top._jdf.queryExecution().optimizedPlan().toString())
    assert "], 60" in plan
