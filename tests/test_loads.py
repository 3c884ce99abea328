"""Loads: constraints that act, keys and stored views that outlast a load, mergeable counts."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tillwise.operators import bitmaps, keys
from tillwise.plans import loading, stores

FOLDER = "/root/testdata/sf0.001"
ROWS = [(1, 1, "P1", 2, "2019-03-01"), (1, 1, "P1", 2, "2019-03-01"), (2, 2, "P2", 1, "2019-05-02"),
        (2, 9, "P1", 5, "2019-05-02"), (3, 9, "P3", 1, "2020-01-07"), (4, 3, "P9", 1, "2020-02-01"),
        (5, None, "P1", 1, "2020-02-02"), (None, 1, "P1", 1, None), (6, 2, None, 4, None)]


def test_accepted_and_rejected_rows_are_the_input(shop):
    t = shop.tables(ROWS, products=[("P1", "Toys", "1.00", 1, 7), ("P1", "Toys", "2.00", 1, 7),
                                    ("P2", "Toys", "3.00", 1, 8), ("P3", "Food", "4.00", 2, 8)])
    load = loading.enforce(t)
    found = load.rejected["transactional_data"].collect()
    assert sorted((r["orderID"] or 0, r["rule"], r["copies"]) for r in found) == [
        (0, "orderID is missing", 1), (1, "orderID is repeated", 1), (2, "orderID is repeated", 1),
        (3, "Customer_ID is unknown", 1), (4, "Product_ID is unknown", 1)]
    assert sorted(r["orderID"] for r in load.accepted.transactions.collect()) == [1, 2, 5, 6]
    counts = {r["table_name"]: r for r in loading.load_counts(t).collect()}
    assert all(r["given_rows"] == r["accepted_rows"] + r["rejected_rows"] for r in counts.values())
    assert counts["product_master"]["rejected_rows"] == 1
    assert counts["transactional_data"]["accepted_units"] == 2 + 1 + 1 + 4


def test_equal_rows_leave_one(spark):
    rows = spark.createDataFrame([(1, "a")] * 500 + [(1, "b"), (None, "c"), (None, "c")], "k int, v string")
    kept, rejected = keys.enforce_key(rows, "k")
    assert [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert sorted((r["v"], r["copies"]) for r in rejected.collect()) == [("a", 499), ("b", 1), ("c", 2)]


def test_known_members_keep_their_keys(spark, tmp_path):
    def load(values):
        rows = spark.createDataFrame([(v, 1) for v in values], "name string, more int")
        found = keys.extend_key_map(rows, str(tmp_path / "map"), "no", ["name"]).collect()
        return {r["name"]: r["no"] for r in found}
    first = load(["b", "a", None, "a"])
    assert sorted(first.values()) == [1, 2, 3]
    second = load(["z", "a", "y", None])
    assert {n: second[n] for n in first} == first and sorted(second.values()) == [1, 2, 3, 4, 5]
    assert load(["z", "a"]) == second and load([]) == second


def test_untouched_years_keep_their_files(shop, tmp_path, spark):
    folder = str(tmp_path / "quarters")
    t = shop.tables([r for r in ROWS if r[0]])
    early = F.coalesce(F.col("order_date") < F.lit("2020-01-10").cast("date"), F.lit(False))
    stores.store_load(t, folder, early)
    def files(year):
        return {f: os.path.getmtime(os.path.join(folder, f"sales_year={year}", f))
                for f in os.listdir(os.path.join(folder, f"sales_year={year}"))}
    before = files(2019), files(2020)
    stores.store_load(t, folder, ~early)
    assert files(2019) == before[0] and files(2020).keys() != before[1].keys()
    want = stores.store_quarters(t)
    got = stores.stored_quarters(spark, folder).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_words_add_up(spark):
    rows = [(g, i * 37 % 500 - 100, str(i % 7), i) for i in range(2000) for g in ("a", None)]
    rows += [("a", None, None, 5), ("b", None, None, 1)]
    lines = spark.createDataFrame(rows, "g string, id long, label string, n int")
    ids = {"ids": F.col("id"), "labels": F.col("label")}
    halves = [bitmaps.states(lines.where(c), ["g"], ids, {"n": F.col("n")}) for c in ("n % 2 = 0", "n % 2 <> 0")]
    both = bitmaps.merged(halves[0].union(halves[1]), ["g"], ["n"])
    got = bitmaps.counted(both, ["g"], ["ids", "labels"], ["n"])
    want = lines.groupBy("g").agg(F.count_distinct("id").alias("ids"),
                                  F.count_distinct("label").alias("labels"), F.sum("n").alias("n"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("name", ["q02_by_gender", "q05_top10_occ", "q05_diversity", "q08_city_summary",
                                  "q17_store_summary", "q17_rollup"])
def test_lines_are_not_copied_for_distinct_counts(spark, name):
    frame = registry.queries()[name](spark, FOLDER)
    assert "Expand" not in frame._jdf.queryExecution().toString()


def test_a_cross_tab_of_too_many_columns_is_refused(spark):
    from tillwise.operators.crosstab import MOST_COLUMNS, values_of
    assert values_of(spark.range(MOST_COLUMNS), "id") == list(range(MOST_COLUMNS))
    with pytest.raises(ValueError, match="more than"):
        values_of(spark.range(MOST_COLUMNS + 1), "id")
