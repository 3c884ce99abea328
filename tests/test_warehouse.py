from decimal import Decimal as D

from pyspark.sql import functions as F

from tillwise.operators.keys import with_surrogate_key
from tillwise.plans import star, warehouse
from tillwise.tables import RetailTables


def rows(df):
    return [tuple(r) for r in df.collect()]


LINES = [(1, 1, "P1", 2, "2020-01-04"), (2, 2, "P3", 4, "2020-01-06"), (3, 2, "P1", 1, None)]


def test_surrogate_keys_are_dense_and_repeatable(spark):
    people = spark.range(5000).select((F.col("id") * 7).alias("id"), F.lit("x").alias("name"))
    keyed = with_surrogate_key(people, "key", ["id", "name"], buckets=16)
    again = with_surrogate_key(people.repartition(13), "key", ["id", "name"], buckets=16)
    assert sorted(r.key for r in keyed.collect()) == list(range(1, 5001))
    assert sorted(rows(keyed)) == sorted(rows(again))


def test_missing_date_is_in_neither_dimension_nor_fact(shop, tmp_path):
    w = warehouse.build(shop.tables(LINES), str(tmp_path))
    assert sorted(r.weekday_flag for r in w.dim_date.collect()) == ["Weekday", "Weekend"]
    assert sorted(rows(warehouse.fact_resolved(w).select("product_id", "revenue"))) == [
        ("P1", D("20.00")), ("P3", D("10.00"))]


def test_duplicate_product_multiplies_facts_and_is_reported(shop, tmp_path):
    products = [("P1", "Toys", "10.00", 1, 7), ("P1", "Toys", "12.00", 1, 7)]
    t = shop.tables([(1, 1, "P1", 1, "2020-01-04")], products=products)
    w = warehouse.build(t, str(tmp_path))
    assert w.dim_product.count() == 2
    # two staging rows times two product rows
    assert sorted(r.revenue for r in w.fact_sales.collect()) == [
        D("10.00"), D("10.00"), D("12.00"), D("12.00")]
    assert rows(warehouse.duplicates(t)) == [("product_master", "P1", 2)]


def test_orphans_are_counted_and_dropped(shop, tmp_path):
    t = shop.tables([(1, 99, "P1", 1, "2020-01-04"), (2, 1, "P9", 1, "2020-01-04"),
                     (3, None, "P1", 1, "2020-01-04"), (4, 1, "P1", 1, "2020-01-04")])
    assert sorted(rows(warehouse.orphan_counts(t))) == [
        ("customer_master", 1), ("product_master", 1)]
    assert warehouse.build(t, str(tmp_path)).fact_sales.count() == 1


def test_fact_keys_do_not_depend_on_partitions_or_joins(shop, tmp_path, spark):
    lines = [(i % 50, i % 4 + 1, "P1", 1 + i % 3, "2020-01-04") for i in range(400)] * 2
    t = shop.tables(lines)
    first = warehouse.build(t, str(tmp_path / "a")).fact_sales
    before = {k: spark.conf.get(k, None) for k in (
        "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        again = RetailTables(t.customers, t.products, t.transactions.repartition(7))
        second = warehouse.build(again, str(tmp_path / "b")).fact_sales
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert sorted(map(str, rows(first))) == sorted(map(str, rows(second.select(*first.columns))))
    assert first.select("sales_key").distinct().count() == first.count() == 800


def test_key_report_and_view(shop, tmp_path, spark):
    w = warehouse.build(shop.tables(LINES), str(tmp_path))
    report = {r.table_name: r for r in warehouse.key_report(w).collect()}
    assert (report["dim_customer"].first_key, report["dim_customer"].last_key) == (1, 4)
    assert report["fact_sales"].distinct_keys == report["fact_sales"].row_count == 2
    star.create_quarterly_view(w, "star_quarters")
    assert spark.table("star_quarters").count() == 2


def test_year_prunes_fact_folders(shop, tmp_path):
    w = warehouse.build(shop.tables(LINES), str(tmp_path))
    plan = star.quarter_gender_age(w, 2020)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sale_year" in plan


def test_products_listed_at_two_prices_are_one_product_in_the_star_reports(spark, shop, tmp_path):
    goods = [("P1", "Toys", "10.00", 1, 7), ("P1", "Toys", "30.00", 1, 7), ("P1", None, "1.00", 1, 7),
             ("P2", "Toys", "39.00", 1, 8)]
    lines = [(1, 1, "P1", 1, "2016-01-04"), (2, 1, "P2", 1, "2016-01-05"), (3, 2, "P1", 1, "2016-02-02"),
             (3, 2, "P1", 1, "2016-02-02")]
    # each line meets the three rows of P1 once for each of them
    w = warehouse.build(shop.tables(lines, products=goods), str(tmp_path))
    best = [tuple(r) for r in star.top_products(w, 3).collect()]
    assert best == [(2016, 2, "Weekday", "P1", "Toys", D("240.00")),
                    (2016, 1, "Weekday", "P1", "Toys", D("120.00")),
                    (2016, 1, "Weekday", "P2", "Toys", D("39.00"))]
    assert [tuple(r) for r in star.top_products_of_year(w, 2016, 2).collect()] == [r[1:] for r in best[:2]]
    assert [(r.product_id, r.product_category, r.season, r.total_sales)
            for r in star.product_month_season(w).collect() if r.product_category] == [
        ("P1", "Toys", "Winter", D("120.00")), ("P1", "Toys", "Winter", D("240.00")),
        ("P2", "Toys", "Winter", D("39.00"))]
    assert [(r.product_id, r.total_sales, r.avg_daily_sales) for r in star.daily_flag(w).collect()] == [
        ("P1", D("369.00"), D("184.500")), ("P2", D("39.00"), D("39.000"))]


def test_numbering_and_writing_the_fact_share_a_shuffle(spark, shop, tmp_path):
    t = shop.tables([(1, 1, "P1", 1, "2016-01-04"), (1, 1, "P1", 1, "2017-01-04")])
    dims = warehouse.dimensions(t)
    plan = warehouse.with_sales_key(warehouse.fact_rows(t, dims))._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" not in plan and "RepartitionByExpression [sale_year" in plan
    w = warehouse.build(t, str(tmp_path))
    assert w.fact_sales.select("sales_key").distinct().count() == 2


def test_star_reports_do_not_add_up_lines_under_names(spark, shop, tmp_path):
    w = warehouse.build(shop.tables([(1, 1, "P1", 1, "2016-01-04")]), str(tmp_path))
    for report in (star.top_products, star.top_products_of_year, star.product_month_season, star.daily_flag):
        plan = report(w)._jdf.queryExecution().optimizedPlan().toString()
        sums = [line for line in plan.split("\n") if "Aggregate [" in line and "sum(" in line]
        assert sums and not any("product_id" in line for line in sums)
