"""Shape of physical plans: what is read, what is shuffled, what is broadcast."""

import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = registry.queries()


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString().split(
        "== Physical Plan ==")[1]


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "qdx"])
def test_no_report_joins_without_a_key(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


@pytest.mark.parametrize("name", [
    "q01_month_daytype_top5", "q05_top5_occ_per_category", "q13_top3_suppliers", "q14_best_season", "q20_best_quarter"])
def test_ranking_is_limited_before_the_shuffle(spark, name):
    assert plan(spark, name).count("WindowGroupLimit") == 2  # Partial and Final


@pytest.mark.parametrize("name", ["q03_top10_occ_category", "q19_spike_frequency", "x01_top_customers"])
def test_top_lists_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


@pytest.mark.parametrize("name", ["q04_gender_age_quarter", "q12_store_qoq", "q18_h1_h2"])
def test_year_prunes_folders_and_row_groups(spark, name):
    text = plan(spark, name)
    assert "PartitionFilters: [isnotnull(order_year" in text
    assert "GreaterThanOrEqual(order_date,2000-01-01)" in text


def test_scan_reads_only_used_columns(spark):
    text = plan(spark, "q02_gender_city_pivot")
    assert "ReadSchema: struct<Customer_ID:bigint,Product_ID:string,quantity:int>" in text
    assert "ReadSchema: struct<Customer_ID:bigint,Gender:string,City_Category:string>" in text


def test_hot_customer_is_split_when_masters_are_too_large_to_broadcast(spark, shop, tmp_path):
    from pyspark.sql import functions as F

    from tillwise.plans import shoppers
    from tillwise.sources import files
    from tillwise.tables import RetailTables

    # a third of 300,000 lines belongs to customer 1
    lines = spark.range(0, 300_000, 1, 8).select(
        F.lit(None).cast("bigint").alias("row_index"), F.col("id").alias("orderID"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 997 + 2).alias("Customer_ID"),
        F.concat(F.lit("P"), F.col("id") % 50).alias("Product_ID"),
        F.lit(1).alias("quantity"), F.lit("2020-01-06").cast("date").alias("order_date"))
    people = [(i, "F" if i % 2 else "M", "55+", 1, "A", "1", 0) for i in range(1, 1000)]
    goods = [(f"P{i}", "Toys", "1.00", 1, 7) for i in range(50)]
    tables = RetailTables(shop.customers(people), shop.products(goods), lines)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB"}
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        staged = files.write_staging(tables, str(tmp_path))
        report = shoppers.gender_by_city(staged, cities=["A"])
        got = {r.Gender: int(r.total_purchase) for r in report.collect()}
        assert "skew=true" in report._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    women = sum(1 for i in range(300_000) if i % 3 == 0 or (i % 997 + 2) % 2)
    assert got == {"F": women, "M": 300_000 - women}


@pytest.mark.parametrize("name", ["d01_top5_products", "d05_top5_occ_category", "d13_store_supplier_category",
                                  "d17_rollup", "d19_daily_flag"])
def test_the_fact_is_added_up_before_it_meets_a_dimension(spark, name):
    lines = QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if "Relation" in line and "product_key" in line
              and "revenue" in line)
    above = next(line for line in reversed(lines[:at]) if "Join " in line or "Aggregate " in line)
    assert "Aggregate " in above


def test_late_lines_are_marked_by_their_batch(spark):
    text = plan(spark, "s09_late_customers")
    assert "transaction_id" not in text and "batch_id" in text
