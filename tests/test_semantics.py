"""Edge cases of the reports on hand-made tables."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions import labels
from tillwise.plans import affinity, assortment, shoppers, spikes, star, stores, trends, warehouse


def rows(df):
    return [tuple(r) for r in df.collect()]


def build(shop, tmp_path, lines, **kw):
    return warehouse.build(shop.tables(lines, **kw), str(tmp_path))


GAP = [(1, 1, "P1", 1, "2020-01-05"), (2, 1, "P1", 2, "2020-02-05"), (3, 1, "P1", 3, "2020-04-05")]


def test_growth_compares_with_previous_existing_month(shop):
    got = rows(trends.category_month_growth(shop.tables(GAP), 2020).select(
        "month_year", "prev_month", "growth_pct", "trend"))
    assert got == [("2020-01", None, None, "-"), ("2020-02", "2020-01", 100.0, "UP"),
                   ("2020-04", "2020-02", 50.0, "UP")]


def test_star_growth_compares_with_calendar_month(shop, tmp_path):
    w = build(shop, tmp_path, GAP)
    got = rows(star.category_month_growth(w, 2020).select("month", "previous_sales"))
    assert got == [(1, None), (2, D("10.00")), (4, None)]
    got = rows(star.store_supplier_growth(w).select("month", "prev_month", "difference"))
    assert got == [(1, None, None), (2, 1, D("10.00")), (4, None, None)]


def test_zero_predecessor_gives_null_not_an_error(shop, tmp_path):
    lines = [(1, 1, "P1", 0, "2020-01-05"), (2, 1, "P1", 2, "2020-02-05")]
    t = shop.tables(lines)
    assert [r.growth_pct for r in trends.category_month_growth(t, 2020).collect()] == [None, None]
    mean = trends.category_mean_growth(t, 2020).first()
    assert (mean.months_analyzed, mean.avg_growth_pct, mean.performance) == (2, None, "-")
    w = build(shop, tmp_path, lines)
    assert [r.growth_percentage for r in star.category_month_growth(w, 2020).collect()] == [None, None]


def test_equal_revenue_is_ranked_by_product(shop):
    products = [(f"P{i}", "Toys", "5.00", 1, 7) for i in range(8)]
    lines = [(i, 1, f"P{i}", 1, "2020-01-06") for i in range(8)]
    got = assortment.top_by_month_day_type(shop.tables(lines, products=products), 2020)
    assert [(r.Product_ID, r.rnk) for r in got.collect()] == [(f"P{i}", i + 1) for i in range(5)]


def test_unknown_marital_status_reads_differently_in_both_schemas(shop, tmp_path):
    lines = [(i, i, "P1", 1, "2020-05-05") for i in (1, 2, 3, 4)]
    summary = shoppers.city_marital_summary(shop.tables(lines))
    # NULL and 2 both read "Married" but stay separate rows
    assert [(r.City_Category, r.marital_status) for r in summary.collect()] == [
        ("A", "Single"), ("B", "Married"), ("B", "Married"), ("C", "Married")]
    dim = build(shop, tmp_path, lines).dim_customer
    assert {r.customer_id: r.marital_status for r in dim.collect()} == {
        1: "Single", 2: "Married", 3: "Single", 4: "Single"}


def test_six_months_are_a_strict_clamped_bound(shop):
    lines = [(1, 1, "P1", 1, "2020-02-29"), (2, 1, "P1", 1, "2020-03-01"),
             (3, 1, "P1", 1, "2020-08-31")]
    got = rows(shoppers.city_marital_monthly(shop.tables(lines)).select("month_year"))
    assert got == [("2020-03",), ("2020-08",)]


def test_city_pivot_has_total_row_and_shares(shop):
    lines = [(1, 1, "P1", 3, "2020-05-05"), (2, 2, "P1", 1, "2020-05-06")]
    got = rows(shoppers.city_by_marital(shop.tables(lines)))
    assert got == [("A", D("30.00"), D("0.00"), D("30.00"), 100.0, 0.0),
                   ("C", D("0.00"), D("10.00"), D("10.00"), 0.0, 100.0),
                   ("TOTAL", D("30.00"), D("10.00"), D("40.00"), 75.0, 25.0)]


def test_missing_year_means_latest(shop):
    lines = [(1, 1, "P1", 1, "2018-05-05"), (2, 1, "P2", 1, "2019-05-06")]
    got = assortment.top_by_day_type(shop.tables(lines)).collect()
    assert [r.Product_ID for r in got] == ["P2"]


def test_store_growth_prefers_its_year(shop):
    lines = [(1, 1, "P1", 1, "2017-02-05"), (2, 1, "P1", 3, "2017-05-05"),
             (3, 1, "P1", 1, "2019-05-06")]
    got = rows(trends.store_quarter_growth(shop.tables(lines)).select(
        "quarter_label", "prev_quarter", "growth_rate_pct", "trend"))
    assert got == [("Q1", None, None, "Baseline"), ("Q2", "Q1", 200.0, "Strong")]
    later = trends.store_quarter_growth(shop.tables(lines[2:]))
    assert rows(later.select("quarter_label", "total_orders")) == [("Q2", 1)]


def test_two_names_of_a_store_stay_apart_in_the_view(shop):
    products = [("P1", "Toys", "10.00", 1, 7), ("P9", "Toys", "1.00", None, 7)]
    lines = [(1, 1, "P1", 1, "2020-02-05"), (2, 1, "P9", 1, "2020-02-05")]
    got = rows(stores.store_quarters(shop.tables(lines, products=products)).select(
        "storeName", "year_quarter", "total_sales"))
    assert got == [(None, "2020-Q1", D("1.00")), ("Store 1", "2020-Q1", D("10.00"))]


def test_rollup_tells_subtotals_from_missing_names(shop):
    products = [("P1", "Toys", "10.00", 1, 7), ("P9", "Toys", "1.00", None, 7)]
    lines = [(1, 1, "P1", 1, "2020-02-05"), (2, 1, "P9", 1, "2020-02-05"),
             (2, 1, "P1", 1, "2020-02-06")]
    got = rows(stores.yearly_rollup(shop.tables(lines, products=products), 2020).select(
        "storeName", "level", "total_revenue", "total_orders"))
    assert (None, "store", D("1.00"), 1) in got and got[-1] == (None, "all", D("21.00"), 2)
    assert sum(r[1] == "product" for r in got) == 2 and len(got) == 7


def test_supplier_subtotals(shop):
    lines = [(1, 1, "P1", 1, "2020-02-05"), (2, 1, "P2", 1, "2020-02-05")]
    got = rows(stores.supplier_subtotals(shop.tables(lines)).select(
        "storeName", "supplierName", "level", "total_sales"))
    assert got == [("Store 1", "Supplier 7", "supplier", D("10.00")),
                   ("Store 1", "Supplier 8", "supplier", D("20.00")),
                   ("Store 1", None, "store", D("30.00"))]


def test_materialised_quarters_equal_the_view(shop, tmp_path):
    t = shop.tables(GAP)
    stored = stores.materialise_quarters(t, str(tmp_path / "quarters"))
    assert sorted(rows(stored)) == sorted(rows(stores.store_quarters(t)))
    stores.create_quarterly_view(t)
    spark = t.transactions.sparkSession
    assert spark.table(stores.QUARTERLY_VIEW).count() == stored.count()


def test_spikes_need_five_days_and_strict_multiples(shop):
    quiet = [(i, 1, "P1", 1, f"2020-01-0{i}") for i in range(1, 5)]
    four_days = shop.tables(quiet[:3] + [(9, 1, "P1", 50, "2020-01-09")])
    assert spikes.spikes(four_days).count() == 0
    # four days of 1 and one of 16: mean 4, so 16 is 4 times the mean
    five_days = shop.tables(quiet + [(9, 1, "P1", 16, "2020-01-09")])
    spike = spikes.spikes(five_days).first()
    assert (spike.multiple_of_avg, spike.spike_classification) == (4.0, labels.EXTREME_SPIKE)
    assert (spike.avg_daily_revenue, spike.stddev_revenue) == (D("40.000000"), 60.0)
    assert (spike.day_of_week, spike.daily_orders) == ("Thursday", 1)
    # exactly three times the mean is high, not extreme: 1, 1, 1, 1, 6 has mean 2
    edge = spikes.spikes(shop.tables(quiet + [(9, 1, "P1", 6, "2020-01-09")])).first()
    assert (edge.multiple_of_avg, edge.spike_classification) == (3.0, labels.HIGH_SPIKE)


def test_pairs_count_visits_not_lines(shop):
    lines = [(1, 1, "P1", 1, "2020-01-01"), (2, 1, "P2", 1, "2020-01-01"),
             (3, 1, "P2", 1, "2020-01-01"), (4, 1, "P1", 1, "2020-01-02"),
             (5, 1, "P2", 1, "2020-01-02"), (6, 2, "P1", 1, "2020-01-02"),
             (7, 2, "P1", 1, "2020-01-02"), (8, 2, "P3", 1, "2020-01-02")]
    t = shop.tables(lines)
    assert rows(affinity.product_pairs(t)) == [("P1", "Toys", "P2", "Toys", 2)]
    assert rows(affinity.category_pairs(t)) == [("Grocery", "Toys", 1, 100.0)]
    assert rows(affinity.same_category_visits(t)) == [("Toys", 2, 2.0, 2)]


def test_order_pairs_count_line_pairs(shop):
    lines = [(1, 1, "P1", 1, "2020-01-01"), (1, 1, "P2", 1, "2020-01-01"),
             (1, 1, "P2", 1, "2020-01-01"), (2, 1, "P1", 1, "2020-01-01")]
    assert rows(star.order_pairs(shop.tables(lines))) == [("P1", "P2", 2)]


def test_daily_flag_marks_product_totals(shop, tmp_path):
    w = build(shop, tmp_path, [(i, 1, "P1", 1, f"2020-01-0{i}") for i in range(1, 4)]
              + [(9, 1, "P2", 1, "2020-01-01")])
    got = rows(star.daily_flag(w).select("product_id", "avg_daily_sales", "flag"))
    assert got == [("P1", D("10.000"), 1), ("P2", D("20.000"), 0)]


def test_product_listed_twice_multiplies_lines_but_not_orders(shop):
    products = [("P1", "Toys", "10.00", 1, 7), ("P1", "Toys", "12.00", 1, 7)]
    t = shop.tables([(1, 1, "P1", 2, "2020-01-04"), (1, 1, "P1", 1, "2020-08-04")],
                    products=products)
    assert rows(stores.supplier_products(t).select(
        "total_orders", "total_quantity", "total_sales")) == [(1, 6, D("66.00"))]
    half = assortment.product_halves(t, 2020).first()
    assert (half.h1_quantity, half.h1_revenue, half.h2_revenue, half.yearly_orders) == (
        4, D("44.00"), D("22.00"), 1)
    assert rows(assortment.product_seasons(t).select("season", "total_sales")) == [
        ("Summer", D("22.00")), ("Winter", D("44.00"))]
    # the report over joined lines agrees
    assert rows(assortment.by_category(t).select("total_quantity", "total_sales")) == [
        (6, D("66.00"))]


def test_missing_price_and_quantity(shop):
    products = [("P1", "Toys", "10.00", 1, 7), ("P2", "Toys", "1.00", 1, 7)]
    t = shop.tables([(1, 1, "P1", None, "2020-01-04"), (2, 1, "P1", 3, "2020-08-04"),
                     (3, 1, "P2", None, "2020-08-04")], products=products)
    halves = {r.Product_ID: r for r in assortment.product_halves(t, 2020).collect()}
    assert (halves["P1"].h1_revenue, halves["P1"].h2_revenue) == (D("0.00"), D("30.00"))
    assert (halves["P2"].h1_revenue, halves["P2"].h2_revenue) == (D("0.00"), None)
    # an average leaves out lines without a quantity, an order count does not
    total = shoppers.by_gender(t).first()
    assert (total.total_orders, total.avg_per_transaction) == (3, D("30.00"))


def test_calendar_labels(spark):
    days = spark.createDataFrame([("2024-06-01",), ("2024-06-02",), ("2024-06-03",)], "d string")
    day = F.col("d").cast("date")
    got = rows(days.select(cal.day_type(day), cal.day_name(day)))
    assert got == [("Weekend", "Saturday"), ("Weekend", "Sunday"), ("Weekday", "Monday")]
    months = spark.range(1, 13).select(cal.season(F.col("id").cast("int")))
    assert [r[0] for r in months.collect()] == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"])


def test_trend_words(spark):
    values = [20.0, 10.0, 0.0, -10.0, -20.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(labels.month_trend(F.col("v"))).collect()] == [
        "UP", "up", "flat", "down", "DOWN", "-"]
    assert [r[0] for r in df.select(labels.above(F.col("v"), *labels.STORE_RATING)).collect()] == [
        "Excellent", "Good", "Needs Attention", "Critical", "Critical", "Insufficient Data"]


def test_store_quarters_copy_no_line_for_their_counts(shop):
    from tillwise.plans import stores, trends

    t = shop.tables([(1, 1, "P1", 2, "2020-01-04"), (1, None, "P1", 1, "2020-01-04"), (2, 2, "P2", None, None)])
    for report in (stores.store_quarters(t), trends.store_quarter_growth(t, 2020)):
        assert "Expand" not in report._jdf.queryExecution().optimizedPlan().toString()
    got = {r.year_quarter: (r.total_orders, r.unique_customers, r.total_quantity, r.products_sold)
           for r in stores.store_quarters(t).collect()}
    assert got == {"2020-Q1": (1, 1, 3, 1), None: (1, 1, None, 1)}


def test_orders_of_a_product_are_counted_in_as_many_tasks_as_lines_ask_for(shop, monkeypatch):
    from tillwise import tables
    monkeypatch.setattr(tables, "TASK_LINES", 1, raising=False)
    rows = [(n, 1, "P1", 1, "2020-01-01") for n in range(20)]
    rows += [(1, 2, "P1", 2, "2020-01-01"), (None, 1, "P1", 4, "2020-01-01"), (1, 1, "P1", 8, "2020-07-01"),
             (1, 1, "P2", 1, None), (1, 1, None, 1, "2020-01-01")]
    got = assortment.product_seasons(shop.tables(rows))
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().toString()
    found = sorted(((r.Product_ID, r.total_quantity, r.total_orders) for r in got.collect()), key=repr)
    assert found == [("P1", 26, 20), ("P1", 8, 1), ("P2", 1, 1)]
