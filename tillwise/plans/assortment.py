"""Reports by product and category: best sellers, shares, seasons, halves of the year."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.labels import larger_of, listed_order
from tillwise.functions.money import from_cents, percent, share_or_zero
from tillwise.operators import metrics as m
from tillwise.operators.crosstab import with_total_row
from tillwise.operators.ranking import (ranked, top_k, top_k_per_group,
                                        with_order_counts)
from tillwise.tables import RetailTables

PRODUCT = ["Product_ID", "Product_Category"]


def years(t: RetailTables) -> DataFrame:
    stored = cal.stored_by_year(t.transactions)
    year = F.col(cal.STORED_YEAR) if stored else F.year("order_date")
    return t.transactions.select(year.alias("year")).distinct().orderBy("year")


def _by_day_type(t: RetailTables, year: int | None, monthly: bool = False) -> DataFrame:
    """Sums per product and kind of day (and month); no single line meets the products."""
    day = F.col("order_date")
    by = [cal.day_type(day).alias("day_type"),
          *([cal.month_start(day).alias("month_start")] if monthly else [])]
    return t.sold_by_product(PRODUCT, *by, where=cal.year_condition(t.transactions, year))


def _winning_lines(t: RetailTables, year: int | None) -> DataFrame:
    day = F.col("order_date")
    return t.lines(cal.year_condition(t.transactions, year)).withColumns(
        {"day_type": cal.day_type(day), "month_start": cal.month_start(day)})


def _best_first(measure: str, *tie_breakers: str):
    return [F.desc(measure), *(F.col(c) for c in tie_breakers)]


def top_by_month_day_type(t: RetailTables, year: int | None = None, k: int = 5) -> DataFrame:
    sales = (_by_day_type(t, year, monthly=True)
             .groupBy("month_start", "day_type", *PRODUCT).agg(m.revenue("total_revenue")))
    return (top_k_per_group(sales, ["month_start", "day_type"],
                            _best_first("total_revenue", *PRODUCT), k, "rnk")
            .select(F.year("month_start").alias("year"), F.month("month_start").alias("month"),
                    "day_type", *PRODUCT, "total_revenue", "rnk")
            .orderBy("year", "month", F.desc("day_type"), "rnk"))


def top_by_day_type(t: RetailTables, year: int | None = None, k: int = 5) -> DataFrame:
    sales = _by_day_type(t, year).groupBy("day_type", *PRODUCT).agg(m.revenue("total_revenue"))
    return (top_k_per_group(sales, ["day_type"], _best_first("total_revenue", *PRODUCT), k, "rnk")
            .orderBy(F.desc("day_type"), "rnk"))


def month_day_type_detail(t: RetailTables, year: int | None = None, k: int = 5) -> DataFrame:
    keys = ["month_start", "day_type", *PRODUCT]
    totals = _by_day_type(t, year, monthly=True).groupBy(*keys).agg(
        m.revenue("total_revenue"), m.units())
    top = top_k_per_group(totals, ["month_start", "day_type"],
                          _best_first("total_revenue", *PRODUCT), k, "revenue_rank")
    return (with_order_counts(top, _winning_lines(t, year), ["Product_ID", "month_start", "day_type"],
                              "order_count")
            .orderBy("month_start", F.desc("day_type"), "revenue_rank")
            .select(cal.month_label(F.col("month_start")).alias("month_year"), "day_type", "revenue_rank", *PRODUCT, "total_revenue",
                    "total_quantity", "order_count"))


def day_type_leaders(t: RetailTables, year: int | None = None, k: int = 10) -> DataFrame:
    totals = _by_day_type(t, year).groupBy("day_type", *PRODUCT).agg(m.revenue("total_revenue"))
    top = top_k_per_group(totals, ["day_type"], _best_first("total_revenue", *PRODUCT), k, "rn")
    return (with_order_counts(top, _winning_lines(t, year), ["Product_ID", "day_type"], "total_orders")
            .orderBy(F.desc("day_type"), "rn").drop("rn"))


def day_type_gap(t: RetailTables, year: int | None = None, k: int = 10) -> DataFrame:
    weekend = F.col("day_type") == cal.WEEKEND
    sales = _by_day_type(t, year).groupBy(*PRODUCT).agg(
        m.revenue("weekend_revenue", weekend), m.revenue("weekday_revenue", ~weekend),
        m.revenue("total_revenue"))
    gap = F.abs(F.col("weekend_revenue") - F.col("weekday_revenue"))
    sold_on_both = (F.col("weekend_revenue") > 0) & (F.col("weekday_revenue") > 0)
    return (top_k(sales.where(sold_on_both).withColumn("difference", gap.cast("decimal(20,2)")),
                  _best_first("difference", "Product_ID"), k)
            .withColumn("bias", F.when(F.col("weekend_revenue") > F.col("weekday_revenue"),
                                       cal.WEEKEND).otherwise(cal.WEEKDAY)))


# --- categories ---

def by_category(t: RetailTables) -> DataFrame:
    return (t.sold().groupBy("Product_Category")
            .agg(m.orders(), m.units(), m.revenue("total_sales"), m.mean_amount(),
                 m.revenue_per("Product_ID", "avg_per_product"))
            .orderBy(*_best_first("total_sales", "Product_Category")))


def top_occupations_per_category(t: RetailTables, k: int = 5) -> DataFrame:
    sales = t.sold_to().groupBy("Product_Category", "Occupation").agg(
        m.orders(), m.units(), m.revenue("total_sales"), m.buyers())
    return (top_k_per_group(sales, ["Product_Category"],
                            _best_first("total_sales", "Occupation"), k, "sales_rank")
            .orderBy("Product_Category", "sales_rank"))


def top_occupation_totals(t: RetailTables, k: int = 5) -> DataFrame:
    sales = t.sold_to().groupBy("Product_Category", "Occupation").agg(m.revenue("total_sales"))
    top = top_k_per_group(sales, ["Product_Category"], _best_first("total_sales", "Occupation"),
                          k, "sales_rank")
    return (top.groupBy("Product_Category")
            .agg(F.sum("total_sales").cast("decimal(20,2)").alias("category_total"))
            .orderBy("Product_Category"))


def top_cities_per_category(t: RetailTables, k: int = 5) -> DataFrame:
    sales = t.sold_to().groupBy("Product_Category", "City_Category").agg(
        m.orders(), m.buyers(), m.units(), m.revenue("total_revenue"))
    # the share needs every city of the category, so it is taken before the cut
    in_category = F.sum("total_revenue").over(W.partitionBy("Product_Category"))
    shared = ranked(sales, ["Product_Category"], _best_first("total_revenue", "City_Category"),
                    "revenue_rank").withColumn(
        "pct_of_category", percent(F.col("total_revenue"), in_category.cast("decimal(20,2)"), 2))
    return (shared.where(F.col("revenue_rank") <= k)
            .orderBy("Product_Category", "revenue_rank"))


def city_summary(t: RetailTables) -> DataFrame:
    counts = m.counted_lines(
        t.sold_to(), ["City_Category"],
        categories_sold="Product_Category", unique_customers="Customer_ID", total_orders="orderID")
    cities = counts.select("City_Category", "categories_sold", "unique_customers", "total_orders",
                           m.added_revenue("total_revenue"), m.added_mean())
    table = with_total_row(cities, "City_Category", ["total_revenue"])
    # the window spans one row per city
    everything = F.max(F.when(F.col("is_total"), F.col("total_revenue"))).over(W.partitionBy())
    return (table.withColumn("pct_of_total", share_or_zero(F.col("total_revenue"), everything))
            .orderBy("is_total", *_best_first("total_revenue", "City_Category"))
            .drop("is_total"))


# --- seasons ---

def _seasonal(t: RetailTables) -> DataFrame:
    return t.sold().withColumn("season", cal.season(F.month("order_date")))


def season_order():
    return listed_order(F.col("season"), cal.SEASONS)


def product_seasons(t: RetailTables) -> DataFrame:
    season = cal.season(F.month("order_date")).alias("season")
    return (t.sold_by_product(PRODUCT, season, orders=True)
            .select(*PRODUCT, "season", from_cents(F.col("amount_cents")).alias("total_sales"),
                    F.col("quantity").alias("total_quantity"),
                    F.col("orders").alias("total_orders"))
            .orderBy("Product_Category", "Product_ID", season_order()))


def best_season(t: RetailTables) -> DataFrame:
    sales = _seasonal(t).groupBy("Product_Category", "season").agg(m.revenue("total_sales"))
    return (top_k_per_group(sales, ["Product_Category"],
                            [F.desc("total_sales"), season_order()], 1, "rank_num")
            .drop("rank_num").orderBy(*_best_first("total_sales", "Product_Category")))


def category_by_season(t: RetailTables) -> DataFrame:
    cells = [m.revenue(f"{s.lower()}_sales", F.col("season") == s) for s in cal.SEASONS]
    return (t.sold().withColumn("season", F.when(
                F.col("order_date").isNotNull(), cal.season(F.month("order_date"))))
            .groupBy("Product_Category").agg(*cells, m.revenue("total_sales"))
            .orderBy(*_best_first("total_sales", "Product_Category")))


# --- first and second half of a year ---

# Factors and margins at which the halves count as different.
HALF_TREND_FACTOR, HALF_GAP_FACTOR, HALF_MARGIN_POINTS = 1.2, 1.5, 10


def _halves(t: RetailTables, year: int | None):
    sales = t.sold(cal.year_condition(t.transactions, year))
    early = cal.first_half(F.col("order_date"))
    return sales, early, ~early


def _product_halves(t: RetailTables, year: int | None) -> DataFrame:
    """Units, orders and cents of both halves per product and category.

    Lines are first added up per product and order. That order then counts once for
    each half it touches, so three distinct counts become sums of flags.
    """
    late = F.month("order_date") > 6
    quantity = F.col("quantity").cast("bigint")
    in_half = {1: ~late, 2: late}
    per_order = [c for h, where in in_half.items() for c in (
        F.sum(F.when(where, quantity).otherwise(F.lit(0))).alias(f"units_{h}"),
        F.count_if(where).alias(f"lines_{h}"))]
    touched = {h: F.col("orderID").isNotNull() & (F.col(f"lines_{h}") > 0) for h in in_half}
    per_product = [c for h in in_half for c in (
        F.sum(f"units_{h}").alias(f"units_{h}"), F.sum(f"lines_{h}").alias(f"lines_{h}"),
        F.count_if(touched[h]).alias(f"orders_{h}"))]
    products = (t.lines(cal.year_condition(t.transactions, year))
                .groupBy("Product_ID", "orderID").agg(F.sum(quantity).alias("units"), *per_order)
                .groupBy("Product_ID").agg(F.sum("units").alias("units"),
                                           F.count("orderID").alias("orders"), *per_product)
                .join(t.product_listing(PRODUCT), "Product_ID"))
    # without a price a half is worth zero if the other half has lines, else unknown
    cents = {h: F.coalesce(F.col(f"units_{h}") * F.col("price_cents"),
                           F.when(F.col(f"lines_{3 - h}") > 0, F.lit(0))) for h in in_half}
    halves = [c for h in in_half for c in (
        (F.col(f"units_{h}") * F.col("copies")).alias(f"h{h}_quantity"),
        from_cents(cents[h]).alias(f"h{h}_revenue"), F.col(f"orders_{h}").alias(f"h{h}_orders"))]
    return products.select(
        *PRODUCT, *halves, (F.col("units") * F.col("copies")).alias("yearly_quantity"),
        from_cents(F.col("units") * F.col("price_cents")).alias("yearly_revenue"),
        F.col("orders").alias("yearly_orders"))


def product_halves(t: RetailTables, year: int | None = None) -> DataFrame:
    one, two = F.col("h1_revenue"), F.col("h2_revenue")
    factor = F.lit(HALF_TREND_FACTOR).cast("decimal(3,1)")
    trend = (F.when((one == 0) & (two == 0), "No Sales")
             .when(one == 0, "H2 Only").when(two == 0, "H1 Only")
             .when(two > one * factor, "H2 Strong").when(one > two * factor, "H2 Weak")
             .otherwise("Stable"))
    return (_product_halves(t, year).withColumn("trend", trend)
            .orderBy(*_best_first("yearly_revenue", "Product_ID")))


def category_halves(t: RetailTables, year: int | None = None) -> DataFrame:
    sales, early, late = _halves(t, year)
    table = sales.groupBy("Product_Category").agg(
        m.revenue("h1_revenue", early), m.revenue("h2_revenue", late),
        m.revenue("yearly_revenue"))
    table = with_total_row(table, "Product_Category",
                           ["h1_revenue", "h2_revenue", "yearly_revenue"])
    total = F.col("yearly_revenue")
    # compared before rounding: (h2 - h1) / total * 100 against the margin
    gap = (F.col("h2_revenue") - F.col("h1_revenue")) * F.lit(100)
    performance = (F.when(gap > total * F.lit(HALF_MARGIN_POINTS), "H2 Stronger")
                   .when(-gap > total * F.lit(HALF_MARGIN_POINTS), "H1 Stronger")
                   .otherwise("Balanced"))
    return (table
            .withColumn("h1_pct", share_or_zero(F.col("h1_revenue"), total))
            .withColumn("h2_pct", share_or_zero(F.col("h2_revenue"), total))
            .withColumn("performance", F.when(~F.col("is_total"), performance))
            .orderBy("is_total", *_best_first("yearly_revenue", "Product_Category"))
            .drop("is_total"))


def half_gap(t: RetailTables, year: int | None = None, k: int = 20) -> DataFrame:
    one, two = F.col("h1_revenue"), F.col("h2_revenue")
    factor = F.lit(HALF_GAP_FACTOR).cast("decimal(3,1)")
    uneven = (one > 0) & (two > 0) & ((one > two * factor) | (two > one * factor))
    early = cal.first_half(F.col("order_date"))
    in_half = t.sold_by_product(PRODUCT, early.alias("early"),
                                where=cal.year_condition(t.transactions, year))
    halves = (in_half.groupBy(*PRODUCT)
              .agg(m.revenue("h1_revenue", F.col("early")), m.revenue("h2_revenue", ~F.col("early")))
              .where(uneven)
              .withColumn("difference", F.abs(one - two).cast("decimal(20,2)")))
    return (top_k(halves, _best_first("difference", "Product_ID"), k)
            .withColumn("stronger_half", larger_of(one, "H1", two, "H2", "H2")))
