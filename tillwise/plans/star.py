"""Reports over the star schema.

They read the fact through its surrogate keys and answer narrower questions than
the operational reports of the same theme: totals only, global instead of
per-group top lists, calendar instead of existing months.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.money import MONEY, from_cents, mean_money_fine, percent, to_cents
from tillwise.operators.baskets import basket_lines, top_pairs
from tillwise.operators.growth import with_previous_month
from tillwise.operators.ranking import top_k
from tillwise.plans.warehouse import FACT_PARTITION, Warehouse
from tillwise.session import written
from tillwise.tables import RetailTables

PRODUCT = ["product_id", "product_category"]

# The years the reports ask for.
DEMOGRAPHIC_YEAR, GROWTH_YEAR, RECENT_YEAR, AFTER_MONTH = 2015, 2016, 2017, 7


def _facts(w: Warehouse, *dims: str, year: int | None = None,
           also: tuple[str, ...] = (), facts: DataFrame | None = None) -> DataFrame:
    """Cents, units and lines per combination of the ``dims`` (and ``also``), with their columns.

    The fact (or ``facts``) is added up under the surrogate keys before it meets a dimension, so a product
    or customer with a third of all lines is one row per task and key when it is shuffled.
    """
    facts = w.fact_sales if facts is None else facts
    if year is not None:
        # the fact is stored by year, so this drops whole folders
        facts = facts.where(F.col(FACT_PARTITION) == year)
    facts = (facts.withColumn("cents", to_cents(F.col("revenue")))
             .groupBy(*[f"{dim}_key" for dim in dims], *also)
             .agg(F.sum("cents").alias("cents"), F.count("cents").alias("lines"),
                  F.sum(F.col("quantity").cast("bigint")).alias("quantity")))
    for dim in dims:
        facts = facts.join(w.tables()[f"dim_{dim}"], f"{dim}_key")
    return facts


def _products_as(w: Warehouse, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The fact in which all products of the same ``columns`` have one key, and those keys with their ``columns``.

    Sums by that key are sums by ``columns``, so they need not be added up once more under the names.
    Only products listed more than once, say at two prices, change their key; they are written, so
    that Spark sees how few they are, and the fact is left as it is where there are none.
    """
    keyed = w.dim_product.select("product_key", *columns).withColumn(
        "first_key", F.min("product_key").over(W.partitionBy(*columns)))
    moved = written(keyed.where("product_key <> first_key").select("product_key", "first_key"), "product-keys")
    if moved.isEmpty():
        return w.fact_sales, w.dim_product.select("product_key", *columns)
    facts = (w.fact_sales.join(moved, "product_key", "left")
             .withColumn("product_key", F.coalesce("first_key", "product_key")).drop("first_key"))
    return facts, w.dim_product.join(moved, "product_key", "left_anti").select("product_key", *columns)


def _sum(name: str, where: Column | None = None) -> Column:
    cents = F.col("cents") if where is None else F.when(where, F.col("cents")).otherwise(0)
    return from_cents(F.sum(cents)).alias(name)


def _best_products(w: Warehouse, periods: list[str], k: int, year: int | None = None) -> DataFrame:
    """The ``k`` products and ``periods`` of the highest revenue. A period goes by its first date key until
    its sums have met their product, which keeps what is shuffled narrow."""
    facts, products = _products_as(w, PRODUCT)
    dates = w.dim_date.select("date_key", *periods, F.min("date_key").over(W.partitionBy(*periods)).alias("period"))
    dates = written(dates, "periods")
    sales = (_facts(w, year=year, also=("product_key", "date_key"), facts=facts)
             .join(dates.select("date_key", "period"), "date_key")
             .groupBy("product_key", "period").agg(F.sum("cents").alias("cents"))
             .join(products, "product_key")
             .join(dates.where("date_key = period").drop("date_key"), "period")
             .select(*periods, *PRODUCT, from_cents(F.col("cents")).alias("total_revenue")))
    return top_k(sales, [F.desc("total_revenue"), *map(F.col, [*periods, *PRODUCT])], k)


def top_products(w: Warehouse, k: int = 5) -> DataFrame:
    return _best_products(w, ["year", "month", "weekday_flag"], k)


def demographics(w: Warehouse) -> DataFrame:
    return (_facts(w, "customer").groupBy("gender", "age", "city_category")
            .agg(_sum("purchase_amount")))


def occupation_category(w: Warehouse) -> DataFrame:
    return (_facts(w, "customer", "product").groupBy("occupation", "product_category")
            .agg(_sum("total_sales")))


def quarter_gender_age(w: Warehouse, year: int = DEMOGRAPHIC_YEAR) -> DataFrame:
    return (_facts(w, "customer", "date", year=year).groupBy("quarter", "gender", "age")
            .agg(_sum("purchase_amount")))


def top_occupation_category(w: Warehouse, k: int = 5) -> DataFrame:
    keys = ["occupation", "product_category"]
    sales = _facts(w, "customer", "product").groupBy(*keys).agg(_sum("sales"))
    return top_k(sales, [F.desc("sales"), *map(F.col, keys)], k)


def city_marital(w: Warehouse, year: int = RECENT_YEAR, after_month: int = AFTER_MONTH) -> DataFrame:
    return (_facts(w, "customer", "date", year=year).where(F.col("month") > after_month)
            .groupBy("year", "month", "city_category", "marital_status")
            .agg(_sum("purchase_amount")))


def mean_by_stay_gender(w: Warehouse) -> DataFrame:
    mean = mean_money_fine(F.sum("cents"), F.sum("lines")).alias("avg_purchase_amount")
    return _facts(w, "customer").groupBy("stay_years", "gender").agg(mean)


def top_city_category(w: Warehouse, k: int = 5) -> DataFrame:
    keys = ["city_category", "product_category"]
    sales = _facts(w, "customer", "product").groupBy(*keys).agg(_sum("purchase_amount"))
    return top_k(sales, [F.desc("purchase_amount"), *map(F.col, keys)], k)


def category_month_growth(w: Warehouse, year: int = GROWTH_YEAR) -> DataFrame:
    months = (_facts(w, "date", "product", year=year).groupBy("month", "product_category")
              .agg(_sum("current_sales")))
    now, before = F.col("current_sales"), F.col("previous_sales")
    return (with_previous_month(months, ["product_category"], "month",
                                previous_sales="current_sales")
            .withColumn("growth_percentage", percent(now - before, before, 2))
            .orderBy("product_category", "month"))


def age_weekday(w: Warehouse) -> DataFrame:
    return (_facts(w, "customer", "date").groupBy("age", "weekday_flag")
            .agg(_sum("total_sales")))


def top_products_of_year(w: Warehouse, year: int = GROWTH_YEAR, k: int = 5) -> DataFrame:
    return _best_products(w, ["month", "weekday_flag"], k, year)


def store_quarters_of_year(w: Warehouse, year: int = RECENT_YEAR) -> DataFrame:
    return (_facts(w, "store", "date", year=year).groupBy("store_name", "quarter")
            .agg(_sum("revenue")))


def store_supplier_category(w: Warehouse) -> DataFrame:
    return (_facts(w, "store", "supplier", "product")
            .groupBy("store_name", "supplier_name", "product_category")
            .agg(_sum("total_sales")))


def product_month_season(w: Warehouse) -> DataFrame:
    """One row per product and month of the year, under the season's name."""
    facts, products = _products_as(w, PRODUCT)
    # the few dates meet the lines, so that these are added up once
    dated = facts.join(w.dim_date.select("date_key", "month", "quarter"), "date_key")
    return (dated.withColumn("cents", to_cents(F.col("revenue")))
            .groupBy("product_key", "month", "quarter").agg(_sum("total_sales"))
            .join(products, "product_key")
            .withColumn("season", cal.season(F.col("month")))
            .orderBy("product_id", "season", "month")
            .select(*PRODUCT, "season", "quarter", "total_sales"))


def store_supplier_growth(w: Warehouse) -> DataFrame:
    """Change against the calendar month before, with all years taken together."""
    pair = ["store_name", "supplier_name"]
    months = (_facts(w, "store", "supplier", "date").groupBy(*pair, "month")
              .agg(_sum("current_monthly_total_sales")))
    now, before = F.col("current_monthly_total_sales"), F.col("previous_month_total_sales")
    return (with_previous_month(months, pair, "month", prev_month="month",
                                previous_month_total_sales="current_monthly_total_sales")
            .withColumn("difference", (now - before).cast(MONEY))
            .withColumn("percentage", percent(now - before, before, 2))
            .orderBy(*pair, "month", "prev_month"))


def order_pairs(t: RetailTables, k: int = 5) -> DataFrame:
    """Product pairs by the number of line pairs that share an order."""
    lines = basket_lines(t.transactions, ["orderID"], "Product_ID")
    return top_pairs(lines, k, weighted=True).select(
        F.col("item_1").alias("product_1"), F.col("item_2").alias("product_2"),
        F.col("times").alias("product_bought_together"))


def rollup(w: Warehouse) -> DataFrame:
    keys = ["store_name", "supplier_name", "product_category"]
    # only as many rows as there are combinations enter the rollup
    combinations = (_facts(w, "store", "supplier", "product").groupBy(*keys)
                    .agg(F.sum("cents").alias("cents")))
    depth = sum((F.grouping(c).cast("int") for c in keys[1:]), F.grouping(keys[0]).cast("int"))
    levels = F.array(*[F.lit(x) for x in ["category", "supplier", "store", "all"]])
    return (combinations.rollup(*keys)
            .agg(F.get(levels, depth).alias("level"), _sum("total_sales")))


def product_halves(w: Warehouse) -> DataFrame:
    month = F.col("month")
    return (_facts(w, "product", "date").groupBy(*PRODUCT)
            .agg(_sum("first_half_revenue", month.between(1, 6)),
                 _sum("second_half_revenue", month.between(7, 12)),
                 F.sum("quantity").alias("total_quantity")))


def daily_flag(w: Warehouse) -> DataFrame:
    """Product totals against twice their average selling day."""
    mean = F.round(F.try_divide(F.col("total_sales"), F.col("no_of_days")), 3)
    facts, products = _products_as(w, ["product_id"])
    return (facts.withColumn("cents", to_cents(F.col("revenue"))).groupBy("product_key")
            .agg(_sum("total_sales"), F.count_distinct("date_key").alias("no_of_days"))
            .join(products, "product_key").drop("product_key")
            .withColumn("avg_daily_sales", mean.cast("decimal(24,3)"))
            .withColumn("twice_daily_avg_sales",
                        (F.col("avg_daily_sales") * F.lit(2)).cast("decimal(24,3)"))
            .withColumn("flag", F.when(
                F.col("total_sales") > F.col("twice_daily_avg_sales"), 1).otherwise(0))
            .drop("no_of_days").orderBy("product_id"))


def store_quarterly(w: Warehouse) -> DataFrame:
    return (_facts(w, "store", "date").groupBy("store_name", "year", "quarter")
            .agg(_sum("total_sales")).orderBy("store_name", "year", "quarter"))


def create_quarterly_view(w: Warehouse, name: str = "STORE_QUARTERLY_SALES") -> None:
    store_quarterly(w).createOrReplaceTempView(name)
