"""Growth and volatility: months by category, quarters by store, months by store and supplier."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions import labels
from tillwise.functions.money import change_percent, change_ratio, mean_ratio_percent
from tillwise.operators import metrics as m
from tillwise.operators.growth import with_previous
from tillwise.operators.ranking import top_k
from tillwise.tables import RetailTables

STORE = ["storeID", "storeName"]
STORE_SUPPLIER = ["storeID", "storeName", "supplierID", "supplierName"]


def _month() -> Column:
    return cal.month_start(F.col("order_date")).alias("month_start")


def _labelled(months: DataFrame) -> DataFrame:
    label = cal.month_label(F.col("month_start"))
    return months.withColumn("month_year", label).drop("month_start")


def _total(column: str) -> Column:
    return F.sum(column).cast("decimal(20,2)").alias("total_revenue")


# --- categories by month ---

def _category_months(t: RetailTables, year: int | None, *more: Column) -> DataFrame:
    sales = t.sold(cal.year_condition(t.transactions, year))
    months = _labelled(sales.groupBy("Product_Category", _month())
                       .agg(m.revenue("monthly_revenue"), *more))
    return with_previous(months, ["Product_Category"], ["month_year"],
                         prev_month_revenue="monthly_revenue", prev_month="month_year")


def category_month_growth(t: RetailTables, year: int | None = None) -> DataFrame:
    growth = change_percent(F.col("monthly_revenue"), F.col("prev_month_revenue"))
    return (_category_months(t, year, m.orders())
            .withColumn("growth_pct", growth)
            .withColumn("trend", labels.month_trend(F.col("growth_pct")))
            .select("Product_Category", "month_year", "monthly_revenue", "total_orders",
                    "prev_month_revenue", "prev_month", "growth_pct", "trend")
            .orderBy("Product_Category", "month_year"))


def category_mean_growth(t: RetailTables, year: int | None = None) -> DataFrame:
    ratio = change_ratio(F.col("monthly_revenue"), F.col("prev_month_revenue"))
    return (_category_months(t, year).withColumn("ratio", ratio)
            .groupBy("Product_Category")
            .agg(F.count("*").alias("months_analyzed"),
                 mean_ratio_percent(F.col("ratio")).alias("avg_growth_pct"),
                 _total("monthly_revenue"))
            .withColumn("performance",
                        labels.above(F.col("avg_growth_pct"), *labels.CATEGORY_PERFORMANCE))
            .orderBy(F.desc_nulls_last("avg_growth_pct"), "Product_Category"))


# --- stores by quarter ---

def _store_quarters(t: RetailTables, year: int | None, **ids: str) -> DataFrame:
    """Quarters of ``year``; without one, of the preferred year or else the latest, with the distinct counts ``ids``."""
    if year is None:
        where = cal.preferred_year_condition(t.transactions, cal.PREFERRED_STORE_YEAR)
    else:
        where = cal.year_condition(t.transactions, year)
    lines = t.sold(where).withColumn("quarter", F.quarter("order_date"))
    keys = [*STORE, "quarter"]
    if ids:  # a pass for each count, so that no task holds a copy of its lines for each
        sums = m.counted_lines(lines, keys, **ids).select(*keys, *ids, m.added_revenue("quarterly_revenue"))
    else:
        sums = lines.groupBy(*keys).agg(m.revenue("quarterly_revenue"))
    quarters = (sums.withColumn("quarter_label", F.concat(F.lit("Q"), F.col("quarter"))))
    # a store id may carry two names; the name only breaks the tie inside a quarter
    return with_previous(quarters, ["storeID"], ["quarter", "storeName"],
                         prev_quarter_revenue="quarterly_revenue", prev_quarter="quarter_label")


def store_quarter_growth(t: RetailTables, year: int | None = None) -> DataFrame:
    growth = change_percent(F.col("quarterly_revenue"), F.col("prev_quarter_revenue"))
    return (_store_quarters(t, year, total_orders="orderID", unique_customers="Customer_ID")
            .withColumn("growth_rate_pct", growth)
            .withColumn("trend", labels.above(F.col("growth_rate_pct"), *labels.QUARTER_TREND))
            .orderBy("storeID", "quarter", "storeName")
            .select(*STORE, "quarter_label", "quarterly_revenue", "total_orders",
                    "unique_customers", "prev_quarter_revenue", "prev_quarter",
                    "growth_rate_pct", "trend"))


def store_mean_growth(t: RetailTables, year: int | None = None) -> DataFrame:
    ratio = change_ratio(F.col("quarterly_revenue"), F.col("prev_quarter_revenue"))
    return (_store_quarters(t, year).withColumn("ratio", ratio)
            .groupBy(*STORE)
            .agg(F.count("*").alias("quarters_with_data"), _total("quarterly_revenue"),
                 mean_ratio_percent(F.col("ratio")).alias("avg_growth_rate"))
            .withColumn("rating", labels.above(F.col("avg_growth_rate"), *labels.STORE_RATING))
            .orderBy(F.desc_nulls_last("avg_growth_rate"), *STORE))


# --- stores and suppliers by month ---

def _pair_months(t: RetailTables) -> DataFrame:
    months = _labelled(t.sold().groupBy(*STORE_SUPPLIER, _month())
                       .agg(m.revenue("monthly_revenue")))
    return with_previous(months, ["storeID", "supplierID"],
                         ["month_year", "storeName", "supplierName"],
                         prev_revenue="monthly_revenue", prev_month="month_year")


def pair_month_change(t: RetailTables) -> DataFrame:
    change = change_percent(F.col("monthly_revenue"), F.col("prev_revenue"))
    return (_pair_months(t).withColumn("pct_change", change)
            .withColumn("volatility", labels.above(F.abs("pct_change"), *labels.VOLATILITY))
            .select(*STORE_SUPPLIER, "month_year", "monthly_revenue", "prev_revenue",
                    "prev_month", "pct_change", "volatility")
            .orderBy("storeName", "supplierName", "month_year", "storeID", "supplierID"))


def _pair_volatility(t: RetailTables, more_months_than: int) -> DataFrame:
    now, before = F.col("monthly_revenue"), F.col("prev_revenue")
    exact = F.when(before > 0, F.round(
        F.try_divide(F.abs(now - before) * F.lit(100), before), 2))
    return (_pair_months(t).withColumn("ratio", F.abs(change_ratio(now, before)))
            .groupBy(*STORE_SUPPLIER)
            .agg(F.count("*").alias("months_count"), _total("monthly_revenue"),
                 mean_ratio_percent(F.col("ratio")).alias("avg_volatility"),
                 F.max(exact).cast("double").alias("max_volatility"))
            .where(F.col("months_count") > more_months_than))


def most_volatile_pairs(t: RetailTables, k: int = 20) -> DataFrame:
    return (top_k(_pair_volatility(t, 1),
                  [F.desc_nulls_last("avg_volatility"), "storeID", "supplierID"], k)
            .withColumn("risk_level",
                        labels.above(F.col("avg_volatility"), *labels.RISK_LEVEL)))


def most_stable_pairs(t: RetailTables, k: int = 10) -> DataFrame:
    known = _pair_volatility(t, 3).drop("max_volatility").where("avg_volatility IS NOT NULL")
    return top_k(known, ["avg_volatility", "storeID", "supplierID"], k)
