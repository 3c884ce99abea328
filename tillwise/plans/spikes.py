"""Days on which a product sells far above its average selling day."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.labels import EXTREME_SPIKE, HIGH_SPIKE, listed_order
from tillwise.functions.money import WHOLE, from_cents, mean_money_fine
from tillwise.operators.ranking import top_k, with_order_counts
from tillwise.tables import RetailTables

# Days a product must have sold on, and the multiples that count as spikes.
MIN_DAYS, HIGH, EXTREME = 5, 2, 3

PRODUCT = ["Product_ID", "Product_Category"]


def _days(t: RetailTables, keys: list[str]) -> DataFrame:
    """Product days with the product's totals beside them.

    Lines are added up per product and day before they meet the product. The
    averages are a window over the daily rows, so the days are computed once; a
    product has at most one row per calendar day there, however often it sells.
    """
    days = t.sold_by_product(keys, "order_date").select(
        *keys, "order_date", F.col("amount_cents").alias("cents"),
        F.col("quantity").alias("daily_quantity"))
    product = W.partitionBy("Product_ID")
    return (days.withColumns({"days": F.count("*").over(product),
                              "priced_days": F.count("cents").over(product),
                              "total": F.sum("cents").over(product)})
            .where(F.col("days") >= MIN_DAYS))


def _exceeds(multiple: int):
    """Above ``multiple`` times the average, by exact products instead of a quotient.

    The comparison in floating point, with room for its error, comes first and
    spares almost all rows the wide decimals.
    """
    days, total = F.col("priced_days"), F.col("total")
    roughly = F.col("cents").cast("double") * days > total * F.lit(multiple * (1 - 1e-9))
    exactly = F.col("cents").cast(WHOLE) * days > total.cast(WHOLE) * F.lit(multiple)
    return roughly & exactly


SPIKE_DAY = [*PRODUCT, "order_date"]


def _order():
    return [F.desc("multiple_of_avg"), "Product_ID", "order_date", "Product_Category"]


def _top_spikes(t: RetailTables, k: int) -> DataFrame:
    multiple = F.round(F.try_divide(F.col("cents").cast(WHOLE) * F.col("priced_days"),
                                    F.col("total").cast(WHOLE)), 2).cast("double")
    deviation = F.stddev_pop(F.col("cents") / F.lit(100.0)).over(W.partitionBy("Product_ID"))
    found = (_days(t, PRODUCT).withColumn("deviation", deviation)
             .where(_exceeds(HIGH)).withColumn("multiple_of_avg", multiple))
    kind = F.when(_exceeds(EXTREME), EXTREME_SPIKE).otherwise(HIGH_SPIKE)
    return (top_k(found, _order(), k)
            .withColumn("spike_classification", kind)
            .withColumn("daily_revenue", from_cents(F.col("cents"))))


def spikes(t: RetailTables, k: int = 50) -> DataFrame:
    return (with_order_counts(_top_spikes(t, k), t.lines(), ["Product_ID", "order_date"],
                              "daily_orders")
            .orderBy(*_order())
            .select(*SPIKE_DAY, cal.day_name(F.col("order_date")).alias("day_of_week"),
                    "daily_revenue", "daily_quantity", "daily_orders",
                    mean_money_fine(F.col("total"), F.col("priced_days")).alias("avg_daily_revenue"),
                    F.round("deviation", 4).alias("stddev_revenue"), "multiple_of_avg",
                    "spike_classification"))


def spike_class_counts(t: RetailTables, k: int = 50) -> DataFrame:
    return (_top_spikes(t, k).groupBy("spike_classification")
            .agg(F.count("*").alias("spike_count")).orderBy("spike_classification"))


def first_extreme_spikes(t: RetailTables, k: int = 50, shown: int = 5) -> DataFrame:
    extreme = _top_spikes(t, k).where(F.col("spike_classification") == EXTREME_SPIKE)
    return top_k(extreme, _order(), shown).select(*SPIKE_DAY, "daily_revenue", "multiple_of_avg")


def spike_frequency(t: RetailTables, k: int = 20) -> DataFrame:
    spike_days = F.sum(F.when(_exceeds(HIGH), 1).otherwise(0))
    products = (_days(t, PRODUCT).groupBy(*PRODUCT, "total", "priced_days",
                                          F.col("days").alias("days_with_sales"))
                .agg(spike_days.alias("spike_count"), F.max("cents").alias("most"))
                .where("spike_count > 0"))
    share = F.round(F.col("spike_count").cast(WHOLE) * F.lit(100) / F.col("days_with_sales"), 1)
    return (top_k(products, [F.desc("spike_count"), *map(F.col, PRODUCT)], k)
            .select(*PRODUCT, "days_with_sales", "spike_count",
                    share.cast("double").alias("spike_pct"),
                    mean_money_fine(F.col("total"), F.col("priced_days")).alias("avg_daily_revenue"),
                    from_cents(F.col("most")).alias("max_daily_revenue")))


def spikes_by_weekday(t: RetailTables) -> DataFrame:
    spike = F.when(_exceeds(HIGH), 1).otherwise(0)
    share = F.round(F.sum(spike).cast(WHOLE) * F.lit(100) / F.count("*"), 2).cast("double")
    return (_days(t, ["Product_ID"])
            .groupBy(cal.day_name(F.col("order_date")).alias("day_of_week"))
            .agg(F.count("*").alias("total_days"), F.sum(spike).alias("spike_days"),
                 share.alias("spike_pct"))
            .orderBy(listed_order(F.col("day_of_week"), cal.WEEKDAYS)))
