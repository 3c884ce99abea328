"""Market baskets: what one customer buys on one day."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.operators.baskets import basket_lines, top_pairs
from tillwise.operators.ranking import numbered, top_k
from tillwise.tables import RetailTables

VISIT = ["Customer_ID", "order_date"]


def product_pairs(t: RetailTables, k: int = 20) -> DataFrame:
    """Pairs bought together on more than one visit, with both categories."""
    listed = t.transactions.join(t.products.select("Product_ID"), "Product_ID", "left_semi")
    pairs = top_pairs(basket_lines(listed, VISIT, "Product_ID"), k,
                      at_least=2)
    category = t.products.select("Product_ID", "Product_Category")
    first = category.toDF("product_1", "category_1")
    second = category.toDF("product_2", "category_2")
    named = (pairs.select(F.col("item_1").alias("product_1"), F.col("item_2").alias("product_2"),
                          F.col("times").alias("times_bought_together"))
             .join(first, "product_1").join(second, "product_2"))
    return (top_k(named, [F.desc("times_bought_together"), "product_1", "product_2",
                          "category_1", "category_2"], k)
            .select("product_1", "category_1", "product_2", "category_2",
                    "times_bought_together"))


def category_pairs(t: RetailTables, k: int = 15) -> DataFrame:
    """Category pairs by visits, with a score relative to the most frequent pair."""
    lines = basket_lines(t.sold(), VISIT, "Product_Category")
    top = top_pairs(lines, k).select(
        F.col("item_1").alias("category_1"), F.col("item_2").alias("category_2"),
        F.col("times").alias("times_bought_together"))
    order = [F.desc("times_bought_together"), F.col("category_1"), F.col("category_2")]
    times = F.col("times_bought_together").cast("decimal(20,0)")
    most = F.max(times).over(W.partitionBy())  # at most k rows
    score = F.round(times * F.lit(100) / most, 1).cast("double")
    return top.withColumn("affinity_score", score).orderBy(*order)


def same_category_visits(t: RetailTables) -> DataFrame:
    visits = (t.sold().groupBy(*VISIT, "Product_Category")
              .agg(F.count_distinct("Product_ID").alias("products_count"))
              .where("products_count > 1"))
    total = F.sum("products_count").cast("decimal(20,0)")
    mean = F.round(total / F.count("*"), 2).cast("double")
    return (visits.groupBy("Product_Category")
            .agg(F.count("*").alias("multi_product_sessions"),
                 mean.alias("avg_products_per_session"),
                 F.max("products_count").alias("max_products_in_session"))
            .orderBy(F.desc("multi_product_sessions"), "Product_Category"))


def bundles(t: RetailTables, k: int = 5) -> DataFrame:
    order = [F.desc("times_bought_together"), "product_1", "product_2", "category_1", "category_2"]
    return numbered(top_k(product_pairs(t), order, k), order, "bundle").select(
        "bundle", "product_1", "category_1", "product_2", "category_2", "times_bought_together")
