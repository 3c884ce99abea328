"""Star schema: dimensions with surrogate keys and the sales fact.

The build is meant to run once and be written; the star reports read the written
tables. Dimensions join the staging rows on natural keys, so a key that is listed
twice multiplies fact rows, and ``duplicate_keys`` finds such keys beforehand.
"""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.operators import keys as k
from tillwise.session import written
from tillwise.tables import RetailTables

TABLES = ["dim_customer", "dim_product", "dim_store", "dim_supplier", "dim_date", "fact_sales"]
FACT_PARTITION = "sale_year"
FACT_PARTS = 64  # parts of a year in which the fact is numbered and written


@dataclass(frozen=True)
class Warehouse:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_supplier: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


# --- dimension rows, without keys ---

def customer_rows(t: RetailTables) -> DataFrame:
    status = F.when(F.col("Marital_Status") == 1, "Married").otherwise("Single")
    return t.customers.select(
        F.col("Customer_ID").alias("customer_id"), F.col("Gender").alias("gender"),
        F.col("Age").alias("age"), F.col("Occupation").cast("string").alias("occupation"),
        F.col("City_Category").alias("city_category"),
        F.col("Stay_In_Current_City_Years").alias("stay_years"),
        status.alias("marital_status")).distinct()


def product_rows(t: RetailTables) -> DataFrame:
    return t.products.select(
        F.col("Product_ID").alias("product_id"),
        F.col("Product_Category").alias("product_category"), "price").distinct()


def store_rows(t: RetailTables) -> DataFrame:
    return t.products.select(F.col("storeID").alias("store_id"),
                             F.col("storeName").alias("store_name")).distinct()


def supplier_rows(t: RetailTables) -> DataFrame:
    return t.products.select(F.col("supplierID").alias("supplier_id"),
                             F.col("supplierName").alias("supplier_name")).distinct()


def date_rows(t: RetailTables) -> DataFrame:
    # the few thousand dates are made distinct before their attributes are derived
    day = F.col("full_date")
    return (t.transactions.select(F.col("order_date").alias("full_date"))
            .where(day.isNotNull()).distinct()
            .select("full_date", F.dayofmonth(day).alias("day"), F.month(day).alias("month"),
                    F.quarter(day).alias("quarter"), F.year(day).alias("year"),
                    cal.day_type(day).alias("weekday_flag")))


def dimensions(t: RetailTables) -> dict[str, DataFrame]:
    rows = {
        "dim_customer": ("customer_key", customer_rows(t)),
        "dim_product": ("product_key", product_rows(t)),
        "dim_store": ("store_key", store_rows(t)),
        "dim_supplier": ("supplier_key", supplier_rows(t)),
        "dim_date": ("date_key", date_rows(t)),
    }
    return {name: k.with_surrogate_key(df, key, df.columns) for name, (key, df) in rows.items()}


# --- fact ---

def fact_rows(t: RetailTables, dims: dict[str, DataFrame]) -> DataFrame:
    """Sales lines with dimension keys.

    Store and supplier belong to the product, so the product side (product row,
    store and supplier keys) is joined first, small with small. It is written, so
    that Spark knows its size when the transactions meet it, one customer side and
    one date side.
    """
    listing = (t.products.select(F.col("Product_ID").alias("product_id"),
                                 F.col("storeID").alias("store_id"),
                                 F.col("supplierID").alias("supplier_id"))
               .join(dims["dim_product"], "product_id")
               .join(dims["dim_store"], "store_id")
               .join(dims["dim_supplier"], "supplier_id")
               .select("product_id", "product_key", "store_key", "supplier_key", "price"))
    listing = written(listing, "product-listing")
    revenue = (F.col("quantity") * F.col("price")).cast("decimal(12,2)")
    lines = t.transactions.select(
        "row_index", F.col("Customer_ID").alias("customer_id"),
        F.col("Product_ID").alias("product_id"), "quantity", F.col("order_date").alias("full_date"))
    return (lines
            .join(dims["dim_date"].select("date_key", "full_date"), "full_date")
            .join(listing, "product_id")
            .join(dims["dim_customer"].select("customer_key", "customer_id"), "customer_id")
            .select("row_index", "customer_key", "product_key", "store_key", "supplier_key",
                    "date_key", "quantity", revenue.alias("revenue"),
                    F.year("full_date").alias(FACT_PARTITION)))


def with_sales_key(fact: DataFrame) -> DataFrame:
    """A 64-bit key from the line's identity, its dimension keys, its quantity and, for lines equal
    in all of these, their number: the same however often and wherever a task runs. The
    numbering costs one shuffle of the fact; ``key_report`` would show a chance collision.

    That shuffle is by year and by a part of the year, which equal lines share, so its rows come out
    sorted by year and can be written as they are."""
    parts = ["row_index", *(c for c in fact.columns if c.endswith("_key")), "quantity"]
    dealt = fact.withColumn("part", F.pmod(F.xxhash64(*parts), F.lit(FACT_PARTS)))
    nth = F.row_number().over(W.partitionBy(FACT_PARTITION, "part", *parts).orderBy("revenue"))
    return (dealt.repartition(FACT_PARTITION, "part").withColumn("nth", nth)
            .select(F.xxhash64(*parts, "nth").alias("sales_key"),
                    *[c for c in fact.columns if c != "row_index"]))


def build(t: RetailTables, folder: str) -> Warehouse:
    """Write all dimensions, then the fact built on the written keys."""
    spark = t.transactions.sparkSession
    dims = dimensions(t)
    with ThreadPoolExecutor(len(dims)) as jobs:  # five independent jobs
        list(jobs.map(lambda name: dims[name].write.mode("overwrite").parquet(
            f"{folder}/{name}"), dims))
    written = {name: spark.read.parquet(f"{folder}/{name}") for name in TABLES[:-1]}
    fact = with_sales_key(fact_rows(t, written))
    fact.write.mode("overwrite").partitionBy(FACT_PARTITION).parquet(f"{folder}/fact_sales")
    return load(spark, folder)


def load(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(**{name: spark.read.parquet(f"{folder}/{name}") for name in TABLES})


# --- reports on the build ---

def fact_resolved(w: Warehouse) -> DataFrame:
    """The fact with its keys looked up again, for checking."""
    return (w.fact_sales
            .join(w.dim_customer, "customer_key").join(w.dim_product, "product_key")
            .join(w.dim_store, "store_key").join(w.dim_supplier, "supplier_key")
            .join(w.dim_date, "date_key")
            .select("customer_id", "marital_status", "product_id", "price", "store_id",
                    "supplier_id", "full_date", "weekday_flag", "quantity", "revenue"))


def key_report(w: Warehouse) -> DataFrame:
    """Rows, distinct keys and key range per table (the fact's range is not dense)."""
    key_of = dict(zip(TABLES, ["customer_key", "product_key", "store_key", "supplier_key",
                               "date_key", "sales_key"]))
    reports = []
    for name, df in w.tables().items():
        key = F.col(key_of[name])
        dense = F.lit(name != "fact_sales")
        # the year in front lets the fact's keys be grouped year by year
        years = [FACT_PARTITION] if name == "fact_sales" else []
        per_key = df.groupBy(*years, key_of[name]).agg(F.count("*").alias("rows"))
        reports.append(per_key.agg(
            F.sum("rows").alias("row_count"), F.count("*").alias("distinct_keys"),
            F.when(dense, F.min(key)).alias("first_key"),
            F.when(dense, F.max(key)).alias("last_key"),
        ).select(F.lit(name).alias("table_name"), "*"))
    return k.union_all(reports)


def duplicates(t: RetailTables) -> DataFrame:
    return k.union_all([
        k.duplicate_keys(t.customers, "customer_master", "Customer_ID"),
        k.duplicate_keys(t.products, "product_master", "Product_ID"),
        k.duplicate_keys(t.transactions, "transactional_data", "orderID")])


def orphan_counts(t: RetailTables) -> DataFrame:
    missing = {
        "customer_master": k.orphans(t.transactions, t.customers, "Customer_ID"),
        "product_master": k.orphans(t.transactions, t.products, "Product_ID")}
    return k.union_all([
        df.agg(F.count("*").alias("orphan_rows"))
          .select(F.lit(parent).alias("parent_table"), "orphan_rows")
        for parent, df in missing.items()])


def row_counts(t: RetailTables) -> DataFrame:
    return k.row_counts({"customer_master": t.customers, "product_master": t.products,
                         "transactional_data": t.transactions})
