"""Enriched transactions: the joined row, what fails to join, and reports on the result."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.money import from_cents, to_cents
from tillwise.operators.ranking import top_k

# Names in the enriched table of the columns of both masters.
CUSTOMER_COLUMNS = {
    "Customer_ID": "customer_id", "Gender": "gender", "Age": "age", "Occupation": "occupation",
    "City_Category": "city_category", "Stay_In_Current_City_Years": "stay_years",
    "Marital_Status": "marital_status"}
PRODUCT_COLUMNS = {
    "Product_ID": "product_id", "Product_Category": "product_category", "price": "price",
    "storeID": "store_id", "supplierID": "supplier_id", "storeName": "store_name",
    "supplierName": "supplier_name"}
COPY = "copy_of_key"


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def _lines(transactions: DataFrame) -> DataFrame:
    return transactions.select(
        F.col("orderID").alias("order_id"), "order_date", "quantity",
        F.col("Customer_ID").alias("customer_id"), F.col("Product_ID").alias("product_id"))


def _enriched_columns() -> list:
    who, what = list(CUSTOMER_COLUMNS.values())[1:], list(PRODUCT_COLUMNS.values())[1:]
    amount = (F.col("quantity") * F.col("price")).cast("decimal(12,2)")
    return ["order_id", "order_date", "quantity", "customer_id", *who, "product_id", *what,
            amount.alias("total_amount")]


def enrich(transactions: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Inner join with both masters plus ``total_amount``; works on batches and streams."""
    return (_lines(transactions).join(_renamed(customers, CUSTOMER_COLUMNS), "customer_id")
            .join(_renamed(products, PRODUCT_COLUMNS), "product_id").select(*_enriched_columns()))


# --- one probe of both masters, for rows, rejects and counts together ---

def numbered(master: DataFrame, key: str) -> DataFrame:
    """A master with a running number among the rows of a key, for ``probe``. Write it before use: a
    plain table can be broadcast, or its hot keys split, where a window below the join could not."""
    by = Window.partitionBy(key).orderBy(*[c for c in master.columns if c != key])
    return master.withColumn(COPY, F.row_number().over(by))


def probe(transactions: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Each line with what the ``numbered`` masters know of it, in one left join with each: ``missing`` names
    the masters that do not know it, ``first`` is true for one row of a line, however often a
    master repeats its keys."""
    who = _renamed(customers, CUSTOMER_COLUMNS | {COPY: "nth_customer"})
    what = _renamed(products, PRODUCT_COLUMNS | {COPY: "nth_product"})
    no_customer, no_product = F.col("nth_customer").isNull(), F.col("nth_product").isNull()
    missing = (F.when(no_customer & no_product, "customer and product")
               .when(no_customer, "customer").when(no_product, "product"))
    first = (F.coalesce("nth_customer", F.lit(1)) == 1) & (F.coalesce("nth_product", F.lit(1)) == 1)
    return (_lines(transactions).join(who, "customer_id", "left").join(what, "product_id", "left")
            .select(*_enriched_columns(), missing.alias("missing"), first.alias("first")))


def probed_rows(probed: DataFrame) -> DataFrame:
    """The rows of ``enrich``."""
    return probed.where("missing IS NULL").drop("missing", "first")


def probed_rejects(probed: DataFrame) -> DataFrame:
    """The rows of ``unmatched``."""
    return probed.where("missing IS NOT NULL AND first").select(
        F.col("order_id").alias("orderID"), F.col("customer_id").alias("Customer_ID"),
        F.col("product_id").alias("Product_ID"), "quantity", "order_date", "missing")


def probed_counts() -> list:
    """Aggregates over a probe: lines received, rows enriched and lines dropped."""
    return [F.count_if("first").alias("received"), F.count_if(F.isnull("missing")).alias("joined"),
            F.count_if(F.isnotnull("missing") & F.col("first")).alias("dropped")]


def unmatched(transactions: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions the inner join drops, with the reason."""
    known_customer = customers.select("Customer_ID").distinct().withColumn("_c", F.lit(True))
    known_product = products.select("Product_ID").distinct().withColumn("_p", F.lit(True))
    reason = (F.when(F.col("_c").isNull() & F.col("_p").isNull(), "customer and product")
              .when(F.col("_c").isNull(), "customer").when(F.col("_p").isNull(), "product"))
    return (transactions.join(known_customer, "Customer_ID", "left")
            .join(known_product, "Product_ID", "left")
            .withColumn("missing", reason).where("missing IS NOT NULL")
            .select("orderID", "Customer_ID", "Product_ID", "quantity", "order_date", "missing"))


def enrichment_counts(transactions: DataFrame, customers: DataFrame,
                      products: DataFrame) -> DataFrame:
    """Rows received, enriched and dropped, in one pass over the transactions."""
    known_customer = customers.groupBy("Customer_ID").agg(F.count("*").alias("_c"))
    known_product = products.groupBy("Product_ID").agg(F.count("*").alias("_p"))
    copies = F.coalesce(F.col("_c") * F.col("_p"), F.lit(0))
    return (transactions.join(known_customer, "Customer_ID", "left")
            .join(known_product, "Product_ID", "left")
            .agg(F.count("*").alias("received"),
                 F.coalesce(F.sum(copies), F.lit(0)).alias("joined"),
                 F.count_if(copies == 0).alias("dropped")))


# --- reports on the enriched table ---

def _revenue(name: str):
    return from_cents(F.sum(to_cents(F.col("total_amount")))).alias(name)


def top_customers(rows: DataFrame, k: int = 10) -> DataFrame:
    spent = rows.groupBy("customer_id", "gender", "age").agg(_revenue("total_spent"))
    return top_k(spent, [F.desc("total_spent"), "customer_id"], k)


def city_gender(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("city_category", "gender")
            .agg(F.count("*").alias("orders"), _revenue("revenue"))
            .orderBy("city_category", "gender"))


def category_by_age(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("age", "product_category").agg(F.count("*").alias("purchases"))
            .orderBy("age", F.desc("purchases"), "product_category"))


def monthly_trend(rows: DataFrame) -> DataFrame:
    months = rows.groupBy(cal.month_start(F.col("order_date")).alias("start")).agg(
        _revenue("revenue"))
    return months.select(cal.month_label(F.col("start")).alias("month"), "revenue").orderBy("month")


def order_lookup(rows: DataFrame, order_id: int, k: int = 10) -> DataFrame:
    return rows.where(F.col("order_id") == order_id).orderBy("product_id", "quantity").limit(k)
