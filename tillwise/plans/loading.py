"""Loads that keep their constraints, and dimension keys that outlast a load."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.operators import keys as k
from tillwise.plans import warehouse as w
from tillwise.session import written
from tillwise.tables import RetailTables

# The primary key of each table.
PRIMARY = {"customer_master": "Customer_ID", "product_master": "Product_ID", "transactional_data": "orderID"}


@dataclass(frozen=True)
class Load:
    """The accepted tables, and by table the rejected rows with ``rule`` and ``copies``."""

    accepted: RetailTables
    rejected: dict[str, DataFrame]


def enforce(t: RetailTables, transaction_key: str = PRIMARY["transactional_data"]) -> Load:
    """What primary and foreign keys let in. Of repeated keys the first row stays; a transaction needs
    a customer and a product that are let in, unless it names none. Accepted and rejected rows together
    are the input, row by row."""
    customers, no_customers = k.enforce_key(t.customers, PRIMARY["customer_master"])
    products, no_products = k.enforce_key(t.products, PRIMARY["product_master"])
    customers, products = written(customers, "customers"), written(products, "products")
    unique, repeated = k.enforce_key(t.transactions, transaction_key)
    unique = written(unique, "unique")
    known, no_customer = k.enforce_parent(unique, customers, "Customer_ID")
    accepted, no_product = k.enforce_parent(known, products, "Product_ID")
    return Load(RetailTables(customers, products, written(accepted, "transactions")), {
        "customer_master": no_customers, "product_master": no_products,
        "transactional_data": k.union_all([repeated, no_customer, no_product])})


def load_counts(t: RetailTables) -> DataFrame:
    """Rows given, accepted and rejected per table, and what the accepted ones amount to."""
    load = enforce(t)
    given = {"customer_master": t.customers, "product_master": t.products, "transactional_data": t.transactions}
    kept = dict(zip(given, (load.accepted.customers, load.accepted.products, load.accepted.transactions),
                    strict=True))
    def told(name: str, df: DataFrame, column: str, value) -> DataFrame:
        """One row with one of the numbers."""
        value = F.coalesce(value, F.lit(0)).cast("bigint")
        return df.agg(value.alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("of"), "n")
    parts = []
    for name in given:
        parts += [told(name, given[name], "given_rows", F.count("*")),
                  told(name, kept[name], "accepted_rows", F.count("*")),
                  told(name, load.rejected[name], "rejected_rows", F.sum("copies"))]
    parts.append(told("transactional_data", kept["transactional_data"], "accepted_units", F.sum("quantity")))
    columns = ["given_rows", "accepted_rows", "accepted_units", "rejected_rows"]
    return k.union_all(parts).groupBy("table_name").agg(*[
        F.coalesce(F.sum(F.when(F.col("of") == c, F.col("n"))), F.lit(0)).alias(c) for c in columns])


def rejected_rows(t: RetailTables) -> DataFrame:
    """Rejected transactions by rule and year of order: rows and distinct orders."""
    rejected = enforce(t).rejected["transactional_data"]
    return (rejected.groupBy("rule", F.year("order_date").alias("order_year"))
            .agg(F.sum("copies").alias("rejected_rows"), F.count_distinct("orderID").alias("orders"))
            .orderBy("rule", "order_year"))


# --- keys that outlast a load ---

DIMENSIONS = {
    "dim_customer": ("customer_key", w.customer_rows), "dim_product": ("product_key", w.product_rows),
    "dim_store": ("store_key", w.store_rows), "dim_supplier": ("supplier_key", w.supplier_rows),
    "dim_date": ("date_key", w.date_rows)}


def load_dimensions(t: RetailTables, folder: str) -> dict[str, DataFrame]:
    """All dimensions after this load; members known from earlier loads keep their keys."""
    return {name: k.extend_key_map(rows(t), f"{folder}/{name}", key, rows(t).columns)
            for name, (key, rows) in DIMENSIONS.items()}


def key_growth(first: RetailTables, second: RetailTables, folder: str) -> DataFrame:
    """Per dimension, over two loads: members before and after, members of the first load that kept
    their key, distinct keys, and the least key of a new member."""
    before = {n: written(d, "keys") for n, d in load_dimensions(first, folder).items()}
    after = load_dimensions(second, folder)
    rows = []
    for name, (key, _) in DIMENSIONS.items():
        natural = [c for c in after[name].columns if c != key]
        old = before[name].select(F.xxhash64(*natural).alias("member"), F.col(key).alias("old_key"))
        both = after[name].select(F.xxhash64(*natural).alias("member"), key).join(old, "member", "left")
        rows.append(both.agg(
            F.count("old_key").alias("members_before"), F.count("*").alias("members_after"),
            F.count_if(F.col(key) == F.col("old_key")).alias("kept_keys"),
            F.count_distinct(key).alias("distinct_keys"),
            F.min(F.when(F.col("old_key").isNull(), F.col(key))).alias("first_new_key"))
            .select(F.lit(name).alias("table_name"), "*"))
    return k.union_all(rows)
