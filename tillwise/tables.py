"""The three operational tables and the joined relations every report starts from."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.money import to_cents

TASK_LINES = 250_000  # lines that a task counts orders of, on average
MOST_TASKS = 20_000


def _tasks(lines: DataFrame) -> int:
    fewest = lines.sparkSession.sparkContext.defaultParallelism
    return min(max(-(-lines.count() // TASK_LINES), fewest), MOST_TASKS)


@dataclass(frozen=True)
class RetailTables:
    """Customer master, product master and transactions.

    The joins carry no broadcast hint. Spark broadcasts a master only while its
    size, estimated from the files or measured by adaptive execution, is under
    the broadcast thresholds; above them the join shuffles, and adaptive
    execution splits the partitions of hot customers or products.
    """

    customers: DataFrame
    products: DataFrame
    transactions: DataFrame

    def lines(self, where=None) -> DataFrame:
        found = self.transactions if where is None else self.transactions.where(where)
        return found.drop("row_index")

    def priced_products(self) -> DataFrame:
        return self.products.drop("row_index").withColumn(
            "price_cents", to_cents(F.col("price")))

    def sold(self, where=None) -> DataFrame:
        """Transactions with their product and the line amount in cents."""
        return (self.lines(where).join(self.priced_products(), "Product_ID")
                .withColumn("amount_cents", F.col("quantity") * F.col("price_cents")))

    def product_listing(self, keys: list[str]) -> DataFrame:
        """Products by ``keys`` (with the id): summed prices and number of copies.

        A product listed twice counts twice in a join; here that is a factor, so rows
        that meet the listing need not be added up again.
        """
        return self.priced_products().groupBy(*keys).agg(
            F.sum("price_cents").alias("price_cents"), F.count("*").alias("copies"))

    def sold_by_product(self, keys: list[str], *by: Column | str, orders: bool = False,
                        where=None) -> DataFrame:
        """Units, cents (and orders) per product ``keys``, which hold the id, and ``by``.

        The transactions are added up under the bare id before they meet the product,
        so a product sold in a third of all lines is one row per task when it is
        shuffled, and however large the product master is, no single transaction is
        shuffled to it. Few lines share product and order, so for ``orders`` the lines are
        dealt out by both first, to as many tasks as there are lines for.
        """
        lines = self.lines(where)
        quantity = F.col("quantity").cast("bigint")
        if orders:
            keys_of = [b if isinstance(b, Column) else F.col(b) for b in by]
            lines = lines.select("Product_ID", "orderID", "quantity", *keys_of)
            by = lines.columns[3:]
            found = (lines.repartition(_tasks(lines), "Product_ID", "orderID")
                     .groupBy("Product_ID", *by, "orderID").agg(F.sum(quantity).alias("units"))
                     .groupBy("Product_ID", *by).agg(F.sum("units").alias("units"),
                                                     F.count("orderID").alias("orders")))
        else:
            found = lines.groupBy("Product_ID", *by).agg(F.sum(quantity).alias("units"))
        return (found.join(self.product_listing(keys), "Product_ID")
                .withColumn("quantity", F.col("units") * F.col("copies"))
                .withColumn("amount_cents", F.col("units") * F.col("price_cents")))

    def sold_to(self, where=None) -> DataFrame:
        """``sold`` plus the attributes of the buying customer."""
        return self.sold(where).join(self.customers.drop("row_index"), "Customer_ID")
