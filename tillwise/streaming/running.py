"""Reports that follow the stream: states added up batch by batch, read at any time.

The stream meets the masters once: a first query writes what the reports need of each enriched line, and the
reports follow what it has written, so masters are shuffled once a batch and not once for each report, and
never sent to the driver. Each report is a streaming aggregation over those lines, so Spark keeps its groups in the state
store and a batch only touches the groups it has lines for. A batch writes those groups, with their
totals so far, to its own folder; a batch that runs again after a failure overwrites it, and the
checkpoint gives it the same lines and the same state. The report of now is each group's latest
row. Groups are few against the lines: one per customer, city, category or month. Checkpoints and folders
of the earlier form, in which each report joined the masters itself, cannot be continued.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwise.functions import calendar as cal
from tillwise.functions.money import from_cents, to_cents
from tillwise.operators.ranking import top_k
from tillwise.plans.enriched import enrich
from tillwise.streaming.enrichment import BATCH

KEYS: dict[str, Callable[[], list[Column]]] = {
    "top_customers": lambda: [F.col("customer_id"), F.col("gender"), F.col("age")],
    "city_gender": lambda: [F.col("city_category"), F.col("gender")],
    "category_by_age": lambda: [F.col("age"), F.col("product_category")],
    "monthly_trend": lambda: [cal.month_start(F.col("order_date")).alias("start")]}

LINES = "lines"
# The columns that the reports need of an enriched line.
COLUMNS = ["customer_id", "gender", "age", "city_category", "product_category", "order_date", "total_amount"]


def start(transactions: DataFrame, customers: DataFrame, products: DataFrame, folder: str, checkpoint: str,
          interval: str | None = None) -> list[StreamingQuery]:
    """Start the four reports over a stream of ``transactions``. Without ``interval`` they take everything
    available and stop; the lines are then written before this returns."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    cents = to_cents(F.col("total_amount"))
    # a broadcast would take whole masters through the driver with every batch
    lines = enrich(transactions, customers.hint("merge"), products.hint("merge")).select(*COLUMNS)
    joined = (lines.writeStream.format("parquet").option("path", f"{folder}/{LINES}")
              .option("checkpointLocation", f"{checkpoint}/{LINES}").trigger(**trigger).start())
    if not interval:
        joined.awaitTermination()

    def follow(name: str) -> StreamingQuery:
        written = transactions.sparkSession.readStream.schema(lines.schema).parquet(f"{folder}/{LINES}")
        totals = written.groupBy(*KEYS[name]()).agg(F.count("*").alias("lines"), F.sum(cents).alias("cents"))

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/{name}/{BATCH}={batch_id}")

        return (totals.writeStream.outputMode("update").foreachBatch(write)
                .option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger).start())
    return [joined, *(follow(name) for name in KEYS)]


def run_to_end(*args, **kwargs) -> None:
    for query in start(*args, **kwargs):
        query.awaitTermination()


def totals(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Each group of a report with its ``lines`` and ``cents`` so far."""
    path = f"{folder}/{name}"
    rows = spark.read.option("basePath", path).parquet(path)
    keys = [c for c in rows.columns if c not in ("lines", "cents", BATCH)]
    latest = F.max_by(F.struct("lines", "cents"), F.col(BATCH).cast("long"))
    return rows.groupBy(*keys).agg(latest.alias("now")).select(*keys, "now.*")


def report(spark: SparkSession, folder: str, name: str, k: int = 10) -> DataFrame:
    """One of the reports as it stands."""
    rows, money = totals(spark, folder, name), from_cents(F.col("cents"))
    if name == "top_customers":
        spent = rows.select("customer_id", "gender", "age", money.alias("total_spent"))
        return top_k(spent, [F.desc("total_spent"), "customer_id"], k)
    if name == "city_gender":
        return rows.select("city_category", "gender", F.col("lines").alias("orders"), money.alias("revenue"))
    if name == "category_by_age":
        return rows.select("age", "product_category", F.col("lines").alias("purchases"))
    return rows.select(cal.month_label(F.col("start")).alias("month"), money.alias("revenue"))
