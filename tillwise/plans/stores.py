"""Store and supplier reports, the yearly rollup and the quarterly store view."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions import calendar as cal
from tillwise.functions.money import from_cents
from tillwise.operators import metrics as m
from tillwise.operators.bitmaps import counted, merged, rolled_up, states
from tillwise.operators.crosstab import with_total_row
from tillwise.operators.ranking import top_k, top_k_per_group
from tillwise.session import written
from tillwise.tables import RetailTables

STORE = ["storeID", "storeName"]
SUPPLIER = ["supplierID", "supplierName"]
PRODUCT = ["Product_ID", "Product_Category"]
# Fixed value: the name of the stored view.
QUARTERLY_VIEW = "STORE_QUARTERLY_SALES"


def supplier_products(t: RetailTables) -> DataFrame:
    keys = [*STORE, *SUPPLIER, *PRODUCT]
    return (t.sold_by_product(keys, orders=True)
            .select(*keys, F.col("orders").alias("total_orders"),
                    F.col("quantity").alias("total_quantity"),
                    from_cents(F.col("amount_cents")).alias("total_sales"))
            .orderBy("storeName", "supplierName", F.desc("total_sales"), "Product_ID"))


def supplier_subtotals(t: RetailTables) -> DataFrame:
    """Supplier totals inside each store, then the store total."""
    # suppliers are added up first, so the rollup only sees one row per supplier and store
    suppliers = (t.sold_by_product([*STORE, *SUPPLIER, "Product_ID"])
                 .groupBy(F.struct(*STORE).alias("store"), F.struct(*SUPPLIER).alias("supplier"))
                 .agg(F.sum("amount_cents").alias("amount_cents")))
    is_store = F.grouping("supplier") == 1
    return (suppliers.rollup("store", "supplier")
            .agg(F.grouping("store").alias("everything"),
                 F.when(is_store, "store").otherwise("supplier").alias("level"),
                 m.revenue("total_sales"))
            .where("everything = 0")
            .select("store.*", "supplier.*", "level", "total_sales")
            .orderBy("storeName", "storeID", F.col("level") == "store", "supplierName",
                     "supplierID"))


def top_suppliers(t: RetailTables, k: int = 3) -> DataFrame:
    sales = t.sold_by_product([*STORE, *SUPPLIER, "Product_ID"]).groupBy(*STORE, *SUPPLIER).agg(
        m.revenue("total_sales"), m.distinct("Product_ID", "products_sold"))
    return (top_k_per_group(sales, ["storeID"],
                            [F.desc("total_sales"), *map(F.col, SUPPLIER), F.col("storeName")],
                            k, "sales_rank")
            .orderBy("storeName", "storeID", "sales_rank"))


def yearly_rollup(t: RetailTables, year: int | None = None) -> DataFrame:
    """Store, supplier and product totals with subtotals at every level.

    ``level`` tells a subtotal from a row whose name is missing.
    """
    keys = ["storeName", "supplierName", "Product_ID"]
    sums = {"quantity": F.col("quantity"), "amount_cents": F.col("amount_cents")}
    lines = t.sold(cal.year_condition(t.transactions, year))
    leaves = states(lines, keys, {"total_orders": F.col("orderID")}, sums)
    levels = F.array(*[F.lit(x) for x in ["product", "supplier", "store", "all"]])
    return (rolled_up(leaves, keys, ["total_orders"], list(sums))
            .select(*keys, F.get(levels, F.col("depth")).alias("level"), "depth",
                    m.added_revenue("total_revenue"), F.col("quantity").alias("total_quantity"), "total_orders")
            .orderBy(F.col("depth") == 3, "storeName", F.col("depth") >= 2, "supplierName",
                     F.col("depth") >= 1, F.desc("total_revenue"), "Product_ID")
            .drop("depth"))


def store_summary(t: RetailTables, year: int | None = None) -> DataFrame:
    counts = m.counted_lines(
        t.sold(cal.year_condition(t.transactions, year)), ["storeName"],
        product_count="Product_ID", supplier_count="supplierID", total_orders="orderID")
    stores = counts.select("storeName", "supplier_count", "product_count", "total_orders",
                           F.col("quantity").alias("total_quantity"), m.added_revenue("total_revenue"))
    return (with_total_row(stores, "storeName", ["total_revenue"])
            .orderBy("is_total", F.desc("total_revenue"), "storeName").drop("is_total"))


# --- quarterly view ---

def _view(counts: DataFrame) -> DataFrame:
    year, quarter = F.col("sales_year"), F.col("sales_quarter")
    return counts.select(
        *QUARTER, F.concat(year, F.lit("-Q"), quarter).alias("year_quarter"), "total_orders",
        "unique_customers", F.col("quantity").alias("total_quantity"), m.added_revenue("total_sales"),
        m.added_mean("avg_order_value"), "products_sold", "suppliers_involved")


def store_quarters(t: RetailTables) -> DataFrame:
    """Each distinct count is a pass of its own, so no task holds a copy of its lines for each of them."""
    counts = counted(quarter_states(t), QUARTER, list(COUNTED), m.SUMS)
    return _view(counts).orderBy("storeName", "sales_year", "sales_quarter", "storeID")


# --- the view, stored and kept up to date ---

QUARTER = [*STORE, "sales_year", "sales_quarter"]
COUNTED = {"products_sold": "Product_ID", "suppliers_involved": "supplierID", "total_orders": "orderID",
           "unique_customers": "Customer_ID"}


def quarter_states(t: RetailTables, where=None) -> DataFrame:
    """Mergeable states of the view's rows, for the lines of one load."""
    day = F.col("order_date")
    lines = t.sold(where).withColumns({"sales_year": F.year(day), "sales_quarter": F.quarter(day)})
    return m.line_states(lines, QUARTER, **COUNTED)


def store_load(t: RetailTables, folder: str, where=None) -> None:
    """Add the lines of one load to the stored states under ``folder``, one folder per year. Years
    that the load does not touch keep their files; in the others old and new states are merged, so
    old lines are not read again. A load must be given once: a line given twice would be added twice to
    the sums. Merged states are written aside before they take the old ones' place."""
    spark = t.transactions.sparkSession
    new = written(quarter_states(t, where), "quarter-states")
    years = [r[0] for r in new.select("sales_year").distinct().collect()]  # one row per year
    known = [f for f in new.columns if f != "sales_year"] + ["sales_year"]
    if stored(spark, folder):
        touched = F.col("sales_year").isin([y for y in years if y is not None])
        if None in years:
            touched = touched | F.col("sales_year").isNull()
        old = spark.read.parquet(folder).where(touched).select(*known)
        new = merged(new.select(*known).union(old), QUARTER, m.SUMS)
    new = written(new, "quarter-states")
    (new.select(*known).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sales_year").parquet(folder))


def stored(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def stored_quarters(spark: SparkSession, folder: str) -> DataFrame:
    """The view from its stored states."""
    return _view(counted(spark.read.parquet(folder), QUARTER, list(COUNTED), m.SUMS))


def create_quarterly_view(t: RetailTables, name: str = QUARTERLY_VIEW) -> None:
    store_quarters(t).createOrReplaceTempView(name)


def materialise_quarters(t: RetailTables, path: str) -> DataFrame:
    """Store the view as Parquet, one folder per year, and read it back."""
    view = store_quarters(t)
    view.write.mode("overwrite").partitionBy("sales_year").parquet(path)
    return view.sparkSession.read.parquet(path).select(*view.columns)


def describe(view: DataFrame, spark: SparkSession) -> DataFrame:
    rows = [(i + 1, name, kind) for i, (name, kind) in enumerate(view.dtypes)]
    return spark.createDataFrame(rows, "position int, column_name string, column_type string")


def quarterly_preview(t: RetailTables, k: int = 20) -> DataFrame:
    return store_quarters(t).limit(k)


def _quarter_sales(t: RetailTables, **ids: str) -> DataFrame:
    """Rows of the view with the distinct counts ``ids`` alone."""
    year, quarter = F.year("order_date").alias("sales_year"), F.quarter("order_date").alias("sales_quarter")
    if ids:
        sales = m.counted_lines(t.sold().select("*", year, quarter), QUARTER, **ids).select(
            *QUARTER, *ids, m.added_revenue("total_sales"))
    else:
        sales = t.sold().groupBy(*STORE, year, quarter).agg(m.revenue("total_sales"))
    return sales.withColumn("year_quarter", F.concat("sales_year", F.lit("-Q"), "sales_quarter"))


def store_totals(t: RetailTables, k: int = 10) -> DataFrame:
    totals = _quarter_sales(t).groupBy(*STORE).agg(
        F.sum("total_sales").cast("decimal(20,2)").alias("total_revenue"))
    return (top_k(totals, [F.desc("total_revenue"), "storeName", "storeID"], k)
            .select("storeName", "total_revenue"))


def quarter_trend(t: RetailTables) -> DataFrame:
    return (_quarter_sales(t, total_orders="orderID").groupBy("sales_year", "sales_quarter", "year_quarter")
            .agg(F.sum("total_sales").cast("decimal(20,2)").alias("quarterly_total"),
                 F.sum("total_orders").alias("total_orders"))
            .orderBy("sales_year", "sales_quarter")
            .select("year_quarter", "quarterly_total", "total_orders"))


def best_quarters(t: RetailTables, k: int = 10) -> DataFrame:
    best = top_k_per_group(_quarter_sales(t), ["storeID"],
                           [F.desc("total_sales"), F.col("sales_year"), F.col("sales_quarter"),
                            F.col("storeName")], 1, "rn")
    return (top_k(best, [F.desc("total_sales"), "storeName", "storeID"], k)
            .select("storeName", "year_quarter", "total_sales"))
