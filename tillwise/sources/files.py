"""File sources with declared schemas, and sinks."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise import schemas
from tillwise.functions.calendar import STORED_YEAR
from tillwise.tables import RetailTables

# The CSV dialect and the file names of the three inputs.
CSV_DIALECT = {"header": "true", "sep": ",", "quote": '"', "lineSep": "\n",
               "dateFormat": "yyyy-MM-dd", "enforceSchema": "true"}
FILES = {"customers": "customer_master_data.csv", "products": "product_master_data.csv",
         "transactions": "transactional_data.csv"}
SCHEMAS = {"customers": schemas.CUSTOMER_MASTER, "products": schemas.PRODUCT_MASTER,
           "transactions": schemas.TRANSACTIONS}


def csv_by_position(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by position under a header row that is skipped; bad fields become NULL."""
    return spark.read.schema(schema).options(**CSV_DIALECT).csv(path)


def csv_by_name(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Columns by header name, in whatever order the file has them."""
    raw = spark.read.options(**CSV_DIALECT).csv(path)
    return raw.select(*[_parsed(raw, field) for field in schema])


def _parsed(raw: DataFrame, field: T.StructField):
    header = schemas.HEADER_ALIASES.get(field.name, field.name)
    if header not in raw.columns:
        header = field.name
    if header not in raw.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return F.col(f"`{header}`").try_cast(field.dataType).alias(field.name)


def csv_stream(spark: SparkSession, folder: str, schema: T.StructType = schemas.TRANSACTIONS,
               files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """New CSV files of a folder as a stream."""
    reader = spark.readStream.schema(schema).options(**CSV_DIALECT)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.csv(folder)


def read_csv(spark: SparkSession, folder: str) -> RetailTables:
    return RetailTables(**{
        name: csv_by_position(spark, f"{folder}/{FILES[name]}", SCHEMAS[name]) for name in FILES})


def read_parquet(spark: SparkSession, folder: str) -> RetailTables:
    stored = dict(SCHEMAS, transactions=T.StructType(
        [*schemas.TRANSACTIONS, T.StructField(STORED_YEAR, T.IntegerType())]))
    return RetailTables(**{
        name: spark.read.schema(stored[name]).parquet(f"{folder}/{name}") for name in FILES})


def read_tables(spark: SparkSession, customers: str = "customer_master",
                products: str = "product_master",
                transactions: str = "transactional_data") -> RetailTables:
    """Tables of the session catalog."""
    return RetailTables(spark.table(customers), spark.table(products), spark.table(transactions))


def read_jdbc(spark: SparkSession, url: str, bounds: tuple[int, int],
              properties: dict | None = None, transaction_partitions: int = 64) -> RetailTables:
    """Tables of a database; the transactions are split by order id over ``bounds``, so no
    task reads them all."""
    def table(name, **split):
        return spark.read.jdbc(url, name, properties=properties or {}, **split)

    return RetailTables(
        table("customer_master"), table("product_master"),
        table("transactional_data", column="orderID", lowerBound=bounds[0], upperBound=bounds[1],
              numPartitions=transaction_partitions))


def write_staging(t: RetailTables, folder: str) -> RetailTables:
    """Replace the staged Parquet copies and return tables that read them.

    Transactions are stored by order year, and the rebalance hint lets adaptive
    execution split or merge the years into files of the advisory partition size.
    Written masters have a known size, by which Spark decides to broadcast them.
    """
    dated = t.transactions.withColumn(STORED_YEAR, F.year("order_date"))
    writers = {
        "customers": t.customers.write, "products": t.products.write,
        "transactions": dated.hint("rebalance", STORED_YEAR).write.partitionBy(STORED_YEAR)}
    with ThreadPoolExecutor(len(writers)) as jobs:  # three independent jobs
        list(jobs.map(lambda name: writers[name].mode("overwrite").parquet(
            f"{folder}/{name}"), writers))
    spark = t.transactions.sparkSession
    return RetailTables(
        customers=spark.read.schema(t.customers.schema).parquet(f"{folder}/customers"),
        products=spark.read.schema(t.products.schema).parquet(f"{folder}/products"),
        transactions=spark.read.schema(dated.schema).parquet(f"{folder}/transactions"))


def parquet_stream(folder: str, like: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream with the columns of ``like``."""
    reader = like.sparkSession.readStream.schema(like.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def write_bucketed(t: RetailTables, buckets: int, prefix: str = "") -> RetailTables:
    """Catalog tables bucketed by product, so that fact and product join in place.

    Worth it once products no longer fit a broadcast.
    """
    def save(df, name, *keys):
        writer = df.write.mode("overwrite").format("parquet")
        if keys:
            writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
        writer.saveAsTable(prefix + name)

    save(t.customers, "customer_master", "Customer_ID")
    save(t.products, "product_master", "Product_ID")
    save(t.transactions, "transactional_data", "Product_ID")
    return read_tables(t.transactions.sparkSession, prefix + "customer_master",
                       prefix + "product_master", prefix + "transactional_data")
