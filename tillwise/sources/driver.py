"""Binds the generated order tables (customer, part, orders, lineitem …) to the
retail schema, so that every report runs over them whole."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.tables import RetailTables

# Upper bounds of the account balance bands that stand in for ages.
AGE_BANDS = [(0, "0-17"), (1500, "18-25"), (3000, "26-35"), (4500, "36-45"),
             (6000, "46-50"), (8000, "51-55")]
AGE_ABOVE = "55+"
# Domains of the columns that reports pivot on.
CITIES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
OCCUPATIONS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


LINES = 1000
# Columns the adapter reads from each generated table.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double",
}


def product_id(part_key: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(part_key.cast("string"), 8, "0"))


def customer_master(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    balance = F.col("c_acctbal")
    age = F.when(balance < AGE_BANDS[0][0], AGE_BANDS[0][1])
    for bound, label in AGE_BANDS[1:]:
        age = age.when(balance < bound, label)
    stay = F.col("c_nationkey") % 5
    return (customer
            .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
            .join(region, nation["n_regionkey"] == region["r_regionkey"])
            .select(
                F.lit(None).cast("bigint").alias("row_index"),
                F.col("c_custkey").alias("Customer_ID"),
                F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("Gender"),
                age.otherwise(AGE_ABOVE).alias("Age"),
                F.col("c_mktsegment").alias("Occupation"),
                F.col("r_name").alias("City_Category"),
                F.when(stay == 4, "4+").otherwise(stay.cast("string"))
                 .alias("Stay_In_Current_City_Years"),
                F.when(F.col("c_custkey") % 3 == 0, 1).otherwise(0).alias("Marital_Status")))


def product_master(part: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    suppliers = supplier.agg(F.count("*")).scalar()
    return (part.withColumn("_supplier", F.col("p_partkey") % suppliers)
            .join(supplier, F.col("_supplier") == F.col("s_suppkey"))
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.lit(None).cast("bigint").alias("row_index"),
                product_id(F.col("p_partkey")).alias("Product_ID"),
                F.col("p_type").alias("Product_Category"),
                F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
                F.col("s_nationkey").alias("storeID"),
                F.col("s_suppkey").alias("supplierID"),
                F.col("n_name").alias("storeName"),
                F.col("s_name").alias("supplierName")))


def transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return (lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                # an order has fewer than LINES lines
                (F.col("l_orderkey") * LINES + F.col("l_linenumber")).alias("row_index"),
                F.col("l_orderkey").alias("orderID"),
                F.col("o_custkey").alias("Customer_ID"),
                product_id(F.col("l_partkey")).alias("Product_ID"),
                F.col("l_quantity").cast("int").alias("quantity"),
                F.col("o_orderdate").cast("date").alias("order_date")))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # a declared schema saves the job that would read it from a footer
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def read(spark: SparkSession, folder: str) -> RetailTables:
    read_one = {name: table(spark, folder, name) for name in COLUMNS}
    nation = read_one["nation"]
    return RetailTables(
        customers=customer_master(read_one["customer"], nation, read_one["region"]),
        products=product_master(read_one["part"], read_one["supplier"], nation),
        transactions=transactions(read_one["lineitem"], read_one["orders"]))
