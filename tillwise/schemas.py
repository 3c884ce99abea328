"""Declared schemas of every table; nothing is inferred from files.

Keys are ``bigint``: an ``int`` order or customer id overflows long before the
table sizes this package is meant for.
"""

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_long, _int, _str, _date = T.LongType(), T.IntegerType(), T.StringType(), T.DateType()

# Column names, order and types of the operational tables.
CUSTOMER_MASTER = _schema(
    ("row_index", _long),
    ("Customer_ID", _long),
    ("Gender", _str),
    ("Age", _str),
    ("Occupation", _int),
    ("City_Category", _str),
    ("Stay_In_Current_City_Years", _str),
    ("Marital_Status", _int),
)
PRODUCT_MASTER = _schema(
    ("row_index", _long),
    ("Product_ID", _str),
    ("Product_Category", _str),
    ("price", PRICE),
    ("storeID", _int),
    ("supplierID", _int),
    ("storeName", _str),
    ("supplierName", _str),
)
TRANSACTIONS = _schema(
    ("row_index", _long),
    ("orderID", _long),
    ("Customer_ID", _long),
    ("Product_ID", _str),
    ("quantity", _int),
    ("order_date", _date),
)

# CSV header names that differ from the column names.
HEADER_ALIASES = {"price": "price$", "order_date": "date"}

# Columns of the enriched transaction table.
ENRICHED = _schema(
    ("transaction_id", _str),
    ("order_id", _long),
    ("order_date", _date),
    ("quantity", _int),
    ("customer_id", _long),
    ("gender", _str),
    ("age", _str),
    ("occupation", _int),
    ("city_category", _str),
    ("stay_years", _str),
    ("marital_status", _int),
    ("product_id", _str),
    ("product_category", _str),
    ("price", PRICE),
    ("store_id", _int),
    ("supplier_id", _int),
    ("store_name", _str),
    ("supplier_name", _str),
    ("total_amount", AMOUNT),
    ("load_timestamp", T.TimestampType()),
)
