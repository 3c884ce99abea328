import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwise import schemas  # noqa: E402
from tillwise.session import create_session  # noqa: E402
from tillwise.tables import RetailTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session("local[8]", 4, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CUSTOMERS = [  # id, gender, age, occupation, city, stay, married
    (1, "F", "0-17", 10, "A", "2", 0),
    (2, "M", "55+", 16, "C", "4+", 1),
    (3, "M", "26-35", 16, "B", "0", None),
    (4, "F", "26-35", 3, "B", "1", 2),
]
PRODUCTS = [  # id, category, price, store, supplier
    ("P1", "Toys", "10.00", 1, 7),
    ("P2", "Toys", "20.00", 1, 8),
    ("P3", "Grocery", "2.50", 2, 7),
]


class Shop:
    """Builds small retail tables from short tuples."""

    def __init__(self, spark):
        self.spark = spark

    def customers(self, rows=CUSTOMERS):
        return self.spark.createDataFrame(
            [(i, *row) for i, row in enumerate(rows)], schemas.CUSTOMER_MASTER)

    def products(self, rows=PRODUCTS):
        full = [(i, pid, category, Decimal(price), store, supplier,
                 None if store is None else f"Store {store}", f"Supplier {supplier}")
                for i, (pid, category, price, store, supplier) in enumerate(rows)]
        return self.spark.createDataFrame(full, schemas.PRODUCT_MASTER)

    def transactions(self, rows):
        """(order, customer, product, quantity, "yyyy-mm-dd" or None)"""
        full = [(i, order, customer, product, quantity, day and dt.date.fromisoformat(day))
                for i, (order, customer, product, quantity, day) in enumerate(rows)]
        return self.spark.createDataFrame(full, schemas.TRANSACTIONS)

    def tables(self, rows, customers=CUSTOMERS, products=PRODUCTS):
        return RetailTables(self.customers(customers), self.products(products),
                            self.transactions(rows))


@pytest.fixture(scope="session")
def shop(spark):
    return Shop(spark)
