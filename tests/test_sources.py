import datetime as dt
from decimal import Decimal as D

import pytest

from tillwise import schemas
from tillwise.plans import shoppers
from tillwise.sources import files

CUSTOMER_CSV = """,Customer_ID,Gender,Age,Occupation,City_Category,Stay_In_Current_City_Years,Marital_Status
0,1000001,F,0-17,10,A,2,0
1,1000002,M,55+,16,C,4+,0
"""
PRODUCT_CSV = """,Product_ID,Product_Category,price$,storeID,supplierID,storeName,supplierName
0,P00069042,Home & Kitchen,77.51,1,2,"Tech, Haven",Samsung
1,P00248942,Grocery,9.63,3,4,Photo World,Canon
"""
TRANSACTION_CSV = """,orderID,Customer_ID,Product_ID,quantity,date
0,9914432,1000001,P00069042,1,2020-12-29
1,1676537,1000002,P00248942,3,2017-03-27
"""


@pytest.fixture()
def folder(tmp_path):
    for name, text in zip(files.FILES.values(), [CUSTOMER_CSV, PRODUCT_CSV, TRANSACTION_CSV]):
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_csv_by_position(spark, folder):
    t = files.read_csv(spark, folder)
    product = t.products.orderBy("row_index").first()
    assert (product.price, product.storeName) == (D("77.51"), "Tech, Haven")
    line = t.transactions.orderBy("row_index").first()
    assert (line.orderID, line.order_date) == (9914432, dt.date(2020, 12, 29))
    assert [r.total_purchase for r in shoppers.by_gender(t).orderBy("Gender").collect()] == [
        D("77.51"), D("28.89")]


def test_csv_by_name_ignores_order_and_bad_values(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("price$,Product_ID,storeID,extra\n1.50,P1,4,x\nfree,P2,,y\n")
    got = files.csv_by_name(spark, str(path), schemas.PRODUCT_MASTER).orderBy("Product_ID").collect()
    assert [(r.Product_ID, r.price, r.storeID, r.supplierName) for r in got] == [
        ("P1", D("1.50"), 4, None), ("P2", None, None, None)]


def test_staging_round_trip_and_replace(spark, folder, tmp_path):
    target = str(tmp_path / "staged")
    t = files.read_csv(spark, folder)
    files.write_staging(t, target)
    staged = files.write_staging(t, target)
    assert staged.transactions.count() == 2
    again = files.read_parquet(spark, target)
    assert again.transactions.drop("order_year").exceptAll(t.transactions).isEmpty()
    assert shoppers.by_gender(again).exceptAll(shoppers.by_gender(t)).isEmpty()


def test_year_reaches_the_scan_of_staged_transactions(spark, folder, tmp_path):
    staged = files.write_staging(files.read_csv(spark, folder), str(tmp_path / "staged"))
    plan = shoppers.gender_age_quarter(staged, 2020)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert "GreaterThanOrEqual(order_date,2020-01-01)" in plan
    assert "SortMergeJoin" not in plan


def test_catalog_tables_bucketed_by_product_join_in_place(spark, folder):
    t = files.write_bucketed(files.read_csv(spark, folder), 4, prefix="bucketed_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = t.sold().select("amount_cents")._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan.split("== Physical Plan ==")[1]
        assert t.sold().count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("customer_master", "product_master", "transactional_data"):
            spark.sql(f"DROP TABLE bucketed_{name}")
