from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sqlchecks import sql
from tillwise.functions import calendar as cal
from tillwise.functions import money
from tillwise.operators.crosstab import crosstab, slug, values_of, with_total_row
from tillwise.sources import files


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def amount(text):
    return F.lit(text).cast(money.MONEY)


@pytest.mark.parametrize("now,before,expected", [
    ("100.05", "100.00", 0.05), ("8001.00", "8000.00", 0.01), ("7999.00", "8000.00", -0.01),
    ("7999.60", "8000.00", -0.01), ("0.00", "5.00", -100.0), ("5.00", "0.00", None)])
def test_change_percent_rounds_half_away_from_zero(spark, now, before, expected):
    assert one(spark, money.change_percent(amount(now), amount(before))) == expected


def test_spark_and_checking_sql_round_alike(spark):
    duckdb = pytest.importorskip("duckdb")
    for cents, n in [(5, 2), (-5, 2), (10, 4), (1, 3), (-1, 3), (199, 200), (10**17 + 1, 2)]:
        text = f"SELECT {sql.money(sql.half_up(str(cents), str(n)))}"
        expected = duckdb.connect().execute(text).fetchall()[0][0]
        assert one(spark, money.mean_money(F.lit(cents).cast("bigint"), F.lit(n))) == expected


def test_mean_of_nothing_is_null(spark):
    assert one(spark, money.mean_money(F.lit(5).cast("bigint"), F.lit(0))) is None
    assert one(spark, money.share_or_zero(amount("0"), amount("0"))) == 0.0


def test_overflow_of_cents_is_an_error_not_a_wrong_total(spark):
    huge = spark.createDataFrame([(2**62,), (2**62,)], "c bigint")
    with pytest.raises(Exception, match="OVERFLOW"):
        huge.agg(F.sum("c")).collect()


def test_crosstab_and_total_row(spark):
    df = spark.createDataFrame([("a", "x y", 1), ("a", "z", 2), ("b", "z", 4)], "r string, c string, n bigint")
    table = crosstab(df, "r", "c", ["x y", "z", "w"], "c_",
                     lambda where: F.sum(F.when(where, F.col("n"))), "total")
    assert sorted(map(tuple, table.collect())) == [("a", 1, 2, 0, 0, 3), ("b", 0, 4, 0, 0, 4)]
    totalled = with_total_row(table, "r", ["c_z", "total"]).orderBy("is_total", "r")
    assert [tuple(r) for r in totalled.select("r", "c_x_y", "c_z", "total").collect()] == [
        ("a", 1, 2, 3), ("b", 0, 4, 4), ("TOTAL", None, 6, 7)]
    assert slug("MIDDLE EAST") == "middle_east" and slug(7) == "7"


def test_crosstab_keeps_what_is_not_listed(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "new", 2), ("a", None, 4)],
                               "r string, c string, n bigint")
    def cell(where):
        return F.sum(F.when(where, F.col("n")))
    table = crosstab(df, "r", "c", ["x"], "c_", cell, "total")
    assert [tuple(r) for r in table.collect()] == [("a", 1, 6, 7)]
    assert values_of(df, "c") == ["new", "x"]


def test_total_row_keeps_a_group_that_is_itself_called_total(spark):
    df = spark.createDataFrame([("TOTAL", 1), ("a", 2), (None, 4)], "r string, n bigint")
    got = with_total_row(df, "r", ["n"])
    assert sorted(map(tuple, got.select("is_total", "n").collect())) == [
        (False, 1), (False, 2), (False, 4), (True, 7)]


def test_latest_year_reads_only_the_last_folder(spark, shop, tmp_path):
    t = files.write_staging(shop.tables(
        [(1, 1, "P1", 1, "2018-05-05"), (2, 1, "P1", 1, "2019-05-05"), (3, 1, "P1", 1, None)]),
        str(tmp_path))
    latest = t.transactions.agg(F.first(cal.latest_day(t.transactions)).alias("d"))
    assert str(latest.first().d) == "2019-05-05"
    recent = t.transactions.where(cal.year_condition(t.transactions, None))
    assert [r.orderID for r in recent.collect()] == [2]
    old = t.transactions.where(cal.preferred_year_condition(t.transactions, 2018))
    assert [r.orderID for r in old.collect()] == [1]
    assert D("1") == D(t.transactions.where(
        cal.last_months_condition(t.transactions, 6)).count())
