"""Reports that follow the stream."""

from pyspark.sql import functions as F

from test_streaming import LINES, masters, write_lines
from tillwise.plans import enriched
from tillwise.sources import files
from tillwise.streaming import running


def plain(rows):
    return sorted(map(repr, (tuple(r) for r in rows.collect())))


def test_running_reports_equal_the_batch_after_a_restart(spark, tmp_path):
    customers, products = masters(spark)

    def follow():
        stream = files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        running.run_to_end(stream, customers, products, str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    seen = []
    for nth, lines in enumerate([LINES[:2], LINES[1:4], [(1, 1000001, "nothing", 1, "2020-01-01"), LINES[0]]]):
        write_lines(tmp_path / "in", f"{nth}.csv", lines)
        seen += lines
        follow()
        rows = [(None, order, customer, product, quantity, day) for order, customer, product, quantity, day in seen]
        t = spark.createDataFrame(rows, "row_index bigint, orderID bigint, Customer_ID bigint, Product_ID string, "
                                        "quantity int, order_date string")
        batch = enriched.enrich(t.withColumn("order_date", F.col("order_date").cast("date")), customers, products)
        for name, of_rows in (("top_customers", enriched.top_customers), ("city_gender", enriched.city_gender),
                              ("category_by_age", enriched.category_by_age), ("monthly_trend", enriched.monthly_trend)):
            want = of_rows(batch)
            got = running.report(spark, str(tmp_path / "out"), name).select(*want.columns)
            assert plain(got) == plain(want), (nth, name)


def test_masters_are_joined_once_a_batch_for_all_reports(spark, tmp_path):
    customers, products = masters(spark)
    write_lines(tmp_path / "in", "0.csv", LINES)
    stream = files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    queries = running.start(stream, customers, products, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    for query in queries:
        query.awaitTermination()
    plans = [q._jsq.explainInternal(False) for q in queries]
    assert [("Join" in p, "StateStoreSave" in p) for p in plans] == [(True, False)] + [(False, True)] * 4


def test_reports_are_empty_while_no_line_meets_its_masters(spark, tmp_path):
    customers, products = masters(spark)
    write_lines(tmp_path / "in", "0.csv", [(1, 5, "nothing", 1, "2020-01-01")])

    def follow():
        stream = files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
        running.run_to_end(stream, customers, products, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    follow()
    assert all(running.report(spark, str(tmp_path / "out"), name).isEmpty() for name in running.KEYS)
    write_lines(tmp_path / "in", "1.csv", LINES)
    follow()
    assert running.report(spark, str(tmp_path / "out"), "city_gender").count() > 0


def test_masters_do_not_come_to_the_driver(spark, tmp_path):
    customers, products = masters(spark)
    write_lines(tmp_path / "in", "0.csv", LINES)
    stream = files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    queries = running.start(stream, customers, products, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    for query in queries:
        query.awaitTermination()
    assert "Broadcast" not in queries[0]._jsq.explainInternal(False)
