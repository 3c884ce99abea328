import datetime as dt
from decimal import Decimal as D

from tillwise import schemas
from tillwise.plans import enriched
from tillwise.sources import files
from tillwise.streaming import enrichment

# order, date, customer, gender, age, occupation, city, stay, married, product, category,
# price, quantity, store, supplier, total
GOLDEN = [
    (9914432, "2020-12-29", 1000001, "F", "0-17", 10, "A", "2", 0, "P00069042",
     "Home & Kitchen", "77.51", 1, "Tech Haven", "Samsung Electronics", "77.51"),
    (1676537, "2017-03-27", 1000002, "M", "55+", 16, "C", "4+", 0, "P00248942",
     "Grocery", "9.63", 3, "Photo World", "Canon Inc.", "28.89"),
    (8910457, "2018-07-15", 1000001, "F", "0-17", 10, "A", "2", 0, "P00087842",
     "Pets", "31.66", 1, "Fashion Hub", "Nike Corporation", "31.66"),
    (4176351, "2019-11-22", 1000005, "M", "26-35", 4, "B", "1", 1, "P00285442",
     "Toys", "34.71", 2, "Home Essentials", "LG Electronics", "69.42"),
    (5523789, "2020-01-10", 1000150, "F", "36-45", 7, "A", "3", 1, "P00112233",
     "Health & Beauty", "45.99", 5, "Wellness Center", "Johnson & Johnson", "229.95"),
]
HEADER = ",orderID,Customer_ID,Product_ID,quantity,date\n"


def masters(spark):
    people = {g[2]: (None, g[2], *g[3:9]) for g in GOLDEN}
    goods = [(None, g[9], g[10], D(g[11]), i, i, g[13], g[14]) for i, g in enumerate(GOLDEN)]
    return (spark.createDataFrame(list(people.values()), schemas.CUSTOMER_MASTER),
            spark.createDataFrame(goods, schemas.PRODUCT_MASTER))


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    body = "".join(f"{i},{','.join(map(str, line))}\n" for i, line in enumerate(lines))
    (folder / name).write_text(HEADER + body)


def run(spark, tmp_path, **kw):
    customers, products = masters(spark)
    stream = files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    enrichment.run_to_end(stream, customers, products, str(tmp_path / "out"),
                          str(tmp_path / "checkpoint"), **kw)
    return enrichment.read_enriched(spark, str(tmp_path / "out"))


LINES = [(g[0], g[2], g[9], g[12], g[1]) for g in GOLDEN]


def test_golden_rows(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", LINES[:2])
    write_lines(tmp_path / "in", "b.csv", LINES[2:])
    got = run(spark, tmp_path)
    assert got.columns == [f.name for f in schemas.ENRICHED]
    facts = {r.order_id: r for r in got.collect()}
    for g in GOLDEN:
        r = facts[g[0]]
        assert (r.order_date, r.customer_id, r.gender, r.age, r.occupation, r.city_category,
                r.stay_years, r.marital_status, r.product_id, r.product_category, r.price,
                r.quantity, r.store_name, r.supplier_name, r.total_amount) == (
            dt.date.fromisoformat(g[1]), *g[2:11], D(g[11]), *g[12:15], D(g[15]))
    assert len({r.transaction_id for r in facts.values()}) == 5
    assert all(r.load_timestamp for r in facts.values())


def test_stream_equals_batch_and_continues_after_a_stop(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", LINES[:3])
    assert run(spark, tmp_path).count() == 3
    write_lines(tmp_path / "in", "b.csv", LINES[3:])
    got = run(spark, tmp_path).drop("transaction_id", "load_timestamp")
    lines = files.csv_by_position(spark, str(tmp_path / "in"), schemas.TRANSACTIONS)
    batch = enriched.enrich(lines, *masters(spark))
    assert got.count() == 5 and got.exceptAll(batch.select(*got.columns)).isEmpty()


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", LINES)
    assert run(spark, tmp_path).count() == 5
    # a lost checkpoint makes the same first batch run again into the same sink
    customers, products = masters(spark)
    stream = files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1)
    enrichment.run_to_end(stream, customers, products, str(tmp_path / "out"),
                          str(tmp_path / "fresh"))
    assert enrichment.read_enriched(spark, str(tmp_path / "out")).count() == 5


def test_unmatched_rows_are_dropped_reported_and_do_not_block(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", LINES[:1] + [
        (1, 5, "P00069042", 1, "2020-01-01"), (2, 1000001, "P0", 1, "2020-01-01"),
        (3, 5, "P0", 1, "2020-01-01")])
    assert run(spark, tmp_path, rejected=str(tmp_path / "rejected")).count() == 1
    rejected = enrichment.read_rejected(spark, str(tmp_path / "rejected"))
    assert {(r.orderID, r.missing) for r in rejected.collect()} == {
        (1, "customer"), (2, "product"), (3, "customer and product")}
    lines = files.csv_by_position(spark, str(tmp_path / "in"), schemas.TRANSACTIONS)
    counts = enriched.enrichment_counts(lines, *masters(spark)).first()
    assert tuple(counts) == (4, 1, 3)


def test_order_lookup(spark):
    customers, products = masters(spark)
    lines = spark.createDataFrame(
        [(None, *line[:4], dt.date.fromisoformat(line[4])) for line in LINES], schemas.TRANSACTIONS)
    found = enriched.order_lookup(enriched.enrich(lines, customers, products), 9914432).collect()
    assert [(r.order_id, r.total_amount) for r in found] == [(9914432, D("77.51"))]


def test_empty_sink_is_created_once_and_rows_are_counted(spark, tmp_path):
    enrichment.create_sink(spark, str(tmp_path / "out"))
    assert enrichment.read_enriched(spark, str(tmp_path / "out")).count() == 0
    write_lines(tmp_path / "in", "a.csv", LINES)
    customers, products = masters(spark)
    stream = files.csv_stream(spark, str(tmp_path / "in"))
    enrichment.run_to_end(stream, customers, products, str(tmp_path / "out"),
                          str(tmp_path / "checkpoint"))
    enrichment.create_sink(spark, str(tmp_path / "out"))
    assert tuple(enrichment.counts(spark, str(tmp_path / "out")).first()) == (5, 5, 0)
    assert enrichment.read_enriched(spark, str(tmp_path / "out")).count() == 5


def test_masters_that_repeat_keys_multiply_rows_but_not_lines(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", LINES + [(1, 5, "P00069042", 1, "2020-01-01"), (2, None, "P0", 1, "")])
    customers, products = masters(spark)
    stream = files.csv_stream(spark, str(tmp_path / "in"))
    enrichment.run_to_end(stream, customers.union(customers), products.union(products), str(tmp_path / "out"),
                          str(tmp_path / "checkpoint"), rejected=str(tmp_path / "rejected"))
    assert tuple(enrichment.counts(spark, str(tmp_path / "out")).first()) == (7, 20, 2)
    assert enrichment.read_enriched(spark, str(tmp_path / "out")).count() == 20
    assert enrichment.read_rejected(spark, str(tmp_path / "rejected")).count() == 2


def test_a_fresh_checkpoint_with_other_batches_adds_only_new_files(spark, tmp_path):
    for nth, name in enumerate("abc"):
        write_lines(tmp_path / "in", f"{name}.csv", LINES[nth:nth + 2] + LINES[:1])
    customers, products = masters(spark)
    out = str(tmp_path / "out")

    def stream(checkpoint, **kw):
        enrichment.run_to_end(files.csv_stream(spark, str(tmp_path / "in"), **kw), customers, products, out,
                              str(tmp_path / checkpoint))
        return sorted(r.order_id for r in enrichment.read_enriched(spark, out).collect())
    want = [line[0] for nth in range(3) for line in LINES[nth:nth + 2] + LINES[:1]]
    assert stream("one", files_per_batch=1) == sorted(want)
    assert stream("two") == sorted(want)  # all files in one batch
    write_lines(tmp_path / "in", "d.csv", LINES[3:])
    assert stream("three", files_per_batch=3) == sorted(want + [line[0] for line in LINES[3:]])
    assert stream("two") == stream("one", files_per_batch=1) == sorted(want + [line[0] for line in LINES[3:]])
    assert tuple(enrichment.counts(spark, out).first()) == (11, 11, 0)


def test_late_masters_release_waiting_lines_once(spark, tmp_path, monkeypatch):
    customers, products = masters(spark)
    out, rejected = str(tmp_path / "out"), str(tmp_path / "rejected")
    early = customers.where("Customer_ID <> 1000001")

    def follow(known):
        enrichment.run_to_end(files.csv_stream(spark, str(tmp_path / "in"), files_per_batch=1), known, products,
                              out, str(tmp_path / "checkpoint"), rejected=rejected)

    def orders():
        return sorted(r.order_id for r in enrichment.read_enriched(spark, out).collect())

    def waits():
        return sorted((r.orderID, r.missing) for r in enrichment.waiting(spark, out, rejected).collect())
    write_lines(tmp_path / "in", "a.csv", LINES + [(7, 5, "P0", 1, "2020-01-01"), LINES[0]])
    follow(early)
    first, third = LINES[0][0], LINES[2][0]
    known = [LINES[1][0], LINES[3][0], LINES[4][0]]
    assert orders() == sorted(known)
    assert waits() == sorted([(first, "customer"), (first, "customer"), (third, "customer"),
                              (7, "customer and product")])
    assert tuple(enrichment.counts(spark, out).first()) == (7, 3, 4)

    enrichment.release(spark, early, products, out, rejected)  # nothing new is known
    assert len(waits()) == 4 and orders() == sorted(known)
    write_lines(tmp_path / "in", "b.csv", [(8, 1000001, "P00087842", 1, "2020-01-02")])
    follow(early)  # a batch after the first release waits with the others
    assert len(waits()) == 5

    finish = enrichment._finish  # the release stops before it is finished ...
    monkeypatch.setattr(enrichment, "_finish", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
    try:
        enrichment.release(spark, customers, products, out, rejected)
    except OSError:
        pass
    assert len(waits()) == 5 and orders() == sorted(known)
    monkeypatch.setattr(enrichment, "_finish", finish)
    for _ in range(2):  # ... and is called again, once more than needed
        enrichment.release(spark, customers, products, out, rejected)
        assert orders() == sorted(known + [first, first, third, 8])
        assert waits() == [(7, "customer and product")]
        assert tuple(enrichment.counts(spark, out).first()) == (8, 7, 1)
    follow(customers)
    assert len(orders()) == 7
