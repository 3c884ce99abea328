"""Stream enrichment with Structured Streaming.

Each micro-batch is joined once with each master as an ordinary query, so adaptive
execution broadcasts a master that is small and splits hot customers when it is
not. Rows, rejects and counts come from that one join; counts are observed while the rows are written, in
the tasks that write them, so a task that runs again is counted once. A batch overwrites its own folder: a batch
that runs again after a failure replaces its rows instead of adding them, and the checkpoint makes it
run again with the same input. Joining needs no state.

After its rows a batch writes the names of the files it took and, last, one row of counts. That row says
that the batch is finished: readers take the rows of such batches only.

* A lost checkpoint adds nothing. A file source hands out whole files, so a query with a fresh checkpoint
  leaves out the lines of files that finished batches of other queries have taken. Batches are named by the
  query and its batch number, so a fresh query does not write over the folders of an older one. Sources
  that are no files keep to their checkpoint.
* Lines of unknown customers and products can wait. With ``rejected``, ``release`` probes the lines that
  wait with the masters of today and moves what they now know into the sink, each line once. Call it
  after masters have been loaded; a line whose master came while its batch ran waits for the next call.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillwise import schemas
from tillwise.plans.enriched import (
    enrich, numbered, probe, probed_counts, probed_rejects, probed_rows)
from tillwise.session import written

BATCH = "batch_id"
EMPTY_BATCH = "none"
RELEASE = "release"
COUNTS = "received long, joined long, dropped long"
SOURCE = "source_file"
WAITING = "orderID long, Customer_ID long, Product_ID string, quantity int, order_date date, missing string"


def to_table_rows(rows: DataFrame) -> DataFrame:
    """Add the row id and load time of the enriched table."""
    columns = [f.name for f in schemas.ENRICHED]
    return (rows.withColumn("transaction_id", F.expr("uuid()"))
            .withColumn("load_timestamp", F.current_timestamp())
            .select(*columns))


def _finish(spark: SparkSession, sink: str, batch: str, row: tuple) -> None:
    (spark.createDataFrame([row], COUNTS).coalesce(1)
     .write.mode("overwrite").parquet(f"{sink}-counts/{BATCH}={batch}"))


def _masters(customers: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (written(numbered(customers, "Customer_ID"), "customers"),
            written(numbered(products, "Product_ID"), "products"))


def _with_source(stream: DataFrame) -> DataFrame:
    """The stream with the file of each line, NULL where the source has no files."""
    try:
        return stream.withColumn(SOURCE, F.col("_metadata.file_path"))
    except AnalysisException:
        return stream.withColumn(SOURCE, F.lit(None).cast("string"))


def _taken(spark: SparkSession, sink: str) -> DataFrame:
    """(source_file, batch_id) of finished batches."""
    files = spark.read.schema(f"{SOURCE} string, {BATCH} string").parquet(f"{sink}-files")
    return files.join(batches(spark, sink).select(BATCH), BATCH, "left_semi")


def start(transactions: DataFrame, customers: DataFrame, products: DataFrame, sink: str,
          checkpoint: str, interval: str | None = None,
          rejected: str | None = None) -> StreamingQuery:
    """Start enriching ``transactions`` (a stream) into Parquet under ``sink``.

    Without ``interval`` the query takes everything available and stops; with one
    it keeps running. Dropped rows go to ``rejected`` when that is given. The masters are those of
    the start; later ones reach waiting lines by ``release``.
    """
    spark = transactions.sparkSession
    nothing = spark.createDataFrame([], transactions.schema)
    create_sink(spark, sink, to_table_rows(enrich(nothing, customers, products)).schema)
    if rejected:
        spark.createDataFrame([], WAITING).write.mode("ignore").parquet(f"{rejected}/{BATCH}={EMPTY_BATCH}")
    customers, products = _masters(customers, products)

    others: list[DataFrame | None] = []

    def not_taken(batch: DataFrame, query: str) -> DataFrame:
        """The lines of files no other query has finished. A sink has one running query at a time, so
        the list is made once, with the first batch."""
        if not others:
            taken = (_taken(spark, sink).where(~F.col(BATCH).startswith(f"{query}-"))
                     .select(SOURCE).distinct())
            others.append(None if taken.isEmpty() else written(taken, "taken-files"))
        return batch if others[0] is None else batch.join(others[0], SOURCE, "left_anti")

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{query}-{batch_id}"
        fresh = not_taken(batch, query)
        probed = probe(fresh, customers, products)
        if rejected:  # joined once for rows and rejects; a lost copy is computed again
            probed = probed.persist()
        seen = Observation()  # counted while the rows are written, after the joins
        rows = to_table_rows(probed_rows(probed.observe(seen, *probed_counts())))
        rows.write.mode("overwrite").parquet(f"{sink}/{BATCH}={name}")
        if rejected:
            probed_rejects(probed).write.mode("overwrite").parquet(f"{rejected}/{BATCH}={name}")
            probed.unpersist()
        (fresh.where(F.isnotnull(SOURCE)).select(SOURCE).distinct()
         .write.mode("overwrite").parquet(f"{sink}-files/{BATCH}={name}"))
        _finish(spark, sink, name, tuple(seen.get[n] for n in ("received", "joined", "dropped")))

    writer = (_with_source(transactions).writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_to_end(*args, **kwargs) -> StreamingQuery:
    query = start(*args, **kwargs)
    query.awaitTermination()
    return query


def create_sink(spark: SparkSession, sink: str,
                schema: T.StructType = schemas.ENRICHED) -> None:
    """An empty enriched table, unless the sink already exists."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(f"{sink}/{BATCH}={EMPTY_BATCH}")
    (spark.createDataFrame([], f"{SOURCE} string")
     .write.mode("ignore").parquet(f"{sink}-files/{BATCH}={EMPTY_BATCH}"))
    (spark.createDataFrame([(0, 0, 0)], COUNTS).coalesce(1)
     .write.mode("ignore").parquet(f"{sink}-counts/{BATCH}={EMPTY_BATCH}"))


def batches(spark: SparkSession, sink: str) -> DataFrame:
    """(batch_id, received, joined, dropped) of every finished batch."""
    return spark.read.schema(f"{COUNTS}, {BATCH} string").parquet(f"{sink}-counts")


def counts(spark: SparkSession, sink: str) -> DataFrame:
    """Rows received, joined and dropped by all finished batches. A line that was released later counts
    among the joined ones, and no longer among the dropped."""
    return batches(spark, sink).agg(*[F.sum(c).alias(c) for c in ("received", "joined", "dropped")])


def _finished(spark: SparkSession, sink: str, folder: str) -> DataFrame:
    """The rows under ``folder`` of finished batches."""
    rows = (spark.read.option("basePath", folder).parquet(folder)
            .withColumn(BATCH, F.col(BATCH).cast("string")))
    return rows.join(batches(spark, sink).select(BATCH), BATCH, "left_semi")


def read_enriched(spark: SparkSession, sink: str, with_batch: bool = False) -> DataFrame:
    """The rows of finished batches, on request with the batch that wrote each."""
    rows = _finished(spark, sink, sink)
    return rows if with_batch else rows.drop(BATCH)


def read_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Every line that was dropped when it came, whether or not it was released later."""
    return spark.read.option("basePath", folder).parquet(folder).drop(BATCH)


# --- lines that wait for their customer or product ---

def _releases(spark: SparkSession, sink: str) -> int:
    """How many releases have finished."""
    return batches(spark, sink).where(F.col(BATCH).startswith(f"{RELEASE}-")).count()


def waiting(spark: SparkSession, sink: str, rejected: str) -> DataFrame:
    """The lines that wait now: those the last release left, and those dropped by batches since."""
    done, dropped = _releases(spark, sink), _finished(spark, sink, rejected)
    if not done:
        return dropped.drop(BATCH)
    last = f"{rejected}-left/{done}"
    since = dropped.join(spark.read.parquet(f"{last}/covered"), BATCH, "left_anti").drop(BATCH)
    return spark.read.parquet(f"{last}/lines").unionByName(since)


def release(spark: SparkSession, customers: DataFrame, products: DataFrame, sink: str, rejected: str) -> None:
    """Probe the lines that wait with these masters and move those now known into the sink.

    The release is a batch of its own: its rows, the lines it leaves and the batches it covers are written
    first, its counts last, so a release that failed is simply called again and overwrites what it had
    written. The stream may run meanwhile: batches that finish after the list of covered ones
    was written are the next release's. Two releases of one sink must not run at once.
    """
    nth = _releases(spark, sink) + 1
    name, folder = f"{RELEASE}-{nth}", f"{rejected}-left/{nth}"
    batches(spark, sink).select(BATCH).write.mode("overwrite").parquet(f"{folder}/covered")
    covered = spark.read.parquet(f"{folder}/covered")
    lines = spark.read.option("basePath", rejected).parquet(rejected).withColumn(BATCH, F.col(BATCH).cast("string"))
    lines = lines.join(covered, BATCH, "left_semi")
    if nth > 1:
        last = f"{rejected}-left/{nth - 1}"
        lines = lines.join(spark.read.parquet(f"{last}/covered"), BATCH, "left_anti").drop(BATCH).unionByName(
            spark.read.parquet(f"{last}/lines"))
    probed = probe(lines, *_masters(customers, products)).persist()
    to_table_rows(probed_rows(probed)).write.mode("overwrite").parquet(f"{sink}/{BATCH}={name}")
    probed_rejects(probed).write.mode("overwrite").parquet(f"{folder}/lines")
    received, joined, dropped = probed.agg(*probed_counts()).first()
    # the lines were received, and counted as dropped, by the batches that brought them
    _finish(spark, sink, name, (0, joined, dropped - received))
    probed.unpersist()
