"""Reading the input tables, and tables written between steps."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillwise.session import working_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared working folder and read again: cuts its lineage, so
    a lost executor costs a read and not the whole computation."""
    folder = working_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        found.append(name)
    return found


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def filtered(docs: DataFrame, passes: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows of ``docs`` whose text passes. ``passes`` makes the test once per task."""
    def keep_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = passes()
        for batch in sliced(batches):
            yield batch.filter(pa.array([test(t.as_py()) for t in batch.column("text")], pa.bool_()))
    return docs.mapInArrow(keep_rows, docs.schema)
