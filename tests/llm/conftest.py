import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text), with further columns whose names operators use themselves."""
    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t), 1, "x", "y", "z", 2, 3)
                for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", copy int, hashes string, component string, "
                                     "found string, nth int, blob int")
    return make


@pytest.fixture(scope="session")
def sql():
    def run(text, folder=SF):
        db = duckdb.connect()
        for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
            db.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
        return db.execute(text).fetchall()
    return run
