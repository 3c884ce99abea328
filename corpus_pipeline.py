"""A corpus pipeline over ``documents``: each stage works on all that the one before kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import contamination, pieces, quality, secrets, simhash
from tillwise.llm.tables import keep, table
from tillwise.llm.vocabulary import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: four-word shingles, four bits at most."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secrets.redact(docs, secrets.update_ledger(docs, secrets.ledger_folder(spark)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as ids of pieces."""
    return pieces.encode(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", accept_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("sentencepiece", encode_pieces),
]

ORACLE_SQL = None  # neither the classifier nor the segmentation is expressible


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
