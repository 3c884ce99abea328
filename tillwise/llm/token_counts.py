"""Token counts of whole texts, from counts of distinct pre-tokens.

No piece of the vocabulary holds a space after another character, and none holds a line feed.
So merges never cross the start of a run of spaces or either side of a line feed, and the
count of a text is the sum over its pre-tokens cut there. The library counts each distinct
pre-token once; no ids are kept.

Frequent pre-tokens are counted first and travel to the tasks as a table of at most
``FREQUENT`` entries of at most ``LONGEST`` characters, ``TABLE_BYTES`` in all. It only saves shuffling: whatever
it lacks goes through the general way, where per-document frequencies meet the piece counts by
pre-token. The heavy keys are thus never shuffled, and those longer than ``LONGEST`` are spread over up to
``SALTS`` places, each of which counts them once.

Results: null and empty texts have 0 bytes and 0 tokens; repeated rows each come out; a null
id is kept; an empty table gives no rows; further columns of the input are ignored.
"""

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.tables import table
from tillwise.llm.vocabulary import vocabulary_path

LIMIT = 4096
FREQUENT = 1 << 18
LONGEST = 256
TABLE_BYTES = 32 << 20
SALTS = 64
_SPACE = "▁"  # fixed value: the vocabulary's sign for a space
_PRETOKEN = re.compile(f"\n+|[ {_SPACE}]*[^ {_SPACE}\n]+|[ {_SPACE}]+")
_AT_ONCE = 1 << 22  # characters of a text whose pre-tokens are listed at once
_DISTINCT = 200_000


def pretokens(text: str | None) -> Counter:
    """Frequencies of the pre-tokens of a text. The library puts a space before a text."""
    if not text:
        return Counter()
    if len(text) <= _AT_ONCE:
        return Counter(_PRETOKEN.findall(" " + text))
    found, matches = Counter(), _PRETOKEN.finditer(" " + text)
    while part := [m.group() for m in islice(matches, 1 << 16)]:
        found.update(part)
    return found


class Pieces:
    """Piece counts of pre-tokens. A line feed before the pre-token keeps the library's
    leading space away from it; both are pieces of their own."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def __call__(self, tokens: list[str]) -> list[int]:
        return [len(ids) - 2 for ids in self.model.encode(
            ["\n" + t for t in tokens], num_threads=1)]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pre-tokens with their counts, per task; those seen once among the last ``_DISTINCT``
    are no candidates for the table of frequent ones."""
    found: Counter = Counter()
    def flush() -> pa.RecordBatch:
        often = [(t, n) for t, n in found.items() if n > 1 and len(t) <= LONGEST]
        found.clear()
        return pa.RecordBatch.from_pydict(
            {"token": pa.array([t for t, _ in often], pa.string()),
             "n": pa.array([n for _, n in often], pa.int64())})
    for batch in batches:
        for text in batch.column("text"):
            found.update(pretokens(text.as_py()))
            if len(found) > _DISTINCT:
                yield flush()
    yield flush()


def frequent_pieces(docs: DataFrame, path: str, size: int = FREQUENT) -> dict[str, int]:
    """Piece counts of the ``size`` most frequent short pre-tokens: a table of bounded size."""
    counts = (docs.select("text").mapInArrow(_frequencies, "token string, n long")
              .groupBy("token").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "token").limit(size))
    # the most frequent come first, so a bound on bytes leaves out none that is hot
    so_far = F.sum(F.octet_length("token")).over(Window.orderBy(F.desc("n"), "token"))
    tokens = counts.select("token", so_far.alias("bytes")).where(F.col("bytes") <= TABLE_BYTES).select(
        "token").toArrow().column("token").to_pylist()
    return dict(zip(tokens, Pieces(path)(tokens), strict=True))


_ROWS = pa.schema([("doc_id", pa.int64()), ("copy", pa.int32()), ("token", pa.string()),
                   ("freq", pa.int32()), ("base", pa.int64()), ("n_bytes", pa.int64())])


def _documents(batches: Iterator[pa.RecordBatch], known: dict[str, int]
               ) -> Iterator[pa.RecordBatch]:
    """One row per document with the pieces of its frequent pre-tokens (freq 0), and one row per
    other pre-token of it."""
    out: list[list] = [[] for _ in _ROWS]
    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array(x, f.type) for x, f in zip(out, _ROWS, strict=True)], schema=_ROWS)
        for x in out:
            x.clear()
        return made
    get = known.get
    for batch in batches:
        ids, copies = batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist()
        for doc_id, copy, n_bytes, text in zip(ids, copies, batch.column("n_bytes").to_pylist(),
                                               batch.column("text"), strict=True):
            base, rare, freqs = 0, [], []
            for token, freq in pretokens(text.as_py()).items():
                pieces = get(token)
                if pieces is None:
                    rare.append(token)
                    freqs.append(freq)
                else:
                    base += pieces * freq
            # a document's own row goes where the hash of its text sends it
            n = len(rare) + 1
            out[0] += [doc_id] * n
            out[1] += [copy] * n
            out[2] += [*rare, f"{copy:x}"]
            out[3] += [*freqs, 0]
            out[4] += [*[None] * len(rare), base]
            out[5] += [*[None] * len(rare), n_bytes]
            if len(out[0]) >= 50_000:
                yield flush()
    yield flush()


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Pieces per row, of rows in order of their token: each distinct one is counted once."""
    pieces = Pieces(path)
    last, last_n = None, 0
    for batch in batches:
        rare = [f > 0 for f in batch.column("freq").to_pylist()]
        coded = batch.column("token").filter(pa.array(rare)).dictionary_encode()
        tokens = coded.dictionary.to_pylist()
        carried = bool(tokens) and tokens[0] == last
        counts = [last_n] * carried + pieces(tokens[carried:])
        if tokens:
            last, last_n = tokens[-1], counts[-1]
        each = iter(coded.indices.to_pylist())
        total = [counts[next(each)] * f if f else b for f, b in zip(
            batch.column("freq").to_pylist(), batch.column("base").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("copy"), batch.column("n_bytes"),
             pa.array([int(not r) for r in rare], pa.int32()), pa.array(total, pa.int64())],
            names=["doc_id", "copy", "n_bytes", "rows", "pieces"])


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT,
                 frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(frequent_pieces(docs, path, frequent))
    texts = docs.select("doc_id", F.hash("text").alias("copy"), "text", F.octet_length(
        F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    rows = texts.mapInArrow(
        lambda b: _documents(b, known.value),
        "doc_id long, copy int, token string, freq int, base long, n_bytes long")
    # a token too long for that table may be hot: it is counted in up to SALTS places
    salt = F.when(F.length("token") > LONGEST, F.pmod(F.hash("doc_id", "copy"), F.lit(SALTS)))
    counted = (rows.repartition(F.col("token"), salt).sortWithinPartitions("token").mapInArrow(
        lambda b: _count(b, path), "doc_id long, copy int, n_bytes long, rows int, pieces long"))
    # ``copy`` tells texts of one id apart, and four bytes of it are shuffled with every row;
    # equal rows add up to a multiple of the count of one, and are told apart again at the end
    total = (counted.groupBy("doc_id", "copy").agg(
        F.max("n_bytes").alias("n_bytes"), F.sum("rows").alias("rows"),
        F.expr("sum(pieces) div sum(rows)").alias("n_tokens"))
        .withColumn("nth", F.explode(F.expr("sequence(1, rows)"))))
    return total.select("doc_id", "n_bytes", "n_tokens",
                        (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())
