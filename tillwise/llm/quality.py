"""Quality scores of texts: ridge regression on random Fourier features, calibrated.

The inputs of a score are statistics of the text alone: how its characters fall into
classes, how words and lines repeat, how long they are. Random cosines of the standardised
statistics approximate a Gaussian kernel. Partitions sum their share of the normal equations
of ridge regression; the sums have a fixed size. Labelled rows held back from the fit turn raw
scores into probabilities by isotonic regression.

Labels come from rows whose crc32(doc_id as text) mod 4 is not 2. At most ``TRAIN_ROWS`` of
them are used, those whose ids hash lowest; of these a remainder of 3 calibrates and
the others fit. Rows without a document, an id or a label teach nothing; of repeated ids one
row counts. Without any usable label every score is 0.5; with labels of one kind it is that.

Results: null and empty texts are scored like any other (all their statistics are zero);
repeated rows each come out; a null id is not held out; an empty table gives no rows; other
columns of the input are never read.
"""

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.tables import filtered, keep, sliced, table
from tillwise.llm.words import word_blocks

TRAIN_ROWS = 20_000
FIT_PARTITIONS = 8
COSINES = 384
RIDGE = 1e-3
THRESHOLD = 0.7
_SEED = 8

# ---- statistics of one text -----------------------------------------------------------

_SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASSES = bytearray(256)  # 0 other bytes of UTF-8 and controls
for _chars, _class in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"abcdefghijklmnopqrstuvwxyz", 2),
                       (b"0123456789", 3), (b" \t\v\f\r", 4), (b"\n", 5), (b".,", 6),
                       (bytes(c for c in _SYMBOLS if c not in b".,"), 7)):
    for _c in _chars:
        _CLASSES[_c] = _class
FEATURES = ("chars", "words", "upper", "digits", "spaces", "line_feeds", "stops", "symbols",
            "most_symbol", "word_length", "one_char_words", "symbol_words", "distinct_words",
            "most_word", "same_as_before", "same_as_second_before", "distinct_lines",
            "line_length", "shouting_words")


def statistics(text: str | None) -> list[float]:
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data.strip():
        return [0.0] * len(FEATURES)
    n = len(data)
    codes = np.frombuffer(data, np.uint8)
    per_byte = np.bincount(codes, minlength=256)
    per_class = np.bincount(np.frombuffer(bytes(_CLASSES), np.uint8), per_byte, minlength=8)
    letters = max(per_class[1] + per_class[2], 1)
    count, length, single, symbolic, shouting, again, second = 0, 0, 0, 0, 0, 0, 0
    found: Counter = Counter()
    last: list[bytes] = []
    for words in word_blocks(data):
        found.update(words)
        count += len(words)
        length += sum(map(len, words))
        run = last + words
        again += sum(map(bytes.__eq__, run[1:], run[:-1])) if len(run) > 1 else 0
        second += sum(map(bytes.__eq__, run[2:], run[:-2])) if len(run) > 2 else 0
        last = words[-1:]
    for word, times in found.items():
        single += times * (len(word) == 1)
        symbolic += times * (word[-1] in _SYMBOLS and word[-1:] not in b".,")
        shouting += times * word.isupper()
    lines = [x for x in data.split(b"\n") if x]
    return [math.log1p(n), math.log1p(count), per_class[1] / letters, per_class[3] / n,
            per_class[4] / n, per_class[5] / n, per_class[6] / n, per_class[7] / n,
            max(per_byte[list(_SYMBOLS)]) / n, length / count, single / count, symbolic / count,
            len(found) / count ** 0.9, max(found.values()) / count, again / count,
            second / count, len(set(lines)) / len(lines), math.log1p(n / len(lines)),
            shouting / count]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every row."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(
                    [statistics(t.as_py()) for t in batch.column("text")], pa.list_(pa.float32()))],
                names=["doc_id", "stats"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(of, f"doc_id {kind}, stats array<float>")

# ---- model ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # knots of the calibration
    calibrated: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        inputs = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(inputs @ self.turn + self.shift) * math.sqrt(2 / len(self.shift))
        return np.hstack([waves, np.ones((len(stats), 1))])

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.cosines(stats) @ self.weights, self.raw, self.calibrated)


def remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4


def isotonic(raw: np.ndarray, truth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing function nearest to ``truth``, by pooling neighbours."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # mean, weight, first and last raw score
    for x, y in zip(raw[order].tolist(), truth[order].tolist(), strict=True):
        pools.append([y, 1.0, x, x])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] >= pools[-1][2]):
            mean, weight, _, end = pools.pop()
            head = pools[-1]
            head[0] = (head[0] * head[1] + mean * weight) / (head[1] + weight)
            head[1] += weight
            head[3] = max(head[3], end)
    knots = [(x, p[0]) for p in pools for x in ((p[2], p[3]) if p[3] > p[2] else (p[2],))]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def constant(score: float) -> Model:
    k = len(FEATURES)
    return Model(np.zeros(k), np.ones(k), np.zeros((k, 1)), np.zeros(1), np.zeros(2),
                 np.zeros(1), np.array([score]))


def _normal_equations(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums over ``rows`` (stats, label), which each partition adds up on its own."""
    size = len(model.shift) + 1

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if len(batch):
                x = model.cosines(np.stack(batch["stats"]).astype(float))
                total += x.T @ np.column_stack([x, batch["label"].to_numpy(float)])
        yield pd.DataFrame({"sums": [total.tobytes()]})

    parts = rows.mapInPandas(part, "sums binary").collect()  # FIT_PARTITIONS rows
    total = sum(np.frombuffer(p.sums).reshape(size, size + 1) for p in parts)
    return total[:, :-1], total[:, -1]


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality",
                  most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, label, stats, remainder) of the ``most`` labelled rows whose ids hash lowest. Only their texts
    get statistics here; of several texts of one id the smallest statistics count."""
    known = (labels.where(F.col(label).isin(0, 1) & (remainder() != 2))
             .groupBy("doc_id").agg(F.max(label).cast("double").alias("label")))
    chosen = keep(known.join(docs.select("doc_id"), "doc_id", "left_semi")
                  .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "train-ids")
    texts = docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi")
    one = with_statistics(texts).groupBy("doc_id").agg(F.min("stats").alias("stats"))
    return keep(chosen.join(one, "doc_id").withColumn("remainder", remainder())
                .repartition(FIT_PARTITIONS, "doc_id"), "train")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        most: int = TRAIN_ROWS) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id and ``label``, 0 or 1)."""
    sample = training_rows(docs, labels, label, most)
    local = sample.select("stats", "label", "remainder").toPandas()  # at most ``most`` rows
    if local.empty or local["label"].nunique() == 1:
        return constant(0.5 if local.empty else float(local["label"].iloc[0]))
    x = np.stack(local["stats"]).astype(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    rng = np.random.default_rng(_SEED)
    some = np.clip((x[rng.permutation(len(x))[:512]] - mean) / scale, -8, 8)
    apart = np.sqrt(((some[:, None] - some[None]) ** 2).sum(-1))
    width = max(float(np.median(apart[apart > 0])) if (apart > 0).any() else 1.0, 1e-6)
    model = Model(mean, scale, rng.normal(size=(x.shape[1], COSINES)) / width,
                  rng.uniform(0, 2 * math.pi, COSINES), np.zeros(COSINES + 1),
                  np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    held = local["remainder"] == 3
    if held.all() or not held.any():
        held[:] = False
    gram, target = _normal_equations(
        sample.where("remainder <> 3") if held.any() else sample, model)
    n = int((~held).sum())
    weights = np.linalg.solve(gram + RIDGE * n / 100 * np.eye(len(gram)), target)
    check = local[held] if held.any() else local
    raw, calibrated = isotonic(
        model.cosines(np.stack(check["stats"]).astype(float)) @ weights, check["label"].to_numpy())
    return Model(model.mean, model.scale, model.turn, model.shift, weights, raw, calibrated)


def score_of(spark: SparkSession, model: Model):
    """A column function: the score of an array of statistics."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        if not len(stats):
            return pd.Series([], dtype=float)
        return pd.Series(shared.value.scores(np.stack(stats).astype(float)))
    return score


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality",
           threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text)."""
    score = score_of(docs.sparkSession, fit(docs, labels, label))
    return (with_statistics(docs).withColumn("score", score("stats")).select(
        "doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label))

    def passes():
        model = shared.value
        return lambda text: bool(model.scores(
            np.array([np.float32(statistics(text))], float))[0] >= threshold)
    return filtered(docs, passes)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
