import random
import zlib

import numpy as np
import pytest

from conftest_llm import SF, rows_of
from tillwise.llm import quality
from tillwise.llm.tables import table


def test_held_out_rows_are_told_apart(spark):
    found = quality.op8_quality_classifier(spark, SF)
    assert found.dtypes[1:] == [("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    held = [(rows[r["doc_id"]]["predicted"], r["quality"])
            for r in table(spark, SF, "labels").collect() if rows[r["doc_id"]]["held_out"]]
    assert len(held) > 50
    assert sum(p == q for p, q in held) / len(held) > 0.95


def test_only_labels_of_the_other_rows_and_the_text_count(docs_of, spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(("alpha", "beta.", "gamma")) for _ in range(30))
             if i % 3 else "BAD!! " * rng.randint(5, 30)) for i in range(400)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(400)]
    schema = "doc_id long, quality int, toxic int"
    whole = quality.scored(docs_of(rows), spark.createDataFrame(labels, schema))
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    again = quality.scored(docs_of(rows), spark.createDataFrame(turned, schema))
    assert rows_of(whole, "doc_id", "score") == rows_of(again, "doc_id", "score")
    kept = quality.accepted(docs_of(rows), spark.createDataFrame(labels, schema))
    assert kept.columns == docs_of([]).columns
    assert {r["doc_id"] for r in kept.collect()} == {
        r["doc_id"] for r in whole.where("predicted = 1").collect()} == {
        i for i in range(400) if i % 3}


def test_odd_rows_and_tables(docs_of, spark):
    schema = "doc_id long, quality int, toxic int"
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (4, "word " * 300_000), (5, "é"), (6, "   ")]
    none = spark.createDataFrame([], schema)
    found = quality.scored(docs_of(rows), none)
    assert rows_of(found, "score", "predicted") == [(0.5, 0)] * len(rows)
    assert [r["held_out"] for r in found.where("doc_id is null").collect()] == [False]
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (5, 1, 1), (99, 0, 0)], schema)
    assert {r["score"] for r in quality.scored(docs_of(rows), labels).collect()} <= {0.5, 1.0}
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 7)], schema)
    assert quality.scored(docs_of(rows), labels).count() == len(rows)
    assert quality.scored(docs_of([]), labels).count() == 0
    assert quality.accepted(docs_of([]), labels).count() == 0


def test_isotonic_scores_rise_and_pool():
    rng = np.random.default_rng(0)
    raw = np.round(rng.uniform(size=300), 2)
    truth = (rng.uniform(size=300) < raw).astype(float)
    x, y = quality.isotonic(raw, truth)
    assert (np.diff(x) > 0).all() and (np.diff(y) >= 0).all()
    fitted = np.interp(raw, x, y)
    assert fitted.sum() == pytest.approx(truth.sum())
    flat = np.interp(raw, np.sort(x), np.full(len(x), truth.mean()))
    assert ((fitted - truth) ** 2).sum() < ((flat - truth) ** 2).sum()


def test_cosines_approximate_the_kernel():
    rng = np.random.default_rng(0)
    k, width = len(quality.FEATURES), 4.0
    n = 4000
    model = quality.Model(np.zeros(k), np.ones(k), rng.normal(size=(k, n)) / width,
                          rng.uniform(0, 2 * np.pi, n), np.zeros(n + 1), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(20, k))
    waves = model.cosines(x)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width ** 2))
    assert np.abs(waves @ waves.T - kernel).max() < 0.1


def test_scores_equal_a_plain_refit(spark):
    """The whole way again in numpy, row by row of the sample, without partitions."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(np.float32(quality.statistics(r["text"])).tolist())
    truth = {}
    for r in labels.collect():
        if r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["doc_id"] in texts:
            truth[r["doc_id"]] = max(r["quality"], truth.get(r["doc_id"], 0))
    assert len(truth) < quality.TRAIN_ROWS  # so the sample is all of them
    ids = sorted(truth)
    x, y = np.array([min(texts[i]) for i in ids]), np.array([float(truth[i]) for i in ids])
    third = np.array([zlib.crc32(str(i).encode()) % 4 == 3 for i in ids])
    model = quality.fit(docs, labels)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.maximum(x.std(0), 1e-6))
    waves = np.cos(np.clip((x - model.mean) / model.scale, -8, 8) @ model.turn + model.shift)
    z = np.hstack([waves * np.sqrt(2 / len(model.shift)), np.ones((len(x), 1))])
    a, n = z[~third], (~third).sum()
    weights = np.linalg.solve(a.T @ a + quality.RIDGE * n / 100 * np.eye(a.shape[1]), a.T @ y[~third])
    assert np.allclose(weights, model.weights, atol=1e-6)
    raw = z[third] @ weights
    order = np.argsort(raw, kind="stable")
    fitted = y[third][order]
    steps = [max(min(fitted[i:j].mean() for j in range(k + 1, len(fitted) + 1)) for i in range(k + 1))
             for k in range(0, len(fitted), 7)]  # the least and greatest means give the isotonic fit
    assert np.allclose(model.scores(x[third])[order][::7], steps, atol=1e-6)
    scores = {r["doc_id"]: r["score"] for r in quality.scored(docs, labels).collect() if len(texts[r["doc_id"]]) == 1}
    at = {i: k for k, i in enumerate(ids)}
    want = model.scores(x)
    assert all(abs(scores[i] - want[at[i]]) < 1e-9 for i in ids if i in scores)
