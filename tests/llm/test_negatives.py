import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import SF, rows_of
from tillwise.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, q int, row string, low int, cell int"
OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("size", [1, 7, 8, 64, 70])
def test_scores_are_inner_products(size):
    rng = np.random.default_rng(size)
    for most in (1, 200, 1 << 20):
        a = rng.integers(-most, most + 1, (9, size))
        b = rng.integers(-most, most + 1, (30, size))
        b[3] = 0
        b[4] = -most
        found = negatives.scores(negatives.bit_planes(b), negatives.subset_sums(a))
        assert (found == b @ a.T).all()


def setting():
    rng = np.random.default_rng(13)
    center = rng.normal(size=(5, 10))
    rows = [(k, (center[k % 5] + rng.normal(size=10)).astype(np.float32).tolist(), int(rng.integers(0, 4)))
            for k in range(400)]
    one = rows[10][1]
    rows += [(1000 + k, one, k % 4) for k in range(200)]  # a third are copies
    rows += [(500 + k, one, 7) for k in range(3)]  # a rare label
    rows += [(700, None, 1), (701, one, None), (710, [None] + one[1:], 1), (720, [float("nan")] + one[1:], 1),
             (730, [float("inf")] + one[1:], 1), (740, one[:4], 1), (741, one[:4], 1), (742, one[:4], 2),
             (750, [], 1), (751, [], 1), (752, [], 2), (None, one, 1), (None, one, 2), (10, one, 1),
             (760, [1e30] * 10, 1), (770, [0.0] * 10, 3)]
    return rows


def plain(rows, every=10):
    kept = []
    for r, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        q = [int(np.floor(256 * float(np.float32(c)))) for c in v]
        if sum(c * c for c in q) < negatives.LONGEST ** 2:
            kept.append((r, i, label, q))
    out = []
    for r, i, label, q in kept:
        if i is None or i % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, p)), float("inf") if j is None else j, m, j)
                         for s, j, m, p in kept if s != r and len(p) == len(q)), key=lambda x: x[:2])
        for score, _, _, positive in [x for x in scored if x[2] == label][:5]:
            near = [x for x in scored if x[2] != label and 50 * -score <= 100 * -x[0] <= 95 * -score]
            out += [(i, positive, rank, x[3], -score, -x[0]) for rank, x in enumerate(near[:3], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, stretch", [(8192, 65_536), (50, 7)])
def test_equal_to_brute_force_with_odd_rows(spark, block, stretch):
    rows = setting()
    table = spark.createDataFrame([(*r, 1, "r", 2, 3) for r in rows], SCHEMA)
    found = negatives.mine(table, F.col("vec_id") % 10 == 0, block=block, stretch=stretch)
    assert rows_of(found, *OUT) == plain(rows)


def test_empty_table(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(table, F.col("vec_id") % 10 == 0).count() == 0


def test_query_equals_sql(spark, sql):
    found = negatives.op13_hard_negatives(spark, SF)
    assert rows_of(found, *OUT) == sorted(sql(negatives.OP13_SQL), key=repr)
