import numpy as np
import pytest

from conftest_llm import SF, rows_of
from tillwise.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, x int"


def setting():
    rng = np.random.default_rng(4)
    rows, center = [], rng.normal(size=(4, 16))
    for k in range(300):
        v = center[k % 4] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.27, 1.0])
        rows.append((k, v.astype(np.float32).tolist(), k % 3 if k % 7 else 0))
    one = rows[10][1]
    rows += [(400 + k, one, rows[10][2]) for k in range(20)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [0.0] * 16, 1),
             (504, [float("nan")] + one[1:], 1), (505, [float("inf")] + one[1:], 1),
             (506, [None] + one[1:], 1), (507, one, None), (508, one, None), (509, one[:15], 1),
             (510, one[:15], 1), (None, one, rows[10][2]), (400, one, rows[10][2]),
             (511, [x * 1e30 for x in one], rows[10][2]), (512, [3.0], 2), (513, [0.5], 2),
             (514, [-2.0], 2)]
    return rows


def plain(rows, threshold=0.93):
    def good(v, label):
        return label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
    x = [np.array(np.array(v, np.float32), float) if good(v, l) else None for _, v, l in rows]
    linked = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= threshold:
                    linked[i].append(j)
                    linked[j].append(i)
    out, group = [], [None] * len(rows)
    for i in range(len(rows)):
        if group[i] is None:
            seen, front = {i}, [i]
            while front:
                for j in linked[front.pop()]:
                    if j not in seen:
                        seen.add(j)
                        front.append(j)
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            for j in seen:
                group[j] = min(ids) if ids else None
        out.append((rows[i][0], len(linked[i]), group[i], rows[i][0] == group[i]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile", [2048, 40, 7])
def test_links_and_components_equal_brute_force(spark, tile):
    rows = setting()
    table = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    found = vectors.near_duplicates(table, tile=tile)
    assert rows_of(found, "vec_id", "n_links", "component_id", "kept") == plain(rows)


def test_query_equals_sql(spark, sql):
    found = vectors.op4_embedding_near_dedup(spark, SF)
    assert rows_of(found, "vec_id", "n_links", "component_id", "kept") == sorted(
        sql(vectors.OP4_SQL), key=repr)


def test_an_empty_table(spark):
    assert vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_give_each_pair_once():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3, 12))[rng.integers(0, 3, 1300)] + rng.normal(size=(1300, 12)) * 0.25
    y = vectors.unit(x).astype(np.float32)
    true = vectors.unit(x) @ vectors.unit(x).T >= 0.93
    i, j = vectors.close_in_blocks(y, y, x, x, 0.93, True)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, np.argwhere(np.triu(true, 1)).tolist()))
    i, j = vectors.close_in_blocks(y[:700], y[700:], x[:700], x[700:], 0.93, False)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, np.argwhere(true[:700, 700:]).tolist()))


def test_pairs_are_given_up_only_below_the_threshold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 48)) * np.linspace(2, 0.1, 48)
    x[100:] = x[:100] + rng.normal(size=(100, 48)) * 0.15
    y = vectors.unit(x)
    i, j = vectors.close_pairs(y.astype(np.float32), y.astype(np.float32), x, x, 0.93)
    want = np.argwhere(y @ y.T >= 0.93)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, want.tolist()))
