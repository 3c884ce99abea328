import random

from tillwise.llm.components import components


def test_chains_stars_loops_and_repeats(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 80)]
    edges += [(rng.randrange(5000, 5200), rng.randrange(5000, 5200)) for _ in range(150)]
    edges += [(7, 7), (1, 2), (2, 1)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"]
           for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    assert got == {x: root(x) for x in list(parent)}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
