import random

import numpy as np
import xxhash

from conftest_llm import rows_of
from tillwise.llm import simhash

RNG = random.Random(3)


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or (
        [b" ".join(words)] if words else [])
    values = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(prints):
    """Smallest id reachable, by comparing all with all."""
    left, found = list(range(len(prints))), {}
    while left:
        group, front = set(), [left[0]]
        while front:
            i = front.pop()
            group.add(i)
            front += [j for j in left if j not in group
                      and (prints[i] ^ prints[j]).bit_count() <= 4 and j not in front]
        left = [i for i in left if i not in group]
        for i in group:
            found[i] = group
    return found


def words(n):
    return " ".join(RNG.choice("abcdefghijkl") + str(RNG.randrange(50)) for _ in range(n))


def texts():
    base = [words(n) for n in (300, 250, 40, 7, 3, 1)]
    rows = [(k, t) for k, t in enumerate(base, 10)]
    for k in range(30):  # near copies of a long text: one word changed
        w = base[0].split()
        w[RNG.randrange(len(w))] = "changed"
        rows.append((100 + k, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \n\t "), (5, base[1].upper()), (203, base[1]),
             (203, base[1]), (None, base[1]), (None, words(60)), (204, "É é É"),
             (205, words(200_000)), (206, base[3].replace(" ", "\x0b\x1c ")), (207, " a b c d")]
    return rows


def test_every_row_gets_its_fingerprint_and_component(docs_of):
    rows = texts()
    found = simhash.near_duplicates(docs_of(rows))
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(prints)
    want = []
    for k, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in groups[k] if rows[j][0] is not None]
        want.append((doc_id, prints[k], min(ids) if ids else None))
    got = [(i, f % (1 << 64), c) for i, f, c in rows_of(found, "doc_id", "fingerprint", "component_id")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = simhash.keep_one(docs_of(rows))
    assert kept.count() == len({id(g) for g in groups.values()})
    assert kept.columns == docs_of([]).columns
    assert {r["doc_id"] for r in kept.collect()} == {w[2] for w in want}


def test_fingerprints_four_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    shared = []
    for prints in (a, b):
        keys, at = simhash.keys_of(prints)
        sets = [set() for _ in prints]
        for key, position in zip(keys.tolist(), at.tolist()):
            sets[position].add(key)
        shared.append(sets)
    assert all(x & y for x, y in zip(*shared))


def test_a_crowded_key_is_compared_in_blocks(spark):
    """Fingerprints that all share keys, in blocks of eight."""
    rng = np.random.default_rng(2)
    prints = [0]
    for _ in range(300):
        p = prints[rng.integers(len(prints))]
        for bit in rng.choice(20, 3, replace=False):
            p ^= 1 << int(bit)
        prints.append(p)
    prints = sorted(set(prints))
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "print long"), block=8)
    from tillwise.llm.components import components
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    groups = plain_components(prints)
    want = {prints[i]: min(prints[j] for j in g) for i, g in groups.items() if len(g) > 1}
    assert found == want
    assert edges.count() < len(prints) * len(prints) / 4


def test_an_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.keep_one(docs_of([])).count() == 0
