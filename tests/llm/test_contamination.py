import random
from collections import Counter

from conftest_llm import rows_of
from tillwise.llm import contamination

RNG = random.Random(7)
ITEM = "item_id long, text string, doc_id long, similarity string"


def words(n):
    return [f"w{RNG.randrange(3000)}" for _ in range(n)]


def setting():
    items = [(i, " ".join(words(n))) for i, n in enumerate((15, 40, 59, 25, 300))]
    items += [(10, "two words"), (11, ""), (12, None), (13, items[1][1]), (None, " ".join(words(30))),
              (14, "same " * 12)]
    rows = []
    for k in range(60):
        text = (RNG.choice(items[:5])[1]).split()
        for _ in range(RNG.randint(0, 4)):
            text[RNG.randrange(len(text))] = "changed" if RNG.random() < 0.5 else "so changed"
        rows.append((k, " ".join(words(RNG.randint(0, 40)) + text + words(RNG.randint(0, 40)))))
    rows += [(100, items[1][1][:-20]), (101, None), (102, ""), (103, "Two, WORDS!"), (104, "two"),
             (105, " ".join(words(100_000)) + "##" + items[2][1].upper() + "%%% " + items[0][1]),
             (106, items[1][1]), (106, items[1][1]), (None, items[3][1]), (107, "same " * 30),
             (108, " ".join(words(500)))]
    return items, rows


def plain(items, rows, least=0.8):
    def grams(w, k):
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for doc_id, text in rows:
        w = contamination.words_of(text)
        for item_id, item in items:
            v = contamination.words_of(item)
            k = min(5, len(v))
            if not v or len(w) < k:
                continue
            n, goal, best = min(len(v), len(w)), grams(v, k), None
            shared = set(goal)
            near = [s for s in range(len(w) - k + 1) if tuple(w[s:s + k]) in shared]
            starts = sorted({s for p in near for s in range(max(0, p + k - n), min(p, len(w) - n) + 1)})
            for s in starts:
                part = grams(w[s:s + n], k)
                joint = (part | goal).total()
                found = (part & goal).total() / joint
                if found >= least and (best is None or found > best[0]):
                    best = found, s, n
            if best:
                out.append((doc_id, item_id, *best))
    return sorted(out, key=repr)


def test_every_window_that_reaches_the_similarity_is_found(docs_of, spark):
    items, rows = setting()
    benchmark = spark.createDataFrame([(i, t, 0, "x") for i, t in items], ITEM)
    found = rows_of(contamination.find(docs_of(rows), benchmark),
                    "doc_id", "item_id", "similarity", "start", "n_words")
    want = plain(items, rows)
    assert len(want) > 40
    assert found == want
    bad = [d for d, *_ in want]
    clean = contamination.clean(docs_of(rows), benchmark)
    assert clean.columns == docs_of([]).columns
    assert rows_of(clean, "doc_id") == sorted(((i,) for i, _ in rows if i not in bad), key=repr)


def test_blocks_of_items_add_up(docs_of, spark, monkeypatch):
    items, rows = setting()
    benchmark = spark.createDataFrame([(i, t, 0, "x") for i, t in items], ITEM)
    whole = rows_of(contamination.find(docs_of(rows), benchmark), "doc_id", "item_id", "start")
    monkeypatch.setattr(contamination, "BLOCK_WORDS", 100)
    assert rows_of(contamination.find(docs_of(rows), benchmark), "doc_id", "item_id", "start") == whole


def test_empty_tables(docs_of, spark):
    items, rows = setting()
    benchmark = spark.createDataFrame([(i, t, 0, "x") for i, t in items], ITEM)
    none = spark.createDataFrame([], ITEM)
    assert contamination.find(docs_of([]), benchmark).count() == 0
    assert contamination.find(docs_of(rows), none).count() == 0
    assert contamination.clean(docs_of(rows), none).count() == len(rows)


def test_the_index_finds_all_within_its_radius():
    import numpy as np
    rng = np.random.default_rng(0)
    items = contamination.Items([(i, " ".join(words(30))) for i in range(50)])
    for i in range(50):
        for bits in range(contamination.RADIUS + 1):
            p = int(items.prints[i])
            for b in rng.choice(64, bits, replace=False):
                p ^= 1 << int(b)
            assert i in items.near(30, p)


def found_by(items, rows):
    known, rolling = contamination.Items(items), contamination.Rolling(contamination._BASE)
    return sorted(((d, known.ids[i], *hit) for d, text in rows for i, hit in contamination.matches(
        text, known, rolling).items()), key=repr)


def test_repeated_shingles_and_small_vocabularies():
    """The item and the document begin with different words of two that alternate: similarity 0.8."""
    assert found_by([(1, "yes no " * 6 + "yes")], [(2, "no yes " * 6 + "no")]) == [(2, 1, 0.8, 0, 13)]
    rng = random.Random(3)
    for size in (2, 3, 5, 20):
        items, rows = [], []
        for i in range(12):
            items.append((i, " ".join(f"w{rng.randrange(size)}" for _ in range(rng.randint(12, 40)))))
        for d in range(40):
            text = items[rng.randrange(12)][1].split()
            if rng.random() < 0.7:
                text[rng.choice((0, 1, -1))] = f"w{rng.randrange(size)}"
            around = [f"w{rng.randrange(size)}" for _ in range(30)]
            rows.append((d, " ".join(around[:rng.randint(0, 30)] + text + around)))
        want = plain(items, rows)
        assert want and found_by(items, rows) == want


def test_a_long_text_of_one_repeated_phrase(monkeypatch):
    import tracemalloc
    items, long = [(1, "on and on " * 10)], "on and on " * 100_000
    tracemalloc.start()
    assert found_by(items, [(1, long)]) == [(1, 1, 1.0, 0, 30)]
    assert tracemalloc.get_traced_memory()[1] < 300_000_000
    tracemalloc.stop()
    rows = [(i, ("x " * i + "on and on " * (7 + i) + "y and on ") * 4) for i in range(12)]
    monkeypatch.setattr(contamination, "STRETCH", 7)  # stretches join without a seam
    monkeypatch.setattr(contamination, "REMEMBERED", 3)
    assert found_by(items, rows) == plain(items, rows)
