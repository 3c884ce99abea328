import hashlib
import random

import pytest

from conftest_llm import SF, rows_of
from tillwise.llm import passages

RNG = random.Random(11)


def words(n, kinds=400):
    return [f"w{RNG.randrange(kinds)}é" for _ in range(n)]


def texts():
    passage, other = words(60), words(25)
    rows = [(k, " ".join(words(30) + passage + words(10))) for k in range(12)]
    rows += [(20, "\n".join(other)), (21, " ".join(words(5) + other)), (22, " ".join(other[:19])),
             (23, " ".join(words(15) + other + other + passage[:20])), (24, None), (25, ""),
             (26, "same " * 80), (27, "a b c " * 30), (None, " ".join(passage)),
             (None, " ".join(passage)), (3, " ".join(other)), (28, " ".join(passage)),
             (28, " ".join(passage)), (29, " ".join(words(100_000, 10 ** 6) + passage)),
             (-5, " ".join(words(3) + passage[:25])), (30, "x" * 3_000_000 + " y")]
    return rows


def plain(rows, window):
    split = [(2 ** 63 - 1 if i is None else i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for (doc_id, _), (i, w) in zip(rows, split):
        gone = set()
        for s in range(len(w) - window + 1):
            if (i, s) > first[tuple(w[s:s + window])]:
                gone.update(range(s, s + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, part_bytes", [(20, 48 << 20), (20, 100_000), (5, 200_000)])
def test_repeated_windows_go(docs_of, window, part_bytes):
    rows = texts()
    found = passages.remove_repeated(docs_of(rows), window, whole=False, part_bytes=part_bytes)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept") == plain(rows, window)


def test_what_is_kept_as_text(docs_of):
    rows = [(1, "a b\tc " * 10), (2, "a b\tc " * 10), (3, "é  ü")]
    found = passages.remove_repeated(docs_of(rows), 20)
    assert {r["doc_id"]: r["kept"] for r in found.collect()} == {
        1: "a b c", 2: "", 3: "é ü"}


def test_query_equals_sql(spark, sql):
    found = passages.op9_substring_dedup(spark, SF)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(
        sql(passages.OP9_SQL), key=repr)


def test_an_empty_table(docs_of):
    assert passages.remove_repeated(docs_of([])).count() == 0
