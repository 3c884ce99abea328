import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from conftest_llm import SF
from tillwise.llm import packing
from tillwise.llm.tables import table
from tillwise.llm.vocabulary import vocabulary_path

PATH = vocabulary_path(packing.VOCABULARY)


MODEL = Tokenizer.from_file(PATH)


def library_ids(text):
    return MODEL.encode(text or "", add_special_tokens=False).ids + [packing.END]


HOSTILE = ["", " ", "It's I'LL they'Re ''s 's's x'll1'd", "ÉCOLE école École ſtraße İi Σας ΟΔΟΣ",
           "a<|endoftext|>b <|startoftext|> <|END|> <| |>", "x\x1cy\x1dz\x85  w　v​q",
           "日本語 テキスト 12３４ ½ ² ٣", "🙂🙂 ȩ́ ﬁ Å", "a_b-c--d 1,234.5 $%^ `~`",
           "\x00\x01 \x7f", "ǅ ŉ ſ ŸŸ ĸ", "\ud800".encode("utf-8", "replace").decode(), "w" * 5000]


def test_ids_equal_the_library():
    words = packing.Words(PATH)
    rng = np.random.default_rng(11)
    signs = list("abzABZ0'’sSlLtTdDmMrRvVeE.,-_<|>éÉßſİ́ \n\t\x0b\x1c\x85 Σσς日½")
    texts = HOSTILE + ["".join(rng.choice(signs, int(rng.integers(1, 40)))) for _ in range(3000)]
    for text, ids in zip(texts, words.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text), repr(text)


def test_memory_of_words_is_bounded_and_forgets_nothing_needed(monkeypatch):
    monkeypatch.setattr(packing, "_REMEMBERED", 20)
    monkeypatch.setattr(packing, "TOGETHER", 200)
    words = packing.Words(PATH)
    rng = np.random.default_rng(1)
    texts = [" ".join(f"word{i}" for i in rng.integers(0, 90, 60)) for _ in range(30)] + [None]
    for text, ids in zip(texts, words.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)
    assert len(words.words) < 150


def fewest(lengths, capacity):
    """Sequences of the best packing, by trying all subsets for the first piece."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for n in range(len(rest) + 1):
        for chosen in combinations(range(len(rest)), n):
            if first + sum(rest[i] for i in chosen) <= capacity:
                left = [x for i, x in enumerate(rest) if i not in chosen]
                best = min(best, 1 + fewest(left, capacity))
    return best


def test_bound_never_exceeds_the_best_packing():
    rng = np.random.default_rng(2)
    tight = 0
    for _ in range(150):
        capacity = int(rng.integers(6, 24))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 8))).tolist()
        least = packing.bound(np.array(lengths), capacity)[0]
        best = fewest(lengths, capacity)
        assert least <= best
        tight += least == best
    assert tight > 130


def test_bound_sees_more_than_the_sum():
    assert packing.bound(np.full(10, 6), 10)[0] == 10
    assert packing.bound(np.full(10, 4), 11)[0] == 5
    assert packing.bound(np.array([5] * 9 + [7] * 2), 14)[0] == 6
    assert packing.bound(np.zeros(0, np.int64), 14) == (0, 0.0)


def test_best_fit_takes_the_fullest_that_fits():
    assert packing.best_fit(np.array([7, 6, 4, 3, 3]), 10).tolist() == [0, 1, 1, 0, 2]


def checked(rows, capacity):
    """(ids of documents, number of sequences) after all contract rules are seen to hold."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by_doc, len(by_sequence)


@pytest.mark.parametrize("capacity, shard, fan", [(64, 16, 3), (64, 10_000, 4), (4096, 32, 2)])
def test_packs_whole_documents_gaplessly(spark, capacity, shard, fan):
    docs = table(spark, SF, "documents")
    found = packing.pieces(docs, PATH, capacity)
    packed, told = packing.pack(found, capacity, shard, fan)
    rows = packed.collect()
    by_doc, n = checked(rows, capacity)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert by_doc.keys() == texts.keys()
    crc = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows}
    for i, text in texts.items():
        ids = MODEL.encode(text or "", add_special_tokens=False).ids + [1]
        parts = [ids[at:at + capacity] for at in range(0, len(ids), capacity)]
        assert sorted(by_doc[i]) == [(k, k * capacity, len(p)) for k, p in enumerate(parts)]
        assert all(crc[i, k] == zlib.crc32(np.array(p, "<u4").tobytes()) for k, p in enumerate(parts))
    sequences, least = packing.certificate(packed, capacity)
    assert sequences == n and least <= n <= least * 1.01 + 1
    for row in told.collect():
        assert row["certified"] == (row["sequences"] == row["least"]) and row["least"] <= row["sequences"]


def test_exchange_saves_sequences(spark):
    """Many small shards alone waste a part of a sequence each."""
    rng = np.random.default_rng(5)
    rows = [(k, k, 0, 0, int(x), 0) for k, x in enumerate(rng.integers(1, 60, 600))]
    found = spark.createDataFrame(rows, "row long, doc_id long, piece int, start long, length int, ids_crc32 long")
    packed, told = packing.pack(found, 100, 8, 4)
    first = sum(r["sequences"] for r in told.where("round = 0").collect())
    sequences, least = packing.certificate(packed, 100)
    assert checked(packed.collect(), 100)[1] == sequences
    assert sequences < first - 20 and sequences <= least + 3


def test_odd_rows(docs_of):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (None, "a b"), (3, "word " * 300_000), (4, " \n ")]
    packed, _ = packing.pack(packing.pieces(docs_of(rows), PATH))
    found = packed.collect()
    by_doc, n = checked(found, 4096)
    assert by_doc[1] == [(0, 0, 1)] and by_doc[2] == [(0, 0, 1)] * 2 and by_doc[None] == [(0, 0, 3)] * 2
    assert sum(x[2] for x in by_doc[3]) == 300_001 and len(by_doc[3]) == 74 and n == 74
    none, told = packing.pack(packing.pieces(docs_of([]), PATH))
    assert none.count() == 0 and told.count() == 0
