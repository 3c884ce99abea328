"""Benchmark decontamination: windows of an item's size, found by SimHash, verified exactly.

Words are runs of letters, digits and underscores in lower case, so symbols stuck to a word
do not hide it. A document is contaminated by an item if some window of as many words as the item
has (the whole document, if it is shorter) has a weighted similarity of at least 0.8 with it:
over five-word shingles, each weighing as often as it occurs, the shared weight
divided by the joint weight.

For every item that shares a shingle with a document, the windows of its size around the
shared places get fingerprints (a window that shares no shingle has similarity zero). The features of a
fingerprint are occurrences: the second occurrence of a shingle in a window is another feature than the
first, so the share of common features is the weighted similarity. A
fingerprint has eight blocks of eight bits. Two fingerprints at most 23 bits apart differ in
at most two bits in some block, so an index of all blocks with up to two bits changed finds
every item within that radius. What it finds is verified on the words themselves.

The benchmark is the stated set of queries. It is taken in blocks of about ``BLOCK_WORDS``
words, each of which travels to the tasks; documents are never shuffled. Bit sums follow the windows of a
text in stretches of ``STRETCH``, so a long text needs no more memory than its words and their hashes.

Results: null and empty texts match nothing, and neither do items without words; an item of
fewer than five words has its whole sequence as its one shingle; repeated rows of either table
each get their own results; an empty table gives no rows; other columns may carry any name.
"""

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.passages import Rolling
from tillwise.llm.tables import filtered, table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 23
BLOCK_BITS, BLOCK_RADIUS = 8, 2
BLOCK_WORDS = 2_000_000
_WORD = re.compile(r"\w+")
STRETCH = 4096  # windows with bit sums in memory at once
REMEMBERED = 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier
_NTH = np.uint64(0xD6E8FEB86659FD93)  # another one


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _hashes(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on all bits of a rolling hash."""
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


class Windows:
    """Features of all windows of some size over the shingles of a text."""

    def __init__(self, grams: np.ndarray):
        self.grams, self.n = grams, len(grams) + 1
        kinds, self.kind = np.unique(grams, return_inverse=True)
        self.places = None  # sorted places, kind by kind; not needed where nothing repeats
        if len(kinds) < len(grams):
            self.places = np.sort(self.kind * self.n + np.arange(len(grams)))

    def _features(self, at: np.ndarray, low, high) -> np.ndarray:
        """The shingles at places ``at``, numbered by how often each occurs in [low, high)."""
        hashes = self.grams[at]
        if self.places is not None:
            kind = self.kind[at] * self.n
            before = np.searchsorted(self.places, kind + high) - np.searchsorted(self.places, kind + low)
            hashes = hashes + before.astype(np.uint64) * _NTH
        return _mixed(hashes)

    def prints(self, low: int, high: int, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For windows of ``n`` shingles that start at low to high, in stretches: the first start, the
        fingerprints, and hashes of the windows as bags of shingles."""
        sums, bag = np.zeros(64, np.int32), np.uint64(0)
        for at in range(low, low + n, STRETCH):
            places = np.arange(at, min(at + STRETCH, low + n))
            found = self._features(places, low, places)
            sums = sums + _bits(found).sum(0, dtype=np.int32)
            bag = found.sum(dtype=np.uint64) + bag
        for at in range(low, high + 1, STRETCH):
            end = min(at + STRETCH, high + 1)
            steps = np.arange(at, min(end, high))  # each leads to the window that starts one later
            gone = self._features(steps, steps + 1, steps + n)
            come = self._features(steps + n, steps + 1, steps + n)
            all_sums = np.empty((len(steps) + 1, 64), np.int32)
            all_sums[0] = sums
            np.subtract(_bits(come), _bits(gone), out=all_sums[1:], dtype=np.int32)
            all_sums.cumsum(0, dtype=np.int32, out=all_sums)
            bags = np.append(bag, come - gone).cumsum(dtype=np.uint64)
            yield at, _packed(2 * all_sums[:end - at] > n), bags[:end - at]
            sums, bag = all_sums[-1].copy(), bags[-1]


_NEAR = [np.flatnonzero(np.bitwise_count(np.arange(256, dtype=np.uint8) ^ np.uint8(v))
                        <= BLOCK_RADIUS) for v in range(256)]


class Items:
    """A block of benchmark items: shingles with the sizes of their items, and fingerprints by block."""

    def __init__(self, items: list[tuple[int, str]], n: int = SHINGLE_WORDS):
        rolling = Rolling(_BASE)
        self.ids, self.sizes, self.counts, self.grams = [], [], [], []
        holders = defaultdict(set)
        prints = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            k, at = min(n, len(words)), len(self.ids)
            hashes = _mixed(rolling(_hashes(words), k))
            self.ids.append(item_id)
            self.sizes.append(len(words))
            self.grams.append(k)
            self.counts.append(Counter(zip(*(words[i:] for i in range(k)), strict=False)))
            prints.append(next(Windows(hashes).prints(0, 0, len(hashes)))[1][0])
            for h in hashes.tolist():
                holders[k, h].add(at)
        self.prints = np.array(prints, np.uint64)
        self.by_gram = {}
        for k in sorted({k for k, _ in holders}):
            hashes = np.array(sorted(h for kk, h in holders if kk == k), np.uint64)
            self.by_gram[k] = hashes, [sorted({self.sizes[i] for i in holders[k, h]})
                                       for h in hashes.tolist()]
        # (size, block, value) -> the items of that size with a block at most two bits away
        self.index = defaultdict(list)
        for i, (size, p) in enumerate(zip(self.sizes, self.prints.tolist(), strict=True)):
            for block in range(64 // BLOCK_BITS):
                for value in _NEAR[p >> BLOCK_BITS * block & 255].tolist():
                    self.index[size, block, value].append(i)

    def near(self, size: int, fingerprint: int) -> list[int]:
        """All items of ``size`` words within the radius of a fingerprint."""
        found = {i for block in range(64 // BLOCK_BITS) for i in self.index.get(
            (size, block, fingerprint >> BLOCK_BITS * block & 255), ())}
        return [i for i in found if (int(self.prints[i]) ^ fingerprint).bit_count() <= RADIUS]


def similarity(a: Counter, b: Counter) -> float:
    shared = (a & b).total()
    return shared / (a.total() + b.total() - shared)


def matches(text: str | None, items: Items, rolling: Rolling, least: float = SIMILARITY
            ) -> dict[int, tuple[float, int, int]]:
    """By place of the item: the best similarity, and start and number of words of its window."""
    words = words_of(text)
    best: dict[int, tuple[float, int, int]] = {}
    hashes = _hashes(words)
    near: dict[tuple[int, int], list[int]] = {}
    seen: set[tuple[int, int, int]] = set()  # windows with equal bags of shingles are equally similar
    for k, (known, sizes) in items.by_gram.items():
        if len(words) < k:
            continue
        grams = _mixed(rolling(hashes, k))
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        hits = np.flatnonzero(known[at] == grams)
        if not len(hits):
            continue
        places = defaultdict(list)  # of shared shingles, by window size
        for place, key in zip(hits.tolist(), at[hits].tolist(), strict=True):
            for size in sizes[key]:
                places[size].append(place)
        windows = Windows(grams)
        for size, shared in places.items():
            window, shared = min(size, len(words)), np.array(shared)
            low = np.maximum(0, shared + k - window)
            high = np.minimum(shared, len(words) - window)
            cuts = np.flatnonzero(low[1:] > high[:-1] + 1) + 1
            for first, last in zip([0, *cuts], [*(cuts - 1), len(shared) - 1], strict=True):
                for start, prints, bags in windows.prints(int(low[first]), int(high[last]), window - k + 1):
                    for start, fingerprint, bag in zip(
                            count(start), prints.tolist(), bags.tolist(), strict=False):
                        found_near = near.get((size, fingerprint))
                        if found_near is None:
                            if len(near) > REMEMBERED:
                                near.clear()
                            found_near = near[size, fingerprint] = items.near(size, fingerprint)
                        for i in found_near:
                            if (i, fingerprint, bag) in seen:
                                continue
                            if len(seen) > REMEMBERED:
                                seen.clear()
                            seen.add((i, fingerprint, bag))
                            part = words[start:start + window]
                            found = similarity(items.counts[i], Counter(
                                zip(*(part[j:] for j in range(items.grams[i])), strict=False)))
                            if found >= least and found > best.get(i, (0.0, 0, 0))[0]:
                                best[i] = found, start, window
    return best


_FOUND = "doc_id long, item_id long, similarity double, start int, n_words int"


def find(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, start, n_words): for every row of ``docs`` (doc_id, text) and
    item (item_id, text) that matches it, the first of the most similar windows, in words."""
    if benchmark.isEmpty():
        return docs.sparkSession.createDataFrame([], _FOUND)
    found = [_with_items(docs, block, least) for block in item_blocks(benchmark)]
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole


def item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in blocks of about BLOCK_WORDS words by a hash; one block is on the driver at once."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = size // (6 * BLOCK_WORDS) + 1
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block)
        yield Items([(r.item_id, r.text) for r in part.orderBy("item_id", "text").collect()])


def _with_items(docs: DataFrame, items: Items, least: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, rolling = shared.value, Rolling(_BASE)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                    strict=True):
                rows += [(doc_id, items.ids[i], *hit) for i, hit in sorted(
                    matches(text.as_py(), items, rolling, least).items())]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()), strict=True)],
                names=["doc_id", "item_id", "similarity", "start", "n_words"])
    return docs.select("doc_id", "text").mapInArrow(search, _FOUND)


def clean(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that no item contaminates. Each block of items filters on its own."""
    if benchmark.isEmpty():
        return docs
    for items in item_blocks(benchmark):
        docs = filtered(docs, _untouched(docs.sparkSession, items, least))
    return docs


def _untouched(spark: SparkSession, items: Items, least: float):
    shared = spark.sparkContext.broadcast(items)

    def passes():
        rolling = Rolling(_BASE)
        return lambda text: not matches(text, shared.value, rolling, least)
    return passes


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
