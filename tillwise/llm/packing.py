"""Best-fit packing of token sequences, certified by lower bounds.

A document is its word pieces and one end id; documents longer than a sequence are cut into pieces of
the whole length, and only the last piece may be shorter. Pieces are dealt into shards by a hash
and each shard packs its own: longest first, each into the fullest sequence that still takes it (best-fit
decreasing). Dual feasible functions give each shard a lower bound: such a function maps lengths to
weights, and whatever fits into one sequence weighs one at most, so no packing has
fewer sequences than the weights' sum. ``bound`` takes the best of three families of functions.

A shard whose number of sequences equals its bound, rounded up, is certified: it cannot pack its
pieces into fewer. The part of a sequence between the bound and the number is the shard's gap.
Shards with a gap hand their loosest sequences, some more than four times the gap, to a shard of the next
round, which gets those of ``FAN`` shards, packs them anew, and keeps the old sequences where it gains
nothing. All other sequences are final. Rounds go on until one shard is left. So in the
end sequences are wasted at most where a bound is not reached, and no task ever sees more than
``FAN * RELEASED`` pieces of a later round or about ``SHARD`` of the first.

Word pieces are looked up: no piece crosses white space, so texts are cut there and the ids of a word
and of its parts are remembered, packed as bytes.

Results: null and empty texts are one piece of the end id; repeated rows and null ids are documents
of their own; an empty table gives no rows; other columns are ignored. Ties are ordered by
a row number, so a written piece table always packs the same way.
"""

import heapq
import os
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.tables import keep, sliced, table
from tillwise.llm.vocabulary import vocabulary_path
from tillwise.llm.words import word_blocks

VOCABULARY = "word_bpe_49k.json"
END = 1  # fixed value: the id after each document
CAPACITY = 4096
SHARD = 4096  # pieces that a shard of the first round gets, about
FAN = 16  # shards that hand pieces to one of the next round
RELEASED = 4096  # pieces that a shard hands on, at most
_REMEMBERED = 500_000  # of each kind, about 100 MB a generation
_END = END.to_bytes(4, "little")
TOGETHER = 1 << 20  # bytes of text
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
# Fixed value: how the vocabulary cuts words of such letters.
_RUN = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[!-/:-@[-`{-~]+")

# ---- pieces ---------------------------------------------------------------------------


class Words:
    """Ids of words as bytes. Words are remembered in two generations, and so are the runs of letters,
    of signs, and single digits they consist of; what is known of neither goes to the library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        size = self.model.get_vocab_size()
        self.ending = np.array([(self.model.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.words: dict[bytes, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.old_runs: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 1024):
            found = self.model.encode_batch_fast(texts[at:at + 1024], add_special_tokens=False)
            yield from (np.array(e.ids, "<u4").tobytes() for e in found)

    def _encoded_runs(self, runs: list[str]) -> Iterator[bytes]:
        """Ids of runs, many at a time: the last id of each run, and no other, ends a word."""
        joined = ["\n".join(runs[at:at + 256]) for at in range(0, len(runs), 256)]
        for ids in self._encoded(joined):
            ends = 4 * np.flatnonzero(self.ending[np.frombuffer(ids, "<u4")]) + 4
            yield from (ids[x:y] for x, y in zip([0, *ends], ends, strict=False))

    def _learn(self, missing: set[bytes]) -> None:
        if len(self.runs) > _REMEMBERED:
            self.runs, self.old_runs = {}, self.runs
        words, runs, made, whole = self.words, self.runs, [], []
        for word in missing:
            known = self.old_words.get(word)
            if known is not None:
                words[word] = known
                continue
            text = word.decode("utf-8", "surrogatepass")
            if _PLAIN.fullmatch(text) and "<|" not in text:
                made.append((word, _RUN.findall(text.lower())))
            else:  # other letters, or perhaps special ids: the library sees the whole word
                whole.append((word, text))
        new = {r for _, parts in made for r in parts}.difference(runs)
        unknown = list(new.difference(self.old_runs))
        runs.update((r, self.old_runs[r]) for r in new.difference(unknown))
        runs.update(zip(unknown, self._encoded_runs(unknown), strict=True))
        for word, parts in made:
            words[word] = runs[parts[0]] if len(parts) == 1 else b"".join([runs[r] for r in parts])
        for (word, _), ids in zip(whole, self._encoded([t for _, t in whole]), strict=True):
            words[word] = ids

    def _known(self, words: Iterable[bytes]) -> Callable[[bytes], bytes]:
        if len(self.words) > _REMEMBERED:
            self.words, self.old_words = {}, self.words
        if missing := set(words).difference(self.words):
            self._learn(missing)
        return self.words.__getitem__

    def ids(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian ids of each text and the end id. Short texts are looked up together."""
        waiting: list[list[bytes]] = []
        size = 0
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            if size + len(data) > TOGETHER:
                yield from self._together(waiting)
                waiting, size = [], 0
            if len(data) > TOGETHER:
                yield b"".join([b"".join(map(self._known(words), words)) for words in word_blocks(data)]) + _END
            else:
                waiting.append(data.split())
                size += len(data)
        yield from self._together(waiting)

    def _together(self, texts: list[list[bytes]]) -> Iterator[bytes]:
        known = self._known(chain.from_iterable(texts))
        return (b"".join(map(known, words)) + _END for words in texts)


@cache
def _words(path: str) -> Words:
    return Words(path)


_PIECE = [("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
          ("ids_crc32", pa.int64())]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(row, doc_id, piece, start, length, ids_crc32) of every piece of ``docs`` (doc_id, text); ``row``
    numbers the pieces and stays the same when a task runs again."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, at = _words(path), TaskContext.get().partitionId() << 40
        for batch in sliced(batches):
            source, out = [], []
            for n, ids in enumerate(words.ids(t.as_py() for t in batch.column("text"))):
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start:start + 4 * capacity]
                    source.append(n)
                    out.append((at, piece, start // 4, len(part) // 4, zlib.crc32(part)))
                    at += 1
            columns = zip(*out, strict=True) if out else [()] * len(_PIECE)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(source, pa.int64()))]
                + [pa.array(c, kind) for c, (_, kind) in zip(columns, _PIECE, strict=True)],
                names=["doc_id"] + [name for name, _ in _PIECE])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, row long, piece int, start long, length int, ids_crc32 long")

# ---- bounds ---------------------------------------------------------------------------


def bound(lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    return bound_of_counts(np.bincount(lengths, minlength=capacity + 1), capacity)


def bound_of_counts(n: np.ndarray, capacity: int) -> tuple[int, float]:
    """Least number of sequences for ``n[x]`` pieces of each length x, and the largest weight sum
    that says so. With capacity C the functions are

    * x itself, over C; and for a step s up to C / 2 nothing below s, C above C - s, else x;
    * for k = 1, 2, ...: x where (k + 1) x is a multiple of C, else the next lower of the k + 1 steps, over k;
    * for a step s up to C / 2: below C / 2 the whole steps in x, above it what the whole steps in C - x
      leave of those in C; at C / 2 half of them."""
    x = np.arange(capacity + 1, dtype=np.int64)
    best = (int(n @ x), capacity)  # numerator and denominator

    def better(numerator: int, denominator: int) -> None:
        nonlocal best
        if numerator * best[1] > best[0] * denominator:
            best = numerator, denominator

    count, total = np.cumsum(n), np.cumsum(n * x)
    steps = np.arange(1, capacity // 2 + 1)
    large = count[-1] - count[capacity - steps]
    middle = total[capacity - steps] - total[steps - 1]
    better(int((large * capacity + middle).max(initial=0)), capacity)
    for k in range(1, min(100, capacity)):
        weight = np.where((k + 1) * x % capacity == 0, x * k, (k + 1) * x // capacity * capacity)
        better(int(n @ weight), capacity * k)
    used = np.flatnonzero(n)
    for s in np.unique(np.append(used[used <= capacity // 2], capacity - used[used > capacity // 2])):
        if s == 0:
            continue
        whole = capacity // s
        weight = np.where(2 * x > capacity, 2 * (whole - (capacity - x) // s),
                          np.where(2 * x == capacity, whole, 2 * (x // s)))
        better(int(n @ weight), 2 * int(whole))
    return -(-best[0] // best[1]), best[0] / best[1]

# ---- best fit -------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Sequence number of each piece; the pieces are in order of falling length."""
    open_with: dict[int, list[int]] = {}  # sequences by the room they have left
    rooms = 0  # bit r: there is a sequence with room r
    out = np.zeros(len(lengths), np.int64)
    made = 0
    for i, length in enumerate(lengths.tolist()):
        enough = rooms >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            which = open_with[room].pop()
            if not open_with[room]:
                rooms &= ~(1 << room)
        else:
            room, which = capacity, made
            made += 1
        out[i] = which
        left = room - length
        if left:
            open_with.setdefault(left, []).append(which)
            rooms |= 1 << left
    return out


def _loosest(room: np.ndarray, size: np.ndarray, wanted: int, most: int) -> np.ndarray:
    """Sequences with the most room, ``wanted`` of them that have any and ``most`` pieces in all."""
    order = [int(b) for b in heapq.nlargest(wanted, range(len(room)), key=lambda b: (room[b], -b))
             if room[b]]
    fits = np.cumsum(size[order]) <= most
    return np.array(order, np.int64)[fits]


def repacked(rows: np.ndarray, lengths: np.ndarray, before: np.ndarray | None, capacity: int,
             last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, float]:
    """One shard's work: (order of its pieces, their sequence numbers, which sequences are handed on,
    the bound, the gap). ``before``: the sequences the pieces come from."""
    order = np.lexsort((rows, -lengths))
    of = best_fit(lengths[order], capacity)
    if before is not None and of.max(initial=-1) + 1 >= len(old := np.unique(before)):
        of = np.searchsorted(old, before[order])  # nothing gained: they stay as they were
    least, weight = bound(lengths, capacity)
    made = int(of.max(initial=-1)) + 1
    gap = made - weight
    handed = np.zeros(0, np.int64)
    if not last and gap > 1e-9:
        used = np.bincount(of, lengths[order], made).astype(np.int64)
        handed = _loosest(capacity - used, np.bincount(of, minlength=made), int(4 * np.ceil(gap)) + 4, RELEASED)
    return order, of, handed, least, gap

# ---- rounds ---------------------------------------------------------------------------


_OUT = ("row long, doc_id {kind}, piece int, start long, length int, ids_crc32 long, sequence_id long, "
        "offset long, final boolean, shard long, sequences long, least long, gap double")


def _round(dealt: DataFrame, nth: int, capacity: int, last: bool) -> DataFrame:
    """Packs every shard of ``dealt`` (pieces, shard, before); also each shard's certificate."""
    def pack(key: tuple, found: pa.Table) -> pa.Table:
        rows, lengths = found.column("row").to_numpy(), found.column("length").to_numpy()
        before = found.column("before").to_numpy() if nth else None
        order, of, handed, least, gap = repacked(rows, lengths, before, capacity, last)
        made = int(of.max()) + 1
        by = np.lexsort((np.arange(len(of)), of))
        order, of = order[by], of[by]
        length = lengths[order].astype(np.int64)
        starts = np.cumsum(length) - length
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        offset = starts - np.repeat(starts[first], np.diff(np.append(first, len(of))))
        shard = key[0].as_py()
        same = np.ones(len(of), np.int64)
        return found.take(pa.array(order)).select(
            ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
        ).append_column("sequence_id", pa.array(nth << 58 | shard << 22 | of)
        ).append_column("offset", pa.array(offset)
        ).append_column("final", pa.array(~np.isin(of, handed))
        ).append_column("shard", pa.array(same * shard)
        ).append_column("sequences", pa.array(same * made)
        ).append_column("least", pa.array(same * least)
        ).append_column("gap", pa.array(same * gap, pa.float64()))

    kind = dealt.schema["doc_id"].dataType.simpleString()
    return keep(dealt.groupBy("shard").applyInArrow(pack, _OUT.format(kind=kind)), "packed")


def pack(found: DataFrame, capacity: int = CAPACITY, shard: int = SHARD,
         fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Packs ``found`` (as ``pieces`` has them). Gives the pieces with sequence_id, offset and
    ``round``, and the certificates: (round, shard, sequences, least, certified) of every shard."""
    found = keep(found, "pieces")
    columns = [*found.columns, "sequence_id", "offset"]
    full = found.where(F.col("length") == capacity).select(
        "*", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = found.where(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard))  # one number
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("long")).withColumn(
        "before", F.lit(0).cast("long"))
    done, certificates, nth = [full.select(*columns, F.lit(-1).alias("round"))], [], 0
    while True:
        packed = _round(dealt, nth, capacity, shards == 1)
        done.append(packed.where("final").select(*columns, F.lit(nth).alias("round")))
        certificates.append(packed.groupBy("shard").agg(
            F.min("sequences").alias("sequences"), F.min("least").alias("least")).select(
            F.lit(nth).alias("round"), "*", (F.col("sequences") == F.col("least")).alias("certified")))
        if shards == 1:
            break
        shards = -(-shards // fan)
        dealt = packed.where("not final").select(
            *found.columns, F.pmod("shard", F.lit(shards)).alias("shard"), F.col("sequence_id").alias("before"))
        nth += 1
    out, told = done[0], certificates[0]
    for part in done[1:]:
        out = out.unionByName(part)
    for part in certificates[1:]:
        told = told.unionByName(part)
    return out, told


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences, least number of sequences any packing of the same pieces needs). Only how many
    pieces there are of each length comes to the driver."""
    counts = packed.groupBy("length").count().collect()
    lengths = np.zeros(capacity + 1, np.int64)
    for row in counts:
        lengths[row["length"]] = row["count"]
    return packed.select("sequence_id").distinct().count(), bound_of_counts(lengths, capacity)[0]


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces(table(spark, sf_dir, "documents"), vocabulary_path(VOCABULARY))
    return pack(found)[0].select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
