"""SimHash near-duplicates, searched with Golay-code fuzzy hashing.

A fingerprint has 64 bits. Two fingerprints are linked when at most four bits differ. Cut
into five blocks, the pair agrees on one block whole (pigeonhole), and of the two halves
of the other bits one has at most two differing bits. 23 bits of each half are decoded
with the binary Golay code, whose words lie within three bits of every 23-bit string: two
strings two bits apart have a codeword within four bits of both, namely the one nearest to
the string between them. So each half gives the indices of all codewords within four bits
(one or six), each together with the exact block as one key, and linked fingerprints share a
key. Pairs that share a key are verified by their exact distance.

Equal fingerprints are one node throughout, so copies of a text cost one row. Per key the
fingerprints are cut into blocks of bounded size, and pairs of blocks are compared; what comes
out is a spanning forest of each comparison, not its pairs.

Results: a null or empty text, or one of white space, has the fingerprint zero and is linked
like any other; a null id is kept and is nobody's smallest id unless the whole component
has none; repeated rows each come out; an empty table gives no rows; further columns of the
input are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.components import components
from tillwise.llm.tables import fresh, keep, sliced, table
from tillwise.llm.words import shingles

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
BLOCK = 1024  # fingerprints of one key that meet in one comparison

# ---- fingerprints ---------------------------------------------------------------------


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in over half of the shingles' XXH64 values."""
    ones, count = np.zeros(64, np.int64), 0
    digest = xxhash.xxh64_digest
    for found in shingles((text or "").encode("utf-8", "surrogatepass").lower(), n):
        for at in range(0, len(found), 1 << 16):
            part = b"".join([digest(s, SEED) for s in found[at:at + (1 << 16)]])
            bits = np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1)
            ones += bits.sum(0, dtype=np.uint32)
            count += len(bits)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, copy, fingerprint) of every row; ``copy`` is a hash of the text, and the
    fingerprint a signed 64-bit integer."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = np.array([fingerprint(t.as_py(), n) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("copy"), pa.array(found.view(np.int64))],
                names=["doc_id", "copy", "fingerprint"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("copy"), "text").mapInArrow(
        of, f"doc_id {kind}, copy long, fingerprint long")

# ---- keys -----------------------------------------------------------------------------


GENERATOR = 0xC75  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, the Golay polynomial
LENGTH, CHECKS = 23, 11
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit and width


def _syndromes() -> np.ndarray:
    """Remainder of every single-bit string modulo the generator."""
    out, value = [], 1
    for _ in range(LENGTH):
        out.append(value)
        value <<= 1
        if value >> CHECKS:
            value ^= GENERATOR
    return np.array(out, np.int64)


def _error_table() -> tuple[np.ndarray, np.ndarray]:
    """For every syndrome the strings of weight at most four that have it, padded, and how
    many there are: what must be added to a string to reach the codewords near it."""
    single = _syndromes()
    found: list[list[int]] = [[] for _ in range(1 << CHECKS)]
    def grow(start: int, error: int, syndrome: int, left: int) -> None:
        found[syndrome].append(error)
        for i in range(start, LENGTH if left else 0):
            grow(i + 1, error | 1 << i, syndrome ^ int(single[i]), left - 1)
    grow(0, 0, 0, 4)
    counts = np.array([len(x) for x in found])
    out = np.zeros((len(found), counts.max()), np.int64)
    for i, errors in enumerate(found):
        out[i, :len(errors)] = errors
    return out, counts


_ERRORS, _COUNTS = _error_table()
_BYTE_SYNDROME = np.array([[np.bitwise_xor.reduce(np.append(0, _syndromes()[8 * j:8 * j + 8][
    [b for b in range(min(8, LENGTH - 8 * j)) if value >> b & 1]])) for value in range(256)]
    for j in range(3)])


def codewords_near(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in ``strings``, 12-bit indices) of all codewords within four bits."""
    syndrome = (_BYTE_SYNDROME[0][strings & 255] ^ _BYTE_SYNDROME[1][strings >> 8 & 255]
                ^ _BYTE_SYNDROME[2][strings >> 16])
    counts = _COUNTS[syndrome]
    at = np.repeat(np.arange(len(strings)), counts)
    nth = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    return at, (strings[at] ^ _ERRORS[syndrome[at], nth]) >> CHECKS


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, positions in ``prints``): two fingerprints at most four bits apart share a key."""
    prints = prints.view(np.uint64)
    keys, positions = [], []
    for i, (first, width) in enumerate(BLOCKS):
        exact = (prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
        low = prints & np.uint64((1 << first) - 1)
        high = prints >> np.uint64(first + width) if first + width < 64 else np.zeros_like(prints)
        rest = low | high << np.uint64(first)
        for half in (0, 1):
            string = (rest >> np.uint64(26 * half) & np.uint64((1 << LENGTH) - 1)).astype(np.int64)
            at, index = codewords_near(string)
            keys.append(((2 * i + half) << 25) | (exact[at] << 12) | index)
            positions.append(at)
    return np.concatenate(keys), np.concatenate(positions)

# ---- links ----------------------------------------------------------------------------


def forest(prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the fingerprints at most ``radius`` bits apart: each
    fingerprint with the first one of its component."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    left = np.ones(len(prints), bool)
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(near[front].any(0) & left)
            left[front] = False
            yield from ((int(prints[x]), int(prints[root])) for x in front)


def _compare(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes = batch["prints"].map(len).to_numpy(np.int64)
        two = batch["prints"][sizes == 2]
        pairs = np.array([tuple(x) for x in two], np.int64).reshape(-1, 2)
        close = np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= radius
        yield pd.DataFrame(pairs[close], columns=["a", "b"])
        more = [e for x in batch["prints"][sizes > 2] for e in forest(
            np.asarray(x, np.int64).view(np.uint64), radius)]
        yield pd.DataFrame(np.array(more, np.uint64).view(np.int64).reshape(-1, 2),
                           columns=["a", "b"])


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) that connect what chains of links connect. ``prints``: one column of
    distinct fingerprints."""
    if radius > RADIUS:
        raise ValueError(f"the keys guarantee a radius of {RADIUS} at most")
    name = prints.columns[0]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[name].to_numpy(np.int64)
            for at in range(0, len(values), 1 << 14):
                part = values[at:at + (1 << 14)]
                keys, positions = keys_of(part)
                yield pd.DataFrame({"key": keys.astype(np.int32), "print": part[positions]})

    keyed = prints.mapInPandas(expand, "key int, print long")
    by_key = W.partitionBy("key").orderBy("print")
    numbered = keyed.select("key", "print", (F.row_number().over(by_key) - 1).alias("nth"),
                            F.lead("print").over(by_key).alias("next"))
    # most keys have one fingerprint; a group that goes on is cut into blocks
    blocks = keep(numbered.where("nth > 0 or next is not null")
                  .groupBy("key", F.floor(F.col("nth") / block).cast("int").alias("block"))
                  .agg(F.collect_list("print").alias("prints")), "blocks")
    schema = "a long, b long"
    inside = blocks.where(F.size("prints") > 1).select("prints").mapInPandas(
        lambda b: _compare(b, radius), schema)
    later = blocks.where("block > 0").select("key", "block", F.col("prints").alias("later"))
    across = (blocks.where(F.size("prints") == block)
              .select("key", F.col("block").alias("first"), "prints").join(later, "key")
              .where("first < block").select(F.concat("prints", "later").alias("prints"))
              .repartition(F.xxhash64("prints")))
    return inside.union(across.mapInPandas(lambda b: _compare(b, radius), schema)).distinct()

# ---- groups ---------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """(doc_id, copy, fingerprint, component, component_id) of every row: the component is
    named by one of its fingerprints, its id is the smallest doc_id reachable by links."""
    found = keep(fingerprints(docs, n), "fingerprints")
    prints = keep(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "prints")
    return grouped(found, prints, components(links(prints.select("fingerprint"), radius)))


def grouped(found: DataFrame, prints: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (doc_id, copy, fingerprint) with their component. ``prints``: each fingerprint and its
    smallest id; ``groups``: (node, component) of linked ones."""
    member = keep(prints.join(groups, prints["fingerprint"] == groups["node"], "left").select(
        "fingerprint", "first_id",
        F.coalesce("component", "fingerprint").alias("component")), "members")
    least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_print = keep(member.join(least, "component")
                    .select("fingerprint", "component", "component_id"), "ids")
    return found.join(of_print, "fingerprint").select(
        "doc_id", "copy", "fingerprint", "component", "component_id")


def keep_one(docs: DataFrame, n: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row with the smallest
    id stays (of several, the one whose text and then whose other columns hash lowest)."""
    return one_of_each(docs, near_duplicates(docs, n, radius))


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component of ``found``."""
    text, nth, first_id, first_copy = fresh(docs, "text_hash", "nth", "first_id", "first_copy")
    winners = (found.where("doc_id <=> component_id")
               .groupBy("component").agg(F.min(F.struct("doc_id", "copy")).alias("w"))
               .select(F.col("w.doc_id").alias(first_id), F.col("w.copy").alias(first_copy)))
    rows = docs.withColumn(text, F.xxhash64("text"))
    rows = rows.join(winners, F.col("doc_id").eqNullSafe(F.col(first_id))
                     & (F.col(text) == F.col(first_copy)), "left_semi")
    once = W.partitionBy(text, "doc_id").orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]))
    return (rows.withColumn(nth, F.row_number().over(once))
            .where(F.col(nth) == 1).select(*docs.columns))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id")
