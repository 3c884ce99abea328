"""Removal of repeated passages: windows of ``WINDOW`` words that also start earlier.

Windows are compared by Rabin-Karp hashes over the hashes of their words, 96 bits in all
(chance collisions stay improbable up to some 10^13 windows). Hashes are dealt out by value
and counted per part with arrays; the earliest start of a sequence is kept.

Shuffling a hash with its place for every window would move several times the size of the
input, so a sieve goes first. Equal windows have the same smallest hash of eight words in the same
place (their minimizer). About one start in seven is a minimizer; only those hashes are
counted in the first round, and a window whose minimizer occurs once in the whole corpus
cannot be repeated. The sieve loses nothing; only windows that pass it are dealt out in full.

Whatever repeats inside one batch of a task is settled there, and one entry per hash and
batch goes on. So a passage that a third of all documents share costs one entry per batch
and not one per document. What is found out travels back to documents in one row for each
part and bucket of documents.

Results: order is by doc_id, a null id counting as the largest, then by start. Rows with one
id count as one document for that order, and equal rows get equal results each. A null or
empty text has no words; texts shorter than a window lose nothing; an empty table gives no
rows; further columns of the input are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm.tables import keep, table
from tillwise.llm.words import word_blocks

WINDOW = 20
GRAM = 8
PART_BYTES = 48 << 20  # of text per part: bounds what a task holds of one part
NO_ID = (1 << 63) - 1
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers

# ---- hashes of one text ---------------------------------------------------------------


def word_hashes(data: bytes) -> np.ndarray:
    """Two 64-bit hashes of every word, as an array of two columns."""
    digest = xxhash.xxh3_128_digest
    parts = [np.frombuffer(b"".join([digest(w) for w in words]), "<u8").reshape(-1, 2)
             for words in word_blocks(data)]
    return np.concatenate(parts) if parts else np.zeros((0, 2), np.uint64)


class Rolling:
    """Rabin-Karp hashes modulo 2^64 of all runs of k words, from running sums."""

    def __init__(self, base: np.uint64):
        self.base, self.powers, self.inverses = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, words: np.ndarray, k: int) -> np.ndarray:
        n = len(words)
        if n < k:
            return np.zeros(0, np.uint64)
        if len(self.powers) < n:
            inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
            self.powers = np.append(np.uint64(1), np.full(2 * n, self.base)).cumprod()
            self.inverses = np.append(np.uint64(1), np.full(2 * n, inverse)).cumprod()
        sums = np.append(np.uint64(0), (words * self.inverses[:n]).cumsum(dtype=np.uint64))
        return (sums[k:] - sums[:-k]) * self.powers[k - 1:n]


def minimizers(words: np.ndarray, rolling: Rolling, window: int, gram: int) -> np.ndarray:
    """Per window the start of its smallest run of ``gram`` words, and the hashes of all runs."""
    grams = rolling(words, gram)
    inside = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    return inside.argmin(1) + np.arange(len(inside)), grams

# ---- blobs of arrays ------------------------------------------------------------------


_PARTED = "part int, bucket int, own binary, a binary, b binary, c binary"
_PARTED_ARROW = pa.schema([("part", pa.int32()), ("bucket", pa.int32()),
                           *[(n, pa.binary()) for n in ("own", "a", "b", "c")]])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_PARTED_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _PARTED_ARROW, strict=True)],
        schema=_PARTED_ARROW)


def _in_batches(rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) >= size:
            yield _batch(some)
            some = []
    yield _batch(some)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in sorted arrays."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _spans(key: np.ndarray) -> Iterator[tuple[int, int]]:
    first = _runs(key)
    return zip(first, [*first[1:], len(key)], strict=False)


def _mixed(ids: np.ndarray) -> np.ndarray:
    return (ids.astype(np.uint64) * _BASES[0]) >> np.uint64(24)


def _messages(ids: np.ndarray, copies: np.ndarray, values: np.ndarray, buckets: int
              ) -> Iterator[tuple]:
    """Values for documents, as one row (part, bucket, documents, values, null, null) for each bucket
    of documents."""
    bucket = (_mixed(ids) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((values, copies, ids, bucket))
    bucket, ids, copies, values = bucket[order], ids[order], copies[order], values[order]
    for lo, hi in _spans(bucket):
        first = _runs(ids[lo:hi], copies[lo:hi])
        own = np.stack([ids[lo:hi][first], copies[lo:hi][first],
                        np.diff(np.append(first, hi - lo))], 1)
        b = int(bucket[lo])
        yield b, b, own.astype(np.int64).tobytes(), values[lo:hi].tobytes(), None, None


def _gathered(batches: Iterator[pa.RecordBatch], kind) -> Iterator[pa.RecordBatch]:
    """One row (doc_id, copy, list) per document, from its messages; rows come by bucket."""
    for messages, _ in _parts(batches):
        own = _array(messages, "own", np.int64).reshape(-1, 3)
        values = _array(messages, "a", kind)
        doc = np.repeat(np.arange(len(own)), own[:, 2])
        order = np.lexsort((values, own[doc, 1], own[doc, 0]))
        doc, values = doc[order], values[order]
        ids, copies = own[doc, 0], own[doc, 1]
        first = _runs(ids, copies)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[first]), pa.array(copies[first]),
             pa.array([values[lo:hi].tobytes() for lo, hi in zip(
                 first, [*first[1:], len(ids)], strict=True)], pa.binary())],
            names=["doc_id", "copy", "packed"])


def _by_part(hashes: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    part = (hashes % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    bounds = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        if bounds[p] < bounds[p + 1]:
            yield p, order[bounds[p]:bounds[p + 1]]


def _docs(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for i, text in enumerate(batch.column("text")):
        value = text.as_buffer()
        yield i, value.to_pybytes() if value else b""


def _slices(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text at most, or of one row."""
    for batch in batches:
        ends = np.cumsum([len(t.as_buffer() or b"") for t in batch.column("text")])
        at = 0
        while at < len(ends):
            past = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, past + most, "right")))
            yield batch.slice(at, to - at)
            at = to

# ---- first round: which minimizers occur more than once --------------------------------


def _sieve(batches: Iterator[pa.RecordBatch], window: int, gram: int, parts: int
           ) -> Iterator[tuple]:
    """Rows (part, null, null, hashes, ids, known) to be counted, and messages of minimizers
    already known to be repeated."""
    rolling = Rolling(_BASES[0])
    for batch in _slices(batches):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        hashes, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, data in _docs(batch):
            words = word_hashes(data)[:, 0]
            if len(words) >= window:
                starts, grams = minimizers(words, rolling, window, gram)
                hashes.append(grams[np.unique(starts)])
                at.append(np.full(len(hashes[-1]), i))
        hashes, at = np.concatenate(hashes), np.concatenate(at)
        order = np.argsort(hashes, kind="stable")
        hashes, at = hashes[order], at[order]
        first = _runs(hashes)
        repeated = np.diff(np.append(first, len(hashes))) > 1
        # one entry per hash: known ones without asking back, marked by no id
        single, owner = hashes[first], np.where(repeated, NO_ID, ids[at[first]] if len(first)
                                                else np.zeros(0, np.int64))
        for p, which in _by_part(single, parts):
            yield (p, None, None, single[which].tobytes(), owner[which].tobytes(),
                   repeated[which].tobytes())
        again = np.repeat(repeated, np.diff(np.append(first, len(hashes))))
        hashes, at = hashes[again], at[again]
        owners = ids[at] if len(at) else np.zeros(0, np.int64)
        yield from _messages(owners, np.zeros_like(owners), hashes, parts)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[dict]]]:
    """(messages, blobs) of each part in turn; rows come in order of their part."""
    part, done, blobs = None, [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part:
                if part is not None:
                    yield done, blobs
                part, done, blobs = row["part"], [], []
            (blobs if row["bucket"] is None else done).append(row)
    if part is not None:
        yield done, blobs


def _array(blobs: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join([x[name] for x in blobs]), kind)


def _repeated(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple]:
    """Messages of repeated minimizers."""
    for done, blobs in _parts(batches):
        for row in done:
            yield tuple(row.values())
        if not blobs:
            continue
        hashes, ids, known = (_array(blobs, "a", np.uint64), _array(blobs, "b", np.int64),
                              _array(blobs, "c", bool))
        order = np.argsort(hashes, kind="stable")
        hashes, ids, known = hashes[order], ids[order], known[order]
        first = _runs(hashes)
        sizes = np.diff(np.append(first, len(hashes)))
        ask = np.repeat(sizes > 1, sizes) & ~known
        yield from _messages(ids[ask], np.zeros(int(ask.sum()), np.int64), hashes[ask], parts)

# ---- second round: windows that start earlier elsewhere --------------------------------


def _windows(batches: Iterator[pa.RecordBatch], window: int, gram: int, parts: int
             ) -> Iterator[tuple]:
    """Rows (part, null, documents, two hash arrays, places) to be compared, and messages of
    windows that are not the first."""
    rolling, second = Rolling(_BASES[0]), Rolling(_BASES[1])
    for batch in _slices(batches):
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        copies = batch.column("copy").to_numpy(zero_copy_only=False)
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32),
                  np.zeros(0, np.uint32))]
        hits = batch.column("hashes")
        for i, data in _docs(batch):
            repeated = np.frombuffer(hits[i].as_py(), np.uint64)
            words = word_hashes(data) if len(repeated) else np.zeros((0, 2), np.uint64)
            if len(words) >= window:
                starts, grams = minimizers(words[:, 0], rolling, window, gram)
                at = np.flatnonzero(np.isin(grams[starts], repeated))
                found.append((rolling(words[:, 0], window)[at],
                              (second(words[:, 1], window)[at] >> np.uint64(32)).astype(np.uint32),
                              np.full(len(at), i, np.uint32), at.astype(np.uint32)))
        h1, h2, doc, start = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((start, ids[doc], h2, h1))
        h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
        first = _runs(h1, h2)
        sizes = np.diff(np.append(first, len(h1)))
        lead = np.repeat(first, sizes)
        least = (ids[doc] == ids[doc[lead]]) & (start == start[lead])
        late = doc[~least]
        yield from _messages(ids[late], copies[late], start[~least], parts)
        h1, h2, doc, start = h1[least], h2[least], doc[least], start[least]
        for p, which in _by_part(h1, parts):
            which = which[np.lexsort((start[which], doc[which]))]
            runs = _runs(doc[which])
            own = doc[which][runs]
            table = np.stack([ids[own], copies[own], np.diff(np.append(runs, len(which)))], 1)
            yield (p, None, table.astype(np.int64).tobytes(), h1[which].tobytes(),
                   h2[which].tobytes(), start[which].tobytes())


def _later(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[tuple]:
    """Messages of windows that are not the first."""
    for done, blobs in _parts(batches):
        for row in done:
            yield tuple(row.values())
        if not blobs:
            continue
        table = _array(blobs, "own", np.int64).reshape(-1, 3)
        doc = np.repeat(np.arange(len(table)), table[:, 2])
        h1, h2, start = (_array(blobs, "a", np.uint64), _array(blobs, "b", np.uint32),
                         _array(blobs, "c", np.uint32))
        order = np.lexsort((start, table[doc, 0], h2, h1))
        h1, h2, start, doc = h1[order], h2[order], start[order], doc[order]
        first = _runs(h1, h2)
        lead = np.repeat(first, np.diff(np.append(first, len(h1))))
        least = (table[doc, 0] == table[doc[lead], 0]) & (start == start[lead])
        late = doc[~least]
        yield from _messages(table[late, 0], table[late, 1], start[~least], parts)

# ---- whole corpus ---------------------------------------------------------------------


def _dealt(rows: DataFrame, by: str) -> DataFrame:
    return rows.withColumn("part", F.col(by)).repartition("part").sortWithinPartitions("part")


def repeated_starts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, copy, starts): the starts of the windows of a row whose word sequence also starts
    earlier, as packed 32-bit numbers. ``copy`` is a hash of the text."""
    if not 1 <= gram <= window:
        raise ValueError("a minimizer lies within a window")
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
                        F.xxhash64("text").alias("copy"), "text")
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = int(size // part_bytes) + 1

    def gathered(rows: DataFrame, kind) -> DataFrame:
        return _dealt(rows, "bucket").mapInArrow(
            lambda b: _gathered(b, kind), "doc_id long, copy long, packed binary")

    sieved = texts.select("doc_id", "text").mapInArrow(
        lambda b: _in_batches(_sieve(b, window, gram, parts)), _PARTED)
    repeated = keep(gathered(_dealt(sieved, "part").mapInArrow(
        lambda b: _in_batches(_repeated(b, parts)), _PARTED), np.uint64)
        .select("doc_id", F.col("packed").alias("hashes")), "minimizers")
    windows = texts.join(repeated, "doc_id").mapInArrow(
        lambda b: _in_batches(_windows(b, window, gram, parts)), _PARTED)
    later = _dealt(windows, "part").mapInArrow(lambda b: _in_batches(_later(b, parts)), _PARTED)
    return keep(gathered(later, np.uint32).select(
        "doc_id", "copy", F.col("packed").alias("starts")), "later")


def _kept(batches: Iterator[pa.RecordBatch], window: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Per row the number of words, of removed words, and the digest of what is kept (or, with
    ``whole``, the kept words themselves)."""
    for batch in batches:
        out: list[list] = [[], [], []]
        starts = batch.column("starts")
        for i, data in _docs(batch):
            at = np.frombuffer(starts[i].as_py() or b"", np.uint32).astype(np.int64)
            digest, text, n, removed, some = hashlib.sha256(), [], 0, 0, False
            at = np.sort(at)
            for words in word_blocks(data):
                if len(at):
                    # a word goes if a removed window starts at it or less than a window before
                    here = np.arange(n, n + len(words))
                    last = at[np.maximum(np.searchsorted(at, here, "right") - 1, 0)]
                    gone = (last <= here) & (here - last < window)
                    removed += int(gone.sum())
                    stay = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    stay = words
                n += len(words)
                if stay:
                    piece = (b" " if some else b"") + b" ".join(stay)
                    digest.update(piece)
                    if whole:
                        text.append(piece)
                    some = True
            for column, value in zip(out, (n, removed, b"".join(text).decode() if whole
                                           else digest.hexdigest()), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated(docs: DataFrame, window: int = WINDOW, whole: bool = True,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row of ``docs``: the words no repeated window covers,
    joined by one space, or their SHA-256 where ``whole`` is false."""
    later = repeated_starts(docs, window, min(GRAM, window), part_bytes).select(
        F.col("doc_id").alias("_id"), F.col("copy").alias("_copy"), "starts")
    texts = docs.select("doc_id", "text").join(
        later, (F.coalesce("doc_id", F.lit(NO_ID)) == F.col("_id"))
        & (F.xxhash64("text") == F.col("_copy")), "left").select("doc_id", "text", "starts")
    return texts.mapInArrow(lambda b: _kept(b, window, whole),
                            "doc_id long, n_words long, n_removed long, kept string")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated(table(spark, sf_dir, "documents"), whole=False).withColumnRenamed(
        "kept", "kept_sha256")


OP9_SQL = f"""
with d as (select row_number() over () as row_id, doc_id,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'),
                              lambda x: x <> '') as ws
           from documents),
starts as (select row_id, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as s from d
           where len(ws) >= {WINDOW}),
sequences as (select row_id, doc_id, s, array_to_string(ws[s:s + {WINDOW - 1}], ' ') as w from starts),
judged as (select row_id, s, (doc_id, s) as place, min((doc_id, s)) over (partition by w) as first
           from sequences),
gone as (select distinct row_id, unnest(range(s, s + {WINDOW})) as i from judged where place > first),
each as (select row_id, unnest(range(1, len(ws) + 1)) as i, unnest(ws) as word from d),
kept as (select row_id, string_agg(word, ' ' order by i) as t, count(*) as n
         from each anti join gone using (row_id, i) group by row_id)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (row_id)"""
