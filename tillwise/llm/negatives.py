"""Hard negatives of anchor vectors, scored exactly by the method of the Four Russians.

Components become whole numbers, ``floor(scale * x)``. The dimensions of an anchor are cut into groups
of eight, and for each group a table of 256 entries has the sum of every subset of its eight
numbers. A candidate is kept as bit planes: for each binary digit of its numbers (two's complement)
one byte per group says which of the eight have that digit. A score is then the table
entries at these bytes, added over the groups, shifted and added over the digits; the highest digit
counts negatively. Every score is whole and exact.

Every row is scored with every anchor once, on a grid: candidates are dealt into blocks of bounded
size, anchors into stretches, and one cell is a block with a stretch. A cell's rows come in
order, candidates first, and anchors pass by a few hundred at a time, so a task holds one block and
the tables of those anchors. Positives only meet rows of their own label, so they are looked for
among blocks of one label (rare labels share blocks); a hot label is many blocks. A cell gives a
few best rows per anchor, and those are ranked over all cells.

Results: rows with a null label, a null vector or any null or non-finite component take no part, and
neither do vectors so long that scores would not fit 64 bits (scaled length of 2**28 or more); only
vectors of one number of dimensions are compared, an empty vector scores zero. Equal scores are
ordered by smaller id, a null id last. Repeated rows are rows of their own: a repeated anchor gives
its results again, and a row's equal is a possible positive of it. Where a positive's score is
negative nothing lies in the band. An empty table gives no rows; other columns are ignored.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.tables import keep, table

SCALE = 256
EVERY, RELABELLED, LABELS = 50, 7, 10  # of the query
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95  # percent of the positive's score
BLOCK = 8192  # candidates of a cell
SPREAD, FEW = 24, 256  # a smaller table makes up to SPREAD blocks of at least FEW rows
STRETCH = 65_536  # anchors of a cell
AT_ONCE = 256  # anchors whose tables a task holds
SLICE = 1024  # candidates scored at once
LONGEST = 2.0 ** 28
_LAST = np.iinfo(np.int64).max

# ---- scores ---------------------------------------------------------------------------


def bit_planes(q: np.ndarray) -> np.ndarray:
    """(digit, row, group) bytes of whole numbers (row, dimension), lowest digit first."""
    digits = int(max(np.abs(q).max(initial=0), 1)).bit_length() + 1
    return np.stack([np.packbits((q >> p & 1).astype(np.uint8), axis=1, bitorder="little")
                     for p in range(digits)])


def subset_sums(q: np.ndarray) -> np.ndarray:
    """(group, subset, row): sums of every subset of eight neighbouring dimensions."""
    rows, size = q.shape
    groups = -(-size // 8)
    padded = np.zeros((rows, groups * 8), np.int64)
    padded[:, :size] = q
    most = int(np.abs(padded).sum(1).max(initial=0))
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    eight = padded.reshape(rows, groups, 8).transpose(1, 2, 0).astype(kind)
    sums = np.zeros((groups, 256, rows), kind)
    for bit in range(8):
        sums[:, 1 << bit:2 << bit] = sums[:, :1 << bit] + eight[:, bit:bit + 1]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """(row, anchor) inner products from the rows' bit planes and the anchors' tables."""
    digits, rows, groups = planes.shape
    total = np.zeros((rows, sums.shape[2]), kind)
    for p in range(digits - 1, -1, -1):
        part = np.zeros((rows, sums.shape[2]), sums.dtype)
        for g in range(groups):
            part += np.take(sums[g], planes[p, :, g], axis=0)
        if p == digits - 1:
            total -= part
        else:
            total += total
            total += part
    return total


def _fitting(a: np.ndarray, b: np.ndarray) -> type:
    """A type that holds all scores, by the lengths of the vectors."""
    longest = [np.sqrt(np.square(x.astype(float)).sum(1).max(initial=0)) for x in (a, b)]
    return np.int32 if longest[0] * longest[1] < 2 ** 30 else np.int64

# ---- cells ----------------------------------------------------------------------------


class Rows:
    """Rows of a cell as arrays."""

    def __init__(self, parts: list[pa.RecordBatch]):
        def numbers(name: str, missing: int = _LAST) -> np.ndarray:
            return np.concatenate([p.column(name).fill_null(missing).to_numpy() for p in parts])
        self.row, self.id, self.label = numbers("row"), numbers("id"), numbers("label")
        self.q = np.concatenate([p.column("q").flatten().to_numpy() for p in parts]).reshape(
            len(self.row), -1)
        self.low = [p.column("low") for p in parts]
        self.high = [p.column("high") for p in parts]
        self.planes: list[np.ndarray] | None = None

    def bands(self) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, positive) least and largest score looked for; an impossible band where there
        are fewer positives."""
        out = []
        for parts, empty in ((self.low, 1), (self.high, 0)):
            lists = [x or [] for p in parts for x in p.to_pylist()]
            out.append(np.array([(x + [empty] * POSITIVES)[:POSITIVES] for x in lists], np.int64))
        return out[0], out[1]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Rows, Rows]]:
    """(block, some anchors of its cell) from rows in order of ``cell`` and ``anchor``."""
    now, parts, block = None, [], None
    for batch in batches:
        cell = batch.column("cell").to_numpy()
        anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (anchor[1:] != anchor[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if start == end:
                continue
            if cell[start] != now:
                now, parts, block = cell[start], [], None
            part = batch.slice(start, end - start)
            if not anchor[start]:
                parts.append(part)
            elif parts:
                if block is None:
                    block = Rows(parts)
                for at in range(0, end - start, AT_ONCE):
                    yield block, Rows([part.slice(at, AT_ONCE)])


def _scored(block: Rows, anchors: Rows) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, scores) of a block's slices."""
    sums, kind = subset_sums(anchors.q), _fitting(block.q, anchors.q)
    if block.planes is None:
        block.planes = [bit_planes(block.q[at:at + SLICE]) for at in range(0, len(block.row), SLICE)]
    for nth, planes in enumerate(block.planes):
        yield nth * SLICE, scores(planes, sums, kind)


def _first(group: np.ndarray, n: int) -> np.ndarray:
    """Of rows in order of their group, which are among the first ``n`` of it."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    return np.arange(len(group)) - np.repeat(starts, np.diff(np.append(starts, len(group)))) < n


_FOUND = "anchor_row long, nth int, id long, score long"
_FOUND_ARROW = pa.schema([("anchor_row", pa.int64()), ("nth", pa.int32()), ("id", pa.int64()),
                          ("score", pa.int64())])


def _batch(anchor_row: np.ndarray, nth: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor_row), pa.array(nth.astype(np.int32)), pa.array(ids, mask=ids == _LAST),
         pa.array(score.astype(np.int64))], schema=_FOUND_ARROW)


def _best(found: list[tuple], key: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int) -> tuple:
    """The first ``n`` by score and id of every key, from (row, anchor, nth, score, id) arrays."""
    j, nth, score, ids = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, -score.astype(np.int64), nth, j))
    j, nth, score, ids = j[order], nth[order], score[order], ids[order]
    first = _first(key(j, nth), n)
    return j[first], nth[first], score[first], ids[first]


def _positives(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The best rows of an anchor's own label, of each cell."""
    for block, anchors in _cells(batches):
        found = []
        for at, score in _scored(block, anchors):
            rows = slice(at, at + len(score))
            fit = ((block.label[rows, None] == anchors.label[None])
                   & (block.row[rows, None] != anchors.row[None]))
            ranked = np.where(fit, score, np.iinfo(score.dtype).min)
            if len(ranked) > n:  # ties with the n-th stay in until ids decide
                fit &= ranked >= np.partition(ranked, len(ranked) - n, axis=0)[len(ranked) - n]
            i, j = np.nonzero(fit)
            found.append((j, np.zeros(len(j), np.int64), score[i, j], block.id[rows][i]))
        j, nth, score, ids = _best(found, lambda j, nth: j, n)
        yield _batch(anchors.row[j], nth, ids, score)


def _negatives(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The best rows of other labels in the band of each positive, of each cell."""
    for block, anchors in _cells(batches):
        low, high = anchors.bands()
        possible = low <= high
        least = np.where(possible, low, _LAST).min(1)
        most = np.where(possible, high, -_LAST).max(1)
        found = []
        for at, score in _scored(block, anchors):
            rows = slice(at, at + len(score))
            i, j = np.nonzero((score >= least[None]) & (score <= most[None]))
            other = block.label[rows][i] != anchors.label[j]
            i, j = i[other], j[other]
            value, ids = score[i, j], block.id[rows][i]
            for nth in range(low.shape[1]):
                inside = (value >= low[j, nth]) & (value <= high[j, nth])
                found.append((j[inside], np.full(inside.sum(), nth), value[inside], ids[inside]))
        j, nth, score, ids = _best(found, lambda j, nth: j * (POSITIVES + 1) + nth, n)
        yield _batch(anchors.row[j], nth, ids, score)

# ---- grid -----------------------------------------------------------------------------


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(row, id, label, q) of the rows that take part, written, so that row numbers stay."""
    x = F.col("embedding").cast("array<double>")
    fit = (F.col("label").isNotNull() & x.isNotNull()
           & F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    scaled = F.transform("x", lambda c: F.floor(c * scale))
    length = F.aggregate("x", F.lit(0.0), lambda s, c: s + (c * scale) * (c * scale))
    return keep(vectors.where(fit).select(
        "vec_id", F.col("label").cast("long").alias("label"), x.alias("x"))
        .where(length < LONGEST * LONGEST)
        .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"),
                "label", scaled.cast("array<int>").alias("q"), F.size("x").alias("size")), "whole")


def _grid(candidates: DataFrame, anchors: DataFrame, keys: list[str], block: int, stretch: int,
          spread: int = 1) -> DataFrame:
    """Rows of all cells in order: each candidate once per stretch of anchors, each anchor once per
    block. Both meet under equal ``keys`` only."""
    n = F.count("*")
    blocks = candidates.groupBy(keys).agg(F.greatest(
        F.ceil(n / block), F.least(F.lit(spread), F.ceil(n / FEW))).cast("int").alias("parts"))
    stretches = anchors.groupBy(keys).agg(F.ceil(n / stretch).cast("int").alias("stretches"))
    sizes = keep(blocks.join(stretches, keys), "cells")
    rows = candidates.join(sizes, keys).select(
        *keys, F.pmod(F.xxhash64("row"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("stretches") - 1)).alias("stretch"),
        F.lit(False).alias("anchor"), "row", "id", "label", "q",
        F.lit(None).cast("array<long>").alias("low"), F.lit(None).cast("array<long>").alias("high"))
    met = anchors.join(sizes, keys).select(
        *keys, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("row"), "stretches").cast("int").alias("stretch"),
        F.lit(True).alias("anchor"), "row", "id", "label", "q", "low", "high")
    cell = F.xxhash64(*keys, "part", "stretch")
    return (rows.union(met).select(cell.alias("cell"), "anchor", "row", "id", "label", "q", "low", "high")
            .repartition("cell").sortWithinPartitions("cell", "anchor"))


def mine(vectors: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES,
         negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST, block: int = BLOCK,
         stretch: int = STRETCH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors
    among ``vectors`` (vec_id, embedding, label): for each of an anchor's ``positives`` best rows of
    its label the ``negatives`` best rows of other labels whose score is ``least`` to ``most`` percent of
    the positive's."""
    if not 0 < positives <= POSITIVES:
        raise ValueError(f"{POSITIVES} positives at most")
    rows = whole(vectors, scale)
    # rare labels share a family, so that every family has a few hundred rows
    n = rows.groupBy("label", "size").agg(F.count("*").alias("n"))
    rare = n.where(F.col("n") < FEW).groupBy("size").agg(
        F.ceil(F.sum("n") / FEW).alias("shared"))
    family = F.when(F.col("n") >= FEW, F.col("label").cast("string")).otherwise(
        F.concat(F.lit("rare "), F.pmod(F.xxhash64("label"), F.col("shared"))))
    families = keep(n.join(rare, "size", "left").select("label", "size", family.alias("family")),
                    "families")
    rows = rows.join(families, ["label", "size"])
    nothing = F.lit(None).cast("array<long>")
    anchors = rows.withColumn("vec_id", F.col("id")).where(is_anchor).drop("vec_id").select(
        "*", nothing.alias("low"), nothing.alias("high"))

    found = _grid(rows, anchors, ["size", "family"], block, stretch).mapInArrow(
        lambda b: _positives(b, positives), _FOUND)
    best = W.partitionBy("anchor_row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = keep(found.withColumn("nth", F.row_number().over(best) - 1).where(F.col("nth") < positives),
                 "positives")
    bands = found.groupBy("anchor_row").agg(F.array_sort(F.collect_list(
        F.struct("nth", "score"))).alias("p"))
    score = F.transform("p", lambda p: p["score"])
    # whole-number bounds of least * p <= 100 * n <= most * p
    low = F.transform(score, lambda s: F.ceil(s * least / F.lit(100).cast("decimal(3,0)")).cast("long"))
    high = F.transform(score, lambda s: F.floor(s * most / F.lit(100).cast("decimal(3,0)")).cast("long"))
    ready = (anchors.drop("low", "high").join(bands.withColumnRenamed("anchor_row", "row"), "row")
             .select("row", "id", "label", "q", "size", low.alias("low"), high.alias("high")))

    nearby = _grid(rows, keep(ready, "bands"), ["size"], block, stretch, SPREAD).mapInArrow(
        lambda b: _negatives(b, negatives), _FOUND)
    hardest = W.partitionBy("anchor_row", "nth").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    nearby = nearby.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    named = found.select("anchor_row", "nth", F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return (nearby.join(named, ["anchor_row", "nth"]).join(ids, "anchor_row")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % RELABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(
        F.col("label"))
    return mine(vectors.withColumn("label", label), F.col("vec_id") % EVERY == 0)


OP13_SQL = f"""
with v as (select row_number() over () as r, vec_id,
                  case when vec_id % {RELABELLED} = 0 then (label + 1) % {LABELS} else label end as label,
                  cast(embedding as double[]) as e from embeddings),
rows as (select r, vec_id, label, list_transform(e, lambda x: cast(floor({SCALE} * x) as bigint)) as q from v
         where label is not null and e is not null
         and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0),
scored as (select a.r, a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id, cast(coalesce(
           list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0) as bigint) as score
           from rows a join rows b on a.vec_id % {EVERY} = 0 and a.r <> b.r and len(a.q) = len(b.q)),
positives as (select * from (select *, row_number() over (
              partition by r order by score desc, id nulls last) as nth from scored where same)
              where nth <= {POSITIVES}),
near as (select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score,
         n.score as negative_score, row_number() over (
         partition by p.r, p.nth order by n.score desc, n.id nulls last) as rank
         from positives p join scored n on p.r = n.r and not n.same
         and {LEAST} * p.score <= 100 * n.score and 100 * n.score <= {MOST} * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from near where rank <= {NEGATIVES}"""
