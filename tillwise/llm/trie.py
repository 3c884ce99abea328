"""The prefix trie of conversations, with totals over subtrees by time-forward processing.

A conversation is rebuilt from the first turns of another one (``heads``) and its own later turns. A trie
node is a distinct sequence of first turns. Nodes are never compared as texts: a turn and its
place hash to 128 bits, a node is its depth and the bits of its turns added without carry, and
these prefix sums are taken over stretches of a conversation first and inside a stretch then, so
that a conversation of any length is worked on by many tasks.

Totals over subtrees travel forward in time. Conversations are laid out by their nodes at depths 1,
2, 4, ... and cut into shards of neighbours; a node all of whose conversations are in one shard is
done there, others where 64 shards, 64 times 64 and so on meet. In a shard the nodes come sorted by
reverse level order (Spark sorts them and spills). A node takes the messages of its children
from a priority queue that spills sorted runs to scratch files of its task, adds itself, and sends one
message to its parent. Messages to parents that are not in the shard are added up and come out:
they are what the shard's roots hand to the next level.

Results: turns are ordered by number, null first, ties by a hash of role and text; a null role or
text is empty; rows without a conversation id take no part; repeated rows are turns of their own; a
conversation without turns is a member of the root; an empty table gives no rows; other columns
are ignored. The ids of conversations that end in a node are digested as a stream, in order, in messages
of neighbouring ids.
"""

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.tables import keep, table

BLOCK = 100  # conversations that share a head, of the query
MOST_SHARED = 6
STRETCH = 256  # turns that are numbered and added up at once
SHARD_TURNS = 8192  # turns of a shard, about
FAN_BITS = 6  # 64 shards meet at the next level
SORT_DEPTHS = [1, 2, 4, 8, 16, 32, 64, 128]
IN_MEMORY = 100_000  # messages that a queue holds before it spills
IDS = 4096  # ids of one message to the digest

# ---- queue ----------------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples, smallest first. Beyond ``limit`` tuples the larger half is written to
    a scratch file as a sorted run; runs are read back in step with what is popped."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.heap, self.runs, self.spilled = limit, [], [], 0

    @staticmethod
    def _run(file) -> Iterator[tuple]:
        file.seek(0)
        with file:
            while chunk := file.read(8):
                yield from pickle.loads(file.read(int.from_bytes(chunk, "little")))

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        out, self.heap = self.heap[half:], self.heap[:half]  # a sorted list is a heap
        file = tempfile.TemporaryFile()
        for at in range(0, len(out), 4096):
            data = pickle.dumps(out[at:at + 4096], pickle.HIGHEST_PROTOCOL)
            file.write(len(data).to_bytes(8, "little") + data)
        self.spilled += len(out)
        run = self._run(file)
        self.runs.append((next(run), len(self.runs) + self.spilled, run))
        heapq.heapify(self.runs)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def first(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if not self.runs or (self.heap and self.heap[0] <= self.runs[0][0]):
            return heapq.heappop(self.heap)
        item, nth, run = self.runs[0]
        following = next(run, None)
        if following is None:
            heapq.heappop(self.runs)
        else:
            heapq.heapreplace(self.runs, (following, nth, run))
        return item

# ---- rebuilt conversations ------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, t1, t2, chars): each turn's place in its conversation, the 128 bits of its role and
    text, and the length of its text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = keep(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.floor(F.col("turn") / STRETCH).alias("stretch"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit("second"), text, role).alias("t2"),
        F.char_length(text).cast("long").alias("chars")), "turns")
    before = W.partitionBy("_conv").orderBy(F.asc_nulls_first("_stretch")).rowsBetween(
        W.unboundedPreceding, -1)
    starts = (turns.groupBy(F.col("conv_id").alias("_conv"), F.col("stretch").alias("_stretch"))
              .agg(F.count("*").alias("n"))
              .select("_conv", "_stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = W.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_first("turn"), "t1", "t2")
    return keep(turns.withColumn("nth", F.row_number().over(inside))
                .join(starts, (F.col("conv_id") == F.col("_conv"))
                      & F.col("stretch").eqNullSafe(F.col("_stretch")))
                .select("conv_id", (F.col("start") + F.col("nth")).alias("n"), "t1", "t2", "chars"),
                "numbered")


def _placed() -> list[Column]:
    """The bits of a turn at its place."""
    return ["conv_id", "n", F.xxhash64("t1", "n").alias("x1"), F.xxhash64("t2", "n").alias("x2"), "chars"]


def rebuilt(turns: DataFrame, head: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n, x1, x2, chars) of every turn of the rebuilt conversations, and (conv_id, turns) of
    every conversation. ``head`` is the conversation whose first ``shared`` turns, ``most`` at most, a
    conversation begins with in place of its own first ones."""
    convs = turns.groupBy("conv_id").agg(F.max("n").alias("own")).select(
        "conv_id", "own", head.alias("head"), shared.cast("int").alias("shared"))
    heads = (turns.where(F.col("n") <= most)
             .join(convs.select(F.col("head").alias("conv_id")).distinct(), "conv_id")
             .groupBy(F.col("conv_id").alias("head"))
             .agg(F.array_sort(F.collect_list(F.struct("n", "t1", "t2", "chars"))).alias("first")))
    first = F.slice(F.coalesce("first", F.expr("array()")), F.lit(1), F.col("shared"))
    convs = keep(convs.join(heads, "head", "left").select(
        "conv_id", "shared", first.alias("first"), F.size(first).cast("long").alias("kept"),
        (F.size(first) + F.greatest(F.lit(0), F.col("own") - F.col("shared"))).alias("turns")), "rebuilt")
    taken = convs.select("conv_id", F.inline("first"))
    own = turns.join(convs, "conv_id").where(F.col("n") > F.col("shared")).select(
        "conv_id", (F.col("n") - F.col("shared") + F.col("kept")).alias("n"), "t1", "t2",
        turns["chars"])
    return keep(taken.unionByName(own).select(*_placed()), "placed"), convs.select("conv_id", "turns")


def paths(placed: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, up_a, up_b, chars): the node at every depth of every conversation, its
    parent, and the length of its last text."""
    band = F.floor(F.col("n") / STRETCH)
    placed = placed.withColumn("band", band)
    before = W.partitionBy("_conv").orderBy("_band").rowsBetween(W.unboundedPreceding, -1)
    starts = (placed.groupBy(F.col("conv_id").alias("_conv"), F.col("band").alias("_band"))
              .agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
              .select("_conv", "_band", F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("s1"),
                      F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("s2")))
    upto = W.partitionBy("conv_id", "band").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    sums = placed.select("*", F.bit_xor("x1").over(upto).alias("i1"), F.bit_xor("x2").over(upto).alias("i2"))
    a, b = F.col("s1").bitwiseXOR(F.col("i1")), F.col("s2").bitwiseXOR(F.col("i2"))
    return keep(sums.join(starts, (F.col("conv_id") == F.col("_conv")) & (F.col("band") == F.col("_band")))
                .select("conv_id", F.col("n").alias("depth"), a.alias("a"), b.alias("b"),
                        a.bitwiseXOR(F.col("x1")).alias("up_a"), b.bitwiseXOR(F.col("x2")).alias("up_b"),
                        "chars"), "paths")

# ---- shards and nodes -----------------------------------------------------------------


def shards(found: DataFrame, convs: DataFrame, turns_each: int) -> DataFrame:
    """(conv_id, shard): neighbours in the order of their first nodes are in one shard."""
    keys = [F.max(F.when(F.col("depth") == d, F.col("a"))).alias(f"k{d}") for d in SORT_DEPTHS]
    laid = convs.select("conv_id").join(
        found.where(F.col("depth").isin(SORT_DEPTHS)).groupBy("conv_id").agg(*keys), "conv_id", "left")
    n = max(1, -(-found.count() // turns_each))  # one number
    # four ranges make a shard, so shards are about even though ranges are only sampled
    return keep(laid.repartitionByRange(4 * n, *[f"k{d}" for d in SORT_DEPTHS], "conv_id")
                .select("conv_id", F.shiftright(F.spark_partition_id().cast("long"), 2).alias("shard")),
                "shards")


def nodes(found: DataFrame, placed_in: DataFrame) -> DataFrame:
    """One row per node: its key (depth, a, b), parent, smallest member, members, length of the last text,
    and the level and shard where all its members meet."""
    top = placed_in.select(
        "conv_id", "shard", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c)
                                                                    for c in ("a", "b", "up_a", "up_b", "chars")])
    rows = found.join(placed_in, "conv_id").unionByName(top)
    spread = F.length(F.bin(F.col("low").bitwiseXOR(F.col("high"))))
    level = F.when(F.col("low") == F.col("high"), 0).otherwise(F.ceil(spread / FAN_BITS)).cast("int")
    return keep(rows.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars"),
        F.first("up_a").alias("up_a"), F.first("up_b").alias("up_b"),
        F.min("shard").alias("low"), F.max("shard").alias("high"))
        .withColumn("level", level)
        .withColumn("shard", F.expr(f"shiftright(high, {FAN_BITS} * level)")).drop("low", "high"), "nodes")

# ---- time-forward processing ----------------------------------------------------------


_TOTALS = ["n_children", "n_leaves", "saved_tokens"]
_OUT = ("final boolean, depth long, a long, b long, n_children long, n_leaves long, saved_tokens long")
_OUT_ARROW = pa.schema([("final", pa.bool_())] + [(c, pa.int64()) for c in ("depth", "a", "b", *_TOTALS)])
_IN = ["shard", "depth", "a", "b", "up_a", "up_b", "n_convs", "chars", *_TOTALS]


def _taken(queue: SpillingQueue, upto: tuple | None) -> Iterator[tuple]:
    """Messages to nodes before ``upto`` in the order of processing, added up by node."""
    while (first := queue.first()) is not None and (upto is None or first[:3] < upto):
        key, children, leaves, saved = first[:3], 0, 0, 0
        while (first := queue.first()) is not None and first[:3] == key:
            _, _, _, c, l, s = queue.pop()
            children, leaves, saved = children + c, leaves + l, saved + s
        yield (False, -key[0], key[1], key[2], children, leaves, saved)


def forward(rows: Iterator[tuple], limit: int = IN_MEMORY) -> Iterator[tuple]:
    """Totals of the nodes of several shards. ``rows`` (columns ``_IN``) come by shard and in reverse level
    order. Gives (True, node, totals), and (False, parent, totals) for parents that are not there."""
    for _, of_shard in groupby(rows, key=lambda r: r[0]):
        queue = SpillingQueue(limit)
        for _, depth, a, b, up_a, up_b, n_convs, chars, children, leaves, saved in of_shard:
            now = (-depth, a, b)
            yield from _taken(queue, now)
            while (first := queue.first()) is not None and first[:3] == now:
                _, _, _, c, l, s = queue.pop()
                children, leaves, saved = children + c, leaves + l, saved + s
            if not children:
                leaves += 1
            saved += (n_convs - 1) * chars
            yield (True, depth, a, b, children, leaves, saved)
            if depth:
                queue.push((1 - depth, up_a, up_b, 1, leaves, saved))
        yield from _taken(queue, None)


def _forward(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in _IN), strict=True)
    out = []
    for row in forward(rows(), limit):
        out.append(row)
        if len(out) == 8192:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=_OUT_ARROW)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], schema=_OUT_ARROW)


def totals(found: DataFrame, limit: int = IN_MEMORY) -> DataFrame:
    """(depth, a, b, n_children, n_leaves, saved_tokens) of every node: within shards, then across their
    roots, level by level."""
    key = ["depth", "a", "b"]
    last = found.agg(F.max("level")).first()[0]
    if last is None:
        last = 0
    done, sent = [], None
    for level in range(last + 1):
        rows = found.where(F.col("level") == level)
        if sent is None:
            rows = rows.select("*", *[F.lit(0).cast("long").alias(c) for c in _TOTALS])
        else:
            told = sent.groupBy(key).agg(*[F.sum(c).alias(c) for c in _TOTALS])
            rows = rows.join(told, key, "left").na.fill(0, _TOTALS)
        packed = keep(rows.select(_IN).repartition("shard")
                      .sortWithinPartitions("shard", F.desc("depth"), "a", "b")
                      .mapInArrow(lambda b: _forward(b, limit), _OUT), "totals")
        done.append(packed.where("final").drop("final"))
        out = packed.where("not final").drop("final")
        sent = out if sent is None else sent.union(out)
    result = done[0]
    for part in done[1:]:
        result = result.union(part)
    return result

# ---- ends -----------------------------------------------------------------------------


def ends(found: DataFrame, convs: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes in which conversations end."""
    key = ["depth", "a", "b"]
    zero = F.lit(0).cast("long")
    last = convs.where("turns > 0").select("conv_id", F.col("turns").alias("depth")).join(
        found.select("conv_id", *key), ["conv_id", "depth"]).select("conv_id", *key)
    none = convs.where("turns = 0").select("conv_id", *[zero.alias(c) for c in key])
    chunk = F.floor(F.col("conv_id") / IDS)
    messages = (last.unionByName(none).groupBy(*key, chunk.alias("chunk"))
                .agg(F.array_sort(F.collect_list("conv_id")).alias("ids")))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    yield from zip(*(part.column(c).to_pylist() for c in (*key, "ids")), strict=True)
        out = []
        for node, of_node in groupby(rows(), key=lambda r: r[:3]):
            made, comma = hashlib.sha256(), b""
            for *_, ids in of_node:
                made.update(comma + ",".join(map(str, ids)).encode())
                comma = b","
            out.append((*node, made.hexdigest()))
            if len(out) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [*key, "ends_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], [*key, "ends_sha256"])

    return (messages.repartition(*[F.col(c) for c in key]).sortWithinPartitions(*key, "chunk")
            .mapInArrow(digest, "depth long, a long, b long, ends_sha256 string"))

# ---- trie -----------------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, head: Column, shared: Column, most: int,
                shard_turns: int = SHARD_TURNS, limit: int = IN_MEMORY) -> DataFrame:
    """One row per node of the trie over ``conversations`` (conv_id, turn, role, text): conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. ``head`` and
    ``shared``: as in ``rebuilt``, over conv_id."""
    key = ["depth", "a", "b"]
    placed, convs = rebuilt(numbered(conversations), head, shared, most)
    found = paths(placed)
    trie = nodes(found, shards(found, convs, shard_turns))
    parents = trie.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"),
                          F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    nobody = F.lit(hashlib.sha256().hexdigest())
    whole = (trie.select(*key, "up_a", "up_b", "conv_id", "n_convs")
             .join(totals(trie, limit), key).join(keep(ends(found, convs), "ends"), key, "left"))
    return whole.join(parents, ["depth", "up_a", "up_b"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", *_TOTALS,
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv_id")
    return prefix_trie(table(spark, sf_dir, "conversations"), conv - conv % BLOCK,
                       F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED, MOST_SHARED - 1)


OP12_SQL = f"""
with numbered as (select conv_id, role, text, row_number() over (
                  partition by conv_id order by turn nulls first, role, text) as n
                  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
                        from conversations where conv_id is not null)),
own as (select conv_id, list({{'role': role, 'text': text}} order by n) as turns from numbered group by conv_id),
shared as (select conv_id, turns, cast(xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(
           string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint))), lambda s, c:
           list_reduce(list_prepend(xor(s, c), list_transform(range(8), lambda i: cast(i as bigint))), lambda x, i:
           case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)),
           4294967295) % {MOST_SHARED} as bigint) as h from own),
rebuilt as (select s.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, s.h),
            list_slice(s.turns, s.h + 1, len(s.turns))) as turns
            from shared s left join own b on b.conv_id = s.conv_id - s.conv_id % {BLOCK}),
depths as (select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from rebuilt),
members as (select conv_id, depth, list_slice(turns, 1, depth) as path, len(turns) = depth as ends from depths),
nodes as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(
          case when ends then cast(conv_id as varchar) end, ',' order by conv_id), '')) as ends_sha256
          from members group by path, depth),
valued as (select *, case when depth = 0 then 0 else (n_convs - 1) * length(path[depth].text) end as saved,
           list_slice(path, 1, depth - 1) as up from nodes),
children as (select up, count(*) as n from valued where depth > 0 group by up),
marked as (select v.*, coalesce(c.n, 0) as n_children from valued v left join children c on c.up = v.path),
above as (select list_slice(m.path, 1, k) as path, m.saved, m.n_children
          from (select *, unnest(range(0, depth + 1)) as k from marked) m),
subtree as (select path, sum(saved) as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
            from above group by path)
select m.conv_id, m.depth, p.conv_id as parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       cast(s.saved_tokens as bigint) as saved_tokens, m.ends_sha256
from marked m join subtree s on s.path = m.path
left join marked p on m.depth > 0 and p.path = m.up"""
