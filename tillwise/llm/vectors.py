"""Near-duplicate vectors by exact cosine, compared in tiles ordered by principal components.

Unit vectors are turned to the principal axes of the corpus, so the leading dimensions carry
most of a product. Two linked unit vectors are at most ``sqrt(2 - 2 t)`` apart in every
coordinate, so cells of that width on the first axes only meet their neighbours. A label is cut
on as many axes as its size asks for, since every pair of tiles costs a journey of both. A cell is
dealt into tiles of bounded size, and pairs of tiles are compared: products of the leading
dimensions first; what the other dimensions can add is at most the product of the suffix
norms, and a pair is given up as soon as that no longer reaches the threshold. The pairs left
are decided by the cosine of the given components in double precision.

Equal vectors of a label are one node with a multiplicity. A comparison gives each node its
number of links and one edge to its group, never the pairs, so a group of
near copies costs rows in proportion to its tiles.

Results: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, link with nothing; vectors of different lengths do not link either; each of
them is its own component. Equal rows link with each other. A null id is nobody's smallest id unless
the whole component has none. An empty table gives no rows; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwise.llm.components import components
from tillwise.llm.tables import keep, table

THRESHOLD = 0.93
TILE = 2048  # vectors of up to LONG numbers; fewer of longer ones
LONG = 256
BLOCK = 512  # rows of a tile that are multiplied at once
AXES = 3
STEPS = (8, 16, 32)  # dimensions after which the bound is looked at
SLACK = 1e-5  # what single precision may be off in a bound
TURNED_LENGTHS = 4  # vector lengths that get principal axes; others keep their own
_CELL = [f"c{i}" for i in range(AXES)]
_KEY = ["label", "size", *_CELL, "sub"]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no cosine but keeps squares finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]

# ---- nodes and axes -------------------------------------------------------------------


def with_node(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x, node); the node names label and vector, and is null for vectors that
    link with nothing."""
    x = F.col("embedding").cast("array<double>")
    fit = (F.col("label").isNotNull() & x.isNotNull()
           & F.forall(x, lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
           & F.exists(x, lambda c: c != 0))
    name = F.substring(F.sha2(F.to_json(F.struct("label", x.alias("x"))), 256), 1, 32)
    return vectors.select("vec_id", "label", x.alias("x"), F.when(fit, name).alias("node"))


def axes(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes, strongest first, for the most frequent vector lengths. Partitions sum
    their second moments, which are added up in eight tasks and then once more."""
    found = {}
    lengths = (nodes.groupBy(F.size("x").alias("size")).count()
               .orderBy(F.desc("count"), "size").limit(TURNED_LENGTHS))
    for size in [r["size"] for r in lengths.collect()]:
        def moments(batches: Iterator[pd.DataFrame], size=size) -> Iterator[pd.DataFrame]:
            total = np.zeros((size, size))
            for batch in batches:
                if len(batch):
                    u = unit(np.stack(batch["x"]).astype(float))
                    total += u.T @ u
            yield pd.DataFrame({"sums": [total.tobytes()]})

        def added(batches: Iterator[pd.DataFrame], size=size) -> Iterator[pd.DataFrame]:
            total = np.zeros(size * size)
            for batch in batches:
                for sums in batch["sums"]:
                    total += np.frombuffer(sums)
            yield pd.DataFrame({"sums": [total.tobytes()]})

        parts = (nodes.where(F.size("x") == size).select("x").mapInPandas(moments, "sums binary")
                 .repartition(8).mapInPandas(added, "sums binary").collect())
        total = sum(np.frombuffer(p["sums"]).reshape(size, size) for p in parts)
        found[size] = np.linalg.eigh(total)[1][:, ::-1]
    return found

# ---- tiles ----------------------------------------------------------------------------


def tiles(nodes: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Rows of ``_KEY`` columns and ``rows``: (node, copies, turned, x) of at most about ``tile``
    nodes; vectors are packed numbers."""
    turn = nodes.sparkSession.sparkContext.broadcast(axes(nodes))
    width = np.sqrt(max(2 - 2 * threshold, 0)) + 1e-4

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, same in batch.groupby(batch["x"].map(len)):
                x = np.stack(same["x"]).astype(float)
                y = unit(x) @ turn.value[size] if size in turn.value else unit(x)
                at = np.floor(np.pad(y[:, :AXES], ((0, 0), (0, max(0, AXES - size)))) / width)
                yield pd.DataFrame({
                    "label": same["label"], "size": np.int32(size), "node": same["node"],
                    "copies": same["copies"],
                    **{c: at[:, i].astype(np.int32) for i, c in enumerate(_CELL)},
                    "turned": [v.tobytes() for v in y.astype(np.float32)],
                    "x": [v.tobytes() for v in scaled(x)]})

    kind = nodes.schema["label"].dataType.simpleString()
    placed = keep(nodes.mapInPandas(
        place, f"label {kind}, size int, node string, copies long, "
        + "".join(f"{c} int, " for c in _CELL) + "turned binary, x binary"), "placed")
    # from the counts of the finest cells: the axes that a label needs, and the tiles of what
    # is then a cell; an axis at least about halves a label
    fine = [f"fine_{c}" for c in _CELL]
    placed = placed.withColumnsRenamed(dict(zip(_CELL, fine)))
    label, cell = ["label", "size"], ["label", "size", *_CELL]
    cells = placed.groupBy(*label, *fine).count()
    room = tile / F.greatest(F.col("size") / LONG, F.lit(1.0))
    needed = F.ceil(F.log2(F.sum("count").over(W.partitionBy(label)) / room))
    cells = cells.withColumn("needed", needed).withColumns({
        c: F.when(F.col("needed") > i, F.col(f)).otherwise(0)
        for i, (c, f) in enumerate(zip(_CELL, fine))})
    parts = F.ceil(F.sum("count").over(W.partitionBy(cell)) / room).cast("int")
    cells = cells.select(*label, *fine, *_CELL, parts.alias("parts"))
    dealt = (placed.join(cells, [*label, *fine])
             .withColumn("sub", F.pmod(F.xxhash64("node"), "parts").cast("int")))
    return keep(dealt.groupBy(_KEY).agg(F.collect_list(F.struct(
        "node", "copies", "turned", "x")).alias("rows")), "tiles")


def tile_pairs(found: DataFrame) -> DataFrame:
    """Pairs of tiles of one cell or of neighbouring cells, each once: ``_KEY`` with the prefixes
    a_ and b_."""
    steps = [s for s in np.ndindex(*[3] * AXES) if s >= (1,) * AXES]  # (1, 1, 1) is the cell itself
    a = found.select(*[F.col(k).alias(f"a_{k}") for k in _KEY], F.explode(F.array(*[
        F.array(*[F.lit(int(d) - 1) for d in s]) for s in steps])).alias("step"))
    b = found.select(*[F.col(k).alias(f"b_{k}") for k in _KEY])
    near = [F.col(f"a_{c}") + F.col("step")[i] == F.col(f"b_{c}") for i, c in enumerate(_CELL)]
    same = F.forall("step", lambda d: d == 0)
    return (a.join(b, [F.col("a_label") == F.col("b_label"), F.col("a_size") == F.col("b_size"), *near])
            .where(~same | (F.col("a_sub") <= F.col("b_sub"))).drop("step"))

# ---- comparison -----------------------------------------------------------------------


def close_pairs(ya: np.ndarray, yb: np.ndarray, xa: np.ndarray, xb: np.ndarray,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two tiles whose cosine reaches the threshold. ``y`` are turned unit vectors in
    single precision, ``x`` the vectors themselves."""
    size = ya.shape[1]
    least = threshold - SLACK
    past, i, j, products = 0, None, None, None
    for upto in [s for s in STEPS if s < size] + [size]:
        if i is None:
            part = ya[:, past:upto] @ yb[:, past:upto].T
            products = part if products is None else products + part
        else:
            products = products + np.einsum("ij,ij->i", ya[i, past:upto], yb[j, past:upto])
        rest_a = np.sqrt(np.square(ya[:, upto:]).sum(1))
        rest_b = np.sqrt(np.square(yb[:, upto:]).sum(1))
        if i is None:
            alive = products + np.outer(rest_a, rest_b) >= least
            if alive.mean() < 0.1:  # go on with single pairs
                i, j = np.nonzero(alive)
                products = products[i, j]
        else:
            alive = products + rest_a[i] * rest_b[j] >= least
            i, j, products = i[alive], j[alive], products[alive]
        if i is not None and not len(i):
            return i, j
        past = upto
    if i is None:
        i, j = np.nonzero(products >= least)
    norm_a = np.sqrt(np.einsum("ij,ij->i", xa, xa))
    norm_b = np.sqrt(np.einsum("ij,ij->i", xb, xb))
    true = np.concatenate([np.zeros(0, bool)] + [
        np.einsum("ij,ij->i", xa[i[at:at + 65536]], xb[j[at:at + 65536]])
        / (norm_a[i[at:at + 65536]] * norm_b[j[at:at + 65536]]) >= threshold
        for at in range(0, len(i), 65536)])
    return i[true], j[true]


def close_in_blocks(ya: np.ndarray, yb: np.ndarray, xa: np.ndarray, xb: np.ndarray,
                    threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """``close_pairs`` block by block, so that products stay small; with ``same`` both tiles are
    one and a pair is given once."""
    found = []
    for p in range(0, len(ya), BLOCK):
        for q in range(p if same else 0, len(yb), BLOCK):
            i, j = close_pairs(ya[p:p + BLOCK], yb[q:q + BLOCK], xa[p:p + BLOCK], xb[q:q + BLOCK],
                               threshold)
            found.append((i + p, j + q))
    i, j = (np.concatenate(side) for side in zip(*found))
    return (i[i < j], j[i < j]) if same else (i, j)


def grouped(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row each of ``n`` rows is connected with."""
    least = np.arange(n)
    while True:
        new = least.copy()
        np.minimum.at(new, i, least[j])
        np.minimum.at(new, j, least[i])
        new = new[new]
        if (new == least).all():
            return least
        least = new


def _unpacked(rows: list[dict]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    return ([r["node"] for r in rows], np.array([r["copies"] for r in rows], np.int64),
            np.stack([np.frombuffer(r["turned"], np.float32) for r in rows]),
            np.stack([np.frombuffer(r["x"], np.float64) for r in rows]))


def _compare(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in ("a_rows", "b_rows", "same")}
            names, copies, ya, xa = _unpacked(row["a_rows"])
            n = len(names)
            if row["same"]:
                i, j = close_in_blocks(ya, ya, xa, xa, threshold, True)
            else:
                more, more_copies, yb, xb = _unpacked(row["b_rows"])
                i, j = close_in_blocks(ya, yb, xa, xb, threshold, False)
                names, copies, j = names + more, np.append(copies, more_copies), j + n
            if not len(i):
                continue
            linked = (np.bincount(i, copies[j], len(names))
                      + np.bincount(j, copies[i], len(names))).astype(np.int64)
            root = grouped(len(names), i, j)
            at = np.flatnonzero(linked).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[x] for x in at], pa.string()), pa.array(linked[at]),
                 pa.array([names[root[x]] for x in at], pa.string())],
                names=["node", "links", "root"])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label)."""
    named = with_node(vectors)
    nodes = keep(named.where("node is not null").groupBy("node").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"),
        F.first("label").alias("label"), F.first("x").alias("x")), "nodes")
    found = tiles(nodes.select("node", "copies", "label", "x"), threshold, tile)
    pairs = keep(tile_pairs(found), "pairs")
    same = F.lit(True)
    for k in _KEY:
        same = same & (F.col(f"a_{k}") == F.col(f"b_{k}"))
    alone, others = pairs.where(same), pairs.where(~same)
    def rows_of(pairs: DataFrame, side: str) -> DataFrame:
        blobs = found.select(*[F.col(k).alias(f"{side}_{k}") for k in _KEY],
                             F.col("rows").alias(f"{side}_rows"))
        return pairs.join(blobs, [f"{side}_{k}" for k in _KEY])
    travelled = (rows_of(alone, "a").select("a_rows", F.lit(None).alias("b_rows"), F.lit(True).alias("same"))
                 .union(rows_of(rows_of(others, "a"), "b").select("a_rows", "b_rows", F.lit(False))))
    links = keep(travelled.mapInArrow(
        lambda b: _compare(b, threshold), "node string, links long, root string"), "links")
    groups = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = keep(
        nodes.select("node", "first_id", "copies")
        .join(links.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
        .join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node")), "known")
    least = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = keep(known.join(least, "component").select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        "component_id"), "known")
    linked = named.where("node is not null").select("vec_id", "node").join(known, "node")
    alone = named.where("node is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (linked.select("vec_id", "n_links", "component_id").union(alone)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP4_SQL = f"""
with recursive
v as (select row_number() over () as r, vec_id, label, cast(embedding as double[]) as e from embeddings),
fit as (select * from v where label is not null and e is not null
        and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(e, lambda x: x <> 0)) > 0),
linked as (select a.r as x, b.r as y from fit a join fit b on a.label = b.label and a.r <> b.r
           and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reached(r, id) as (select r, vec_id from v
                   union select l.x, reached.id from reached join linked l on l.y = reached.r),
least as (select r, min(id) as component_id from reached group by r),
counted as (select x as r, count(*) as n from linked group by x)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from v join least using (r) left join counted using (r)"""
