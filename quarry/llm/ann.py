"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node. A graph of each node's nearest nodes starts from cells of random hyperplanes
and is improved by joins of neighbours of neighbours: every node introduces its neighbours, in both
directions, to each other, and each keeps the best it has met; only pairs with a fresh edge are compared.
A query starts at its own node and repeatedly visits the best nodes it has not visited yet, taking in
their neighbours, until its list of best nodes holds visited ones only. All of it is joins and windows over
the edge table; vectors travel in single precision (bytes would confuse near copies), and the whole final list
is scored on the originals.

The nearness is the largest inner product. The graph is built over vectors lengthened by one component
that gives all of them the same norm, for which larger inner products are smaller distances.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import broadcast_if_small, saved

# Edges of a node; nodes of a starting cell; members of one group of introductions.
DEGREE, CELL, GROUP = 32, 512, 128
# Starting rounds, each with its own hyperplanes.
STARTS = 2
# Descent ends when less than this share of the edges is fresh.
FRESH = 0.12
# Best nodes a search keeps, all of them scored on their original vectors.
BEAM = 160
SEED = 11


def usable(df: DataFrame, key: str, vec: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part."""
    v = F.col(vec).cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.select(F.col(key).cast("long").alias("id"), v.alias("vec")).where(fine)


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision, summed in order; components that the shorter one lacks count as 0."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def largest(vec: Column) -> Column:
    """Largest absolute value of a vector's components."""
    return F.aggregate(vec, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))


def scaled(vec: Column, by: Column) -> Column:
    """The vector divided by ``by``."""
    return F.transform(vec, lambda x: x / by)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of vectors, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dim))
    sizes = column.value_lengths().to_numpy()
    out[np.arange(dim) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def coded(nodes: DataFrame, dim: int, scale: float, norm: float) -> DataFrame:
    """``node, code, q_code``: bytes of single-precision numbers, for a place in the graph the vector over ``scale``,
    lengthened to ``norm``, and for a query the vector over its own largest component, not lengthened."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = matrix(batch.column("vec"), dim)
            x = whole / scale
            last = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
            code = (np.column_stack([x, last]) / norm).astype(np.float32)  # by the norm: no overflow
            own = np.column_stack([whole / np.abs(whole).max(axis=1, keepdims=True), np.zeros(len(x))]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array([r.tobytes() for r in c], pa.binary()) for c in (code, own))],
                                             names=["node", "code", "q_code"])

    return nodes.select("node", "vec").mapInArrow(kernel, "node long, code binary, q_code binary")


def decoded(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(edges, edges[1:], strict=False):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


EDGE = "node long, nbr long, score float"


def found_edges(node: list[np.ndarray], nbr: list[np.ndarray], score: list[np.ndarray]) -> pa.RecordBatch:
    columns = [np.concatenate(x) if x else np.zeros(0) for x in (node, nbr, score)]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(t)) for c, t in zip(columns, (np.int64, np.int64, np.float32), strict=True)],
                                      names=["node", "nbr", "score"])


def met(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Kernel: in each group, edges between members that beat a member's bound and have a fresh end."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        held = 0
        for group in by_group(batches, keys):
            ids, first = np.unique(group["member"].to_numpy(), return_index=True)
            if len(ids) < 2:
                continue
            fresh = np.isin(ids, group["member"].to_numpy()[group["fresh"].to_numpy(zero_copy_only=False)])
            part = group.take(pa.array(first)).combine_chunks()
            x = decoded(part["code"].chunk(0))
            bound = part["bound"].to_numpy()
            score = x @ x.T
            good = (score > bound[:, None]) & (fresh[:, None] | fresh[None, :])
            np.fill_diagonal(good, False)
            i, j = np.nonzero(good)
            if len(ids) > DEGREE + 1 and len(i):  # of each member only as many as it could keep
                order = np.lexsort((-score[i, j], i))
                i, j = i[order], j[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[rank < DEGREE], j[rank < DEGREE]
            for to, value in zip(out, (ids[i], ids[j], score[i, j]), strict=True):
                to.append(value)
            held += len(i)
            if held > 200_000:
                yield found_edges(*out)
                out, held = ([], [], []), 0
        yield found_edges(*out)

    return kernel


def kept(edges: DataFrame) -> DataFrame:
    """The DEGREE best edges of each node; an edge that was known before is not fresh."""
    best = Window.partitionBy("node").orderBy(F.desc("score"), "nbr")
    return (edges.repartition("node").groupBy("node", "nbr").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= DEGREE).drop("rank"))


def started(codes: DataFrame, dim: int, n: int) -> DataFrame:
    """First edges: the best of each node within cells of random hyperplanes, cut into parts of CELL nodes."""
    bits = max(0, math.ceil(math.log2(max(1, 2 * n / CELL))))
    planes = np.random.default_rng(SEED).normal(size=(STARTS, dim + 1, bits))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = decoded(batch.column("code"))
            for r in range(STARTS):
                cell = ((x @ planes[r]) > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node"), pa.array(np.full(len(x), r, np.int32)), pa.array(cell.astype(np.int64)),
                     batch.column("code")], names=["member", "start", "cell", "code"])

    cells = codes.mapInArrow(kernel, "member long, start int, cell long, code binary")
    sizes = broadcast_if_small(saved(cells.groupBy("start", "cell").agg(F.ceil(F.count("*") / CELL).alias("parts"))))
    dealt = cells.join(sizes, ["start", "cell"]).withColumn("part", F.pmod(F.xxhash64("member", "start"), "parts"))
    keys = ["start", "cell", "part"]
    dealt = dealt.select(*keys, "member", "code", F.lit(True).alias("fresh"), F.lit(float("-inf")).alias("bound"))
    return kept(dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(met(keys), EDGE).withColumn("fresh", F.lit(True)))


def introduced(graph: DataFrame, codes: DataFrame) -> DataFrame:
    """Edges found by introducing each node's neighbours, both ways, to each other.

    The nodes that point to one node are dealt into groups of GROUP, each with all nodes it points to: a
    hub meets no task whole, and each of its neighbours meets the hub's own list.
    """
    ends = graph.groupBy("node").agg(F.when(F.count("*") >= DEGREE, F.min("score")).otherwise(float("-inf")).cast("double").alias("bound"))
    known = saved(codes.join(ends, "node", "left").select(F.col("node").alias("member"), "code",
                                                          F.coalesce("bound", F.lit(float("-inf"))).alias("bound")))
    parts = graph.groupBy(F.col("nbr").alias("at")).agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    forth = (graph.select(F.col("node").alias("at"), F.col("nbr").alias("member"), "fresh").join(parts, "at", "left")
             .select("at", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), "member", "fresh"))
    back = (graph.select(F.col("nbr").alias("at"), F.col("node").alias("member"), "fresh").join(parts, "at")
            .select("at", F.pmod(F.xxhash64("member"), "parts").cast("int").alias("part"), "member", "fresh"))
    keys = ["at", "part"]
    meeting = forth.union(back).join(broadcast_if_small(known, ("code",)), "member")
    return meeting.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(met(keys), EDGE).withColumn("fresh", F.lit(True))


def graph_of(codes: DataFrame, dim: int, n: int) -> DataFrame:
    """``node, nbr, score, fresh``: the graph after its descent."""
    graph = saved(started(codes, dim, n))
    while True:  # every round makes lists of edges better, so it ends
        old = graph.withColumn("fresh", F.lit(False))
        graph = saved(kept(old.union(introduced(graph, codes).select(*old.columns))))
        edges, fresh = graph.agg(F.count("*"), F.count_if("fresh")).first()
        if fresh <= FRESH * edges:
            return graph


def searched(queries: DataFrame, graph: DataFrame, codes: DataFrame) -> DataFrame:
    """``query, node, score``: the best nodes of each of the ``query`` nodes, by greedy search from itself."""
    both = graph.select("node", "nbr").union(graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))).distinct()
    near = codes.select(F.col("node").alias("nbr"), "code")
    around = both.join(broadcast_if_small(near, ("code",)), "nbr").repartition("node").persist()
    codes_of = broadcast_if_small(saved(queries.join(codes, F.col("query") == F.col("node")).select("query", "q_code")), ("q_code",))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = (decoded(batch.column("q_code")) * decoded(batch.column("code"))).sum(axis=1)
            good = score > batch.column("bound").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("query").filter(pa.array(good)), batch.column("nbr").filter(pa.array(good)),
                 pa.array(score[good].astype(np.float32))], names=["query", "node", "score"])

    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    state = saved(queries.select("query", F.col("query").alias("node"), F.lit(float("inf")).cast("float").alias("score"),
                                 F.lit(False).alias("visited")))
    while True:  # a node that left a list is below its bound and does not come back, so it ends
        bounds = state.groupBy("query").agg(F.when(F.count("*") >= BEAM, F.min("score")).otherwise(float("-inf")).cast("double").alias("bound"))
        ahead = state.where(~F.col("visited")).join(bounds, "query").select("query", "node", "bound")
        pairs = ahead.join(around, "node").join(codes_of, "query")
        new = pairs.select("query", "nbr", "bound", "code", "q_code").mapInArrow(
            kernel, "query long, node long, score float").withColumn("visited", F.lit(False))
        merged = state.withColumn("visited", F.lit(True)).union(new).repartition("query").groupBy("query", "node").agg(
            F.max("score").alias("score"), F.max("visited").alias("visited"))
        state = saved(merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BEAM).drop("rank"))
        if state.where(~F.col("visited")).isEmpty():
            around.unpersist()
            return state.select("query", "node", "score")


def nearest(df: DataFrame, is_query: Column, key: str = "vec_id", vec: str = "embedding", k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of every query among all other rows.

    ``is_query`` is a condition on the column ``id``. Scores are inner products of the original vectors in
    double precision, components that a shorter vector lacks counting as 0; ties go to the smaller id, a null id
    last. Where doubles cannot hold a product (infinite, or 0 by underflow), the inner products of the vectors
    over powers of two near their largest components decide first. Vectors that are null, empty or zero, or hold
    null or non-finite components, take no part. Each row counts, also one that repeats an id or a whole row: rows
    that are equal find each other, and each query row has its own list. Equal vectors share a node, of which the
    k + 1 least rows can be among the nearest. With fewer candidates all of them are returned; an empty table, or
    one without queries, gives an empty result. Further columns are not read.
    """
    rows = saved(usable(df, key, vec).groupBy("vec", "id").agg(F.count("*").alias("copies")))
    nodes = saved(rows.select("vec").distinct().sortWithinPartitions("vec").select(F.monotonically_increasing_id().alias("node"), "vec"))
    ids = saved(rows.join(nodes, "vec").select("id", "node", "copies"))
    top = nodes.agg(F.max(largest(F.col("vec")))).first()[0]
    scale = 2.0 ** (math.frexp(top)[1] - 1) if top else 1.0
    over = scaled(F.col("vec"), F.lit(scale))
    n, dim, norm = nodes.agg(F.count("*"), F.max(F.size("vec")), F.max(dot(over, over))).first()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    codes = saved(coded(nodes, dim, scale, math.sqrt(norm)))
    graph = graph_of(codes.select("node", "code"), dim, n)
    # the copies of a query row are rows of their own
    queries = ids.where(is_query).select(F.col("id").alias("query_id"), F.col("node").alias("query"),
                                         F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("query_copy"))
    found = searched(queries.select("query").distinct(), graph, codes).select("query", "node")
    least = Window.partitionBy("node").orderBy(F.asc_nulls_last("id"), "copy")
    members = (ids.select("node", F.col("id"), F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k + 1)))).alias("copy"))
               .withColumn("place", F.row_number().over(least)).where(F.col("place") <= k + 1)
               .select("node", F.col("id").alias("vec_id"), "copy"))
    size = F.pow(F.lit(2.0), F.floor(F.log2(largest(F.col("vec")))))
    vecs = saved(found.select("query").distinct().join(nodes, F.col("query") == F.col("node")).select(
        "query", F.col("vec").alias("q_vec"), size.alias("q_size")))
    pairs = found.join(nodes, "node").join(vecs, "query").withColumn("exact", dot(F.col("q_vec"), F.col("vec")))
    held = (F.abs("exact") < float("inf")) & (F.col("exact") != 0)  # false for NaN, the sum of opposite infinities
    near = F.when(held, 0.0).otherwise(dot(scaled(F.col("q_vec"), F.col("q_size")), scaled(F.col("vec"), F.lit(scale))))
    scored = pairs.select("query", "node", "exact", near.alias("near")).select(
        "query", "node", "near", F.when(F.isnan("exact"), F.nanvl(F.col("near") * float("inf"), F.lit(0.0))).otherwise(F.col("exact")).alias("score"))
    # of a query node as many as any row of it can return; then the rows themselves
    best = [F.desc("score"), F.desc("near"), F.asc_nulls_last("vec_id")]
    lists = (scored.join(members, "node").withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(*best, "node", "copy")))
             .where(F.col("place") <= k + 1))
    itself = (F.col("node") == F.col("query")) & F.col("vec_id").eqNullSafe(F.col("query_id")) & (F.col("copy") == F.col("query_copy"))
    order = Window.partitionBy("query_id", "query", "query_copy").orderBy("place")
    return (queries.join(lists, "query").where(~itself).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
