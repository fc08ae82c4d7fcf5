"""Exact top-k by integer inner product on a bit-sliced index.

The components of all vectors become integers. The index cuts the rows into blocks; a block keeps, for every
dimension, the ``SLICES`` most significant bits of its values above the block's minimum as bitmaps, one bit a
row, beside the integers themselves.

A query adds slices with bitmap arithmetic: its weights are written in signed binary digits, each digit adds
the bitmaps of its dimension (their complements, if negative) at the digit's place, and the bitmaps of
one place are reduced by full adders, whose carries go to the next place. The result is a bit-sliced sum, a
lower bound of every row's score with one known error for all. From the most significant slice downward the
k-th largest sum is found by counting bits; rows whose sum is within the error of it, and of the k-th best
score met so far, lie on the boundary. Their scores are computed exactly and decide.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import saved

# Rows of a block, and bits of a dimension that become slices.
ROWS, SLICES = 16384, 6
# Bytes of the queries that are searched together.
GROUP_BYTES = 4 << 20
# Blocks that meet a group of queries in one cell of the grid, where the queries are not broadcast.
CELL = 64
INDEX = "block long, n long, dims int, kind string, uids binary, ids binary, no_id binary, vals binary"
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, as int64, or as Python integers where these do not fit."""
    small = np.abs(x).max(initial=0.0) < 2.0 ** 52 / scale
    if small:
        return np.floor(x * scale).astype(np.int64)
    flat = [math.floor(v * scale) if abs(v) < 2.0 ** 52 / scale else math.floor(v) * scale + math.floor((v % 1) * scale)
            for v in x.ravel().tolist()]
    return np.array(flat, dtype=object).reshape(x.shape)


class Block:
    """The bit slices of some rows: ``values`` is (dims, rows) of integers."""

    def __init__(self, values: np.ndarray):
        self.values = values
        dims, self.n = values.shape
        words = -(-self.n // 64)
        self.every = np.zeros(words * 64, np.uint8)
        self.every[:self.n] = 1
        self.every = np.packbits(self.every, bitorder="little").view(np.uint64)
        self.low = [int(v) for v in values.min(axis=1)] if dims else []
        spans = [(int(v) - low).bit_length() for v, low in zip(values.max(axis=1), self.low)] if dims else []
        self.drop = [max(0, b - SLICES) for b in spans]
        self.bits = [min(b, SLICES) for b in spans]
        self.first = np.cumsum([0, *self.bits]).tolist()
        self.maps = np.zeros((self.first[-1], words), np.uint64)
        padded = np.zeros(words * 64, np.uint8)
        for j in range(dims):
            high = ((values[j] - self.low[j]) >> self.drop[j]).astype(np.uint8)
            for s in range(self.bits[j]):
                padded[:self.n] = (high >> s) & 1
                self.maps[self.first[j] + s] = np.packbits(padded, bitorder="little").view(np.uint64)
        self.largest = max((abs(int(v)) for v in (values.min(), values.max())), default=0) if values.size else 0

    def sums(self, query: list[int]) -> tuple[list[np.ndarray], int, int]:
        """The bit-sliced sum S, a constant and an error: constant + S <= score <= constant + S + error."""
        places: dict[int, tuple[list[int], list[bool]]] = {}
        constant = error = 0
        for j, w in enumerate(query[:len(self.bits)]):
            if not w:
                continue
            constant += w * self.low[j]
            rest = ((1 << self.drop[j]) - 1) * abs(w)
            error += rest
            if w < 0:
                constant -= rest
            top = (1 << self.bits[j]) - 1
            for place, digit in signed_digits(w):
                if digit < 0:  # -h = (top - h) - top
                    constant -= top << (place + self.drop[j])
                for s in range(self.bits[j]):
                    rows, flip = places.setdefault(place + s + self.drop[j], ([], []))
                    rows.append(self.first[j] + s)
                    flip.append(digit < 0)
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        at = 0
        while places or carried:
            rows, flip = places.pop(at, ([], []))
            parts = carried
            if rows:
                parts = [*carried, self.maps[rows] ^ np.where(flip, ALL, np.uint64(0))[:, None]]
            total, carried = full_adders(parts)
            out.append(np.zeros_like(self.every) if total is None else total)
            at += 1
        return out, constant, error

    def search(self, query: list[int], k: int, least: int | None) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, scores)``: all rows of the k largest scores, and some more; none below ``least`` need be there."""
        if self.n > k:
            slices, constant, error = self.sums(query)
            at = kth_largest(slices, self.every, k) - error
            if least is not None:
                at = max(at, least - constant - error)
            rows = np.flatnonzero(np.unpackbits(at_least(slices, self.every, at).view(np.uint8), bitorder="little")[:self.n])
        else:
            rows = np.arange(self.n)
        return rows, self.scores(rows, query)

    def scores(self, rows: np.ndarray, query: list[int]) -> np.ndarray:
        """Exact scores of some rows."""
        dims = min(len(query), self.values.shape[0])
        part = self.values[:dims, rows]
        q = query[:dims]
        if self.largest * sum(map(abs, q)) < 1 << 62:
            return np.array(q, np.int64) @ part.astype(np.int64) if dims else np.zeros(rows.size, np.int64)
        return np.array(q, object) @ part.astype(object)


def signed_digits(w: int) -> list[tuple[int, int]]:
    """``(place, digit)`` with digits 1 and -1, no two adjacent, whose powers of two sum up to w."""
    out, place = [], 0
    while w:
        if w & 1:
            digit = 2 - (w & 3)
            out.append((place, digit))
            w -= digit
        w >>= 1
        place += 1
    return out


def full_adders(parts: list[np.ndarray]) -> tuple[np.ndarray | None, list[np.ndarray]]:
    """The sum bitmap of all rows of ``parts`` (bitmaps of one place), and the bitmaps carried to the next."""
    carried = []
    held = np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else None
    if held is None or not len(held):
        return None, []
    while len(held) > 2:
        n = len(held) // 3
        a, b, c = held[:n], held[n:2 * n], held[2 * n:3 * n]
        half = a ^ b
        carried.append((a & b) | (half & c))
        total = half ^ c
        held = np.concatenate([total, held[3 * n:]]) if len(held) > 3 * n else total
    if len(held) == 2:
        carried.append((held[0] & held[1])[None])
        return held[0] ^ held[1], carried
    return held[0], carried


def kth_largest(slices: list[np.ndarray], among: np.ndarray, k: int) -> int:
    """The k-th largest sum of the rows of ``among`` (at least k of them)."""
    value = 0
    for place in range(len(slices) - 1, -1, -1):
        ones = among & slices[place]
        n = int(np.bitwise_count(ones).sum())
        if n >= k:
            among, value = ones, value | 1 << place
        else:
            k -= n
            among = among & ~slices[place]
    return value


def at_least(slices: list[np.ndarray], among: np.ndarray, value: int) -> np.ndarray:
    """The rows of ``among`` whose sum is at least ``value``."""
    if value <= 0:
        return among
    if value >> len(slices):
        return np.zeros_like(among)
    above, equal = np.zeros_like(among), among
    for place in range(len(slices) - 1, -1, -1):
        if value >> place & 1:
            equal = equal & slices[place]
        else:
            above = above | (equal & slices[place])
            equal = equal & ~slices[place]
    return above | equal


def _doubles(column: pa.Array) -> np.ndarray:
    """(rows, dims) of a list column, shorter vectors filled with zeros."""
    values, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if lengths.size and (lengths == lengths[0]).all():
        return values.reshape(lengths.size, -1) if lengths[0] else np.zeros((lengths.size, 0))
    out = np.zeros((lengths.size, int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def build_index(rows: DataFrame, scale: int) -> DataFrame:
    """Blocks of ``uid, id, vec`` rows with their integers, column by column; one row a block, of any task.

    The vectors of a block may differ in length: what a shorter one lacks is 0.
    """
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(parts).combine_chunks()
            t = t.to_batches()[0]
            x = np.ascontiguousarray(_doubles(t.column("vec")).T)
            vals, kind = quantised(x, scale), "f8"
            if vals.dtype != object:
                most = np.abs(vals).max(initial=0)
                kind = next(k for k in ("i1", "i2", "i4", "i8") if most <= np.iinfo(k).max)
                x = vals.astype(kind)
            uids, ids = t.column("uid").to_numpy(), t.column("id")
            blank = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
            ids = ids.fill_null(0).to_numpy()
            return pa.RecordBatch.from_pydict({
                "block": [int(uids[0])], "n": [t.num_rows], "dims": pa.array([x.shape[0]], pa.int32()), "kind": [kind],
                "uids": [uids.tobytes()], "ids": [ids.tobytes()], "no_id": [blank.tobytes()], "vals": [x.tobytes()]})

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, ROWS - n))
                batch = batch.slice(held[-1].num_rows)
                n += held[-1].num_rows
                if n == ROWS:
                    yield block(held)
                    held, n = [], 0
        if n:
            yield block(held)

    return rows.select("uid", "id", "vec").mapInArrow(kernel, INDEX)


def _searcher(k: int, scale: int):
    """mapInArrow kernel over index blocks, each beside a group of queries: the best k of the task for every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # by query: group, id, (score, no id, id, uid) of its best so far, sorted
        best: dict[int, list] = {}
        groups: dict[int, tuple] = {}
        last = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("n", "dims", "kind", "uids", "ids", "no_id", "vals", "g")}
                if last is not None and last != row["g"] and len(groups) > 8:
                    groups.clear()
                last = row["g"]
                if last not in groups:
                    queries = batch.column("queries")[i].values
                    vecs = queries.field("vec")
                    groups[last] = (queries.field("uid").to_pylist(), queries.field("id").to_pylist(),
                                    quantised(_doubles(vecs), scale).tolist())
                vals = np.frombuffer(row["vals"], row["kind"]).reshape(row["dims"], row["n"])
                block = Block(quantised(vals, scale) if row["kind"] == "f8" else vals.astype(np.int64))
                uids, ids, blank = (np.frombuffer(row[c], t) for c, t in (("uids", "i8"), ("ids", "i8"), ("no_id", "u1")))
                for uid, qid, query in zip(*groups[last], strict=True):
                    mine = best.setdefault(uid, [qid, []])
                    least = mine[1][k - 1][0] if len(mine[1]) >= k else None
                    at, scores = block.search(query, k + 1, None if least is None else -least)
                    if not at.size:
                        continue
                    if at.size > 2 * k + 2:  # many on the boundary: the k + 1 best by score, then id
                        order = np.lexsort((uids[at], ids[at], blank[at], -scores if scores.dtype != object else [-s for s in scores]))[:k + 1]
                        at, scores = at[order], scores[order]
                    met = [(-int(s), int(blank[a]), int(ids[a]), int(uids[a])) for a, s in zip(at, scores) if uids[a] != uid]
                    mine[1] = sorted(mine[1] + met)[:k]
        out = [(uid, qid, None if blank else i, -s) for uid, (qid, found) in best.items() for s, blank, i, _ in found]
        for a in range(0, len(out), 1 << 16):
            # a task does not know what is returned in the end: scores that do not fit are marked above or below all others
            part = [(*r[:3], max(-(1 << 63), min(r[3], (1 << 63) - 1)), (r[3] >= 1 << 63) - (r[3] < -(1 << 63))) for r in out[a:a + (1 << 16)]]
            columns = [pa.array(c, pa.int64()) for c in zip(*part, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "id", "score", "beyond"])

    return run


def finite(vec: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    v = F.col(vec).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vec).isNotNull() & F.coalesce(~bad, F.lit(False))


def top_k(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest integer inner product for every query row.

    ``is_query`` is a condition on ``id``; candidates of a query are all rows but itself, also those that repeat its
    id or vector. A component x counts as floor(scale * x). Ties go to the smaller id, null ids last. Null vectors
    and those with a null, NaN or infinite component take no part; where lengths differ, missing components are 0. A
    returned score beyond 64 bits fails the job. Further columns are not read; an empty table gives no row.

    Queries are joined with the blocks of the index in groups of bounded bytes: by a broadcast if all groups are
    small, else cell by cell of a grid. A task carries k rows a query over its blocks, so only these are shuffled.
    """
    spark = df.sparkSession
    rows = saved(df.where(finite(vec_col)).select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).cast("array<double>").alias("vec")))
    index = saved(build_index(rows, scale))
    queries = rows.where(is_query)
    size = queries.agg(F.sum(F.size("vec").cast("long") * 8 + 16)).first()[0] or 0
    groups = -(-size // GROUP_BYTES) or 1
    wide = queries.groupBy(F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("g")).agg(
        F.collect_list(F.struct("uid", "id", "vec")).alias("queries"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("g")
    if size <= 4 * GROUP_BYTES:
        # few blocks, each with much to do: dealt over all cores
        cells = index.repartition(spark.sparkContext.defaultParallelism).select("*", every).join(F.broadcast(saved(wide)), "g")
    else:
        cuts = -(-index.count() // CELL)
        own = F.pmod(F.xxhash64("block"), F.lit(cuts)).alias("r")
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cuts - 1).cast("long"))).alias("r")
        cells = index.select("*", own, every).join(saved(wide).select("*", each), ["g", "r"]).drop("r")
    found = cells.select("n", "dims", "kind", "uids", "ids", "no_id", "vals", "g", "queries").mapInArrow(
        _searcher(k, scale), "query long, query_id long, id long, score long, beyond long")
    w = Window.partitionBy("query").orderBy(F.col("beyond").desc(), F.col("score").desc(), F.col("id").asc_nulls_last())
    score = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score exceeds 64 bits")).cast("long"))
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), score.alias("score")))


def oracle_sql(k: int = 10, every: int = 100) -> str:
    """DuckDB SQL for the rows of ``top_k`` over ``embeddings``; every vector has an id of its own there."""
    return f"""WITH e AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
      q AS (SELECT * FROM e WHERE vec_id % {every} = 0),
      s AS (SELECT q.vec_id AS query_id, e.vec_id, CAST(list_sum(list_transform(list_zip(q.v, e.v),
              lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
        FROM q JOIN e ON q.vec_id <> e.vec_id)
      SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) t WHERE rank <= {k}"""
