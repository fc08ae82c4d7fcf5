"""Point/centroid helpers for 2-D integer k-means.

Points are ``x, y`` bigint columns; centroids are small Python lists of
``(cx, cy)`` ints (at most k, shipped inside the task closure, so no join is
needed). Distances are compared exactly for all coordinates up to 2**32 apart,
as two 32-bit halves where a 64-bit integer could overflow.
"""

from __future__ import annotations

from collections.abc import Sequence

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The reference's domain list (positions 0..14) and spread.
REFERENCE_DOMAINS = [
    "Machine-Learning", "Compute-Science", "Algorithm", "Big-Data", "Data-Analysis", "Security",
    "Silicon Valley", "Computer-Systems", "Deep-learning", "Internet-Service-Providers",
    "Programming-Language", "Cloud-services", "Software-Engineering", "Embedded-System", "Architecture",
]
REFERENCE_SPREAD = 50000

# Distance matrix chunk (points x centroids).
NEAREST_CELLS = 1 << 21
# Differences up to this keep a squared distance in a signed, up to the second in an unsigned 64-bit half sum.
NARROW, WIDE = (1 << 31) - 1, 1 << 32
LOW = np.uint64(0xFFFFFFFF)
HALF = np.uint64(32)


def encode_domain(tag: Column, domains: Sequence[str]) -> Column:
    """0-based position of ``tag`` in ``domains``; -1 if unknown; null if tag is null."""
    return F.array_position(F.array(*[F.lit(d) for d in domains]), tag) - F.lit(1)


def _nearest_arrays(cents: np.ndarray, rows: int, px: np.ndarray, py: np.ndarray):
    """(index of nearest centroid, squared distance as high and low 32-bit halves) for each point."""
    idx = np.empty(px.size, dtype=np.int64)
    hi, lo = np.empty(px.size, np.uint64), np.empty(px.size, np.uint64)
    for s in range(0, px.size, rows):
        dx = np.abs(px[s:s + rows, None] - cents[None, :, 0])
        dy = np.abs(py[s:s + rows, None] - cents[None, :, 1])
        far = max(dx.max(), dy.max())
        if far > WIDE - 1:
            raise OverflowError("coordinates more than 2**32 - 1 apart")
        if far <= NARROW:
            d = (dx * dx).astype(np.uint64) + (dy * dy).astype(np.uint64)
            j = d.argmin(axis=1)
            best = d[np.arange(j.size), j]
            high, low = best >> HALF, best & LOW
        else:
            a, b = dx.astype(np.uint64) ** np.uint64(2), dy.astype(np.uint64) ** np.uint64(2)
            low = (a & LOW) + (b & LOW)
            high = (a >> HALF) + (b >> HALF) + (low >> HALF)
            low = low & LOW
            least = high == high.min(axis=1, keepdims=True)
            j = np.where(least, low, LOW + np.uint64(1)).argmin(axis=1)
            high, low = high[np.arange(j.size), j], low[np.arange(j.size), j]
        idx[s:s + rows], hi[s:s + rows], lo[s:s + rows] = j, high, low
    return idx, hi, lo


def _root(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return np.sqrt(hi.astype(np.float64) * 2.0 ** 32 + lo.astype(np.float64))


def _sorted_centroids(centroids: Sequence[tuple[int, int]]) -> np.ndarray:
    cents = np.array(sorted({(int(cx), int(cy)) for cx, cy in centroids}), dtype=np.int64).reshape(-1, 2)
    if cents.shape[0] == 0:
        raise ValueError("no centroids")
    return cents


def nearest_kernel(centroids: Sequence[tuple[int, int]], x: str = "x", y: str = "y"):
    """mapInPandas kernel adding ``cx, cy, d2`` of the nearest centroid.

    Centroids are sorted by (cx, cy) and ``argmin`` returns the first minimum,
    so ties go to the smallest (cx, cy). A squared distance of 2**63 or more
    fails the job, as ``d2`` is a bigint.
    """
    cents = _sorted_centroids(centroids)
    rows = max(1, NEAREST_CELLS // cents.shape[0])

    def run(batches):
        for pdf in batches:
            idx, hi, lo = _nearest_arrays(cents, rows, pdf[x].to_numpy(dtype=np.int64), pdf[y].to_numpy(dtype=np.int64))
            if hi.size and hi.max() >= 1 << 31:
                raise OverflowError("a squared distance exceeds 64 bits")
            yield pdf.assign(cx=cents[idx, 0], cy=cents[idx, 1], d2=((hi << HALF) | lo).astype(np.int64))

    return run


def exact_sums(v: np.ndarray, w: np.ndarray, groups: np.ndarray, k: int) -> list[int]:
    """Σ v·w per group as Python ints; beyond 64 bits by 32-bit parts of v."""
    if v.size == 0:
        return [0] * k
    if float(np.abs(v).max()) * float(w.max()) * v.size < 2.0 ** 62:
        return [int(t) for t in _int_bincount(groups, v * w, k)]
    total = [0] * k
    for shift, part in ((32, v >> 32), (16, (v >> 16) & 0xFFFF), (0, v & 0xFFFF)):
        for up, weight in ((32, w >> 32), (16, (w >> 16) & 0xFFFF), (0, w & 0xFFFF)):
            for g, t in enumerate(_int_bincount(groups, part * weight, k).tolist()):
                total[g] += t << (shift + up)
    return total


def _int_bincount(groups: np.ndarray, vals: np.ndarray, k: int) -> np.ndarray:
    acc = np.zeros(k, dtype=np.int64)
    np.add.at(acc, groups, vals)
    return acc


def step_kernel(centroids: Sequence[tuple[int, int]]):
    """mapInPandas kernel over ``x, y, w``: one row per (batch, nearest centroid)
    with cx, cy, sx = Σ x·w, sy = Σ y·w (exact, decimal), size = Σ w and
    residual = Σ w·sqrt(d2)."""
    cents = _sorted_centroids(centroids)
    k = cents.shape[0]
    rows = max(1, NEAREST_CELLS // k)

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            px = pdf["x"].to_numpy(dtype=np.int64)
            py = pdf["y"].to_numpy(dtype=np.int64)
            w = pdf["w"].to_numpy(dtype=np.int64)
            idx, hi, lo = _nearest_arrays(cents, rows, px, py)
            sx, sy = exact_sums(px, w, idx, k), exact_sums(py, w, idx, k)
            size = _int_bincount(idx, w, k)
            res = np.bincount(idx, weights=_root(hi, lo) * w, minlength=k)
            hit = np.nonzero(size)[0]
            yield pd.DataFrame({
                "cx": cents[hit, 0], "cy": cents[hit, 1],
                "sx": [Decimal(sx[j]) for j in hit], "sy": [Decimal(sy[j]) for j in hit],
                "size": size[hit], "residual": res[hit]})

    return run


STEP_SCHEMA = "cx bigint, cy bigint, sx decimal(38,0), sy decimal(38,0), size bigint, residual double"


def nearest_schema(points_schema: T.StructType) -> T.StructType:
    return T.StructType(list(points_schema.fields) + [
        T.StructField("cx", T.LongType()), T.StructField("cy", T.LongType()), T.StructField("d2", T.LongType())])
