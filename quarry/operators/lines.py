"""Weighted points as sorted lines, for k-means steps and seeding without a scan of the points.

A line is all points of one x, sorted by y and cut into blocks; the blocks lie in a table sorted by their
number, and the driver knows of each one its ends and sums (at most ``MOST_BLOCKS`` and one a line). On a line the
squared distances to all centroids have one curvature, so every centroid owns one interval of it, found by
integer arithmetic. Sums over an interval are running sums of whole blocks plus a look into the block of
either end; the farthest point of an interval is its first or last one.

``Lines.step`` costs one job that opens the blocks in which an interval ends. ``Lines.farthest_first`` plays
all rounds with what is known of the points next to the ends of the intervals, asks for what was missing in one
job, and plays again until nothing was: a few jobs for any k.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.geometry import exact_sums
from quarry.session import scratch_path

# Least points of a block, and most blocks besides one a line.
BLOCK_POINTS, MOST_BLOCKS = 1024, 8192
# Points on either side of a place that a look-up for the seeding brings back.
WINDOW = 32
BLOCKS = "block long, x long, n long, y0 long, y1 long, w decimal(38,0), s decimal(38,0), ys binary, ws binary"


def intervals(x: int, centroids: Sequence[tuple[int, int]]) -> list[tuple[int, tuple[int, int]]]:
    """``(last y or None, centroid)`` of the line at x from below: who is nearest, ties to the smallest (cx, cy)."""
    best: dict[int, tuple[int, int]] = {}
    for c in centroids:
        other = best.get(c[1])
        if other is None or ((x - c[0]) ** 2, c[0]) < ((x - other[0]) ** 2, other[0]):
            best[c[1]] = c
    held: list[tuple[int | None, tuple[int, int]]] = []  # (first y, centroid)
    for cy in sorted(best):
        b = best[cy]
        first = None
        while held:
            start, a = held[-1]
            # a is nearer than b while 2 y (by - ay) < n
            n = (x - b[0]) ** 2 + b[1] ** 2 - (x - a[0]) ** 2 - a[1] ** 2
            d = 2 * (b[1] - a[1])
            first = (n // d if a < b else (n - 1) // d) + 1
            if start is None or first > start:
                break
            held.pop()
            first = None
        held.append((first, b))
    ends = [None if start is None else start - 1 for start, _ in held[1:]]
    return list(zip([*ends, None], (c for _, c in held)))


def _cut(size: int):
    """Kernel over ``x, y, w`` sorted by both: blocks of one line each."""

    def cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = []  # x, y, w of what is not given away yet

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            x, y, w = (np.concatenate(c) for c in zip(*held))
            edges = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), x.size]
            done = 0
            for a, b in zip(edges, edges[1:]):
                while a < b and (b - a >= size or b < x.size or last):
                    c = min(b, a + size)
                    total = [pa.array(exact_sums(v, w[a:c], np.zeros(c - a, np.int64), 1), pa.decimal128(38)) for v in (np.ones(c - a, np.int64), y[a:c])]
                    yield pa.RecordBatch.from_pydict({
                        "block": [number], "x": [int(x[a])], "n": [c - a], "y0": [int(y[a])], "y1": [int(y[c - 1])], "w": total[0], "s": total[1],
                        "ys": [y[a:c].tobytes()], "ws": [w[a:c].tobytes()]})
                    number, a = number + 1, c
                done = a
            held = [(x[done:], y[done:], w[done:])]

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("x", "y", "w")))
            yield from out(False)
        if held:
            yield from out(True)

    return cut_lines


class Lines:
    """Points in a table of blocks, and what the driver knows of the blocks."""

    def __init__(self, points: DataFrame, n_points: int):
        spark = points.sparkSession
        size = max(BLOCK_POINTS, -(-n_points // MOST_BLOCKS))
        path = scratch_path(spark, "lines")
        sorted_ = points.select("x", "y", "w").repartitionByRange("x", "y").sortWithinPartitions("x", "y")
        sorted_.mapInArrow(_cut(size), BLOCKS).write.option("parquet.block.size", 8 << 20).parquet(path)
        self.table = spark.read.schema(BLOCKS).parquet(path)
        self.lines: dict[int, list] = {}
        for r in self.table.drop("ys", "ws").orderBy("x", "y0").collect():
            self.lines.setdefault(r.x, []).append(r)
        self.first = {x: [b.y0 for b in blocks] for x, blocks in self.lines.items()}
        self.before = {}
        for x, blocks in self.lines.items():
            sums = [(0, 0)]
            for b in blocks:
                sums.append((sums[-1][0] + int(b.w), sums[-1][1] + int(b.s)))
            self.before[x] = sums
        self.known: dict[int, list[tuple[int, list[int]]]] = {}  # by block: windows (first index, values)

    def _looked_up(self, asked: dict[int, list[int]], kernel, schema: str) -> list:
        return self.table.where(F.col("block").isin(list(asked))).mapInArrow(kernel, schema).collect() if asked else []

    # ------------------------------------------------------------------ steps

    def sums(self, places: set[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int]]:
        """(Σ w, Σ y·w) of the points up to y on the line of x, for each (x, y)."""
        out, asked, of = {}, {}, {}
        for x, y in places:
            at = bisect_right(self.first[x], y) - 1
            if at < 0 or y >= self.lines[x][at].y1:
                out[x, y] = self.before[x][at + 1]
            else:
                block = self.lines[x][at].block
                asked.setdefault(block, []).append(y)
                of[block, y] = (x, at)

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.column("block")[i].as_py()
                    ys, ws = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("ys", "ws"))
                    wanted = np.array(sorted(asked[block]))
                    ends = np.searchsorted(ys, wanted, side="right")
                    group = np.searchsorted(ends, np.arange(ys.size), side="right")  # by the first end beyond a point
                    sums = [exact_sums(v, ws, group, wanted.size + 1)[:-1] for v in (np.ones(ys.size, np.int64), ys)]
                    totals = [[sum(s[:k + 1]) for k in range(len(s))] for s in sums]
                    yield pa.RecordBatch.from_arrays([pa.array([block] * wanted.size), pa.array(wanted), *(pa.array(t, pa.decimal128(38)) for t in totals)],
                                                     names=["block", "y", "w", "s"])

        for r in self._looked_up(asked, look, "block long, y long, w decimal(38,0), s decimal(38,0)"):
            x, at = of[r.block, r.y]
            w, s = self.before[x][at]
            out[x, r.y] = (w + int(r.w), s + int(r.s))
        return out

    def step(self, centroids: Sequence[tuple[int, int]]) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(Σ w, Σ x·w, Σ y·w) of the points nearest to each centroid that has any."""
        cuts = {x: intervals(x, centroids) for x in self.lines}
        sums = self.sums({(x, y) for x, cut in cuts.items() for y, _ in cut if y is not None})
        out: dict[tuple[int, int], list[int]] = {}
        for x, cut in cuts.items():
            w0 = s0 = 0
            for y, c in cut:
                w, s = self.before[x][-1] if y is None else sums[x, y]
                if w > w0:
                    mine = out.setdefault(c, [0, 0, 0])
                    mine[0] += w - w0
                    mine[1] += x * (w - w0)
                    mine[2] += s - s0
                w0, s0 = w, s
        return {c: tuple(v) for c, v in out.items()}

    # ------------------------------------------------------------------ seeding

    def _neighbours(self, x: int, y: int, missing: dict[int, list[int]]) -> tuple[int | None, int | None]:
        """The last point up to y and the first one after it; where unknown y stands for both and goes to ``missing``."""
        blocks = self.lines[x]
        at = bisect_right(self.first[x], y) - 1
        after = blocks[at + 1].y0 if at + 1 < len(blocks) else None
        if at < 0:
            return None, after
        b = blocks[at]
        if y >= b.y1:
            return b.y1, after
        for first, values in self.known.get(b.block, ()):
            i = bisect_right(values, y)
            if 0 < i < len(values) or (i == 0 and first == 0):
                return values[i - 1] if i else None, values[i]
        missing.setdefault(b.block, []).append(y)
        return y, y + 1

    def _fetch(self, missing: dict[int, list[int]]) -> None:
        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.column("block")[i].as_py()
                    ys = np.frombuffer(batch.column("ys")[i].as_py(), np.int64)
                    for y in missing[block]:
                        at = int(np.searchsorted(ys, y, side="right"))
                        a, b = max(0, at - WINDOW), min(ys.size, at + WINDOW)
                        yield pa.RecordBatch.from_pydict({"block": [block], "first": [a], "ys": [ys[a:b].tolist()]})

        for r in self._looked_up(missing, look, "block long, first long, ys array<long>"):
            self.known.setdefault(r.block, []).append((r.first, r.ys))

    def _play(self, start: tuple[int, int], k: int) -> tuple[list[tuple[int, int]], dict[int, list[int]]]:
        """Seeds by what is known, and the places that were not."""
        seeds, missing = [start], {}
        far: dict[int, tuple] = {}  # by line: (distance, -x, -y) of its farthest point
        cuts: dict[int, list] = {}
        while len(seeds) < k:
            for x in self.lines:
                cut = intervals(x, seeds)
                if cuts.get(x) != cut:
                    cuts[x] = cut
                    low, line = self.first[x][0], []
                    for y, c in cut:
                        last, after = (self.lines[x][-1].y1, None) if y is None else self._neighbours(x, y, missing)
                        for v in {low, last}:
                            if low is not None and last is not None and low <= last:
                                line.append(((x - c[0]) ** 2 + (v - c[1]) ** 2, -x, -v))
                        low = after
                    far[x] = max(line)
            d2, x, y = max(far.values())
            if d2 == 0:
                break
            seeds.append((-x, -y))
        return seeds, missing

    def farthest_first(self, start: tuple[int, int], k: int) -> list[tuple[int, int]]:
        """Seeds from ``start``, each the point farthest from those before it; ties to the smallest (x, y)."""
        while True:
            seeds, missing = self._play(start, k)
            if not missing:
                return seeds
            self._fetch(missing)
