"""Clustering of scored question/answer threads with integer k-means.

postings → best answer per question → vector (spread · domain code, score)
→ weighted distinct points → farthest-first seeds → Lloyd iterations with
truncated integer means → per-cluster summary (size, average, median).

Scale notes
-----------
* The best answer is found by aggregating answers per parent *before* the
  join with the questions, so a question with a huge share of the answers
  costs one partial row per task, not a skewed join.
* Points are collapsed to distinct ``(x, y)`` with a weight ``w``; means,
  residuals, sizes and medians are weighted, which gives exactly the same
  numbers as the raw points while every iteration scans only distinct points.
  The weighted points are checkpointed to the shared folder, so iterations
  survive executor loss and re-plan from a short lineage.
* Where x takes few values (``lines_of``), the points are sorted once into lines
  with running sums: a step only looks up the sums at the ends of the centroids'
  intervals, and all seeds are found in a few jobs. See ``operators.lines``.
* Otherwise, and where distances themselves are summed (residual), a step is one
  aggregate job whose result (at most k rows) is the only thing collected; the
  (at most k) centroids reach the executors inside the nearest-centroid kernel, a
  vectorized numpy arg-min per Arrow batch (``mapInPandas``). A k-way expression
  in whole-stage codegen grows into one huge method the JIT will not compile: a
  step took 4-13 s instead of 0.6 s at k = 45 on sf0.1.
* The median is an exact distributed selection: a table of value ranges, one a
  cluster and rank, is joined with the values and narrowed until each range is
  one value. No cluster's values are gathered into one task, and the driver
  only learns how many ranges are still open.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.geometry import (REFERENCE_SPREAD, STEP_SCHEMA, encode_domain, nearest_kernel,
                                      nearest_schema, step_kernel)
from quarry.operators.common import broadcast_if_small
from quarry.operators.lines import Lines
from quarry.session import cut_lineage

DEC = T.DecimalType(38, 0)
# Buckets per refinement pass of the exact median.
MEDIAN_BUCKETS = 1024


# --------------------------------------------------------------------------- postings

def split_postings(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(questions, answers): posting_type 1 and 2."""
    return p.where(F.col("posting_type") == 1), p.where(F.col("posting_type") == 2)


# Answers of one question from which its answers are dealt over several tasks, and into how many parts.
HOT_ANSWERS, HOT_PARTS = 100_000, 64


def answers_with_questions(p: DataFrame, hot_answers: int = HOT_ANSWERS) -> DataFrame:
    """``(question_id, score, tag)``: each answer with its question's tag.

    Inner join on parent = id: orphan answers and unanswered questions drop;
    null parents never match. Questions with at least ``hot_answers`` answers
    are counted first (their number is at most all answers by that many) and
    joined on one of ``HOT_PARTS`` parts as well, which the answers are dealt over.
    """
    q, a = split_postings(p)
    a = a.where(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("question_id"), "score")
    q = q.select(F.col("id").alias("question_id"), "tag")
    hot = a.groupBy("question_id").count().where(F.col("count") >= hot_answers).select("question_id", F.lit(HOT_PARTS).alias("parts"))
    hot = broadcast_if_small(cut_lineage(hot))
    if hot.isEmpty():
        return a.join(q, "question_id")
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    a = a.join(hot, "question_id", "left").select("question_id", "score", part)
    q = q.join(hot, "question_id", "left").select("question_id", "tag", every)
    return a.join(q, ["question_id", "part"]).select("question_id", "score", "tag")


def best_answer(p: DataFrame) -> DataFrame:
    """``(question_id, score, tag)``: highest answer score per answered question.

    Answers are aggregated per parent first (partial aggregation map-side),
    then joined with the questions. Questions that share an id are one, with
    the greatest of their tags.
    """
    q, a = split_postings(p)
    top = a.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("question_id")) \
        .agg(F.max("score").alias("score"))
    return top.join(q.select(F.col("id").alias("question_id"), "tag"), "question_id") \
        .groupBy("question_id", "score").agg(F.max("tag").alias("tag"))


def tag_vectors(best: DataFrame, domains: Sequence[str], spread: int = REFERENCE_SPREAD,
                on_missing: str = "error") -> DataFrame:
    """``(question_id, x, y)`` with x = spread · domain code (−1 if unknown), y = score.

    A null tag fails the job (``on_missing="error"``) or drops the row (``"drop"``).
    """
    if spread <= 0:
        raise ValueError("spread must be > 0")
    tag = F.col("tag")
    if on_missing == "drop":
        best = best.where(tag.isNotNull())
        code = encode_domain(tag, domains)
    elif on_missing == "error":
        code = F.when(tag.isNull(), F.raise_error(F.lit("posting without a tag"))).otherwise(
            encode_domain(tag, domains))
    else:
        raise ValueError(f"unknown on_missing {on_missing!r}")
    return best.select("question_id", (F.lit(spread).cast("bigint") * code.cast("bigint")).alias("x"),
                       F.col("score").cast("bigint").alias("y"))


def weighted_points(vectors: DataFrame, checkpoint: bool = True) -> DataFrame:
    """``(x, y, w)``: distinct points with their multiplicity, checkpointed."""
    pts = vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w"))
    return cut_lineage(pts) if checkpoint else pts


# Most distinct x of points that are kept as lines.
MOST_LINES = 256


def lines_of(points: DataFrame) -> Lines | None:
    """Weighted points sorted into lines; None where there are none, or more lines than pay."""
    n, n_lines = points.agg(F.count(F.lit(1)), F.countDistinct("x")).first()
    return Lines(points, n) if 0 < n_lines <= MOST_LINES else None


def _weighted(points: DataFrame) -> DataFrame:
    return points if "w" in points.columns else points.withColumn("w", F.lit(1).cast("bigint"))


# --------------------------------------------------------------------------- assignment

def assign(points: DataFrame, centroids: Sequence[tuple[int, int]]) -> DataFrame:
    """Points plus ``cx, cy, d2`` of their nearest centroid (ties: smallest cx, cy)."""
    return points.mapInPandas(nearest_kernel(centroids), nearest_schema(points.schema))


@dataclass
class Step:
    """One Lloyd update: old centroid → new centroid, with its weight and residual (None if not measured)."""
    old: tuple[int, int]
    new: tuple[int, int]
    size: int
    residual: float | None


def step_frame(points: DataFrame, centroids: Sequence[tuple[int, int]]) -> DataFrame:
    """``(cx, cy, nx, ny, size, residual)``: one aggregate over the assigned points.

    nx, ny are the truncated (toward zero) weighted means of the cluster;
    residual is Σ w·sqrt(d2). Clusters without points have no row.
    """
    # Each Arrow batch is reduced to at most k partial rows inside the kernel;
    # Spark merges the partials per centroid.
    part = _weighted(points).select("x", "y", "w").mapInPandas(step_kernel(centroids), STEP_SCHEMA)
    g = part.groupBy("cx", "cy").agg(
        F.sum("sx").alias("_sx"), F.sum("sy").alias("_sy"),
        F.sum("size").alias("size"), F.sum("residual").alias("residual"))
    return g.select("cx", "cy", F.expr("CAST(_sx div size AS BIGINT)").alias("nx"),
                    F.expr("CAST(_sy div size AS BIGINT)").alias("ny"), "size", "residual")


def lloyd_step(points: DataFrame, centroids: Sequence[tuple[int, int]]) -> list[Step]:
    """Run one update and collect its (at most k) rows."""
    rows = step_frame(points, centroids).collect()
    return [Step((r.cx, r.cy), (r.nx, r.ny), r.size, r.residual) for r in rows]


def _towards_zero(a: int, b: int) -> int:
    return abs(a) // b * (1 if a >= 0 else -1)


def line_step(lines: Lines, centroids: Sequence[tuple[int, int]]) -> list[Step]:
    """The same update from running sums, without the residual."""
    return [Step(c, (_towards_zero(sx, w), _towards_zero(sy, w)), w, None) for c, (w, sx, sy) in lines.step(centroids).items()]


def recenter(steps: Sequence[Step]) -> list[tuple[int, int]]:
    """New centroids, distinct and sorted (two clusters may truncate to one point)."""
    return sorted({s.new for s in steps})


def residual(steps: Sequence[Step]) -> float | None:
    """Σ over points of the distance to the nearest (old) centroid; None if the steps did not measure it."""
    return None if any(s.residual is None for s in steps) else math.fsum(s.residual for s in steps)


def movement(steps: Sequence[Step]) -> float:
    """Σ over clusters of the distance between old and new centroid."""
    return math.fsum(math.hypot(s.new[0] - s.old[0], s.new[1] - s.old[1]) for s in steps)


# --------------------------------------------------------------------------- seeding

def _pt(row) -> tuple[int, int]:
    return int(row[0]), int(row[1])


def first_point(points: DataFrame, seed: str | None = None) -> tuple[int, int] | None:
    """Smallest (x, y), or with ``seed`` the point with the smallest md5 of 'x,y,seed'."""
    if seed is None:
        r = points.agg(F.min(F.struct("x", "y")).alias("p")).first().p
    else:
        h = F.md5(F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"), F.lit(seed)))
        r = points.agg(F.min(F.struct(h.alias("h"), "x", "y")).alias("p")).first().p
        r = None if r is None else (r.x, r.y)
    return None if r is None else _pt(r)


# Seeding rounds between two checkpoints of the running distances.
SEED_ROUNDS = 8


def farthest_first(points: DataFrame, k: int, seed: str | None = None, lines: Lines | None = None) -> list[tuple[int, int]]:
    """k seeds: a first point, then repeatedly the point farthest from its nearest seed.

    Ties go to the smallest (x, y). Stops early when every point is a seed
    (largest distance 0). With ``lines`` a few look-ups find all seeds. Without,
    each point carries its distance to the nearest seed so far, so a round
    measures the newest seed only: one column expression and one global
    aggregate. The distances are checkpointed every few rounds. They are
    decimals where a 64-bit square could overflow; seeds are the same.
    """
    start = first_point(points, seed)
    if start is None:
        return []
    if lines is not None:
        return lines.farthest_first(start, k)
    most = points.agg(F.max(F.greatest(F.abs(F.col("x").cast(DEC)), F.abs(F.col("y").cast(DEC))))).first()[0]
    kind = "bigint" if most < 1 << 30 else "decimal(38,0)"

    def to(c: str, value: int):
        return F.col(c).cast(kind) - F.lit(value).cast(kind)

    seeds, rest = [start], points.select("x", "y")
    while len(seeds) < k:
        x, y = seeds[-1]
        d2 = (to("x", x) * to("x", x) + to("y", y) * to("y", y)).cast(kind)
        rest = rest.select("x", "y", (d2 if "d2" not in rest.columns else F.least("d2", d2)).alias("d2"))
        if len(seeds) % SEED_ROUNDS == 0:
            rest = cut_lineage(rest)
        far = rest.agg(F.max(F.struct("d2", (-F.col("x")).alias("nx"), (-F.col("y")).alias("ny"))).alias("s")).first().s
        if far is None or far.d2 == 0:
            break
        seeds.append((-int(far.nx), -int(far.ny)))
    return seeds


def random_seeds(points: DataFrame, k: int, seed: str = "0") -> DataFrame:
    """k distinct points ordered by md5('x,y,seed') (a top-k, reproducible anywhere)."""
    h = F.md5(F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"), F.lit(seed)))
    return points.select("x", "y").distinct().orderBy(h, "x", "y").limit(k)


# --------------------------------------------------------------------------- Lloyd loop

@dataclass
class KMeansResult:
    centroids: list[tuple[int, int]]
    updates: int
    last_movement: float | None
    last_residual: float | None
    converged: bool = False


def lloyd(points: DataFrame, seeds: Sequence[tuple[int, int]], max_updates: int = 121,
          eta: float = 20.0, stop: str | None = "movement", skip_cycles: bool = True, lines: Lines | None = None) -> KMeansResult:
    """Lloyd iterations from ``seeds``; over ``lines`` unless residuals decide (``last_residual`` is None then).

    ``stop="movement"``: stop after an update whose total centroid movement is
    below ``eta``. ``stop="residual"``: before each update, stop if the summed
    point-to-centroid distance is below ``eta``. ``stop=None``: exactly
    ``max_updates`` updates. At most ``max_updates`` updates in every case.
    Empty clusters vanish (k may shrink).

    The update is a deterministic function of the centroid set, so once a set
    repeats (truncated means can cycle) no later update can meet the stop
    rule either; with ``skip_cycles`` the remaining updates are not run and
    the state the cap would reach is taken from the cycle. Same result, far
    fewer jobs.
    """
    cents = sorted(set(seeds))
    states: list[list[tuple[int, int]]] = [cents]
    seen = {tuple(cents): 0}
    moves: list[float | None] = [None]          # movement of the update that produced states[i]
    resids: list[float | None] = [None]         # residual of the state before that update
    n = 0
    while n < max_updates and cents:
        steps = lloyd_step(points, cents) if lines is None or stop == "residual" else line_step(lines, cents)
        res = residual(steps)
        if stop == "residual" and res < eta:
            return KMeansResult(cents, n, moves[-1], res, True)
        mv = movement(steps)
        cents = recenter(steps)
        n += 1
        states.append(cents)
        moves.append(mv)
        resids.append(res)
        if stop == "movement" and mv < eta:
            return KMeansResult(cents, n, mv, res, True)
        key = tuple(cents)
        if skip_cycles and key in seen and n < max_updates:
            j = seen[key]
            i = j + (max_updates - j) % (n - j)
            return KMeansResult(states[i], max_updates, moves[i] if i else moves[n], resids[i] if i else resids[n])
        seen.setdefault(key, n)
    return KMeansResult(cents, n, moves[-1], resids[-1])


# --------------------------------------------------------------------------- summary

def order_statistics(data: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cx, cy, rank, value``: exact weighted order statistics per group.

    ``data``: (cx, cy, y, w). ``wanted``: (cx, cy, rank, lo, hi), ranks from 0
    and the range of the group's values. Every pass joins the ranges that are
    still open with the values, sums the weights in ``MEDIAN_BUCKETS`` equal
    buckets of each and narrows it to the bucket that holds the rank, so a
    range R needs about log_buckets(R) passes. The ranges are a checkpointed
    table; the driver sees the number of open ones.
    """
    state = cut_lineage(wanted.select("cx", "cy", "rank", "lo", "hi", F.lit(0).cast(DEC).alias("below")))
    while True:
        open_ = state.where("lo < hi")
        if not open_.limit(1).count():
            return state.select("cx", "cy", "rank", F.col("lo").alias("value"))
        width = F.expr(f"CAST((CAST(hi AS DECIMAL(38,0)) - lo) div {MEDIAN_BUCKETS} AS BIGINT) + 1")
        ranges = broadcast_if_small(open_.withColumn("width", width))
        buckets = (data.join(ranges, ["cx", "cy"]).where("y BETWEEN lo AND hi")
                   .groupBy("cx", "cy", "rank", "lo", "hi", "below", "width", F.expr("CAST((CAST(y AS DECIMAL(38,0)) - lo) div width AS BIGINT)").alias("b"))
                   .agg(F.sum(F.col("w").cast(DEC)).alias("n")))
        before = Window.partitionBy("cx", "cy", "rank").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        buckets = buckets.withColumn("under", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0).cast(DEC)))
        found = buckets.where("rank >= under AND rank < under + n").select(
            "cx", "cy", "rank", F.expr("lo + b * width").alias("lo"),
            F.expr("CAST(least(CAST(hi AS DECIMAL(38,0)), CAST(lo AS DECIMAL(38,0)) + (b + 1) * width - 1) AS BIGINT)").alias("hi"), F.col("under").cast(DEC).alias("below"))
        state = cut_lineage(state.where("lo = hi").union(found))


def summary(points: DataFrame, centroids: Sequence[tuple[int, int]]) -> DataFrame:
    """``(cx, cy, size, average, median)`` per non-empty cluster.

    average = Σy div size and median = middle value, or the truncated mean of
    the two middle values for an even size — both integers as in the reference.
    """
    # assigned once: the passes of the median read the checkpointed distinct values
    a = cut_lineage(assign(_weighted(points), centroids).groupBy("cx", "cy", "y").agg(F.sum("w").alias("w")))
    w = F.col("w").cast(DEC)
    stats = cut_lineage(a.groupBy("cx", "cy").agg(
        F.sum("w").alias("size"), F.sum(F.col("y").cast(DEC) * w).alias("sy"), F.min("y").alias("lo"), F.max("y").alias("hi")))
    ranks = F.explode(F.array_distinct(F.array(F.expr("(size - 1) div 2"), F.expr("size div 2")))).alias("rank")
    values = order_statistics(a, stats.select("cx", "cy", ranks, "lo", "hi"))
    middle = values.groupBy("cx", "cy").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    return stats.join(middle, ["cx", "cy"]).select(
        "cx", "cy", "size", F.expr("CAST(sy div size AS BIGINT)").alias("average"),
        F.expr("CAST((CAST(low AS DECIMAL(38,0)) + high) div 2 AS BIGINT)").alias("median"))


def centroid_frame(spark, centroids: Sequence[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame([(int(x), int(y)) for x, y in centroids], "cx bigint, cy bigint")
