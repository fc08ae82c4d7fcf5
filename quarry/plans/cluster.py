"""End-to-end clustering job and the named clustering queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import fixtures as fx
from quarry.functions.geometry import REFERENCE_DOMAINS, REFERENCE_SPREAD
from quarry.operators import cluster as C
from quarry.session import scratch_path
from quarry.sources.records import format_postings, read_postings
from quarry.sources.text import write_lines


def cluster_job(postings: DataFrame, k: int = 45, domains: Sequence[str] = REFERENCE_DOMAINS,
                spread: int = REFERENCE_SPREAD, eta: float = 20.0, max_updates: int = 121,
                stop: str | None = "movement", seed: str | None = None,
                on_missing: str = "error", seeding: str = "farthest") -> DataFrame:
    """Postings → ``(cx, cy, size, average, median, updates, converged)`` per cluster.

    Defaults are the reference's settings (k = 45, eta = 20, at most 121
    updates, spread 50000, its 15 domains). ``seeding`` is ``"farthest"`` or
    ``"random"`` (k points in md5 order). ``converged`` says whether the stop
    rule ended the updates, not their cap.
    """
    vectors = C.tag_vectors(C.best_answer(postings), domains, spread, on_missing)
    points = C.weighted_points(vectors)
    lines = C.lines_of(points)
    if seeding == "farthest":
        seeds = C.farthest_first(points, k, seed, lines)
    elif seeding == "random":
        seeds = [(r.x, r.y) for r in C.random_seeds(points, k, seed or "0").collect()]
    else:
        raise ValueError(f"unknown seeding {seeding!r}")
    result = C.lloyd(points, seeds, max_updates=max_updates, eta=eta, stop=stop, lines=lines)
    return C.summary(points, result.centroids).withColumn("updates", F.lit(result.updates)) \
        .withColumn("converged", F.lit(result.converged))


# --------------------------------------------------------------------------- named queries

K_SMALL = 8
UPDATES_SMALL = 5
# The residual rule's query: bound on the mean distance, and most updates.
RESIDUAL_MEAN, UPDATES_RESIDUAL = 9000, 12


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.tag_vectors(C.best_answer(fx.postings(spark, sf_dir)), fx.PRIORITY_DOMAINS)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.weighted_points(_vectors(spark, sf_dir))


def _seeds(spark: SparkSession, sf_dir: str):
    pts = _points(spark, sf_dir)
    return pts, C.farthest_first(pts, K_SMALL, lines=C.lines_of(pts))


def postings_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings written as ragged comma lines (empty parent, no tag on answers) and parsed back."""
    path = scratch_path(spark, "postings")
    write_lines(format_postings(fx.postings(spark, sf_dir)), path)
    return read_postings(spark, path)


def answers_with_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.answers_with_questions(fx.postings(spark, sf_dir))


def best_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.best_answer(fx.postings(spark, sf_dir))


def tag_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir)


def farthest_first_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = C.farthest_first(_points(spark, sf_dir), K_SMALL)  # by a scan a seed
    return C.centroid_frame(spark, seeds).select(F.col("cx").alias("x"), F.col("cy").alias("y"))


def farthest_first_seeded_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Farthest-first from the point with the smallest md5('x,y,0') instead of the smallest point."""
    pts = _points(spark, sf_dir)
    seeds = C.farthest_first(pts, K_SMALL, seed="0", lines=C.lines_of(pts))
    return C.centroid_frame(spark, seeds).select(F.col("cx").alias("x"), F.col("cy").alias("y"))


def random_seeds_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.random_seeds(_points(spark, sf_dir), K_SMALL, seed="0")


def assign_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, seeds = _seeds(spark, sf_dir)
    return C.assign(_vectors(spark, sf_dir), seeds).select("question_id", "cx", "cy", "d2")


def lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, seeds = _seeds(spark, sf_dir)
    return C.step_frame(pts, seeds).select(F.col("nx").alias("cx"), F.col("ny").alias("cy")).distinct()


def residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, seeds = _seeds(spark, sf_dir)
    return C.step_frame(pts, seeds).agg(F.round(F.sum("residual"), 3).alias("residual"))


def centroid_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, seeds = _seeds(spark, sf_dir)
    d = F.sqrt(((F.col("nx") - F.col("cx")) ** 2 + (F.col("ny") - F.col("cy")) ** 2).cast("double"))
    return C.step_frame(pts, seeds).agg(F.round(F.sum(d), 3).alias("movement"))


def _kmeans_small(spark: SparkSession, sf_dir: str):
    pts = _points(spark, sf_dir)
    lines = C.lines_of(pts)
    return pts, C.lloyd(pts, C.farthest_first(pts, K_SMALL, lines=lines), max_updates=UPDATES_SMALL, stop=None, lines=lines)


def kmeans_8x5(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, res = _kmeans_small(spark, sf_dir)
    return C.centroid_frame(spark, res.centroids)


def cluster_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pts, res = _kmeans_small(spark, sf_dir)
    return C.summary(pts, res.centroids)


def cluster_converged_45(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's settings end to end: k = 45, movement < 20, at most 121 updates."""
    return cluster_job(fx.postings(spark, sf_dir), k=45, domains=fx.PRIORITY_DOMAINS)


def cluster_random_8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering job from 8 random seeds, 5 updates."""
    return cluster_job(fx.postings(spark, sf_dir), k=K_SMALL, domains=fx.PRIORITY_DOMAINS, max_updates=UPDATES_SMALL,
                       stop=None, seeding="random")


def kmeans_residual_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 seeds, updates until the mean distance to the centroids, times the points, is below the bound."""
    pts, seeds = _seeds(spark, sf_dir)
    n = pts.agg(F.sum("w")).first()[0]
    res = C.lloyd(pts, seeds, max_updates=UPDATES_RESIDUAL, eta=float(RESIDUAL_MEAN * n), stop="residual")
    return C.centroid_frame(spark, res.centroids).withColumn("updates", F.lit(res.updates)).withColumn("converged", F.lit(res.converged))


QUERIES = {
    "cluster_random_8": cluster_random_8,
    "kmeans_residual_stop": kmeans_residual_stop,
    "postings_parsed": postings_parsed,
    "answers_with_questions": answers_with_questions,
    "best_answer": best_answer,
    "tag_vectors": tag_vectors,
    "farthest_first_8": farthest_first_8,
    "farthest_first_seeded_8": farthest_first_seeded_8,
    "random_seeds_8": random_seeds_8,
    "assign_nearest": assign_nearest,
    "lloyd_step": lloyd_step,
    "residual": residual,
    "centroid_movement": centroid_movement,
    "kmeans_8x5": kmeans_8x5,
    "cluster_summary": cluster_summary,
    "cluster_converged_45": cluster_converged_45,
}


# --------------------------------------------------------------------------- DuckDB oracle

_DOMAINS = "[" + ", ".join(f"'{d}'" for d in fx.PRIORITY_DOMAINS) + "]"
_BASE = f"""
p AS (SELECT 1 AS posting_type, o_orderkey AS id, CAST(NULL AS BIGINT) AS parent_id,
        CAST(0 AS BIGINT) AS score, o_orderpriority AS tag FROM orders
      UNION ALL
      SELECT 2, l_orderkey * 10 + l_linenumber, l_orderkey, CAST(floor(l_extendedprice) AS BIGINT),
        CAST(NULL AS VARCHAR) FROM lineitem),
awq AS (SELECT a.parent_id AS question_id, a.score, q.tag FROM p a JOIN p q
        ON a.parent_id = q.id AND a.posting_type = 2 AND q.posting_type = 1),
best AS (SELECT question_id, max(score) AS score, any_value(tag) AS tag FROM awq GROUP BY question_id),
v AS (SELECT question_id, CAST(50000 AS BIGINT) * CAST(coalesce(list_position({_DOMAINS}, tag), 0) - 1 AS BIGINT) AS x,
        CAST(score AS BIGINT) AS y FROM best),
pts AS MATERIALIZED (SELECT x, y, CAST(count(*) AS BIGINT) AS w FROM v GROUP BY x, y)"""


def _dist(px: str, py: str, cx: str, cy: str) -> str:
    return f"(({px} - {cx}) * ({px} - {cx}) + ({py} - {cy}) * ({py} - {cy}))"


_MD5 = "md5(CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) || ',0')"


def _seed_ctes(k: int, seeded: bool = False) -> str:
    first = f"ORDER BY {_MD5}, x, y" if seeded else "ORDER BY x, y"
    parts = [f"s1 AS MATERIALIZED (SELECT x, y FROM pts {first} LIMIT 1)"]
    for i in range(2, k + 1):
        prev = f"s{i - 1}"
        parts.append(
            f"s{i} AS MATERIALIZED (SELECT x, y FROM {prev} UNION ALL (SELECT x, y FROM "
            f"(SELECT p.x, p.y, min({_dist('p.x', 'p.y', 's.x', 's.y')}) AS d2 FROM pts p, {prev} s "
            f"GROUP BY p.x, p.y) ORDER BY d2 DESC, x ASC, y ASC LIMIT 1))")
    return ",\n".join(parts)


def _assign(points: str, cents: str) -> str:
    near = f"min(struct_pack(d2 := {_dist('p.x', 'p.y', 'c.x', 'c.y')}, cx := c.x, cy := c.y))"
    return f"(SELECT p.x, p.y, p.w, {near} AS n FROM {points} p, {cents} c GROUP BY p.x, p.y, p.w)"


def _update(cents: str) -> str:
    return (f"(SELECT DISTINCT CAST(sum(x * w) // sum(w) AS BIGINT) AS x, CAST(sum(y * w) // sum(w) AS BIGINT) AS y "
            f"FROM {_assign('pts', cents)} a GROUP BY a.n.cx, a.n.cy)")


def _lloyd_ctes(first: str, updates: int) -> str:
    parts = [f"c0 AS MATERIALIZED (SELECT x, y FROM {first})"]
    for i in range(1, updates + 1):
        parts.append(f"c{i} AS MATERIALIZED {_update(f'c{i - 1}')}")
    return ",\n".join(parts)


def _stopped_ctes(first: str, updates: int, eta: float) -> str:
    """Lloyd updates that stop once the movement is below eta: rows keep their count and flag from then on."""
    parts = [f"c0 AS MATERIALIZED (SELECT x, y, false AS done, 0 AS n FROM {first})"]
    for i in range(1, updates + 1):
        prev = f"c{i - 1}"
        moved = (f"SELECT CAST(sum(x * w) // sum(w) AS BIGINT) AS x, CAST(sum(y * w) // sum(w) AS BIGINT) AS y, "
                 f"a.n.cx AS cx, a.n.cy AS cy FROM {_assign('pts', f'(SELECT x, y FROM {prev} WHERE NOT done)')} a "
                 "GROUP BY a.n.cx, a.n.cy")
        move = "sqrt(CAST((x - cx) * (x - cx) + (y - cy) * (y - cy) AS DOUBLE))"
        parts.append(f"c{i} AS MATERIALIZED (SELECT DISTINCT x, y, done, {i} AS n FROM (SELECT x, y, sum({move}) OVER () < {eta} "
                     f"AS done FROM ({moved}) m) t UNION ALL SELECT x, y, done, n FROM {prev} WHERE done)")
    return ",\n".join(parts)


def _residual_ctes(first: str, updates: int, mean: int) -> str:
    """Lloyd updates that stop before an update once the residual is below the bound."""
    near = _assign("pts", "{c}")
    parts = [f"c0 AS MATERIALIZED (SELECT x, y, 0 AS n FROM {first})"]
    for i in range(1, updates + 1):
        prev = f"c{i - 1}"
        assigned = near.format(c=f"(SELECT x, y FROM {prev} WHERE n = {i - 1})")
        parts.append(
            f"a{i} AS MATERIALIZED (SELECT x, y, w, a.n.cx AS cx, a.n.cy AS cy, sqrt(CAST(a.n.d2 AS DOUBLE)) * w AS r FROM {assigned} a),\n"
            f"c{i} AS MATERIALIZED (SELECT DISTINCT CAST(sum(x * w) // sum(w) AS BIGINT) AS x, CAST(sum(y * w) // sum(w) AS BIGINT) AS y, "
            f"{i} AS n FROM a{i} WHERE (SELECT sum(r) FROM a{i}) >= {mean} * (SELECT sum(w) FROM pts) GROUP BY cx, cy "
            f"UNION ALL SELECT x, y, n FROM {prev} WHERE n < {i - 1} OR (SELECT sum(r) FROM a{i}) < {mean} * (SELECT sum(w) FROM pts))")
    return ",\n".join(parts)


def _summary_of(last: str, more: str = "") -> str:
    return ("SELECT cx, cy, CAST(count(*) AS BIGINT) AS size, CAST(sum(y) // count(*) AS BIGINT) AS average, "
            f"CAST(trunc(quantile_cont(y, 0.5)) AS BIGINT) AS median{more} FROM "
            f"(SELECT v.y, a.n.cx AS cx, a.n.cy AS cy FROM v JOIN {_assign('pts', f'(SELECT x, y FROM {last})')} a "
            "ON v.x = a.x AND v.y = a.y) t GROUP BY cx, cy")


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_SEEDS = _seed_ctes(K_SMALL)
_S = f"s{K_SMALL}"

_RANDOM = f"""r8 AS MATERIALIZED (SELECT x, y FROM (SELECT DISTINCT x, y FROM pts) t ORDER BY {_MD5}, x, y LIMIT {K_SMALL})"""

SQL = {
    "cluster_converged_45": _with(_BASE, _seed_ctes(45), _stopped_ctes("s45", 121, 20.0)) + _summary_of(
        "c121", ", (SELECT max(n) FROM c121) AS updates, (SELECT bool_or(done) FROM c121) AS converged"),
    "cluster_random_8": _with(_BASE, _RANDOM, _lloyd_ctes("r8", UPDATES_SMALL)) + _summary_of(
        f"c{UPDATES_SMALL}", f", {UPDATES_SMALL} AS updates, false AS converged"),
    "kmeans_residual_stop": _with(_BASE, _SEEDS, _residual_ctes(_S, UPDATES_RESIDUAL, RESIDUAL_MEAN)) + (
        f"SELECT x AS cx, y AS cy, n AS updates, (n < {UPDATES_RESIDUAL}) AS converged FROM c{UPDATES_RESIDUAL}"),
    "postings_parsed": _with(_BASE) + "SELECT * FROM p",
    "answers_with_questions": """SELECT CAST(l_orderkey AS BIGINT) AS question_id, CAST(floor(l_extendedprice) AS BIGINT) AS score,
        o_orderpriority AS tag FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "best_answer": _with(_BASE) + "SELECT question_id, score, tag FROM best",
    "tag_vectors": _with(_BASE) + "SELECT * FROM v",
    "farthest_first_8": _with(_BASE, _SEEDS) + f"SELECT x, y FROM {_S}",
    "farthest_first_seeded_8": _with(_BASE, _seed_ctes(K_SMALL, seeded=True)) + f"SELECT x, y FROM {_S}",
    "random_seeds_8": _with(_BASE) + "SELECT x, y FROM (SELECT DISTINCT x, y FROM pts) t "
                                     "ORDER BY md5(CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) || ',0'), x, y "
                                     f"LIMIT {K_SMALL}",
    "assign_nearest": _with(_BASE, _SEEDS) + (
        f"SELECT v.question_id, a.n.cx AS cx, a.n.cy AS cy, a.n.d2 AS d2 FROM v JOIN "
        f"{_assign('pts', _S)} a ON v.x = a.x AND v.y = a.y"),
    "lloyd_step": _with(_BASE, _SEEDS, _lloyd_ctes(_S, 1)) + "SELECT x AS cx, y AS cy FROM c1",
    "residual": _with(_BASE, _SEEDS) + (
        f"SELECT round(sum(sqrt(CAST(a.n.d2 AS DOUBLE)) * a.w), 3) AS residual FROM {_assign('pts', _S)} a"),
    "centroid_movement": _with(_BASE, _SEEDS) + (
        "SELECT round(sum(sqrt(CAST((nx - cx) * (nx - cx) + (ny - cy) * (ny - cy) AS DOUBLE))), 3) AS movement "
        "FROM (SELECT a.n.cx AS cx, a.n.cy AS cy, CAST(sum(x * w) // sum(w) AS BIGINT) AS nx, "
        f"CAST(sum(y * w) // sum(w) AS BIGINT) AS ny FROM {_assign('pts', _S)} a GROUP BY a.n.cx, a.n.cy) t"),
    "kmeans_8x5": _with(_BASE, _SEEDS, _lloyd_ctes(_S, UPDATES_SMALL)) + f"SELECT x AS cx, y AS cy FROM c{UPDATES_SMALL}",
    "cluster_summary": _with(_BASE, _SEEDS, _lloyd_ctes(_S, UPDATES_SMALL)) + (
        "SELECT cx, cy, CAST(count(*) AS BIGINT) AS size, CAST(sum(y) // count(*) AS BIGINT) AS average, "
        "CAST(trunc(quantile_cont(y, 0.5)) AS BIGINT) AS median FROM "
        f"(SELECT v.y, a.n.cx AS cx, a.n.cy AS cy FROM v JOIN {_assign('pts', f'c{UPDATES_SMALL}')} a "
        "ON v.x = a.x AND v.y = a.y) t GROUP BY cx, cy"),
}
