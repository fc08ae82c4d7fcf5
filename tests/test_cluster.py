import math
import random

import pytest

from tests.conftest import SF_SMALL, rows
from quarry import fixtures as fx
from quarry.functions.geometry import REFERENCE_DOMAINS, encode_domain
from quarry.operators import cluster as C
from quarry.operators import lines as L
from quarry.plans.cluster import cluster_job
from quarry.sources.records import parse_postings


def pts(spark, xy, w=None):
    data = [(x, y, 1 if w is None else w[i]) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(data, "x bigint, y bigint, w bigint")


def test_posting_reader_ragged_rows(spark):
    lines = spark.createDataFrame([("1,10,,0,Algorithm",), ("1,13,,3,",), ("1,14,,2,Sec,extra",),
                                   ("2,11,10,5",), ("2,12,10,7,",)], "value string")
    got = rows(parse_postings(lines), "id", "parent_id", "tag")
    assert got == [(10, None, "Algorithm"), (11, 10, None), (12, 10, None), (13, None, None), (14, None, "Sec")]
    with pytest.raises(Exception):
        parse_postings(spark.createDataFrame([("1,x,,0,A",)], "value string")).collect()


def test_domain_code(spark):
    df = spark.createDataFrame([("Machine-Learning",), ("nope",), (None,)], "tag string")
    got = [r.c for r in df.select(encode_domain(df.tag, REFERENCE_DOMAINS).alias("c")).collect()]
    assert got == [0, -1, None]


def test_best_answer_joins_and_max(spark):
    p = spark.createDataFrame(
        [(1, 1, None, 0, "A"), (1, 2, None, 0, "B"), (2, 10, 1, 5, None), (2, 11, 1, 9, None), (2, 12, 99, 50, None)],
        "posting_type int, id bigint, parent_id bigint, score bigint, tag string")
    assert rows(C.best_answer(p)) == [(1, 9, "A")]          # orphan and unanswered drop
    assert rows(C.answers_with_questions(p)) == [(1, 5, "A"), (1, 9, "A")]


def test_null_tag(spark):
    best = spark.createDataFrame([(1, 5, None), (2, 7, "Algorithm")], "question_id bigint, score bigint, tag string")
    with pytest.raises(Exception):
        C.tag_vectors(best, REFERENCE_DOMAINS).collect()
    assert rows(C.tag_vectors(best, REFERENCE_DOMAINS, on_missing="drop")) == [(2, 100000, 7)]
    with pytest.raises(ValueError):
        C.tag_vectors(best, REFERENCE_DOMAINS, spread=0)


def test_integer_mean_truncates_toward_zero(spark):
    steps = C.lloyd_step(pts(spark, [(-3, 0), (-4, 0)]), [(0, 0)])
    assert [s.new for s in steps] == [(-3, 0)]


def test_nearest_tie_goes_to_smallest(spark):
    a = C.assign(pts(spark, [(0, 0)]), [(3, 0), (-3, 0)])
    assert rows(a, "cx", "cy", "d2") == [(-3, 0, 9)]


@pytest.mark.parametrize("buckets", [1024, 2])
def test_median_and_average(spark, monkeypatch, buckets):
    monkeypatch.setattr(C, "MEDIAN_BUCKETS", buckets)
    for ys, med in (([1, 2], 1), ([5, 1, 9], 5), ([1, 4, 4, 8], 4), ([-3, -4], -3)):
        s = C.summary(pts(spark, [(0, y) for y in ys]), [(0, 0)]).collect()[0]
        assert s.median == med, ys
        assert s.size == len(ys)
        assert s.average == int(sum(ys) / len(ys))
    # weights count as repeated points
    s = C.summary(pts(spark, [(0, 1), (0, 10)], w=[3, 1]), [(0, 0)]).collect()[0]
    assert (s.size, s.median, s.average) == (4, 1, 3)


def test_update_cap(spark):
    p = pts(spark, [(0, 0), (10, 0), (20, 0), (30, 0)])
    r = C.lloyd(p, [(0, 0), (30, 0)], max_updates=3, eta=-1.0, stop="movement")
    assert r.updates == 3
    assert C.lloyd.__defaults__[0] == 121


def test_seeding_stops_when_points_run_out(spark):
    p = pts(spark, [(0, 0), (0, 0), (5, 5)])
    assert C.farthest_first(p, 5) == [(0, 0), (5, 5)]


# ----------------------------------------------------------------- brute force

def _tdiv(a, b):
    q = abs(a) // b
    return q if a >= 0 else -q


def _brute(points, k, eta=20.0, cap=121):
    uniq = sorted(set(points))
    d2 = lambda p, c: (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2
    seeds = [uniq[0]]
    while len(seeds) < k:
        far = max(uniq, key=lambda p: (min(d2(p, s) for s in seeds), -p[0], -p[1]))
        if min(d2(far, s) for s in seeds) == 0:
            break
        seeds.append(far)
    cents, n = sorted(set(seeds)), 0
    while n < cap:
        groups = {}
        for p in points:
            c = min(cents, key=lambda c: (d2(p, c), c[0], c[1]))
            groups.setdefault(c, []).append(p)
        new = {c: (_tdiv(sum(p[0] for p in g), len(g)), _tdiv(sum(p[1] for p in g), len(g))) for c, g in groups.items()}
        mv = math.fsum(math.hypot(new[c][0] - c[0], new[c][1] - c[1]) for c in new)
        cents, n = sorted(set(new.values())), n + 1
        if mv < eta:
            break
    out = {}
    for p in points:
        c = min(cents, key=lambda c: (d2(p, c), c[0], c[1]))
        out.setdefault(c, []).append(p[1])
    res = []
    for c, ys in out.items():
        ys.sort()
        m = len(ys)
        res.append((c[0], c[1], m, _tdiv(sum(ys), m), _tdiv(ys[(m - 1) // 2] + ys[m // 2], 2)))
    return sorted(res)


def test_converged_job_matches_brute_force(spark):
    postings = fx.postings(spark, SF_SMALL)
    vec = C.tag_vectors(C.best_answer(postings), fx.PRIORITY_DOMAINS)
    points = [(r.x, r.y) for r in vec.collect()]
    expected = _brute(points, 45)
    job = cluster_job(postings, k=45, domains=fx.PRIORITY_DOMAINS)
    assert rows(job, "cx", "cy", "size", "average", "median") == expected


def test_partition_independence_kmeans(spark):
    out = []
    for parts in (1, 3, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        vec = C.tag_vectors(C.best_answer(fx.postings(spark, SF_SMALL)), fx.PRIORITY_DOMAINS).repartition(parts)
        p = C.weighted_points(vec)
        res = C.lloyd(p, C.farthest_first(p, 8), max_updates=5, stop=None)
        out.append(rows(C.summary(p, res.centroids)))
        assert sum(r[2] for r in out[-1]) == vec.count()   # sizes add up to the points
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] == out[2]


def test_residual_stop_rule(spark):
    # residual of the seeds is 2 (< eta 5): no update happens
    p = pts(spark, [(0, 0), (0, 2), (10, 0)])
    r = C.lloyd(p, [(0, 0), (10, 0)], eta=5.0, stop="residual")
    assert (r.updates, r.centroids, r.last_residual) == (0, [(0, 0), (10, 0)], 2.0)
    # with eta 1 the residual (2) never drops below it, so the cap of 2 updates ends the run
    r = C.lloyd(p, [(0, 0), (10, 0)], eta=1.0, stop="residual", max_updates=2)
    assert r.updates == 2 and r.centroids == [(0, 1), (10, 0)]


def test_cycle_skip_lands_on_the_capped_state(monkeypatch):
    # fake update: (0,0) -> (10,0) -> (20,0) -> (30,0) -> (20,0) -> (30,0) ... (cycle of length 2)
    nxt = {(0, 0): (10, 0), (10, 0): (20, 0), (20, 0): (30, 0), (30, 0): (20, 0)}
    calls = []

    def fake_step(points, cents):
        calls.append(1)
        return [C.Step(c, nxt[c], 1, 1.0) for c in cents]

    monkeypatch.setattr(C, "lloyd_step", fake_step)
    for cap in (1, 2, 3, 4, 120, 121):
        calls.clear()
        fast = C.lloyd(None, [(0, 0)], max_updates=cap, eta=5.0)
        slow_calls = len(calls)
        calls.clear()
        slow = C.lloyd(None, [(0, 0)], max_updates=cap, eta=5.0, skip_cycles=False)
        assert (fast.centroids, fast.updates, fast.last_movement) == (slow.centroids, slow.updates, slow.last_movement)
        assert slow_calls <= 4
    assert C.lloyd(None, [(0, 0)], max_updates=121, eta=5.0).centroids == [(30, 0)]


def test_squared_error_does_not_rise_much(spark):
    from pyspark.sql import functions as F
    p = C.weighted_points(C.tag_vectors(C.best_answer(fx.postings(spark, SF_SMALL)), fx.PRIORITY_DOMAINS))
    cents = C.farthest_first(p, 8)
    sse = []
    for _ in range(6):
        sse.append(C.assign(p, cents).agg(F.sum(F.col("d2") * F.col("w")).alias("s")).first().s)
        cents = C.recenter(C.lloyd_step(p, cents))
    # truncated means may raise it a little; exact means never would
    assert all(b <= a * 1.001 + 1e6 for a, b in zip(sse, sse[1:])), sse
    assert sse[-1] < sse[0]


def test_far_coordinates_are_exact(spark):
    for far in (1 << 30, (1 << 30) + 5, (1 << 31) - 1):
        p = pts(spark, [(0, far), (0, far - 1), (0, 0)])
        assert rows(C.assign(p, [(0, 0), (0, far)]), "y", "cy", "d2") == [(0, 0, 0), (far - 1, far, 1), (far, far, 0)]
        assert C.farthest_first(p, 2) == [(0, 0), (0, far)]
    low, high = -(1 << 31), (1 << 31) - 1
    p = pts(spark, [(0, low), (700000, high), (0, 0)])
    steps = C.lloyd_step(p, [(0, low), (700000, high)])
    assert sorted((s.old, s.size) for s in steps) == [((0, low), 2), ((700000, high), 1)]
    assert C.farthest_first(p, 3) == [(0, low), (700000, high), (0, 0)]


def test_questions_with_one_id_are_one(spark):
    p = spark.createDataFrame([(1, 1, None, 0, "A"), (1, 1, None, 0, "B"), (2, 10, 1, 5, None)],
                              "posting_type int, id bigint, parent_id bigint, score bigint, tag string")
    assert rows(C.best_answer(p)) == [(1, 5, "B")]


def test_job_tells_whether_it_converged(spark):
    p = spark.createDataFrame([(1, i, None, 0, "Algorithm") for i in range(6)] + [(2, 100 + i, i, 10 * i, None) for i in range(6)],
                              "posting_type int, id bigint, parent_id bigint, score bigint, tag string")
    done = cluster_job(p, k=2).first()
    assert done.converged and done.updates < 121
    capped = cluster_job(p, k=2, max_updates=1, eta=-1.0, seeding="random").first()
    assert not capped.converged and capped.updates == 1
    with pytest.raises(ValueError):
        cluster_job(p, seeding="other")


# --------------------------------------------------------------------------- lines

def _random_points(seed, n, xs, far=4000):
    rnd = random.Random(seed)
    return sorted({(rnd.choice(xs), rnd.randint(-far, far)): rnd.randint(1, 5) for _ in range(n)}.items())


@pytest.mark.parametrize("block, window", [(1024, 32), (16, 2), (1, 1)])
def test_lines_give_the_steps_and_seeds_of_a_scan(spark, monkeypatch, block, window):
    monkeypatch.setattr(L, "BLOCK_POINTS", block)
    monkeypatch.setattr(L, "WINDOW", window)
    rnd = random.Random(2)
    for xs in ([0], [-50, 0, 50, 100], [-3000, 10, 2500]):
        rows_ = [(x, y, w) for (x, y), w in _random_points(len(xs), 300, xs)]
        p = C.cut_lineage(spark.createDataFrame(rows_, "x bigint, y bigint, w bigint").repartition(5))
        lines = C.lines_of(p)
        assert sum(b.n for bs in lines.lines.values() for b in bs) == len(rows_)
        for k in (1, 2, 9, 400):
            assert C.farthest_first(p, k, lines=lines) == _brute_farthest(rows_, k)
        cents = sorted({(rnd.choice(xs) + rnd.randint(-9, 9), rnd.randint(-4000, 4000)) for _ in range(12)})
        by_scan = {s.old: (s.new, s.size) for s in C.lloyd_step(p, cents)}
        assert {s.old: (s.new, s.size) for s in C.line_step(lines, cents)} == by_scan


def _brute_farthest(points, k):
    seeds = [min((x, y) for x, y, _ in points)]
    while len(seeds) < k:
        d2, x, y = max((min((x - a) ** 2 + (y - b) ** 2 for a, b in seeds), -x, -y) for x, y, _ in points)
        if d2 == 0:
            break
        seeds.append((-x, -y))
    return seeds


def test_seeding_by_lines_takes_few_jobs(spark, monkeypatch):
    rows_ = [(x, y, w) for (x, y), w in _random_points(5, 6000, [0, 500, 1000, 1500], far=60000)]
    p = C.cut_lineage(spark.createDataFrame(rows_, "x bigint, y bigint, w bigint"))
    monkeypatch.setattr(L, "BLOCK_POINTS", 200)
    lines, jobs = C.lines_of(p), []
    fetch = lines._fetch
    monkeypatch.setattr(lines, "_fetch", lambda missing: jobs.append(len(missing)) or fetch(missing))
    assert lines.farthest_first(C.first_point(p), 45) == _brute_farthest(rows_, 45)
    assert len(jobs) <= 3, jobs


def test_sums_beyond_64_bits_on_lines(spark):
    top = (1 << 31) - 1
    p = C.cut_lineage(spark.createDataFrame([(0, top - i, 1 << 40) for i in range(40)] + [(7, -top, 3)], "x bigint, y bigint, w bigint"))
    steps = {s.old: s for s in C.line_step(C.lines_of(p), [(0, 0), (7, -top)])}
    assert steps[0, 0].new == (0, sum(top - i for i in range(40)) // 40) and steps[0, 0].size == 40 << 40
    assert steps[7, -top].new == (7, -top)


def test_many_lines_are_not_kept(spark, monkeypatch):
    monkeypatch.setattr(C, "MOST_LINES", 3)
    p = C.cut_lineage(spark.createDataFrame([(x, 0, 1) for x in range(4)], "x bigint, y bigint, w bigint"))
    assert C.lines_of(p) is None and C.lines_of(p.where("x < 3")) is not None and C.lines_of(p.limit(0)) is None


def test_medians_of_many_skewed_clusters(spark):
    """10,000 clusters, one with a third of all values: nothing but a count of open ranges comes to the driver."""
    rnd = random.Random(9)
    data = {}
    for _ in range(40_000):
        c = 0 if rnd.random() < 0.33 else rnd.randrange(1, 10_000)
        key = (c, -c, int(rnd.paretovariate(0.3)) % (1 << 50) * rnd.choice([1, -1]))
        data[key] = data.get(key, 0) + rnd.randint(1, 4)
    values, want = {}, {}
    for (cx, cy, y), w in sorted(data.items()):
        values.setdefault((cx, cy), []).extend([y] * w)
    df = spark.createDataFrame([(*k, w) for k, w in data.items()], "cx bigint, cy bigint, y bigint, w bigint")
    ranks = [(*c, (len(v) - 1) // 2, v[0], v[-1]) for c, v in values.items()]
    got = C.order_statistics(df, spark.createDataFrame(ranks, "cx bigint, cy bigint, rank bigint, lo bigint, hi bigint"))
    want = sorted((*c, (len(v) - 1) // 2, v[(len(v) - 1) // 2]) for c, v in values.items())
    assert rows(got) == want


@pytest.mark.parametrize("limit", [10, 1000])
def test_answers_of_a_hot_question(spark, limit):
    q = [(1, i, None, 0, f"t{i}") for i in range(30)] + [(1, 3, None, 0, "second of that id")]
    a = [(2, 100 + j, 7 if j % 2 else j % 40, j, None) for j in range(800)] + [(2, 5, None, 9, None)]
    p = spark.createDataFrame(q + a, "posting_type int, id bigint, parent_id bigint, score bigint, tag string")
    want = sorted((parent, score, tag) for _, _, parent, score, _ in a for _, i, _, _, tag in q if i == parent)
    assert rows(C.answers_with_questions(p.repartition(6), hot_answers=limit)) == want
