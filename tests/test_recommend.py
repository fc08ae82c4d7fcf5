import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, rows
from quarry import fixtures as fx
from quarry.operators import recommend as R
from quarry.operators import tiles
from quarry.plans.recommend import recommend_job
from quarry.session import scratch_path
from quarry.sources.records import parse_ratings, read_ratings
from quarry.sources.text import write_lines


def ratings(spark, triples):
    return spark.createDataFrame(triples, "user_id bigint, item_id bigint, pref bigint")


TINY = [(1, 1, 1), (1, 2, 1), (2, 1, 1), (2, 2, 1), (2, 3, 1), (3, 3, 4)]


def test_cooccurrence_literal(spark):
    got = dict(((a, b), n) for a, b, n in rows(R.cooccurrence(ratings(spark, TINY))))
    assert got == {(1, 1): 2, (2, 2): 2, (3, 3): 2, (1, 2): 2, (2, 1): 2,
                   (1, 3): 1, (3, 1): 1, (2, 3): 1, (3, 2): 1}


def test_scores_literal(spark):
    s = {(i, u): v for i, u, v in rows(R.scores(ratings(spark, TINY)), "item_id", "user_id", "score")}
    assert (s[(1, 3)], s[(2, 3)], s[(3, 3)]) == (4, 4, 8)
    one = {i: v for i, _, v in rows(R.scores(ratings(spark, TINY), user_id=3), "item_id", "user_id", "score")}
    assert one == {1: 4, 2: 4, 3: 8}


def test_two_column_keys_do_not_collide(spark):
    # (1, 11) and (11, 1) would share the key "111" if ids were concatenated
    r = ratings(spark, [(1, 1, 1), (1, 11, 1), (2, 11, 1)])
    got = dict(((a, b), n) for a, b, n in rows(R.cooccurrence(r)))
    assert got[(1, 11)] == 1 and got[(11, 1)] == 1 and got[(11, 11)] == 2


def _brute_cooc(triples):
    items = {}
    for u, i, _ in triples:
        items.setdefault(u, set()).add(i)
    out = {}
    for its in items.values():
        for a, b in itertools.product(its, its):
            out[(a, b)] = out.get((a, b), 0) + 1
    return out


@pytest.mark.parametrize("block", [1024, 8, 1])
def test_cooccurrence_is_the_same_at_any_block_size(spark, monkeypatch, block):
    rnd = random.Random(3)
    triples = [(rnd.randint(1, 30), rnd.randint(0, 40), 1) for _ in range(400)]
    triples += [(99, i, 1) for i in range(60)]  # one heavy user with many items
    monkeypatch.setattr(R, "BLOCK_ITEMS", block)
    monkeypatch.setattr(tiles, "CHUNK_CELLS", 500)
    monkeypatch.setattr(tiles, "HELD_CELLS", 700)
    got = dict(((a, b), n) for a, b, n in rows(R.cooccurrence(ratings(spark, triples + [(5, 7, 1)] * 3))))
    assert got == _brute_cooc(triples + [(5, 7, 1)])


def test_one_users_pairs_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ITEMS", 16)
    r = ratings(spark, [(1, i, 1) for i in range(400)])
    pairs = R.block_pairs(r, R.measure(r).blocks)
    sizes = pairs.select(F.size("left") * F.greatest(F.size("right"), F.lit(1))).collect()
    assert len(sizes) > 200 and max(x[0] for x in sizes) < 400 * 400 / 50
    tasks = pairs.repartition(8, "b1", "b2", "part").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == 8


def test_null_users_and_items_never_meet(spark):
    r = spark.createDataFrame([(None, 1, 1), (None, 2, 1), (1, 1, 1), (1, None, 1)], "user_id bigint, item_id bigint, pref bigint")
    assert rows(R.cooccurrence(r)) == [(1, 1, 1)]
    assert rows(R.scores(r)) == [(1, 1, 1)]


def test_cooccurrence_properties_on_fixture(spark):
    r = R.dedupe_ratings(fx.raw_ratings(spark, SF_SMALL))
    c = {(a, b): n for a, b, n in rows(R.cooccurrence(r))}
    assert all(c[(b, a)] == n for (a, b), n in c.items())
    users_per_item = {i: n for i, n in rows(r.groupBy("item_id").count())}
    assert all(c[(i, i)] == n for i, n in users_per_item.items())


def test_shaped_equals_plain(spark):
    raw = fx.raw_ratings(spark, SF_SMALL)
    a = rows(recommend_job(raw, user_id=fx.TARGET_USER, shaped=True))
    b = rows(recommend_job(raw, user_id=fx.TARGET_USER, shaped=False))
    assert a == b and len(a) > 0


def test_rank_ties_and_exclude_seen(spark):
    s = spark.createDataFrame([(1, 5, 3), (1, 2, 3), (1, 9, 7)], "user_id bigint, item_id bigint, score bigint")
    assert rows(R.rank(s), "item_id", "rank") == [(2, 2), (5, 3), (9, 1)]
    seen = spark.createDataFrame([(1, 9)], "user_id bigint, item_id bigint")
    assert rows(R.rank(s, seen=seen), "item_id", "rank") == [(2, 1), (5, 2)]
    assert rows(R.rank(s, n=1), "item_id") == [(9,)]


def test_dense_scores_zero_fill_and_range(spark):
    r = ratings(spark, [(1, 0, 2), (1, 3, 5), (1, 7, 1), (2, 9, 1)])
    got = rows(R.dense_scores(r, n_items=4, out_of_range="drop"))
    assert got == [(1, 0, 2), (1, 1, 0), (1, 2, 0), (1, 3, 5), (2, 0, 0), (2, 1, 0), (2, 2, 0), (2, 3, 0)]


def test_dedupe_modes(spark):
    r = ratings(spark, [(1, 1, 2), (1, 1, 5), (2, 1, 1)])
    assert rows(R.dedupe_ratings(r, "sum")) == [(1, 1, 7), (2, 1, 1)]
    assert rows(R.dedupe_ratings(r, "max")) == [(1, 1, 5), (2, 1, 1)]
    with pytest.raises(ValueError):
        R.dedupe_ratings(r, "last")


def test_vectors_are_sorted_and_blocked(spark):
    r = ratings(spark, [(1, 30, 2), (1, 4, 1), (1, 1500, 3)])
    assert rows(R.user_vectors(r)) == [(1, 0, 2, "4:1,30:2"), (1, 1, 1, "1500:3")]


def test_ratings_reader_separators_and_errors(spark):
    path = scratch_path(spark, "rt")
    write_lines(spark.createDataFrame([("1\t7,2.5",), ("2,8\t1,extra",)], "value string"), path)
    assert rows(read_ratings(spark, path)) == [(1, 7, 2.5), (2, 8, 1.0)]
    bad = spark.createDataFrame([("x,1,1",), ("3,1",)], "value string")
    with pytest.raises(Exception):
        parse_ratings(bad).collect()
    assert {tuple(r) for r in parse_ratings(bad, on_error="null").collect()} == {(None, 1, 1.0), (3, 1, None)}


def _brute_scores(triples):
    cooc, out = _brute_cooc(triples), {}
    for u, y, p in triples:
        for (i, y2), n in cooc.items():
            if y2 == y:
                out[(i, u)] = out.get((i, u), 0) + n * (p or 0)
    return out


@pytest.mark.parametrize("block, users", [(1024, 8192), (2, 8192), (2, 1)])
@pytest.mark.parametrize("triples", [
    [(1, 1, 0), (1, 2, 0), (2, 1, 3), (2, 2, 1)],                               # one user has only zero prefs
    [(1, 1, -2), (1, 3, -1), (2, 1, 1), (2, 3, 1), (2, 2, 5)],                  # negative prefs
    [(1, 1, 0), (1, 2, 4), (2, 1, 1), (2, 2, 1), (2, 3, 2), (3, 3, 9)],         # a seen item with pref 0
    [(1, 1, None), (1, 2, 2), (2, 1, 1)],                                       # a null pref
])
def test_scores_and_top_n_have_one_rule_at_every_size(spark, monkeypatch, triples, block, users):
    monkeypatch.setattr(R, "BLOCK_ITEMS", block)
    monkeypatch.setattr(R, "SLICE_USERS", users)
    r = ratings(spark, triples)
    want = _brute_scores(triples)
    assert {(i, u): v for i, u, v in rows(R.scores(r), "item_id", "user_id", "score")} == want
    for u0 in {u for u, _, _ in triples}:
        one = {i: v for i, _, v in rows(R.scores(r, user_id=u0), "item_id", "user_id", "score")}
        assert one == {i: v for (i, u), v in want.items() if u == u0}
    for unseen in (False, True):
        seen = {(i, u) for u, i, _ in triples} if unseen else set()
        best = []
        for u0 in {u for _, u in want}:
            mine = sorted((-v, i) for (i, u), v in want.items() if u == u0 and (i, u) not in seen)[:2]
            best += [(u0, i, -v, k + 1) for k, (v, i) in enumerate(mine)]
        assert rows(R.top_scores(r, 2, exclude_seen=unseen)) == sorted(best)


@pytest.mark.parametrize("kind", ["int", "float", "double", "decimal(10,2)"])
def test_pref_types(spark, kind):
    r = ratings(spark, [(1, 1, 2), (1, 2, 3), (2, 1, 1)]).select("user_id", "item_id", (F.col("pref") / 4).cast(kind).alias("pref"))
    exact = {(u, i): p for u, i, p in rows(r, "user_id", "item_id", "pref")}
    want = {k: float(v) for k, v in _brute_scores([(u, i, p) for (u, i), p in exact.items()]).items()}
    assert {(i, u): float(v) for i, u, v in rows(R.scores(r))} == want


def test_score_beyond_64_bits_fails(spark):
    r = ratings(spark, [(1, 1, (1 << 62)), (1, 2, (1 << 62)), (2, 1, 1), (2, 2, 1)])
    with pytest.raises(Exception, match="64 bits"):
        R.scores(r).collect()
    with pytest.raises(Exception, match="64 bits"):
        R.scores(r, user_id=1).collect()


def test_cooccurrence_runs_once(spark):
    r = R.dedupe_ratings(fx.raw_ratings(spark, SF_SMALL))
    for df in (R.scores(r, n_items=200, n_users=150), R.top_scores(r, 3, n_items=200, n_users=150)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("count_pairs(") == 1


def test_last_rating_wins_in_the_job(spark):
    raw = spark.createDataFrame([(1, 1, 9, 1), (1, 1, 2, 5), (1, 2, 1, 3), (2, 1, 1, 1)],
                                "user_id bigint, item_id bigint, pref bigint, at bigint")
    assert rows(R.dedupe_ratings(raw, "last", "at")) == [(1, 1, 2), (1, 2, 1), (2, 1, 1)]
    want = _brute_scores([(1, 1, 2), (1, 2, 1), (2, 1, 1)])
    got = recommend_job(raw, dedupe="last", order_col="at")
    assert {(i, u): v for i, u, v in rows(got, "item_id", "user_id", "score")} == want


def test_zero_fill_lists_the_catalogue(spark):
    raw = ratings(spark, [(1, 1, 2), (2, 3, 4)])
    assert rows(recommend_job(raw, zero_fill=True)) == [(1, 1, 2, 1), (1, 3, 0, 2), (2, 1, 0, 2), (2, 3, 4, 1)]
    for shaped in (True, False):
        assert rows(recommend_job(raw, user_id=1, zero_fill=True, shaped=shaped)) == [(1, 1, 2, 1), (1, 3, 0, 2)]


def test_one_user_plan_has_no_single_partition_over_scores(spark):
    s = R.scores(R.dedupe_ratings(fx.raw_ratings(spark, SF_SMALL)), user_id=fx.TARGET_USER)
    assert "SinglePartition" not in s._jdf.queryExecution().executedPlan().toString()
    ranked = rows(R.rank_one(s), "rank")
    assert ranked == [(i + 1,) for i in range(len(ranked))]
    assert rows(R.rank_one(s, n=4)) == rows(R.rank_one(s).where("rank <= 4"))


def test_readers_fail_without_ansi_too(spark):
    bad = spark.createDataFrame([("x,1,1",)], "value string")
    short = spark.createDataFrame([("3,1",)], "value string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for df in (bad, short):
            with pytest.raises(Exception):
                parse_ratings(df).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_header_line_is_skipped(spark):
    lines = spark.createDataFrame([("user,item,pref",), ("1,2,3",)], "value string")
    assert rows(parse_ratings(lines, header="user,item,pref")) == [(1, 2, 3.0)]


def test_dense_scores_out_of_range(spark):
    r = ratings(spark, [(1, 7, 1)])
    with pytest.raises(Exception, match="outside"):
        R.dense_scores(r, n_items=4).collect()


def _random_ratings(seed, users, items, n, low=-3):
    rnd = random.Random(seed)
    return sorted({(rnd.randint(1, users), rnd.randint(0, items)): rnd.randint(low, 9) for _ in range(n)}.items())


@pytest.mark.parametrize("dense_from, sub, held", [(8, 512, 1 << 23), (1 << 40, 7, 50), (0, 3, 50)])
def test_products_are_the_same_dense_and_sparse(spark, monkeypatch, dense_from, sub, held):
    """The rule that chooses the form, the size of groups and the parts that are given away change nothing."""
    for name, value in (("DENSE_FROM", dense_from), ("SUB_ITEMS", sub), ("HELD_CELLS", held), ("CHUNK_CELLS", 200)):
        monkeypatch.setattr(tiles, name, value)
    monkeypatch.setattr(R, "BLOCK_ITEMS", 10)
    monkeypatch.setattr(R, "COLUMN_CELLS", 150)
    triples = [(u, i, p) for (u, i), p in _random_ratings(11, 40, 60, 500)]
    r = ratings(spark, triples)
    want = _brute_scores(triples)
    assert {(a, b): n for a, b, n in rows(R.cooccurrence(r))} == _brute_cooc(triples)
    assert {(i, u): v for i, u, v in rows(R.scores(r))} == want
    assert {(i, u): v for i, u, v in rows(R.scores(r, cooc=R.cooccurrence(r)))} == want
    seen = {(i, u) for u, i, _ in triples}
    for unseen in (False, True):
        best = []
        for u0 in {u for u, _, _ in triples}:
            mine = sorted((-v, i) for (i, u), v in want.items() if u == u0 and not (unseen and (i, u) in seen))[:3]
            best += [(u0, i, -v, k + 1) for k, (v, i) in enumerate(mine)]
        assert rows(R.top_scores(r, 3, exclude_seen=unseen)) == sorted(best)


def test_bounds_skip_groups_and_lose_nothing():
    rng = np.random.default_rng(3)
    n_items, users = 60, 50
    c = rng.integers(0, 3, (n_items, n_items)) * (rng.random((n_items, n_items)) < 0.4)
    c[:5] *= 40  # some sources weigh far more, so that bounds tell groups apart
    y, t = np.nonzero(c)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tiles, "SUB_ITEMS", 6)
        columns = tiles.Columns([(y, t, c[y, t])])
        visited = []
        for sub in columns.subs:
            original = sub.scores
            patch.setattr(sub, "scores", lambda users, u, y, p, f=original: visited.append(users) or f(users, u, y, p))
        for low in (1, -4):
            del visited[:]
            starts = np.arange(0, users * 4 + 1, 4)
            item = np.concatenate([np.sort(rng.choice(n_items, 4, replace=False)) for _ in range(users)])
            p = rng.integers(low, 10, users * 4)
            u, source, pref = columns.ratings(users, starts, item, p)
            whole = np.zeros((users, n_items), np.int64)
            np.add.at(whole, u, pref[:, None] * c[columns.sources[source]])
            met = np.zeros(whole.shape, np.int64)
            np.add.at(met, u, c[columns.sources[source]] > 0)
            (who, ids, score), = columns.best(users, u, source, pref, 3, False)
            for x in range(users):
                want = sorted((-whole[x, i], i) for i in range(n_items) if met[x, i])[:3]
                assert sorted(zip((-score[who == x]).tolist(), ids[who == x].tolist())) == want
            assert sum(visited) < users * len(columns.subs)


def test_copies_of_the_matrix_do_not_follow_the_users(spark):
    """Rows into the product: tiles by task, slices by ratings; no row is a cell or a rating."""
    few, many = (ratings(spark, [(u, (u * 7 + k * k) % 50, 1) for u in range(n) for k in range(6)]).distinct() for n in (40, 4000))
    got = []
    for r in (few, many):
        keyed, keys = R.product_rows(r, r, None, R.measure(r), "bigint")
        got.append((keys, keyed.where("kind = 0").count(), keyed.count()))
    assert got[0] == got[1] and got[1][2] < 1000


def test_zero_fill_has_no_constant_key(spark):
    slots = R.catalogue_slots(ratings(spark, TINY), ratings(spark, TINY).select("user_id").distinct())
    plan = slots._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, ((block" in plan and "part" in plan
    assert rows(slots) == [(i, u) for i in (1, 2, 3) for u in (1, 2, 3)]


def test_dense_scores_of_a_wide_catalogue(spark):
    r = ratings(spark, [(u, (u * 100_003) % 300_000, u) for u in range(1, 21)])
    got = R.dense_scores(r, n_items=300_000)
    n, total, users = got.agg(F.count("*"), F.sum("score"), F.countDistinct("user_id")).first()
    assert (n, total, users) == (20 * 300_000, sum(range(1, 21)), 20)
    assert rows(got.where("score > 0"), "user_id", "item_id", "score") == rows(r)


def test_last_rating_by_several_columns(spark):
    raw = spark.createDataFrame([(1, 1, 9, 1, 12), (1, 1, 2, 2, 1), (1, 1, 3, 1, 13), (2, 1, 5, 1, 1), (2, 1, 4, 1, 1)],
                                "user_id bigint, item_id bigint, pref bigint, a bigint, b bigint")
    assert rows(R.dedupe_ratings(raw, "last", ["a", "b"])) == [(1, 1, 2), (2, 1, 5)]


def test_last_rating_matches_its_sql_where_places_tie(spark):
    from tests.oracle_compare import compare, duck
    from quarry.plans import recommend as plans

    sf = "/root/testdata/sf0.01"
    r = compare(spark, duck(sf), "ratings_last", sf, plans.QUERIES, plans.SQL)
    assert r["cols_ok"] and r["hash_ok"], r


def _sparse(monkeypatch, step=1 << 20, cells=1 << 25):
    """Whole lists meet parts of the items from the smallest catalogue on; steps and parts as small as given."""
    monkeypatch.setattr(R.Sizes, "listed", property(lambda sizes: True))
    monkeypatch.setattr(R, "PART_PAIRS", 100)
    monkeypatch.setattr(R, "TARGET_CELLS", cells)
    monkeypatch.setattr(R, "SLICE_RATINGS", 40)
    monkeypatch.setattr(tiles, "LIST_RATINGS", 20)
    monkeypatch.setattr(tiles, "PART_RATINGS", 1)
    monkeypatch.setattr(tiles, "STEP_CELLS", step)


@pytest.mark.parametrize("step, spread, dense_sums", [(1 << 20, 1, 1000), (30, 10 ** 15, 0)])
def test_few_pairs_among_many_items(spark, monkeypatch, step, spread, dense_sums):
    """Lists and parts give what brute force gives: scores, the best, zeros, with null users and items among the ratings."""
    _sparse(monkeypatch, step, 60)
    monkeypatch.setattr(tiles, "DENSE_SUMS", dense_sums)
    triples = [(u, i * spread, p) for (u, i), p in _random_ratings(5, 25, 400, 90)]
    triples += [(77, i * spread, 2) for i in range(0, 400, 9)]  # one user with many items
    r = ratings(spark, triples)
    assert {(a, b): n for a, b, n in rows(R.cooccurrence(r.union(r)))} == _brute_cooc(triples)
    want = _brute_scores(triples)
    assert {(i, u): v for i, u, v in rows(R.scores(r))} == want
    odd = r.union(spark.createDataFrame([(None, 5 * spread + 1, 3), (500, None, 4), (None, None, 1)], r.schema))
    items, users = {i for _, i, _ in triples} | {5 * spread + 1}, {u for u, _, _ in triples} | {500}
    full = {(i, u): v for i, u, v in rows(R.scores(odd, zero_fill=True))}
    assert full == {(i, u): want.get((i, u), 0) for i in items for u in users}
    seen = {(i, u) for u, i, _ in triples}
    for unseen in (False, True):
        best = []
        for u0 in {u for u, _, _ in triples}:
            mine = sorted((-v, i) for (i, u), v in want.items() if u == u0 and not (unseen and (i, u) in seen))[:3]
            best += [(u0, i, -v, k + 1) for k, (v, i) in enumerate(mine)]
        assert rows(R.top_scores(r, 3, exclude_seen=unseen)) == sorted(best)


def test_few_pairs_keep_64_bits(spark, monkeypatch):
    _sparse(monkeypatch)
    big = [(u, 100 * u + k, (1 << 62) // (k + 1)) for u in range(40) for k in range(2)]
    r = ratings(spark, big[:2] + [(u, i, 1) for u, i, _ in big[2:]])
    assert max(v for _, _, v in rows(R.scores(r))) == (1 << 62) + (1 << 61)
    with pytest.raises(Exception, match="64 bits"):
        R.scores(ratings(spark, [(u, i, 1 << 62) for u, i, _ in big])).collect()


def test_ratings_are_copied_to_few_targets_and_cells_to_none(spark):
    """What meets in a product grows with ratings and cells: no row for each pair of blocks, no 16 bytes a rating."""
    r = spark.range(24_000).select((F.col("id") % 800).alias("user_id"), (F.xxhash64("id") % 40_000).alias("item_id"),
                                   (F.col("id") % 50).alias("pref")).distinct()
    sizes = R.measure(r)
    assert sizes.listed
    keyed, keys = R.product_rows(r, r, None, sizes, "bigint")
    assert keys == spark.sparkContext.defaultParallelism
    assert keyed.where("kind = 1").agg(F.sum(F.length("b") + F.length("n"))).first()[0] < 6 * sizes.ratings * keys
    lists = R._lists(r, 64)
    assert lists.count() <= 64 * r.select("user_id").repartition("user_id").rdd.getNumPartitions()
    for v in ([], [5], [-1 << 63, (1 << 63) - 1], list(range(-3, 70_000, 7))):
        v = np.array(v, np.int64)
        assert (tiles.uncrammed(tiles.crammed(v)) == v).all()


def test_sums_of_dense_counts_take_no_more_room_with_more_users():
    cells = tiles._Cells(np.arange(100), np.arange(100))
    most = 0
    for _ in range(60):
        cells.add(np.arange(10_000), np.ones(10_000, np.int64))
        most = max(most, cells.size)
    assert most <= max(tiles.CHUNK_CELLS >> 4, 30_000) and (cells.taken()[2] == 60).all()
