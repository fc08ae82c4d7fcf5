"""A single key holding a third of all rows must not change results."""

import random

from tests.conftest import rows
from tests.test_recommend import _brute_cooc, ratings
from quarry.operators import cluster as C
from quarry.operators import recommend as R


def test_hot_user_cooccurrence_and_scores(spark):
    rnd = random.Random(7)
    cold = [(rnd.randint(2, 200), rnd.randint(0, 60), rnd.randint(1, 5)) for _ in range(2000)]
    hot = [(1, rnd.randint(0, 60), rnd.randint(1, 5)) for _ in range(1000)]   # a third of all rows
    raw = cold + hot
    r = R.dedupe_ratings(ratings(spark, raw), "sum")
    got = {(a, b): n for a, b, n in rows(R.cooccurrence(r))}
    assert got == _brute_cooc(raw)
    pref = {}
    for u, i, p in raw:
        pref[(u, i)] = pref.get((u, i), 0) + p
    expected = {}
    for (u, y), p in pref.items():
        for (i, y2), n in got.items():
            if y2 == y:
                expected[(i, u)] = expected.get((i, u), 0) + n * p
    s = {(i, u): v for i, u, v in rows(R.scores(r))}
    assert s == expected
    one = {i: v for i, _, v in rows(R.scores(r, user_id=1))}
    assert one == {i: v for (i, u), v in expected.items() if u == 1}


def test_hot_question_best_answer(spark):
    rnd = random.Random(8)
    q = [(1, qid, None, 0, "A") for qid in range(1, 50)]
    a = [(2, 1000 + j, rnd.randint(1, 49), rnd.randint(0, 999), None) for j in range(400)]
    a += [(2, 5000 + j, 7, rnd.randint(0, 999), None) for j in range(225)]          # a third on one question
    p = spark.createDataFrame(q + a, "posting_type int, id bigint, parent_id bigint, score bigint, tag string")
    best = {}
    for _, _, parent, score, _ in a:
        best[parent] = max(best.get(parent, -1), score)
    assert rows(C.best_answer(p)) == sorted((k, v, "A") for k, v in best.items())
