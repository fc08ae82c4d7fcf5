"""Empty inputs and ties must not break the kernels or the loops."""

from tests.conftest import rows
from quarry.operators import cluster as C
from quarry.operators import recommend as R
from quarry.operators import text as T


def test_empty_ratings(spark):
    r = spark.createDataFrame([], "user_id bigint, item_id bigint, pref bigint")
    assert R.cooccurrence(r).count() == 0
    assert R.scores(r).count() == 0
    assert R.scores(r, user_id=1).count() == 0
    assert R.top_scores(r, 3).count() == 0
    assert R.dense_scores(r, n_items=3).count() == 0


def test_empty_points(spark):
    p = spark.createDataFrame([], "x bigint, y bigint, w bigint")
    assert C.farthest_first(p, 5) == []
    res = C.lloyd(p, [(0, 0)], max_updates=3, stop=None)
    assert res.centroids == [] and res.updates == 1
    assert C.summary(p, [(0, 0)]).count() == 0


def test_empty_corpus(spark):
    lines = spark.createDataFrame([], "value string")
    assert T.top_words(T.word_count(T.tokenize(lines)), 15).count() == 0


def test_best_answer_tie(spark):
    p = spark.createDataFrame([(1, 1, None, 0, "A"), (2, 10, 1, 7, None), (2, 11, 1, 7, None)],
                              "posting_type int, id bigint, parent_id bigint, score bigint, tag string")
    assert rows(C.best_answer(p)) == [(1, 7, "A")]
