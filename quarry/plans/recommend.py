"""End-to-end recommendation job and the named recommender queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import fixtures as fx
from quarry.operators import recommend as R
from quarry.session import scratch_path
from quarry.sources.records import read_ratings
from quarry.sources.text import write_lines


def recommend_job(ratings: DataFrame, user_id: int | None = None, n: int | None = None,
                  exclude_seen: bool = False, dedupe: str = "sum", shaped: bool = True,
                  order_col: str | Sequence[str] | None = None, zero_fill: bool = False) -> DataFrame:
    """Ratings → ranked items ``(user_id, item_id, score, rank)``.

    With ``user_id`` only that user is ranked; ``shaped=True`` then uses the
    one-user form that never builds the co-occurrence matrix. ``n`` keeps the
    top n per user; ``exclude_seen`` drops items the user already rated;
    ``dedupe="last"`` needs the ``order_col`` that says which rating is last;
    ``zero_fill`` ranks the whole catalogue, 0 where nothing co-occurs.
    """
    r = R.dedupe_ratings(ratings, dedupe, order_col)
    if user_id is None and n is not None and not zero_fill:
        return R.top_scores(r, n, exclude_seen=exclude_seen)
    if user_id is None:
        return R.rank(R.scores(r, zero_fill=zero_fill), n=n, seen=r if exclude_seen else None)
    if shaped:
        s = R.scores(r, user_id=user_id, zero_fill=zero_fill)
    else:  # the product keeps all raters in C, but only this user's ratings on its other side
        s = R.scores(R.for_user(r, user_id), raters=r, zero_fill=zero_fill)
    seen = R.for_user(r, user_id) if exclude_seen else None
    return R.rank_one(s, n=n, seen=seen)


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dedupe_ratings(fx.raw_ratings(spark, sf_dir), "sum")


def ratings_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ratings written as 'user<TAB>item,pref,extra' lines and parsed back."""
    path = scratch_path(spark, "ratings")
    raw = fx.raw_ratings(spark, sf_dir)
    write_lines(raw.select(F.concat(F.col("user_id").cast("string"), F.lit("\t"), F.col("item_id").cast("string"),
                                    F.lit(","), F.col("pref").cast("string"), F.lit(",extra")).alias("value")), path)
    return read_ratings(spark, path, pref_type="bigint")


def ratings_parsed_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ratings with quarter prefs, written as text lines with a header and parsed back as doubles."""
    path = scratch_path(spark, "ratings")
    raw = fx.raw_ratings(spark, sf_dir)
    header = "user,item,pref"
    lines = raw.select(F.concat_ws(",", "user_id", "item_id", (F.col("pref") / 4).cast("string")).alias("value"))
    write_lines(lines.union(spark.range(1).select(F.lit(header))), path)
    return read_ratings(spark, path, header=header)


def ratings_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per user and item: that of the last line item (order key, line number, part key, then pref)."""
    return R.dedupe_ratings(fx.ordered_ratings(spark, sf_dir), "last", order_col=fx.RATING_ORDER)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dedupe_ratings(fx.wide_ratings(spark, sf_dir), "sum")


def cooccurrence_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-occurrence over every part key, summed up per item (the cells themselves are in `cooccurrence`)."""
    c = R.cooccurrence(_wide(spark, sf_dir))
    return c.groupBy("item1").agg(F.count("*").alias("cells"), F.sum("n").alias("n"), F.sum(F.col("item2") * F.col("n")).alias("check_sum"))


def scores_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all users over every part key, with zero and negative prefs, summed up per user."""
    s = R.scores(_wide(spark, sf_dir))
    return s.groupBy("user_id").agg(F.count("*").alias("items"), F.sum("score").alias("score"), F.sum(F.col("score") * F.col("item_id")).alias("check_sum"),
                                    F.min("score").alias("lowest"))


def scores_zero_filled_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all users over every part key, the whole catalogue for each of them, summed up per user."""
    s = R.scores(_wide(spark, sf_dir), zero_fill=True)
    return s.groupBy("user_id").agg(F.count("*").alias("items"), F.sum((F.col("score") == 0).cast("bigint")).alias("zeros"),
                                    F.sum(F.col("score") * F.col("item_id")).alias("check_sum"))


def recommend_topn_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best of every part key for every user, with zero and negative prefs."""
    return R.top_scores(_wide(spark, sf_dir), 3)


def recommend_topn_unseen_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without the rated ones."""
    return R.top_scores(_wide(spark, sf_dir), 3, exclude_seen=True)


def ratings_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped(spark, sf_dir)


def user_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.user_vectors(_deduped(spark, sf_dir))


def cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cooccurrence(_deduped(spark, sf_dir))


def dense_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dense_scores(_deduped(spark, sf_dir), n_items=fx.N_ITEMS)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.scores(_deduped(spark, sf_dir))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.item_vectors(R.scores(_deduped(spark, sf_dir)))


def recommend_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_job(fx.raw_ratings(spark, sf_dir), user_id=fx.TARGET_USER)


def recommend_user_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_job(fx.raw_ratings(spark, sf_dir), user_id=fx.TARGET_USER, shaped=False)


def recommend_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_job(fx.raw_ratings(spark, sf_dir), user_id=fx.TARGET_USER, exclude_seen=True)


def recommend_topn_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_job(fx.raw_ratings(spark, sf_dir), n=3)


def recommend_topn_unseen_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_job(fx.raw_ratings(spark, sf_dir), n=3, exclude_seen=True)


QUERIES = {
    "ratings_parsed": ratings_parsed,
    "ratings_parsed_double": ratings_parsed_double,
    "ratings_last": ratings_last,
    "cooccurrence_wide": cooccurrence_wide,
    "scores_wide": scores_wide,
    "scores_zero_filled_wide": scores_zero_filled_wide,
    "recommend_topn_wide": recommend_topn_wide,
    "recommend_topn_unseen_wide": recommend_topn_unseen_wide,
    "ratings_deduped": ratings_deduped,
    "user_vectors": user_vectors,
    "cooccurrence": cooccurrence,
    "dense_scores": dense_scores,
    "scores": scores,
    "item_vectors": item_vectors,
    "recommend_user": recommend_user,
    "recommend_user_plain": recommend_user_plain,
    "recommend_unseen": recommend_unseen,
    "recommend_topn_all": recommend_topn_all,
    "recommend_topn_unseen_all": recommend_topn_unseen_all,
}

_RAW = """raw AS (SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey % 500 AS BIGINT) AS item_id,
  CAST(trunc(l_quantity) AS BIGINT) AS pref FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_R = "r AS (SELECT user_id, item_id, CAST(sum(pref) AS BIGINT) AS pref FROM raw GROUP BY user_id, item_id)"
_C = """c AS (SELECT a.item_id AS item1, b.item_id AS item2, CAST(count(*) AS BIGINT) AS n
  FROM r a JOIN r b ON a.user_id = b.user_id GROUP BY 1, 2)"""
_S = """s AS (SELECT c.item1 AS item_id, r.user_id, CAST(sum(c.n * r.pref) AS BIGINT) AS score
  FROM r JOIN c ON c.item2 = r.item_id GROUP BY 1, 2)"""
_W = "WITH " + ", ".join([_RAW, _R, _C, _S])


_WIDE = """raw AS (SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey AS BIGINT) AS item_id,
  CAST(CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN -trunc(l_quantity) ELSE trunc(l_quantity) END AS BIGINT) AS pref
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_WW = "WITH " + ", ".join([_WIDE, _R, _C, _S])


def _ranked(where: str = "", seen: bool = False, n: int | None = None, ctes: str = _W) -> str:
    anti = " AND NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = s.user_id AND r.item_id = s.item_id)" if seen else ""
    inner = (f"SELECT user_id, item_id, score, CAST(row_number() OVER (PARTITION BY user_id "
             f"ORDER BY score DESC, item_id ASC) AS BIGINT) AS rank FROM s WHERE TRUE {where}{anti}")
    if n is None:
        return f"{ctes} {inner}"
    return f"{ctes} SELECT * FROM ({inner}) t WHERE rank <= {n}"


SQL = {
    "ratings_parsed": f"WITH {_RAW} SELECT * FROM raw",
    "ratings_parsed_double": f"WITH {_RAW} SELECT user_id, item_id, CAST(pref AS DOUBLE) / 4 AS pref FROM raw",
    "ratings_last": """SELECT CAST(o_custkey AS BIGINT) AS user_id, CAST(l_partkey % 500 AS BIGINT) AS item_id,
        CAST(max(struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, p := trunc(l_quantity))).p AS BIGINT) AS pref
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "cooccurrence_wide": f"""WITH {_WIDE}, {_R}, {_C} SELECT item1, CAST(count(*) AS BIGINT) AS cells, CAST(sum(n) AS BIGINT) AS n,
        CAST(sum(item2 * n) AS BIGINT) AS check_sum FROM c GROUP BY 1""",
    "scores_wide": f"""{_WW} SELECT user_id, CAST(count(*) AS BIGINT) AS items, CAST(sum(score) AS BIGINT) AS score,
        CAST(sum(score * item_id) AS BIGINT) AS check_sum, min(score) AS lowest FROM s GROUP BY 1""",
    "scores_zero_filled_wide": f"""{_WW}, items AS (SELECT DISTINCT item_id FROM r), users AS (SELECT DISTINCT user_id FROM r)
        SELECT u.user_id, CAST(count(*) AS BIGINT) AS items, CAST(sum(CASE WHEN coalesce(s.score, 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zeros,
        CAST(sum(coalesce(s.score, 0) * i.item_id) AS BIGINT) AS check_sum
        FROM users u CROSS JOIN items i LEFT JOIN s ON s.user_id = u.user_id AND s.item_id = i.item_id GROUP BY 1""",
    "recommend_topn_wide": _ranked(n=3, ctes=_WW),
    "recommend_topn_unseen_wide": _ranked(seen=True, n=3, ctes=_WW),
    "ratings_deduped": f"WITH {_RAW}, {_R} SELECT * FROM r",
    "user_vectors": f"""WITH {_RAW}, {_R} SELECT user_id, CAST(floor(item_id / 1000) AS BIGINT) AS block,
        CAST(count(*) AS BIGINT) AS n_items,
        string_agg(CAST(item_id AS VARCHAR) || ':' || CAST(pref AS VARCHAR), ',' ORDER BY item_id) AS vec
        FROM r GROUP BY 1, 2""",
    "cooccurrence": f"WITH {_RAW}, {_R}, {_C} SELECT * FROM c",
    "dense_scores": f"""WITH {_RAW}, {_R}, users AS (SELECT DISTINCT user_id FROM r),
        grid AS (SELECT user_id, CAST(i AS BIGINT) AS item_id FROM users, range(0, 500) t(i))
        SELECT g.user_id, g.item_id, CAST(coalesce(r.pref, 0) AS BIGINT) AS score
        FROM grid g LEFT JOIN r ON g.user_id = r.user_id AND g.item_id = r.item_id""",
    "scores": f"{_W} SELECT * FROM s",
    "item_vectors": f"""{_W} SELECT item_id, CAST(floor(user_id / 1000) AS BIGINT) AS block,
        CAST(count(*) AS BIGINT) AS n_users,
        string_agg(CAST(user_id AS VARCHAR) || ':' || CAST(score AS VARCHAR), ',' ORDER BY user_id) AS vec
        FROM s GROUP BY 1, 2""",
    "recommend_user": _ranked(f"AND user_id = {fx.TARGET_USER}"),
    "recommend_user_plain": _ranked(f"AND user_id = {fx.TARGET_USER}"),
    "recommend_unseen": _ranked(f"AND user_id = {fx.TARGET_USER}", seen=True),
    "recommend_topn_all": _ranked(n=3),
    "recommend_topn_unseen_all": _ranked(seen=True, n=3),
}
