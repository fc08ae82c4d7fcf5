"""Word counting and common words of two corpora.

Input corpora are DataFrames of lines (``value string``). Every function is
lazy and returns a DataFrame; counts are ``bigint``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.tokenize import counted, space_tokens, text_lines, whitespace_tokens
from quarry.operators.common import broadcast_if_small
from quarry.sources.text import tagged_union


def tokenize(lines: DataFrame, mode: str = "whitespace", lower: bool = False,
             col: str = "value", keep: tuple[str, ...] = (), drop_empty: bool = False) -> DataFrame:
    """One row per token: ``word string`` (plus ``keep`` columns).

    ``mode="whitespace"`` splits on runs of space/tab/newline/CR/form feed and
    drops empties; ``mode="space"`` splits a line on single spaces with the
    empty-token rules of :func:`quarry.functions.tokenize.space_tokens`.
    ``drop_empty`` leaves the empty ones out. ``lower`` lower-cases the token itself.
    """
    if mode == "whitespace":
        df = lines.select(*keep, F.explode(whitespace_tokens(F.col(col))).alias("word"))
    elif mode == "space":
        df = lines.select(*keep, F.explode(space_tokens(F.col(col), drop_empty)).alias("word"))
    else:
        raise ValueError(f"unknown tokenizer mode {mode!r}")
    if lower:
        df = df.select(*keep, F.lower("word").alias("word"))
    return df


def stopword_table(spark: SparkSession, words: Iterable[str] | DataFrame, fold: bool) -> DataFrame:
    """Distinct stop words as ``word string``; ``fold`` lower-cases them first.

    ``words`` is a Python list or a DataFrame with one string column (e.g. the
    lines of a stop-word file).
    """
    if isinstance(words, DataFrame):
        df = words.select(F.col(words.columns[0]).alias("word"))
    else:
        df = spark.createDataFrame([(w,) for w in words], T.StructType([T.StructField("word", T.StringType())]))
    if fold:
        df = df.select(F.lower("word").alias("word"))
    return df.where(F.col("word").isNotNull()).distinct()


def remove_stopwords(tokens: DataFrame, stopwords: DataFrame | Sequence[str], match: str = "fold") -> DataFrame:
    """Drop tokens found in ``stopwords`` (the token keeps its case).

    ``match="fold"``: the lower-cased token is tested against the lower-cased
    list. ``match="exact"``: the token is tested verbatim against the list as
    given. A Python list becomes a set-membership predicate (no join); a
    DataFrame (e.g. a stop-word file) is anti-joined, broadcast only after its
    size is checked.
    """
    if match not in ("fold", "exact"):
        raise ValueError(f"unknown match mode {match!r}")
    if not isinstance(stopwords, DataFrame):
        if match == "fold":
            return tokens.where(~F.lower(F.col("word")).isin(*[F.lower(F.lit(w)) for w in stopwords]))
        return tokens.where(~F.col("word").isin(*[F.lit(w) for w in stopwords]))
    if match == "fold":
        stop = stopwords.select(F.lower("word").alias("_stop")).distinct()
        key = F.lower(F.col("word"))
    else:
        stop = stopwords.select(F.col("word").alias("_stop")).distinct()
        key = F.col("word")
    stop = broadcast_if_small(stop)
    return tokens.join(stop, key == F.col("_stop"), "left_anti")


def word_count(tokens: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(*by, word, n)``: occurrences per word (partial + final aggregate)."""
    return tokens.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))


def word_count_by_text(docs: DataFrame, key: str, mode: str = "whitespace", lower: bool = False,
                       col: str = "text") -> DataFrame:
    """``(key, word, n)``: :func:`word_count` of the tokens of all lines of the texts, by ``key``.

    Words are counted inside each text; only texts whose key stands at several rows are then added up by a
    shuffle, so that the words of all others are never held or moved. Keys may repeat or be null.
    """
    lines = text_lines(F.col(col))
    if mode == "whitespace":
        tokens = whitespace_tokens(F.col(col))  # line breaks are delimiters too
    elif mode == "space":
        tokens = F.flatten(F.transform(lines, lambda line: space_tokens(line)))
    else:
        raise ValueError(f"unknown tokenizer mode {mode!r}")
    if lower:
        tokens = F.transform(tokens, lambda x: F.lower(x))
    repeated = docs.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_key")
    repeated = broadcast_if_small(repeated)
    same = F.col(key).eqNullSafe(F.col("_key"))

    def counts(rows: DataFrame) -> DataFrame:
        return rows.select(key, F.inline(counted(tokens)))

    several = counts(docs.join(repeated, same, "left_semi")).groupBy(key, "word").agg(F.sum("n").alias("n"))
    return counts(docs.join(repeated, same, "left_anti")).unionByName(several)


def common_words(a: DataFrame, b: DataFrame, strategy: str = "join") -> DataFrame:
    """Words counted in both ``a`` and ``b`` with the smaller count: ``(word, n)``.

    ``strategy="join"``: inner equi-join on the word (both inputs are already
    hash-partitioned by word after their aggregates, so no extra exchange).
    ``strategy="union"``: tag the two inputs, union them, keep words seen in
    more than one input with their minimum count. Both give the same rows.
    """
    if strategy == "join":
        return a.alias("a").join(b.alias("b"), "word").select(
            "word", F.least(F.col("a.n"), F.col("b.n")).alias("n"))
    if strategy == "union":
        u = tagged_union(a.select("word", "n"), b.select("word", "n"))
        return (u.groupBy("word")
                .agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("_vals"))
                .where(F.col("_vals") > 1)
                .select("word", "n"))
    raise ValueError(f"unknown strategy {strategy!r}")


def top_words(counts: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` largest counts, ties broken by word ascending (a top-k, not a sort)."""
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(n)
