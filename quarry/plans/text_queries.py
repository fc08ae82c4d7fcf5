"""Named text queries over the test tables (Spark side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import fixtures as fx
from quarry.operators import text as T
from quarry.plans.common_words import common_words_job, corpus_counts
from quarry.session import scratch_path
from quarry.sources import text as io


def tokens_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents", "doc_id", "text")
    return T.word_count_by_text(docs, "doc_id", "whitespace")


def tokens_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.table(spark, sf_dir, "documents", "doc_id", "text")
    return T.word_count_by_text(docs, "doc_id", "space", lower=True)


def _stop_file(spark: SparkSession, fold: bool) -> DataFrame:
    """The stop-word list written as a one-word-per-line file and loaded back
    as a side dictionary (folded to lower case when ``fold``)."""
    path = scratch_path(spark, "stopwords")
    io.write_lines(T.stopword_table(spark, fx.STOPWORDS, fold=False).withColumnRenamed("word", "value"), path)
    return T.stopword_table(spark, io.read_lines(spark, path), fold=fold)


def stopwords_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_counts(fx.corpus_b(spark, sf_dir), _stop_file(spark, fold=True), "cased")


def stopwords_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_counts(fx.corpus_b(spark, sf_dir), _stop_file(spark, fold=False), "lower")


def word_count_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.word_count(T.tokenize(fx.corpus_a(spark, sf_dir), "whitespace"))


def common_words_cased(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = common_words_job(fx.corpus_a(spark, sf_dir), fx.corpus_b(spark, sf_dir),
                          fx.STOPWORDS, variant="cased", n=15)
    return df.select("n", "word")


def common_words_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_words_job(fx.corpus_a(spark, sf_dir), fx.corpus_b(spark, sf_dir),
                            fx.STOPWORDS, variant="lower", n=15)


def common_words_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_words_job(fx.corpus_a(spark, sf_dir), fx.corpus_b(spark, sf_dir),
                            fx.STOPWORDS, variant="cased", n=None, strategy="union")


def kv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts of corpus A written as ``word \\t n`` lines and read back."""
    path = scratch_path(spark, "kv")
    io.write_kv(word_count_a(spark, sf_dir), path, "word", "n", overwrite=True)
    return io.read_kv(spark, path)


def tuple_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top words of the lower variant written as ``(word,n)`` lines and read back."""
    path = scratch_path(spark, "tuples")
    io.write_tuples(common_words_lower(spark, sf_dir), path, "word", "n")
    return spark.read.text(path)


def dir_tagged_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of both corpora written to two folders, read as one input tagged by folder."""
    base = scratch_path(spark, "tagged")
    io.write_lines(fx.corpus_a(spark, sf_dir), f"{base}/corpus_a")
    io.write_lines(fx.corpus_b(spark, sf_dir), f"{base}/corpus_b")
    lines = io.read_lines(spark, f"{base}/corpus_a", f"{base}/corpus_b", tag="dir")
    return lines.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "tokens_whitespace": tokens_whitespace,
    "tokens_space": tokens_space,
    "stopwords_fold": stopwords_fold,
    "stopwords_exact": stopwords_exact,
    "word_count_a": word_count_a,
    "common_words_cased": common_words_cased,
    "common_words_lower": common_words_lower,
    "common_words_union": common_words_union,
    "kv_roundtrip": kv_roundtrip,
    "tuple_roundtrip": tuple_roundtrip,
    "dir_tagged_input": dir_tagged_input,
}
