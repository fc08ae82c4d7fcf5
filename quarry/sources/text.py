"""Line-oriented text sources and sinks.

Text is read and written with Spark's text data source, never the CSV one:
words may hold quotes, backslashes or a leading ``#`` and must round-trip byte
for byte; the CSV writer would quote, escape or mangle them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.tokenize import text_lines


def read_lines(spark: SparkSession, *paths: str, tag: str | None = None) -> DataFrame:
    """One row per line: ``value string``.

    ``tag="dir"`` adds ``tag``, the name of the folder that holds each file
    (the origin marker used when two inputs share one job).
    """
    df = spark.read.text(list(paths))
    if tag is None:
        return df
    if tag != "dir":
        raise ValueError(f"unknown tag mode {tag!r}")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return df.select("value", F.element_at(parts, -2).alias("tag"))


def lines_of(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows holding whole texts → one row per line (``value``), like a line reader."""
    return df.select(*keep, F.explode(text_lines(F.col(text_col))).alias("value"))


def read_kv(spark: SparkSession, *paths: str) -> DataFrame:
    """Key/value text records: ``key`` before the first tab, ``value`` after it.

    A line without a tab is all key and an empty value.
    """
    v = F.col("value")
    pos = F.instr(v, "\t")
    return spark.read.text(list(paths)).select(
        F.substring_index(v, "\t", 1).alias("key"),
        F.when(pos > 0, v.substr(pos + 1, F.length(v))).otherwise(F.lit("")).alias("value"),
    )


def tagged_union(a: DataFrame, b: DataFrame, tags: tuple = (1, 2), col: str = "src") -> DataFrame:
    """Union of two inputs with the same columns, each row marked with its origin."""
    return a.withColumn(col, F.lit(tags[0])).unionByName(b.withColumn(col, F.lit(tags[1])))


def _save_mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def write_kv(df: DataFrame, path: str, key: str, value: str, overwrite: bool = True) -> None:
    """Write ``key \\t value`` lines, a null as an empty string; overwrite the folder or fail if it exists."""
    empty = F.lit("")
    df.select(F.concat_ws("\t", F.coalesce(F.col(key).cast("string"), empty),
                          F.coalesce(F.col(value).cast("string"), empty)).alias("value")) \
        .write.mode(_save_mode(overwrite)).text(path)


def write_tuples(df: DataFrame, path: str, first: str, second: str, overwrite: bool = False) -> None:
    """Write ``(first,second)`` lines, the text form of a pair."""
    df.select(F.format_string("(%s,%s)", F.col(first).cast("string"), F.col(second).cast("string")).alias("value")) \
        .write.mode(_save_mode(overwrite)).text(path)


def write_lines(df: DataFrame, path: str, col: str = "value", overwrite: bool = True) -> None:
    """Write one string column as text lines."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(_save_mode(overwrite)).text(path)
