"""Delimited record readers for ratings and postings (text source, split by hand).

The CSV reader is not used: ratings accept tab *or* comma as separator (no
regex separator in the CSV reader), and posting rows are ragged (4, 5 or more
fields, trailing empty fields dropped) which CSV ``FAILFAST`` rejects and CSV
``PERMISSIVE`` silently nulls together with bad integers.

``on_error="fail"`` (default) fails the job on a bad number or a missing field,
whatever the session's ANSI setting; ``on_error="null"`` turns them into nulls.
``header`` is the text of a header line; lines equal to it are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the rating separator class (tab or comma).
RATING_SEPARATOR = r"[\t,]"


def _cast(arr: Column, i: int, to: str, on_error: str) -> Column:
    """The 1-based field as a number; with ``fail``, a missing or a bad one is an error."""
    text = F.try_element_at(arr, F.lit(i))
    value = text.try_cast(to)
    if on_error != "fail":
        return value
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit(f"field {i} is no {to}: "), F.coalesce(text, F.lit("missing"))))).otherwise(value)


def _body(lines: DataFrame, header: str | None) -> DataFrame:
    return lines if header is None else lines.where(F.col("value") != F.lit(header))


def parse_ratings(lines: DataFrame, pref_type: str = "double", on_error: str = "fail",
                  header: str | None = None) -> DataFrame:
    """``user_id bigint, item_id bigint, pref <pref_type>`` from ``value`` lines.

    Fields 1-3 are used, further fields are ignored.
    """
    f = F.split(F.col("value"), RATING_SEPARATOR)
    return _body(lines, header).select(
        _cast(f, 1, "bigint", on_error).alias("user_id"),
        _cast(f, 2, "bigint", on_error).alias("item_id"),
        _cast(f, 3, pref_type, on_error).alias("pref"),
    )


def read_ratings(spark: SparkSession, *paths: str, pref_type: str = "double",
                 on_error: str = "fail", header: str | None = None) -> DataFrame:
    return parse_ratings(spark.read.text(list(paths)), pref_type, on_error, header)


def parse_postings(lines: DataFrame, on_error: str = "fail", header: str | None = None) -> DataFrame:
    """``posting_type int, id bigint, parent_id bigint, score bigint, tag string``.

    Split on commas (no quoting); trailing empty fields are dropped first, so
    ``…,3,`` has no tag. An empty parent is null; a missing 5th field is null.
    """
    body = F.regexp_replace(F.col("value"), ",+$", "")
    f = F.split(body, ",")
    no_parent = F.coalesce(F.try_element_at(f, F.lit(3)), F.lit("")) == ""
    return _body(lines, header).select(
        _cast(f, 1, "int", on_error).alias("posting_type"),
        _cast(f, 2, "bigint", on_error).alias("id"),
        F.when(~no_parent, _cast(f, 3, "bigint", on_error)).alias("parent_id"),
        _cast(f, 4, "bigint", on_error).alias("score"),
        F.try_element_at(f, F.lit(5)).alias("tag"),
    )


def read_postings(spark: SparkSession, *paths: str, on_error: str = "fail", header: str | None = None) -> DataFrame:
    return parse_postings(spark.read.text(list(paths)), on_error, header)


def format_postings(postings: DataFrame) -> DataFrame:
    """Inverse of :func:`parse_postings`: one ``value`` line per posting."""
    return postings.select(F.concat_ws(
        ",", F.col("posting_type").cast("string"), F.col("id").cast("string"),
        F.coalesce(F.col("parent_id").cast("string"), F.lit("")), F.col("score").cast("string"),
        F.coalesce(F.col("tag"), F.lit(""))).alias("value"))
