"""Table sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin an under-split source up to the session's parallelism.

    A parquet file with one large row group is read by a single task, which
    then does all the work before the first shuffle alone. When the scan has
    fewer partitions than ``min_partitions`` (default: the default
    parallelism) the rows are spread evenly. Only a local master does this,
    where the files are small: on a cluster the splits are the file layout's.
    Apply it after selecting the needed columns.
    """
    if not df.sparkSession.sparkContext.master.startswith("local["):
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def read_parquet(spark: SparkSession, path: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """Parquet scan of ``columns`` (all if empty), spread if under-split."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*columns)
    return spread(df)
