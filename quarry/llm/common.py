"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir

# ASCII white space of the word rule, and the rule itself as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan of one table, only the named columns (all if none)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder: cuts lineage, survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files that checkpoints have made needless: its cleaner follows the driver's garbage collection."""
    spark.sparkContext._jvm.System.gc()


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` whose ``column`` texts hold about ``limit`` bytes; a longer text stands alone.

    Every row is in exactly one slice; this bounds the memory of a numpy kernel, not its input.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def broadcast_if_small(df: DataFrame, strings: tuple[str, ...] = (), limit: int = 16 << 20) -> DataFrame:
    """A broadcast hint on ``df`` (cheap to scan: saved or tiny) if its rows are known to take at most ``limit`` bytes.

    Beyond that ``df`` is returned as it is and joined by a shuffle.
    """
    width = F.lit(32 * len(df.columns))
    for c in strings:
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= limit else df
