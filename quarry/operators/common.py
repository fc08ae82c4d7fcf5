"""Small shared helpers for plan shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side (bytes) that an operator broadcasts after measuring it. Above it
# the plain shuffle join is used and AQE decides at run time.
BROADCAST_MAX_BYTES = 16 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if its rows are measured to take at most ``max_bytes``.

    The measure is a real job over ``df`` (32 bytes a column, and the bytes of
    strings), so use this for sides that are cheap to compute.
    """
    width = F.lit(32 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string":
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= max_bytes else df
