"""Size checks. A side is broadcast, or handed to tasks, only after it was counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# What one executor can hold of a broadcast side without noticing.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def _width(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, T.ArrayType):
        return F.greatest(F.size(c), F.lit(0)) * 8 + 8
    return F.lit(8)


def fits(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether df stays within the bounds. Counted in one pass, each task sending one row."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")).first()
    return found.n <= max_rows and found.bytes <= max_bytes


def broadcast_if_small(df: DataFrame, **bounds) -> DataFrame:
    """df with a broadcast hint if it fits, else as it is: Spark then shuffles the join and
    adaptive execution splits skewed partitions."""
    return F.broadcast(df) if fits(df, **bounds) else df


MAX_LOCAL_ROWS = 10_000
MAX_LOCAL_BYTES = 4 << 20


def held(df: DataFrame) -> DataFrame:
    """A small batch as a table of the plan itself, so that its many uses do not compute it
    again; a larger one as it is."""
    if not fits(df, MAX_LOCAL_ROWS, MAX_LOCAL_BYTES):
        return df
    return df.sparkSession.createDataFrame(df.toArrow(), schema=df.schema)
