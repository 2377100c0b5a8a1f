"""Top-k per group, keep-first, and dense positions, none of which gathers a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsloom.session import checkpoint

SALTS = 64


def top_k(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    k: int,
    rank: str = "rank",
    two_rounds: bool = False,
) -> DataFrame:
    """The first k rows of each group, ranked 1..k.

    Spark limits a ranked window before its shuffle, so a hot group sends at most k rows per
    map task. For a large k that is still much for one task at the end: with two_rounds, where
    there are more than SALTS map tasks, these are first merged in SALTS parts, and the last
    round sees at most k * SALTS rows of a group. Which part a row falls into does not change
    the result.
    """
    if two_rounds and int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) > SALTS:
        window = W.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", F.spark_partition_id() % SALTS)
            .withColumn("_part_rank", F.row_number().over(window))
            .where(F.col("_part_rank") <= k)
            .drop("_part_rank", "_salt")
        )
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def keep_first(df: DataFrame, key: list[Column], order: list[Column]) -> DataFrame:
    """One row per key, the first in order. A hot key is cut to one row per map task."""
    names = [f"_key{i}" for i in range(len(key))]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(key, names)])
    return top_k(keyed, names, order, 1, rank="_rank").drop("_rank", *names)


def dense_positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in an order that tells rows apart.

    Rows are dealt out by ranges of the order, numbered inside their range and shifted by the
    sizes of the ranges before it, so only one row per range is ever in one place. The dealt
    rows are kept, so that numbering and counting see the same ranges.
    """
    ranged = checkpoint(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_range").orderBy(*order)
    return (
        ranged.withColumn("_inside", F.row_number().over(inside) - 1)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_range", "_offset", "_inside")
    )
