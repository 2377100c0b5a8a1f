"""Small helpers that the operators of this package share: columns, stored tables, sizes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from newsloom.operators.ranking import dense_positions
from newsloom.session import shared_dir

#: A side of a join up to this many rows and bytes is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 32 << 20

#: Texts are handed to Python tasks in batches of at most this many rows.
ROWS_PER_BATCH = 1000


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, also where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that df doesn't have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet into the shared folder and read again. Cuts the lineage so that a
    lost executor costs no recomputation."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """docs with a whole number as column key that tells documents apart, in the order of their ids.

    Where every row has an id of its own, that is the key. Otherwise keys are numbered by id, null ids
    first, then by the text's digest: each row without an id is a document, and so are the texts of an
    id that has several; rows with one id and one text share a key. Null texts count as empty.
    """
    number = column(id_col).cast("long")
    if docs.groupBy(number.alias("id")).count().filter("count > 1 or id is null").isEmpty():
        return docs.withColumn(key, number)
    row, known, own, digest = (free_name(docs, f"{key}_{name}") for name in ("row", "known", "own", "digest"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows").withColumns(
        {
            known: F.coalesce(number, F.lit(0)),
            own: F.when(number.isNull(), F.col(row)).otherwise(-1),
            digest: F.sha2(F.coalesce(column(text_col), F.lit("")).cast("binary"), 256),
        }
    )
    order = [F.col(own) < 0, F.col(known), F.col(digest), F.col(own)]
    numbers = dense_positions(rows.select(known, digest, own).distinct(), order, key)
    return rows.join(numbers, [known, digest, own]).select(*[column(c) for c in docs.columns], key)


def small(df: DataFrame, width: Column | int = 8) -> bool:
    """Whether df was counted to be within the bounds for a broadcast. width: bytes of a row."""
    width = F.lit(width) if isinstance(width, int) else width
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def hinted(df: DataFrame, width: Column | int = 8) -> DataFrame:
    """df with a broadcast hint if its counted size allows it, else as it is: Spark then shuffles
    the join and splits skewed partitions."""
    return F.broadcast(df) if small(df, width) else df


def partitions(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions for so many rows, at least what the session asks for."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each))
