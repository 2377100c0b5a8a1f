"""Run queries next to their SQL: python -m checks.run [--sf DIR] [name ...]."""

from __future__ import annotations

import argparse
import math
import time
from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def connect(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value):
    """Values as they are, but for the signs of zero and the several forms of no number. Types
    count: a decimal is no double and a flag no integer."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return ("float", value + 0.0)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    return str(value) if isinstance(value, str) else (type(value).__name__, str(value))


def rows(names, tuples) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in tuples)


def compare(df, sql: str, db) -> str | None:
    """None if equal, else what differs."""
    want = db.sql(sql)
    if sorted(df.columns) != sorted(want.columns):
        return f"columns {sorted(df.columns)} != {sorted(want.columns)}"
    got, wanted = rows(df.columns, df.collect()), rows(want.columns, want.fetchall())
    if got == wanted:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows, want {sum(wanted.values())}; {sum(extra.values())} extra such as "
        f"{str(list(extra)[:2])[:600]}; {sum(missing.values())} missing such as {str(list(missing)[:2])[:600]}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    from checks.queries import QUERIES, SQL

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(args.sf)
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            if name in SQL:
                problem = compare(df, SQL[name], db)
            else:
                n = len(df.collect())
                problem = None if n else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        bad += problem is not None
        kind = "sql" if name in SQL else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {time.time() - start:6.2f}s {kind:4} {name} {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
