"""Mined hard negatives against all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import hard_negatives


def all_pairs(rows, is_anchor, positives=5, negatives=10):
    """Rows (id, label, vector) as mined() returns them."""
    held = {}
    for i, label, v in sorted((r for r in rows if fit(r)), key=lambda r: (r[0], r[1], [math.floor(256 * x) for x in r[2]])):
        held.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, q) in held.items():
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, other) for i, (other, v) in held.items() if i != a]
        for score, p, other in sorted(s for s in scored if s[2] == label)[:positives]:
            kept = sorted(s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score)
            out += [(a, p, rank, n, -score, -s) for rank, (s, n, _) in enumerate(kept[:negatives], 1)]
    return sorted(out)


def fit(row):
    return None not in row and all(x is not None and math.isfinite(x) for x in row[2])


def vectors(n, seed, dims=12):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = rng.randrange(4)
        v = [x / 3 + rng.gauss(0, 0.2) for x in centers[c]] if i % 9 else [0.25] * dims  # many equal vectors
        rows.append((i, c if rng.random() < 0.8 else rng.randrange(4), v))
    return rows


ODD = [
    (1000, None, [0.1] * 12), (1003, 1, None), (None, 1, [0.1] * 12), (1005, 1, [math.nan] * 12), (1006, 2, [math.inf, 0.0]),
    (1007, 2, [0.5, None, 0.5]), (1010, 2, [0.5, 0.5]), (1020, 3, []), (1030, 0, [0.9] * 12), (1030, 0, [0.9] * 12), (1030, 2, [0.1] * 12),
    (-10, 1, [0.3] * 12), (-20, 9, [0.3] * 12),
]


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    for name in ("id", "v", "anchor", "rank", "windows", "score"):
        df = df.withColumn(name, F.lit("mine"))
    return df


@pytest.fixture(scope="module")
def rows():
    return [(i, c, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, c, v in [*vectors(400, 1), *ODD]]


def test_mined(spark, rows):
    found = hard_negatives.mined(table(spark, rows), F.col("vec_id") % 10 == 0)
    want = all_pairs(rows, lambda i: i % 10 == 0)
    assert len(want) > 500 and sorted(map(tuple, found.collect())) == want


def test_small_blocks_and_batches(spark, rows, monkeypatch):
    for name, value in (("ANCHOR_ROWS", 4), ("BLOCK_ROWS", 50), ("FIRST_ROWS", 7), ("STEP", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    some = rows[:160]
    found = hard_negatives.mined(table(spark, some), F.col("vec_id") % 20 == 0, positives=3, negatives=4)
    assert sorted(map(tuple, found.collect())) == all_pairs(some, lambda i: i % 20 == 0, 3, 4)


def test_no_rows_and_no_anchors(spark, rows):
    assert hard_negatives.mined(table(spark, rows[:0]), F.col("vec_id") % 10 == 0).collect() == []
    assert hard_negatives.mined(table(spark, rows), F.col("vec_id") == -1).collect() == []


@pytest.mark.parametrize("kind", [np.float64, np.int64])
def test_scan_keeps_all_and_looks_at_few(kind):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(3000, 64)) * np.linspace(3, 0.1, 64) * 100).astype(np.int64)
    block = hard_negatives.Block(np.arange(3000), pa.array(["a"] * 3000), x.astype(kind))
    q = x[17]
    want = x @ q
    least = np.sort(want)[-10]
    rows, scores = block.scan(q.astype(kind), np.arange(3000), least, math.inf)
    assert sorted(rows) == list(np.flatnonzero(want >= least)) and (scores == want[rows]).all()
    low, high = np.quantile(want, [0.4, 0.6])
    rows, _ = block.scan(q.astype(kind), np.arange(3000), low, high)
    assert sorted(rows) == list(np.flatnonzero((want >= low) & (want <= high)))


def test_whole_numbers_too_large():
    big = np.full((2, 4), 1 << 31, np.int64)
    with pytest.raises(OverflowError):
        hard_negatives._exact(big, big)
    assert hard_negatives._exact(big, np.ones((2, 4), np.int64)) is np.float64
    assert hard_negatives._exact(big, np.full((2, 4), 1 << 24, np.int64)) is np.int64
