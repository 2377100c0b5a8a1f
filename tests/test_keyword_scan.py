"""Many queries are scored share by share: the same best, and few pairs are moved."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import keyword


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    weights = [1 / (i + 1) for i in range(500)]
    text = lambda n: " ".join(rng.choices(words, weights, k=n))
    rows = [(i, text(rng.choice([0, 3, 12, 40]))) for i in range(3000)]
    rows += [(5000 + i, "w0 w1 w499") for i in range(400)]  # equal documents
    rows += [(i, "w1 w1 w7 again") for i in (7, 7, 8, 9)] + [(None, "w0 w3"), (None, "w2 w3 w3"), (10_000, None)]
    asked = [(i, text(rng.choice([1, 2, 9]))) for i in range(60)]
    asked += [(100, "w0 w1 w499"), (101, "again"), (102, "nothing"), (103, ""), (104, None), (None, "w7 w8"), (0, "w3 w5")]
    frame = lambda rows, names: spark.createDataFrame(rows, names).repartition(4)
    return frame(rows, "id long, body string"), frame(asked, "query_id long, query string")


def rows(df):
    return sorted((str(r.query_id), r["rank"], str(r.doc_id), round(r.score, 9)) for r in df.collect())


@pytest.fixture
def always(monkeypatch):
    monkeypatch.setattr(keyword, "SCANNED_QUERIES", 1)
    monkeypatch.setattr(keyword, "SCANNED_PAIRS", 1)
    monkeypatch.setattr(keyword, "TEXT_PER_TASK", 8_000)


@pytest.mark.parametrize("k, block", [(1, 2_000_000), (40, 100), (300, 2_000_000), (5000, 2_000_000)])
def test_the_best_are_the_same(tables, always, monkeypatch, k, block):
    docs, asked = tables
    monkeypatch.setattr(keyword.keyword_scan, "BLOCK_TERMS", block)
    index = keyword.build(docs, F.col("body"))
    want = rows(keyword.candidates(keyword.scores(index, asked), k))
    assert len(want) > 50 and rows(keyword.best(index, asked, k)) == want


def test_a_bound_that_is_too_high_loses_nothing(tables, always, monkeypatch):
    docs, asked = tables
    monkeypatch.setattr(keyword.keyword_scan, "PLACES", (-30.0, -3.0))
    index = keyword.build(docs, F.col("body"))
    want = rows(keyword.candidates(keyword.scores(index, asked), 300))
    assert rows(keyword.best(index, asked, 300)) == want


def test_pairs_stay_where_they_are(tables, always):
    docs, asked = tables
    index = keyword.build(docs, F.col("body"))
    sent = keyword._scan(index, asked, 40).count()
    assert sent * 10 < keyword.scores(index, asked).count()
    assert sent < 2 * keyword.best(index, asked, 40).count()


def test_nothing_to_find(spark, tables, always):
    docs, asked = tables
    empty = spark.createDataFrame([], docs.schema)
    assert keyword.best(keyword.build(empty, F.col("body")), asked, 10).collect() == []
    assert keyword.best(keyword.build(docs, F.col("body")), asked.where("query_id = 102"), 10).collect() == []
