"""Passing over blocks of documents loses none of the best, and scores few."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import keyword


@pytest.fixture(scope="module")
def indexed(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([0, 3, 12, 40, 150])))) for i in range(4000)]
    rows += [(5000 + i, "w0 w1 w2999") for i in range(5)]  # equal documents
    texts = spark.createDataFrame(rows, "id long, body string").repartition(4)
    built = keyword.build(texts, F.col("body"))
    index = keyword.KeywordIndex(*[t.cache() for t in (built.postings, built.doc_stats, built.term_stats)])
    index.blocks = keyword.blocks(index.postings, F.lit(keyword.block_parts(4005))).cache()
    queries = [(1, "w0 w1 w2 w2990"), (2, "w2999 w2998 w5"), (3, "w0"), (4, "w0 w0 w0 w700 w1"), (5, "nothing"), (6, ""), (7, None)]
    return index, spark.createDataFrame(queries, "query_id long, query string")


def rows(df):
    return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 10, 300])
def test_the_best_are_the_same(indexed, k):
    index, queries = indexed
    want = rows(keyword.candidates(keyword.scores(index, queries), k))
    assert len(want) >= k and rows(keyword.best(index, queries, k, prune=True)) == want


def test_few_documents_are_scored(indexed):
    index, queries = indexed
    asked = queries.where("query_id in (1, 2, 4)")
    all_pairs, scored = keyword.scores(index, asked).count(), keyword.pruned_scores(index, asked, 5).count()
    assert scored * 5 < all_pairs


def test_bounds_hold_after_documents_came_and_went(spark, indexed):
    """Blocks of an update are rows beside the old ones; those of documents that are gone stay."""
    index, queries = indexed
    new = keyword.build(spark.createDataFrame([(9000 + i, "w2990 " * (i + 1)) for i in range(20)], "id long, body string"), F.col("body"))
    gone = index.postings.where("doc_id % 3 = 0").select("doc_id").distinct()
    postings = index.postings.join(gone, "doc_id", "left_anti").select(*index.postings.columns).unionByName(new.postings)
    lengths = index.doc_stats.join(gone, "doc_id", "left_anti").unionByName(new.doc_stats)
    parts = index.blocks.select("parts").limit(1).scalar()
    blocks = index.blocks.unionByName(keyword.blocks(new.postings, parts))
    later = keyword.KeywordIndex(postings, lengths, keyword.term_stats(postings), None, blocks)
    want = rows(keyword.candidates(keyword.scores(later, queries), 10))
    assert rows(keyword.best(later, queries, 10, prune=True)) == want


def test_no_documents(spark, indexed):
    empty = keyword.build(spark.createDataFrame([], "id long, body string"), F.col("body"))
    empty.blocks = keyword.blocks(empty.postings, F.lit(1))
    assert keyword.best(empty, indexed[1], 10, prune=True).collect() == []
