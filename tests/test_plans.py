"""The physical plans the operators rely on at scale."""

import re

from pyspark.sql import functions as F

from checks import tables as t
from newsloom.operators import dedup, keyword, ranking, stats
from tests.conftest import SMALL


def plan(df) -> str:
    """The plan before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_and_scores_move_once(spark):
    """One shuffle of texts by document; counting and scoring add none to it."""
    docs = t.documents(spark, SMALL)
    index = keyword.build(docs)
    text = plan(index.postings)
    assert re.findall(r"Exchange (\w+)\(", text) == ["hashpartitioning"] and "REPARTITION_BY_COL" in text
    scored = keyword.scores(index, t.queries(spark, SMALL))
    main = plan(scored).split("BroadcastExchange")[0]
    assert main.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in main


def test_tokens_are_not_extracted_below_the_shuffle(spark):
    below = plan(keyword.build(t.documents(spark, SMALL)).postings).split("REPARTITION_BY_COL")[1]
    assert "regexp_extract_all" not in below


def test_top_k_is_limited_before_its_shuffle(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SALTS", 2)
    df = spark.range(100_000).selectExpr("id", "id % 3 as g", "rand(1) as v").repartition(4)
    for two_rounds in (False, True):
        text = plan(ranking.top_k(df, ["g"], [F.col("v").desc()], 2000, two_rounds=two_rounds))
        assert text.count("WindowGroupLimit") == (4 if two_rounds else 2)


def test_keep_first_is_limited_before_its_shuffle(spark):
    assert plan(dedup.first_by_link(t.articles(spark, SMALL))).count("WindowGroupLimit") == 2


def test_statistics_scan_once(spark):
    docs = t.documents(spark, SMALL).withColumn("category", F.lit("c"))
    text = plan(stats.grouped(docs))
    assert text.count("FileScan") == 1 and "Expand" in text
    # Shares and ranks come from the kept counts, without gathering a dimension in one task.
    for df in (stats.counts(docs), stats.ranked(stats.counts(docs))):
        assert "FileScan" not in plan(df) and "windowspecdefinition(dimension" not in plan(df)


def test_sizes_are_counted_map_side(spark):
    """A size check sends one row per task, whatever it counts."""
    from newsloom.operators import sizing

    seen = []
    df = spark.range(100_000).repartition(6)
    original = type(df).first
    try:
        type(df).first = lambda self: (seen.append(plan(self)), original(self))[1]
        assert sizing.fits(df, 100_000, 1 << 30)
    finally:
        type(df).first = original
    above, _, below = seen[0].partition("Exchange SinglePartition")
    assert "partial_count" in below.split("Exchange")[0] and "Limit" not in seen[0].split("CollectLimit")[-1].split("\n", 1)[-1]


def test_only_needed_columns_are_read(spark):
    text = plan(stats.sources(t.documents(spark, SMALL)))
    assert "ReadSchema: struct<source:string>" in text


def test_no_cross_joins(spark):
    from checks.queries import QUERIES

    for name in ("hybrid_search", "merge_upsert", "classify_urls", "route_queries", "source_listing", "ingest_quota"):
        text = plan(QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_words_of_a_short_batch_reach_the_stored_postings(spark, tmp_path):
    index = keyword.build(t.documents(spark, SMALL))
    path = str(tmp_path / "postings")
    index.postings.sortWithinPartitions("token").write.parquet(path)
    stored = spark.read.parquet(path)
    index = keyword.KeywordIndex(stored, index.doc_stats, keyword.term_stats(stored))
    queries = spark.createDataFrame([(1, "the and")], "query_id long, query string")
    text = plan(keyword.scores(index, queries))
    assert "In(token, [and,the])" in text


def test_untouched_articles_are_passed_through(spark):
    """Existing rows without an incoming row are in a branch of scans and broadcast joins."""
    from newsloom.operators import merge

    existing, incoming = t.recrawl(spark, SMALL)
    old = existing.select("id", "title", "summary", "link", "published", "category", "language", "source", "crawled_time", "seq")
    old = spark.createDataFrame(old.toArrow(), old.schema)
    merged = merge.upsert(old, incoming, F.lit("2024-01-01").cast("timestamp")).articles
    rest = plan(merged).rsplit("LeftAnti", 1)
    assert len(rest) == 2 and "Exchange hashpartitioning" not in rest[1].split("BroadcastExchange")[0]
