"""Tables in folders of files, and steps whose size must not grow with a task's share."""

from pyspark.sql import functions as F

from checks import tables as t
from checks.queries import QUERIES


def _documents(spark, folder, n=40):
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("title "), (F.col("id") % 30).cast("string"), F.lit("\nsome words of row "), (F.col("id") % 30).cast("string")).alias("text"),
        F.lit("en").alias("lang"),
        F.lit("src1").alias("source"),
        F.lit(30).cast("long").alias("n_chars"),
    )
    rows.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_streams_read_a_table_in_a_folder(spark, tmp_path):
    d = _documents(spark, tmp_path)
    merged = QUERIES["stream_merge"](spark, d)
    assert sorted(r.id for r in merged.collect()) == list(range(30))
    assert QUERIES["stream_first_links"](spark, d).agg(F.sum("n")).first()[0] == 30
    assert t.stream(spark, d, "documents").schema == t.table(spark, d, "documents").schema


def test_a_task_keeps_its_share_as_tables_grow(spark):
    from newsloom.operators import keyword

    text = F.concat_ws(" ", F.lit("shared"), *[F.sha2(F.concat(F.col("id"), F.lit(f"/{i}")), 512) for i in range(8)])

    def parts(n):
        rows = spark.range(n, numPartitions=4).select("id", F.lit("title").alias("title"), text.alias("summary"))
        return keyword.build(rows).postings.rdd.getNumPartitions()

    # Twelve or more partitions of 8 MB, though spark.sql.shuffle.partitions is 8 here.
    assert parts(100_000) >= 12 > parts(1_000)


def test_a_merge_moves_texts_once(spark, monkeypatch):
    from newsloom.operators import merge

    names = "id long, title string, summary string, link string, published string, category string, language string, source string, crawled_time string, seq long"
    rows = [(i, f"t{i}", "words " * 50, f"http://x/{i}", "", "c", "en", "s", "2024-01-01", i) for i in range(20)]
    frame = lambda rows: spark.createDataFrame(rows, names).repartition(2)
    seen = []
    whole = merge.checkpoint
    monkeypatch.setattr(merge, "checkpoint", lambda df: (seen.append(df), whole(df))[1])
    done = merge.upsert(frame(rows[:15]), frame(rows[10:]), F.lit("2024-03-01").cast("timestamp"))
    assert done.counters.first().total == 20
    short = next(df for df in seen if "base_at" not in df.columns)
    assert "summary" not in short.columns and short.count() == 10
    plan = next(df for df in seen if "base_at" in df.columns)._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Sort " in line and "summary" in line]


def test_articles_meet_events_without_a_shuffle_of_texts(spark, tmp_path):
    d = _documents(spark, tmp_path)
    spark.range(0, 40, 2).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{d}/labels.parquet")
    events = spark.range(1000).select((F.col("id") + 10).alias("event_id"), F.timestamp_seconds(F.col("id")).alias("ts"))
    events.unionByName(events.where("event_id = 12")).write.parquet(f"{d}/events.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = t.articles(spark, d)
        assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        rows = got.select("id", "published", "category").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Every document, one of them twice for its two events; those without one too.
    assert len(rows) == 41 and sum(r.published is None for r in rows) == 10 and sum(r.category == "good" for r in rows) == 21


def test_a_scan_keeps_its_share_as_tables_grow(spark, tmp_path):
    """A task that scores stored postings holds the pairs of the documents it reads."""
    folder = str(tmp_path / "postings")
    spark.range(200_000, numPartitions=24).select(F.sha2(F.col("id").cast("string"), 512).alias("token")).write.parquet(folder)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")  # as if there were far more files than cores
    try:
        assert spark.read.parquet(folder).rdd.getNumPartitions() >= 6
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_lengths_of_documents_are_stored_without_moving_texts(spark):
    from newsloom.operators import keyword
    from newsloom.plans import build

    rows = [(1, "a title", "some words and words"), (2, None, None), (3, "", "<p>x</p>"), (3, "b", "y z")]
    docs = spark.createDataFrame(rows, "id long, title string, summary string")
    lengths = build.word_tables(docs)["doc_stats"]
    assert "Exchange" not in lengths._jdf.queryExecution().executedPlan().toString()
    assert sorted(lengths.collect()) == sorted(keyword.build(docs).doc_stats.collect())


def test_a_task_scores_so_many_pairs_at_any_number_of_queries(spark, monkeypatch):
    from newsloom.operators import keyword

    docs = spark.range(400).select("id", F.lit("a title").alias("title"), F.concat(F.lit("shared word"), F.col("id") % 7).alias("summary"))
    asked = spark.range(100).select(F.col("id").alias("query_id"), F.concat(F.lit("shared word"), F.col("id") % 9).alias("query"))
    index = keyword.build(docs)
    row = lambda r: (r.query_id, r.doc_id, round(r.score, 9))
    want = sorted(map(row, keyword.scores(index, asked).collect()))
    monkeypatch.setattr(keyword, "PAIRS_PER_TASK", 1000)
    found = keyword.scores(index, asked)
    assert found.rdd.getNumPartitions() >= 40 and len(want) == 40_000
    assert sorted(map(row, found.collect())) == want
    empty = keyword.build(docs.where("id < 0"))
    assert keyword.scores(empty, asked).collect() == [] == keyword.scores(index, asked.where("query_id < 0")).collect()


def test_an_update_does_not_sort_postings(spark):
    from newsloom.operators import keyword
    from newsloom.plans import build

    docs = spark.createDataFrame([(i, "t", f"shared word{i}") for i in range(30)] + [(None, "t", "word0")], "id long, title string, summary string")
    gone = docs.where("id % 3 = 0").select("id")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for c, value in zip(before, ("-1", "false")):
        spark.conf.set(c, value)
    try:
        for bound in (4, 1 << 20):
            after = build.update_keywords(keyword.build(docs), docs.where("id = 3"), gone.unionByName(gone), max_broadcast_rows=bound)
            for made in (after.postings, after.term_stats):
                plan = made._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" not in plan and ("ShuffledHashJoin" in plan) == (bound == 4)
            assert after.postings.count() == 2 * 21 + 1
            df = {r.token: r.df for r in after.term_stats.collect()}
            assert df == {"shared": 21, "word3": 1, "word0": 1, **{f"word{i}": 1 for i in range(30) if i % 3}}
            assert after.doc_stats.count() == 22
    finally:
        for c, value in before.items():
            spark.conf.set(c, value)
