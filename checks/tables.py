"""Views of the test tables in the shapes the operators read. All rows, whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsloom.operators.sizing import MAX_BROADCAST_BYTES, broadcast_if_small
from newsloom.session import checkpoint


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a table as they land, in one file or in a folder of files. A stream takes no single
    file by its plain name; a pattern finds either."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def first_line(c):
    return F.substring_index(c, "\n", 1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, title, summary, source) of the documents; the summary is the whole text."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        first_line(F.col("text")).alias("title"),
        F.col("text").alias("summary"),
        F.col("lang").alias("language"),
        "source",
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with category by label and time by event; equal texts share a link."""
    docs = documents(spark, sf_dir)
    labels = broadcast_if_small(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic"))
    # Events are many and two numbers wide; those of documents are found first, so that no text moves to meet them.
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), "ts")
    events = checkpoint(events.join(docs.select("id"), "id", "left_semi"))
    events = broadcast_if_small(events, max_rows=MAX_BROADCAST_BYTES // 16)
    ts = F.col("ts").cast("timestamp")
    return (
        docs
        .join(labels, "id", "left")
        .join(events, "id", "left")
        .select(
            "id",
            "title",
            "summary",
            F.concat(F.lit("https://example.org/"), F.md5("summary")).alias("link"),
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("published"),
            F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("category"),
            "language",
            "source",
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("crawled_time"),
        )
    )


def queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, query): the benchmark passages."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages with the vector of the same number."""
    near = vectors(spark, sf_dir).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return queries(spark, sf_dir).join(near, "query_id")


def filtered_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector queries, each for the source of the document of the same number."""
    source = documents(spark, sf_dir).select(F.col("id").alias("query_id"), F.upper("source").alias("filter_source"))
    return vector_queries(spark, sf_dir).join(source, "query_id")


def recrawl(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(existing, incoming) for a merge. Existing are the documents, some lacking a title or
    language, short ones without link. Incoming are the labelled documents crawled again, with
    changes by label, and then all pages."""
    labels = broadcast_if_small(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic"))
    base = articles(spark, sf_dir).withColumn(
        "link", F.when(F.length("summary") < 400, "").otherwise(F.col("link"))
    )
    existing = base.select(
        "id",
        F.when(F.col("language") == "de", "").otherwise(F.col("title")).alias("title"),
        "summary",
        "link",
        "published",
        F.coalesce("category", F.lit("")).alias("category"),
        F.when(F.col("language") == "es", " ").otherwise(F.col("language")).alias("language"),
        "source",
        "crawled_time",
        F.col("id").alias("seq"),
    )
    later = F.date_format(
        F.col("crawled_time").cast("timestamp") + F.expr("interval 1 day"), "yyyy-MM-dd'T'HH:mm:ss"
    )
    again = base.join(labels, "id").select(
        F.lit(None).cast("long").alias("id"),
        F.when(F.col("toxic") == 1, "").otherwise(F.col("title")).alias("title"),
        F.when(F.col("quality") == 1, F.concat_ws(" ", "summary", "summary")).otherwise(F.col("summary")).alias("summary"),
        "link",
        "published",
        "category",
        "language",
        "source",
        F.when(F.col("toxic") == 1, "").when(F.col("quality") == 1, later).otherwise("unknown").alias("crawled_time"),
        F.col("id").alias("seq"),
    )
    pages = table(spark, sf_dir, "pages").select(
        F.lit(None).cast("long").alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("summary"),
        F.regexp_replace("url", "[?#].*$", "").alias("link"),
        F.lit("").alias("published"),
        F.lit("page").alias("category"),
        F.regexp_extract("html", 'lang="([^"]*)"', 1).alias("language"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("source"),
        F.lit("2024-02-01T00:00:00").alias("crawled_time"),
        (F.lit(1 << 40) + F.col("page_id")).alias("seq"),
    )
    return existing, again.unionByName(pages)


def feed_items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(items, feeds): every page in the feed of its host, then again in that of its language.
    A host feed may give 3 items, a language feed 20."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_replace("url", "[?#].*$", "").alias("link"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("summary"),
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.regexp_extract("url", "^https?://[^/]+/([a-z]+)/", 1).alias("lang"),
    )
    host = F.concat(F.lit("https://"), F.col("host"), F.lit("/rss"))
    lang = F.concat(F.lit("https://world.example/"), F.col("lang"))
    both = pages.withColumn(
        "place",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), host.alias("feed")),
                F.struct(F.lit(1).alias("kind"), lang.alias("feed")),
            )
        ),
    ).select("page_id", "link", "title", "summary", "place.kind", "place.feed")
    feeds = both.groupBy("kind", "feed").agg(F.min("page_id").alias("_first"))
    feeds = feeds.select(
        (F.col("kind") * F.lit(1 << 40) + F.col("_first")).alias("feed_seq"),
        "feed",
        F.when(F.col("kind") == 0, 3).otherwise(20).alias("quota"),
    )
    items = both.join(feeds.select("feed", "feed_seq"), "feed").select(
        "feed_seq", F.col("page_id").alias("entry_seq"), "title", "link", "summary", F.lit("").alias("published")
    )
    return items, feeds
