"""Updates move ids and flags to the texts, not texts to them; texts to embed are cleaned once and not to their end."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions import text as tx
from newsloom.operators import embed, merge
from newsloom.plans import build
from newsloom.schemas import ARTICLE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 7, 40])
def test_a_beginning_is_that_of_the_whole_text(spark, n):
    rng = random.Random(n)
    pieces = ["<", ">", "<>", "<b>", "< a\n", "http", "ht", "tp://x.y", "http:// ", " ", "  ", "\n", " ", "word", "ab", "é", "李", "😀", ".", ",", "!", "#", "&", "-"]
    text = lambda: "".join(rng.choices(pieces, k=rng.choice([0, 1, 5, 30, 120])))
    rows = [(i, text(), text()) for i in range(1500)] + [(2000, None, text()), (2001, text(), None), (2002, None, None)]
    df = spark.createDataFrame(rows, "id long, title string, summary string")
    head, body = tx.embedding_cleanup(F.col("title")), tx.embedding_cleanup(F.col("summary"))
    want = F.substring(F.concat_ws(". ", F.nullif(head, F.lit("")), F.nullif(body, F.lit(""))), 1, n)
    found = df.select("id", tx.embedding_text(F.col("title"), F.col("summary"), n).alias("got"), want.alias("want"))
    assert [r for r in found.collect() if r.got != r.want] == []


def test_texts_to_embed_are_cleaned_once(spark):
    df = spark.createDataFrame([(1, "long enough title", "x"), (2, "short", ""), (3, None, None)], "id long, title string, summary string")
    texts = embed.article_texts(df)
    assert [(r.id, r.text) for r in texts.collect()] == [(1, "long enough title. x")]
    assert not [line for line in plan(texts).splitlines() if "Filter" in line and "regexp_replace" in line]


def articles(spark, rows):
    names = ["id", "title", "summary", "link", "seq"]
    df = spark.createDataFrame(rows, "id long, title string, summary string, link string, seq long")
    return merge.normalise(df.select(*names), F.lit("2024-01-01").cast("timestamp"))


def test_changes_are_made_without_moving_texts(spark):
    now = F.lit("2024-01-02").cast("timestamp")
    old = articles(spark, [(i, f"title {i}", "text", f"l{i}", i) for i in range(20)])
    new = articles(spark, [(None, f"title {i}", "a longer text" if i % 2 else "text", f"l{i}", i) for i in range(10, 30)])
    merged = merge.upsert(old, new, now).articles
    moved = [line for line in plan(merged).splitlines() if "hashpartitioning(winner_at" in line]
    assert not moved
    rows = {r.id: r.summary for r in merged.collect()}
    assert len(rows) == 30 and rows[5] == "text" and rows[12] == "text" and rows[13] == "a longer text" and rows[25] == "a longer text"
    changed, gone = build._changes(old, merged.select(*[f.name for f in ARTICLE], "is_new", "position").localCheckpoint(), ["title", "summary"])
    assert "hashpartitioning" not in plan(changed)
    assert {r.id for r in changed.collect()} >= {11, 13, 15, 17, 19, *range(20, 30)} and gone.count() >= 5
