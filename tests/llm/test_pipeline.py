"""The pipeline against its stages' plain restatements, and the registration of the queries."""

import re

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from newsloom.llm import mixing
from newsloom.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm import plain


def test_pipeline(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = [r for r in rows if plain.quality(r[1])[-1]]
    groups = plain.near_duplicates([r[:2] for r in kept])
    kept = [r for r in kept if groups[r[0]][2]]
    bad = {i for i, *_, hit in plain.contamination([r[:2] for r in kept], items) if hit}
    kept = [r for r in kept if r[0] not in bad]
    assert 0 < len(bad) and 0 < len(kept) < len(rows)
    # Mixing is tested on its own; here its copies are taken as they come.
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    mixed = mixing.mixed(spark.createDataFrame(kept, schema), weights=[3, 1, 2]).collect()
    repeated = [(r.doc_id, r.text) for r in mixed for _ in range(r.copies)]
    want = plain.token_rows(repeated, public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, SMALL).orderBy("start").collect()
    assert [tuple(r) for r in got] == want


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter("doc_id < 40")
    docs = docs.withColumn("copies", F.lit("mine")).withColumn("_rule", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


def test_stages_of_empty_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).collect() == []


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES] == list(range(1, 11))
