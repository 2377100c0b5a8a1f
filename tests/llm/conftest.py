import random

import pytest
from pyspark.sql import functions as F, types as T

VOCABULARY = [a + b for a in "ka lo mi né su ta Ve xo".split() for b in "ra ti bol ß cun den fi 7".split()]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choices(VOCABULARY, k=n))


def edge_texts():
    """Null, empty, blank, tiny, ordinary, copied, edited and very long texts."""
    base = prose(1, 300)
    edited = base.split()
    edited[150] = "changed"
    other = prose(2, 120)
    return [
        None, "", " \n\t ", "one", "two words", "four words are here", "five words are in here",
        base, base, " ".join(edited), base + " " + prose(3, 60), other, other.upper(), prose(4, 200) + "\n" + base,
        "same line\n" * 80, prose(5, 12_000), "x" * 40_000, "a b c " * 4000, "line one\n" + prose(6, 70) + "\n\né\U0001f600 z",
    ]


@pytest.fixture(scope="session")
def edge_rows():
    """(id, text) with distinct ids."""
    return [(10 * i + 3, t) for i, t in enumerate(edge_texts())]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows, one of them twice, with null sources and columns of clashing names."""
    rows = [(i, t, "en", None if i % 40 == 3 else f"s{i % 3}") for i, t in [*edge_rows, edge_rows[8]]]
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    for name in ("id", "n", "size", "copies", "kept", "spans", "n_words", "_gone", "_mix", "_text", "component_id", "file", "part"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], T._parse_datatype_string("doc_id long, text string, lang string, source string"))
