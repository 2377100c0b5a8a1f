"""Rules held in a table, and matrices as files."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.functions import rules
from newsloom.operators import rule_table
from newsloom.sources import matrices

RULES = "priority int, pattern string, label string"


def decided(texts, listed, default="none"):
    ordered = sorted((r for r in listed if r[1] is not None and r[2] is not None), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return [next((label for _, p, label in ordered if text is not None and p in text), default) for text in texts]


def found(spark, texts, listed, **more):
    table = spark.createDataFrame(listed, RULES)
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(3)
    label = rule_table.first_match(F.col("text"), table, F.lit("none"), **more)
    return [r.label for r in rows.select("n", label.alias("label")).orderBy("n").collect()]


@pytest.mark.parametrize("case_rules", [0, 100])
def test_rules_of_edge_cases(spark, case_rules):
    """Ties, nulls, repeated patterns, one pattern inside another, an empty pattern."""
    listed = [(2, "bc", "two"), (1, "abcd", "one"), (2, "bb", "tie"), (3, "b", "three"), (3, "bcd", "never"), (0, None, "null")]
    listed += [(5, "é€😀", "wide"), (4, "x", None), (6, "x", "late"), (6, "x", "later"), (None, "q", "first")]
    texts = ["abcd", "bcd", "bbc", "ab", "", None, "-é€😀-", "x", "abcdq", "nothing"]
    assert found(spark, texts, listed, case_rules=case_rules) == decided(texts, listed)
    listed += [(4, "", "all")]
    assert found(spark, texts, listed, case_rules=case_rules) == decided(texts, listed)
    assert found(spark, texts, [], case_rules=case_rules) == ["none"] * len(texts)
    assert found(spark, [], listed, case_rules=case_rules) == []


def test_ten_thousand_rules(spark, monkeypatch):
    """As many as no expression could hold, in one automaton and in several."""
    rng = random.Random(3)
    word = lambda a, b: "".join(rng.choices("abcdef./", k=rng.randint(a, b)))
    listed = [(rng.randrange(5000), word(3, 9), f"label {i}") for i in range(10_000)]
    texts = [word(0, 60) for _ in range(400)]
    want = decided(texts, listed)
    assert len(set(want)) > 100
    assert found(spark, texts, listed) == want
    monkeypatch.setattr(rule_table, "AUTOMATON_RULES", 4000)
    monkeypatch.setattr(rule_table, "AUTOMATON_CHARS", 15_000)
    assert found(spark, texts, listed) == want


def test_rule_table_equals_the_expression(spark):
    urls = [f"https://{p}.example/{i}" for i, (p, _) in enumerate(rules.SOURCE_RULES)] + ["https://none/"]
    listed = [(i, p, label) for i, (p, label) in enumerate(rules.SOURCE_RULES)]
    rows = spark.createDataFrame(list(enumerate(urls)), "n int, text string")
    want = [r.s for r in rows.select("n", rules.source_of_url(F.col("text")).alias("s")).orderBy("n").collect()]
    got = found(spark, urls, listed, case_rules=0)
    assert [rules.SOURCE_DEFAULT if g == "none" else g for g in got] == want


def test_matrix_of_other_programs(spark, tmp_path):
    """One file as NumPy writes it, of 32 and 64 bits, read in many ranges of rows."""
    for kind in (np.float32, np.float64, ">f4"):
        made = np.random.default_rng(5).normal(size=(1000, 24)).astype(kind)
        path = str(tmp_path / f"{np.dtype(kind).str[1:]}{np.dtype(kind).byteorder == '>'}.npy")
        np.save(path, made)
        back = matrices.read(spark, path, partition_bytes=10_000)
        assert back.rdd.getNumPartitions() >= 3
        rows = back.orderBy("id").collect()
        assert [r.id for r in rows] == list(range(1000))
        assert np.array_equal(np.array([r.embedding for r in rows], np.float32), made.astype(np.float32))


def test_matrix_round_trip(spark, tmp_path):
    made = np.random.default_rng(6).normal(size=(700, 8)).astype(np.float32)
    ids = np.random.default_rng(7).permutation(700) * 3 - 50
    vectors = spark.createDataFrame([(int(i), v.tolist(), "x") for i, v in zip(ids, made)], "vec long, v array<float>, id string").repartition(5)
    want = made[np.argsort(ids)]
    for per_file, n_files in ((100, 7), (300, 3), (10_000, 1)):
        path = tmp_path / f"m{per_file}"
        matrices.write(vectors, str(path), "vec", "v", rows_per_file=per_file)
        files = sorted(path.glob("part-*.npy"))
        assert len(files) == n_files and not [f for f in path.iterdir() if f not in files]
        assert np.array_equal(np.concatenate([np.load(f) for f in files]), want)
        rows = matrices.read(spark, str(path), partition_bytes=1000).orderBy("id").collect()
        assert [r.id for r in rows] == list(range(700))
        assert np.array_equal(np.array([r.embedding for r in rows], np.float32), want)
    with pytest.raises(FileExistsError):
        matrices.write(vectors, str(tmp_path / "m100"), "vec", "v")


def test_matrices_that_are_none(spark, tmp_path):
    """Rows missing, other shapes and kinds, mixed widths; no rows are no rows."""
    np.save(tmp_path / "empty.npy", np.zeros((0, 4), np.float32))
    assert matrices.read(spark, str(tmp_path / "empty.npy")).collect() == []
    np.save(tmp_path / "flat.npy", np.zeros(4, np.float32))
    np.save(tmp_path / "whole.npy", np.zeros((4, 4), np.int64))
    np.save(tmp_path / "columns.npy", np.asfortranarray(np.ones((4, 4), np.float32)))
    np.save(tmp_path / "cut.npy", np.zeros((4, 4), np.float32))
    (tmp_path / "cut.npy").write_bytes((tmp_path / "cut.npy").read_bytes()[:-1])
    (tmp_path / "widths").mkdir()
    for n in (2, 3):
        np.save(tmp_path / "widths" / f"{n}.npy", np.zeros((4, n), np.float32))
    for name in ("flat.npy", "whole.npy", "columns.npy", "cut.npy", "widths", "nowhere"):
        with pytest.raises(Exception):
            matrices.read(spark, str(tmp_path / name)).collect()
    for bad in ([None], [[1.0], [1.0, 2.0]], [[1.0, None]]):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate([[1.0, 2.0], *bad])], "id long, embedding array<float>")
        with pytest.raises(Exception):
            matrices.write(rows, str(tmp_path / f"bad{len(bad)}{bad[0] is None}"))
    matrices.write(spark.createDataFrame([], "id long, embedding array<float>"), str(tmp_path / "none"))
