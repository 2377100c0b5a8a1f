"""Near duplicates, decontamination, quality rules, mixing and repeats on edge cases."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import decontaminate, line_dedup, mixing, near_dedup, quality, repeats, run_index
from tests.llm import plain
from tests.llm.conftest import prose


def pairs(rows):
    return sorted(rows, key=repr)


def test_near_duplicates(edge_docs, edge_rows):
    got = near_dedup.near_duplicates(edge_docs).collect()
    want = plain.near_duplicates(edge_rows)
    assert pairs((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == pairs(
        (i, *want[i]) for i, _ in [*edge_rows, edge_rows[8]]
    )


def test_near_duplicates_without_id_or_rows(spark, empty_docs):
    assert near_dedup.near_duplicates(empty_docs).collect() == []
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (None, None)], "doc_id long, text string")
    got = near_dedup.near_duplicates(docs).collect()
    assert pairs(map(tuple, got)) == pairs([(None, 1, None, True), (5, 1, 5, True), (None, 0, None, True)])


def test_near_copies_form_a_chain_and_a_large_bucket(spark):
    """Many near copies of one text, and a chain in which only neighbours are alike."""
    base, rows = prose(11, 80).split(), []
    for i in range(120):
        w = list(base)
        w[(7 * i) % 80] = f"x{i}"
        rows.append((i, " ".join(w)))
    chain = prose(12, 400).split()
    rows += [(1000 + i, " ".join(chain[8 * i : 8 * i + 120])) for i in range(12)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = plain.near_duplicates(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got.collect()} == want


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    a, b = x[:2000], x[500:]
    sketch = lambda s: near_dedup.registers(near_dedup.smallest(s))
    assert (near_dedup.merged(np.array([sketch(a), sketch(b)])) == sketch(x)).all()
    found = near_dedup.estimate(sketch(a)[None], sketch(b)[None], np.array([2000.0]), np.array([2500.0]))[0]
    assert abs(found - 0.5) < 0.2


def test_slope_of_the_likelihood_tells_what_the_estimate_does():
    rng = np.random.default_rng(2)
    x, y, nx, ny = [], [], [], []
    for _ in range(2000):
        a, b = (int(k) for k in rng.integers(20, 400, 2))
        e = rng.integers(0, 1 << 63, a + b, np.uint64)
        x.append(near_dedup.registers(near_dedup.smallest(e[:a])))
        y.append(near_dedup.registers(near_dedup.smallest(e[int(rng.integers(0, a)) :])))
        nx.append(float(a))
        ny.append(float(b))
    x, y, nx, ny = map(np.array, (x, y, nx, ny))
    found = near_dedup.estimate(x, y, nx, ny)
    sure = abs(found - near_dedup.LEAST_ESTIMATE) > 1e-6
    assert (near_dedup.likely(x, y, nx, ny) == (found >= near_dedup.LEAST_ESTIMATE))[sure].all()


def test_documents_still_apart_are_dealt_to_stated_tasks(spark, monkeypatch):
    """Their comparisons cost more than their bytes tell, so Spark must not join the tasks."""
    monkeypatch.setattr(near_dedup, "ROWS_APART", 10)
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, 50, np.uint64) for _ in range(200)]
    sketch = lambda e: near_dedup.registers(near_dedup.smallest(e)).tobytes()
    sketches = spark.createDataFrame([(i, 50, bytearray(sketch(e))) for i, e in enumerate(sets)], "id long, n long, sketch binary")
    members = spark.createDataFrame([(i // 2, i, i, 1) for i in range(200)], "bucket long, id long, component long, size long")
    plan = near_dedup.apart(members, sketches)._jdf.queryExecution().toString()
    assert re.search(r"hashpartitioning\(bucket#\d+L?, i#\d+, j#\d+, 20\), REPARTITION_BY_NUM", plan)


def test_deduplicated_keeps_own_columns(edge_docs, edge_rows):
    kept = near_dedup.deduplicated(edge_docs)
    assert kept.columns == edge_docs.columns
    want = plain.near_duplicates(edge_rows)
    assert {r.doc_id for r in kept.collect()} == {i for i in want if want[i][2]}


ITEMS = [
    (1, " ".join(prose(1, 300).split()[40:75])), (2, "Four words ARE"), (3, prose(5, 12_000)[-400:]), (4, None), (5, "!?"),
    (None, prose(2, 120)[:90]), (1, "five words are in here"), (6, prose(77, 30)), (7, "x" * 40_000),
]


@pytest.mark.parametrize("slice_windows", [decontaminate.SLICE_WINDOWS, 7])
def test_contamination(spark, edge_docs, edge_rows, monkeypatch, slice_windows):
    monkeypatch.setattr(decontaminate, "SLICE_WINDOWS", slice_windows)
    items = ITEMS if slice_windows > 7 else ITEMS[:2]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("terms", F.lit("mine"))
    found = decontaminate.contamination(edge_docs, benchmark).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found]
    assert pairs(got) == pairs(plain.contamination([*edge_rows, edge_rows[8]], items))
    assert all(r.n_near_items >= r.n_items for r in found)
    assert all(sum(r.spans[1::2]) - sum(r.spans[::2]) == r.n_hit for r in found)


def test_contamination_of_empty_tables(spark, edge_docs, empty_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(empty_docs, benchmark).collect() == []
    none = decontaminate.contamination(edge_docs, benchmark.limit(0)).collect()
    assert len(none) == edge_docs.count() and not any(r.contaminated for r in none)


def test_proximity_without_exact_match(spark):
    item = prose(31, 10).split()
    swapped = item[:4] + [item[5], item[4]] + item[6:]
    docs = spark.createDataFrame([(1, "lead in " + " ".join(swapped)), (2, " ".join(item[:9]))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got == {1: (0, 1), 2: (0, 0)}


def test_decontaminated_keeps_own_columns(spark, edge_docs, edge_rows):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.decontaminated(edge_docs, benchmark)
    assert kept.columns == edge_docs.columns
    clean = {i for i, *_, bad in plain.contamination(edge_rows, ITEMS) if not bad}
    assert {r.doc_id for r in kept.collect()} == clean


def test_quality(edge_docs, edge_rows, empty_docs):
    names = [*quality.MEASURES, "base_failed", "kept"]
    found = quality.assessed(edge_docs).select("doc_id", *names).collect()
    texts = dict(edge_rows)
    assert pairs(tuple(r) for r in found) == pairs((r.doc_id, *plain.quality(texts[r.doc_id])) for r in found)
    assert len(found) == len(edge_rows) + 1
    assert quality.assessed(empty_docs).collect() == [] == quality.accepted(empty_docs).collect()


def test_cascade_order_changes_no_verdict(edge_docs, edge_rows):
    want = sorted(i for i, t in [*edge_rows, edge_rows[8]] if plain.quality(t)[-1])
    for rules in (quality.RULES, quality.RULES[::-1]):
        kept = quality.accepted(edge_docs, rules, order=False)
        assert sorted(r.doc_id for r in kept.collect()) == want
        assert kept.columns == edge_docs.columns
    ordered = quality.ordered(edge_docs)
    assert set(ordered) == set(quality.RULES)


def test_mixing(edge_docs, edge_rows, empty_docs):
    found = mixing.mixed(edge_docs, weights=[3, 1, 2]).collect()
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        assert r.size == len(plain.SPACED.findall(r.text or "")) and 0 <= r.copies <= 2
        sizes[r.source] += r.size
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    want = plain.targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mixing.mixed(edge_docs.repartition(5), weights=[3, 1, 2]).collect()
    key = lambda rows: pairs((r.doc_id, r.copies, r.target) for r in rows)
    assert key(found) == key(again)
    mix = mixing.repeated(edge_docs, weights=[3, 1, 2])
    assert mix.columns == edge_docs.columns
    assert sum(len(plain.SPACED.findall(r.text or "")) for r in mix.collect()) == sum(taken.values())
    assert mixing.mixed(empty_docs, weights=[3, 1, 2]).collect() == []


def test_water_filling_holds_several_sources(spark):
    """A tiny heavy source, then another once its share is dealt out again."""
    sizes = {"a": 10, "b": 100, "c": 90, "d": 5000, None: 0}
    sources = spark.createDataFrame(list(sizes.items()), "source string, size long")
    plan = mixing.targets(mixing.cyclic_weights(sources, [3, 1, 2]), F.col("total") * 3 / 2, 2)
    got = {r.source: r.target for r in plan.collect()}
    assert {s: round(t, 6) for s, t in got.items()} == {s: round(t, 6) for s, t in plain.targets(sizes).items()}


def line_rows():
    passage = "\n".join(prose(400 + k, 6) for k in range(40))
    rows = [(i, "\n".join([*(prose(500 + 50 * i + k, 4) for k in range(i)), passage, prose(900 + i, 5)])) for i in range(12)]
    rows += [(40, "\n" * 30), (41, "\n" * 31), (42, passage.replace("ka", "KA")), (None, passage), (43, passage + "\n" + passage)]
    return rows + [(44, "x\n" * 5000), (45, "y" * 100_000)]


def test_line_dedup(spark, edge_docs, edge_rows, empty_docs):
    key = lambda r: (r.kept_text, r.n_lines, r.n_chunks, r.n_removed_lines, r.n_removed_chunks)
    want = plain.line_dedup(edge_rows)
    found = line_dedup.without_repeats(edge_docs).collect()
    assert pairs((r.doc_id, *key(r)) for r in found) == pairs((i, *want[i]) for i, _ in [*edge_rows, edge_rows[8]])
    want = plain.line_dedup(line_rows())
    found = line_dedup.without_repeats(spark.createDataFrame(line_rows(), "doc_id long, text string")).collect()
    assert {r.doc_id: key(r) for r in found} == want
    # The passage goes from every document but the first, but for the lines around its ends.
    assert all(want[i][3] >= 30 for i in range(12)) and want[None][3] == 0
    assert line_dedup.without_repeats(empty_docs).collect() == []


def test_chunks_with_one_hash_are_compared(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "_keys", lambda body: [F.lit(1).alias("k1"), F.lit(1).alias("k2")])
    found = line_dedup.without_repeats(spark.createDataFrame(line_rows(), "doc_id long, text string")).collect()
    assert {r.doc_id: r.kept_text for r in found} == {i: v[0] for i, v in plain.line_dedup(line_rows()).items()}


def test_repeats(spark, edge_docs, edge_rows, empty_docs):
    want = plain.kept_bytes(edge_rows)
    found = repeats.without_repeats(edge_docs).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]
    assert pairs(got) == pairs((i, *want[i]) for i, _ in [*edge_rows, edge_rows[8]])
    assert repeats.without_repeats(empty_docs).collect() == []


def test_repeats_of_shifted_passages(spark, monkeypatch):
    """Passages with other surroundings, long runs of one byte, a text worked on in chunks, a null id."""
    monkeypatch.setattr(repeats, "_CHUNK", 3000)
    passage = prose(21, 60)
    rows = [(i, prose(100 + i, i) + passage[3 * i : 300 + i] + prose(200 + i, 5)) for i in range(30)]
    rows += [(50, "z" * 700), (51, "y" * 101 + passage), (None, passage[20:160]), (52, prose(9, 3000) + passage)]
    found = repeats.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == plain.kept_bytes(rows)


def test_repeats_around_a_frequent_phrase(spark, monkeypatch):
    """A phrase with other bytes on one side or both in most documents, cut a few contexts at a time."""
    monkeypatch.setattr(repeats, "CUT", 7)
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choices("abcdefghij ", k=n))
    phrase, before, behind = letters(40), [letters(70) for _ in range(3)], [letters(70) for _ in range(3)]
    rows = []
    for i in range(120):
        left = letters(20) + before[i % 3][rng.randrange(70) :] if i % 4 else letters(70)
        right = behind[i % 5 % 3][: rng.randrange(70)] + letters(20) if i % 3 else letters(70)
        rows.append((i, left + phrase + right + (phrase + right[:66] if i % 7 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.without_repeats(docs).collect()
    want = plain.kept_bytes(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want
    assert 20 < sum(r.n_removed > 0 for r in found) < 120

    data = np.frombuffer("".join(text for _, text in rows).encode(), np.uint8)
    parts = list(repeats.contexts(data, np.cumsum([0, *(len(text) for _, text in rows)])))
    contexts = np.zeros(sum(len(p[0]) for p in parts), repeats._CONTEXT)
    for name, k in (("first", 1), ("n", 2), ("lead", 3)):
        contexts[name] = np.concatenate([p[k] for p in parts])
    which, start, end, core = repeats.halves(contexts)
    assert ((start <= core) & (core + repeats._CORE <= end)).all()
    windows = np.bincount(which, end - start - repeats.LENGTH + 1)
    assert (windows == contexts["n"]).all()


def test_rows_without_an_id_and_ids_with_several_texts(spark):
    """Each is a document of its own: nothing unique of it goes, what repeats does."""
    passage = "\n".join(prose(700 + k, 6) for k in range(30))
    rows = [(None, prose(750, 40) + "\n" + passage), (None, prose(751, 40)), (None, passage), (None, passage), (3, passage), (3, prose(752, 40))]
    rows += [(4, prose(753, 40)), (4, prose(753, 40)), (-(1 << 63), prose(754, 9))]
    schema = "doc_id long, text string"
    docs = spark.createDataFrame(rows, schema).repartition(3)
    # Numbered as the operators define it: no id first, then by digest; equal rows of an id are one.
    own = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, plain.sha(r[1])))
    numbers = [own.index(r) if r[0] is not None else n for n, r in enumerate(own)]
    apart = list(dict(zip(numbers, own)).items())
    texts = [(n, text) for n, (_, text) in apart]

    want = plain.line_dedup(texts)
    found = line_dedup.without_repeats(docs).collect()
    assert pairs((r.doc_id, r.kept_text) for r in found) == pairs((r[0], want[n][0]) for n, r in zip(numbers, own))
    want = plain.kept_bytes(texts)
    found = repeats.without_repeats(docs).collect()
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found]
    assert pairs(got) == pairs((r[0], *want[n]) for n, r in zip(numbers, own))
    want = plain.near_duplicates(texts)
    kept = pairs(r for n, r in zip(numbers, own) if want[n][2])
    assert pairs(map(tuple, near_dedup.deduplicated(docs).collect())) == kept and len(kept) < len(rows)
    items = [(1, prose(751, 40)), (2, prose(752, 40))]
    clean = decontaminate.decontaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert pairs(map(tuple, clean.collect())) == pairs(r for r in rows if r[1] not in [text for _, text in items])


def test_run_index_against_plain_search():
    texts = [prose(300 + k, 80).encode()[k : k + 250] for k in range(6)]
    texts += [texts[0][30:200], texts[1][:99], b"", texts[2][5:150] + texts[0][40:160], b"q" * 150]
    seen = set()
    for text, flags in zip(texts, run_index.repeated_windows(texts)):
        for k in range(len(text) - 99):
            assert flags[k] == (text[k : k + 100] in seen)
            seen.add(text[k : k + 100])


def test_words_and_hashes():
    """Words at the edges of rows, and every byte class."""
    import pyarrow as pa

    from newsloom.llm import textbytes as tb

    texts = ["", None, "a", " a b", "a b ", "é x\ty", "".join(map(chr, range(1, 256)))]
    data, offsets = tb.raw(pa.array(texts))
    for kind, pattern in ((tb.SPACED, plain.SPACED), (tb.ALNUM, plain.ALNUM)):
        hashes, first = tb.words(data, offsets, kind)
        want = [re.findall(pattern, plain.lower(t)) for t in texts]
        assert np.diff(first).tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        assert len(set(hashes.tolist())) == len(set(flat))


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_words_that_differ(spark):
    """Thue–Morse words and their complements, whose polynomial hashes are equal modulo 2**64."""
    import pyarrow as pa

    from newsloom.llm import textbytes as tb

    rows = []
    for i, n in enumerate((256, 1024, 2048, 4096)):
        word = thue_morse(n)
        rows += [(10 * i, word), (10 * i + 1, word.translate(str.maketrans("ab", "ba")))]
    data, offsets = tb.raw(pa.array([t for _, t in rows]))
    assert len(set(tb.words(data, offsets, tb.SPACED)[0].tolist())) == len(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.kept for r in near_dedup.near_duplicates(docs).collect())
    items = docs.where("doc_id % 10 = 0").select(F.col("doc_id").alias("item_id"), "text")
    found = {r.doc_id: r.contaminated for r in decontaminate.contamination(docs, items).collect()}
    assert found == {i: i % 10 == 0 for i, _ in rows}


def test_rows_without_an_id_come_near_their_target(spark):
    rows = [(None if i % 10 else i, prose(i, 5 + i % 40), f"s{i % 3}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in mixing.mixed(docs, weights=[3, 1, 2]).groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect():
        assert abs(r.taken - r.target) <= 45
