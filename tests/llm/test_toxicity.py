"""The string kernel against its definition, and the classifier on held-out documents."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import toxicity
from tests.llm.conftest import prose

INSULTS = ["grobbel", "snarfuck", "plonkerd"]
WORDS = ["idiot", "i.d.i.o.t", "worthless", "wor-th less", "éàü", "aaaa", "ab", "", "ab12cd", "xyzzyxyzzyxyzzyxyzzyxyz"]


def subsequences(word):
    s, out = toxicity.SYMBOL[np.frombuffer(word, np.uint8)], {}
    for i, j, k in combinations(range(len(s)), 3):
        if s[i] and s[j] and s[k]:
            key = int(s[i]), int(s[j]), int(s[k])
            out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
    return out


def alike(a, b):
    a, b = subsequences(a), subsequences(b)
    size = (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5
    return sum(v * b.get(k, 0) for k, v in a.items()) / size if size else 0.0


def test_kernel():
    words = [w.encode()[: toxicity.WINDOW] for w in WORDS]
    s, n = toxicity.symbols(words)
    assert np.allclose(toxicity.norms(s, n) ** 2, [sum(x * x for x in subsequences(w).values()) for w in words])
    marks = toxicity.Landmarks(s, n)
    solid = [w for w in words if subsequences(w)]
    assert marks.n == len(solid)
    assert np.allclose(marks.kernel(s, n), [[alike(a, b) for b in solid] for a in words])
    # On the landmarks themselves the Nyström features give the kernel back.
    x = marks.kernel(*toxicity.symbols(solid)) @ marks.root
    assert np.allclose(x @ x.T, marks.kernel(*toxicity.symbols(solid)), atol=1e-6)


def test_a_linear_machine_is_its_weights():
    words = [w.encode()[: toxicity.WINDOW] for w in WORDS]
    examples = {w: (0.5, 0.0) if i < 4 else (0.0, 0.2) for i, w in enumerate(words)}
    model = toxicity.machine(examples, landmarks=6)
    values = model.values(*toxicity.symbols(words))
    assert values[0] > values[6] and values[2] > values[6] and np.isclose(values[7], model.offset)


def test_pieces():
    texts = ["one two", "", "i d i o t", "é a b xx c d", " a b ", "w" * 60, "q w", "x " * 30]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    starts, ends, rows = toxicity.pieces(data, offsets)
    got = [[] for _ in texts]
    for a, b, r in zip(starts, ends, rows):
        got[r].append(data[a:b].tobytes().decode())
    assert got[0] == ["one", "two"] and got[1] == [] and got[2] == [*"idiot", "i d i o t"]
    assert got[3] == ["é", "a", "b", "xx", "c", "d", "é a b"] and got[4] == ["a", "b"] and got[6] == ["q", "w"]
    assert got[5] == ["w" * 24] * 4 and got[7][:30] == ["x"] * 30
    assert all(len(x) <= toxicity.WINDOW for x in got[7]) and "".join(x[:12] for x in got[7][30:])[:48] == ("x " * 30)[:48]


def test_long_texts_are_cut_between_words():
    texts = ["short", "word " * 500, "y" * 900, "tail"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    got = {}
    for first, part, bounds in toxicity.long_texts_cut(data, offsets, 100):
        assert len(part) <= 200
        for k in range(len(bounds) - 1):
            got.setdefault(first + k, []).append(part[bounds[k] : bounds[k + 1]].tobytes().decode())
    assert ["".join(got[i]) for i in range(4)] == texts
    assert all(p.strip().split(" ")[-1] == "word" and p.strip().split(" ")[0] == "word" for p in got[1])


@pytest.fixture(scope="module")
def labelled():
    """(id, text, toxic): one in six holds insults, some with other endings."""
    rng, rows = random.Random(8), []
    for i in range(900):
        words, toxic = prose(i, rng.randrange(8, 90)).split(), int(rng.random() < 1 / 6)
        for _ in range(rng.randrange(2, 5) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + rng.choice(["", "", "s", "ish", "!"]))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark, labelled):
    docs = spark.createDataFrame(labelled, "doc_id long, text string, toxic int")
    odd = [(None, 1), (3, None), (1_000_000, 1), (5, 7)]
    labels = docs.select("doc_id", "toxic").union(spark.createDataFrame(odd, "doc_id long, toxic int"))
    return toxicity.trained(docs.withColumn("label", F.lit("mine")), labels)


def test_held_out_documents(spark, labelled, model):
    docs = spark.createDataFrame(labelled, "doc_id long, text string, toxic int").withColumn("score", F.lit("mine")).repartition(3)
    found = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert len(found) == len(labelled)
    for i, _, _ in labelled:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i].score <= 1 and found[i].predicted == int(found[i].score >= 0.5)
    held = [(found[i].predicted, t) for i, _, t in labelled if found[i].held_out]
    assert sum(p == t for p, t in held) / len(held) >= 0.97
    assert sum(p for p, t in held if t) / sum(t for _, t in held) >= 0.9


def test_gaps_and_inserted_characters(spark, model):
    base = prose(77, 30)
    forms = ["grobbel plonkerd", "g.r.o.b.b.e.l plonk-erd", "g r o b b e l p*lonker*d", "grobxbel plonkxerd", "GROBBEL Plonkerd", "grobbelings plonkerds"]
    docs = spark.createDataFrame([(i, f"{base} {f} {base}") for i, f in enumerate([*forms, "nothing here"])], "doc_id long, text string")
    found = {r.doc_id: r.predicted for r in toxicity.scored(docs, model).collect()}
    assert [found[i] for i in range(len(forms) + 1)] == [1] * len(forms) + [0]


def test_edges(edge_docs, empty_docs, model, edge_rows):
    found = toxicity.scored(edge_docs, model).collect()
    assert len(found) == len(edge_rows) + 1
    blank = {r.score for r in found if r.doc_id in (3, 13, 23)}
    assert len(blank) == 1 and not any(r.predicted for r in found)
    assert len({(r.score, r.worst) for r in found if r.doc_id == edge_rows[8][0]}) == 1
    assert toxicity.scored(empty_docs, model).collect() == []


def test_one_class_or_none(spark, labelled, empty_docs):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled[:40]], "doc_id long, text string")
    clean = docs.select("doc_id", F.lit(0).alias("toxic"))
    none = clean.limit(0)
    for labels, source in ((clean, docs), (none, docs), (none, empty_docs)):
        scores = {r.score for r in toxicity.scored(docs, toxicity.trained(source, labels)).collect()}
        assert len(scores) == 1 and 0 < scores.pop() <= 0.5


def test_scores_do_not_depend_on_the_rows_beside(spark, labelled, model):
    one = spark.createDataFrame(labelled[:50], "doc_id long, text string, toxic int")
    score = toxicity.Scorer(model)
    for text in ("grobbel", prose(5, 9), ""):
        data = np.frombuffer(text.encode(), np.uint8)
        first, again = (score(data, np.array([0, len(data)]))[3] for _ in range(2))
        assert (first == again).all()
    a = {r.doc_id: r.score for r in toxicity.scored(one.coalesce(1), model).collect()}
    b = {r.doc_id: r.score for r in toxicity.scored(one.repartition(7), model).collect()}
    assert a == b
