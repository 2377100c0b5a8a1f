"""Fill-in-the-middle texts against a plain restatement, over frames of any size."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import fill_middle
from tests.llm.conftest import prose

MORE = ["<P>", "a<M>b", "x<S", ">", "<P", "É<" * 40, "<P <S> x", "ab1cd22 \U0001f600é\n", "z" * 5000, "1" * 700, prose(9, 3000)]


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    if h4 % 100 < 20:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(edge_rows):
    more = [(5000 + 100 * i + j, t) for i, t in enumerate(MORE) for j in range(6)]
    return [*edge_rows, *more, more[5], (None, "no id here"), (None, None), (edge_rows[7][0], "same id")]


@pytest.mark.parametrize("frame_bytes", [5, 64, fill_middle.FRAME_BYTES])
def test_fill_middle(spark, rows, frame_bytes):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for name in ("n", "frames", "form", "marked", "low", "output"):
        docs = docs.withColumn(name, F.lit("mine"))
    found = fill_middle.transformed(fill_middle.framed(docs, frame_bytes=frame_bytes), with_output=True).collect()
    got = sorted(map(repr, [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.output_sha256, r.restored_sha256) for r in found]))
    want = [(*plain(i, t), sha(plain(i, t)[-1]), sha(t or "")) for i, t in rows]
    assert got == sorted(map(repr, want))
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_no_rows(empty_docs):
    assert fill_middle.transformed(fill_middle.framed(empty_docs)).collect() == []


def test_a_cut_reads_one_frame(spark):
    text = prose(3, 20_000)
    row = fill_middle.framed(spark.createDataFrame([(1, text)], "doc_id long, text string"), frame_bytes=4096).first()
    assert len(row.frames) > 20
    read, held = [], fill_middle.Text([f.asDict() for f in row.frames], row.n, row.n_chars, row.n_bytes)
    whole = held.frame
    held.frame = lambda k: read.append(k) or whole(k)
    chars, at = held.place(row.n // 2)
    assert len(set(read)) == 1
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert chars == len("".join(units[: row.n // 2])) and at == len("".join(units[: row.n // 2]).encode())
