"""Benchmark decontamination by a distributed positional inverted index.

Documents are taken in blocks of about a million words. The index has a row for each block and term
with the term's positions, delta-coded, and a directory of each block's documents. Positions count
words through the block, with a gap after each document that no window can bridge. Terms are the
64-bit hashes of words; an index for a given benchmark stores only terms that occur in it, as no
other posting can be met.

A window is ten consecutive words of a benchmark item. In each block its terms are taken from the
rarest in the corpus on: the postings of the rarest are the candidates, and each further list,
shifted by the distance of its term, thins them out by binary search. Most windows end at the
first term. Candidates that have all terms close by, in any order, are proximity matches; those that
have each term at its own distance are exact ones.

The windows go to the tasks in slices of bounded size, one job a slice over the stored index; a
benchmark of any size is a number of slices.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from newsloom.llm import textbytes as tb
from newsloom.llm.tables import column, free_name, hinted, keyed, stored

WINDOW = 10
SLOP = 20  # words around the rarest term in which all others make a proximity match
BLOCK_BYTES = 6 << 20
SLICE_WINDOWS = 200_000  # windows in the hands of a task at once: about 20 MB
_GAP = SLOP + WINDOW


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, distinct keys, where each begins with the end appended)."""
    order = np.argsort(keys, kind="stable")
    found = keys[order]
    at = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return order, found[at], np.append(at, len(keys))


def index(docs: DataFrame, vocabulary: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of docs as one stored table of rows (block, term, n, positions, ids, counts): postings
    have a term and positions, each block's directory row has a null term and the ids and word counts
    of its documents. vocabulary: sorted term hashes to store, all terms if None."""

    def blocks(batches):
        """(ids, bytes, offsets) of blocks of whole rows."""
        held, size = [], 0
        for batch in batches:
            data, offsets = tb.raw(batch.column("text"))
            ids = batch.column("id")
            for first, piece, bounds in tb.sliced(data, offsets):
                if held and size + len(piece) > BLOCK_BYTES:
                    yield held
                    held, size = [], 0
                held.append((ids.slice(first, len(bounds) - 1), piece.copy(), bounds))
                size += len(piece)
        if held:
            yield held

    def run(batches):
        part = TaskContext.get().partitionId()
        for k, held in enumerate(blocks(batches)):
            ids = pa.concat_arrays([x if isinstance(x, pa.Array) else x.combine_chunks() for x, _, _ in held])
            terms, counts = [], []
            for _, piece, bounds in held:
                hashes, first = tb.words(piece, bounds, tb.ALNUM)
                terms.append(hashes)
                counts.append(np.diff(first))
            terms, counts = np.concatenate(terms), np.concatenate(counts).astype(np.int64)
            positions = np.arange(len(terms)) + np.repeat(np.arange(len(counts)) * _GAP, counts)
            if vocabulary is not None:
                at = np.searchsorted(vocabulary, terms)
                at[at == len(vocabulary)] = 0
                wanted = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), bool)
                terms, positions = terms[wanted], positions[wanted]
            order, keys, bounds = _grouped(terms)
            positions = positions[order]
            steps = np.diff(positions, prepend=0)
            steps[bounds[:-1]] = positions[bounds[:-1]]
            steps = steps.astype("<u4")
            block = (part << 32) + k
            lists = [steps[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([*keys.view(np.int64).tolist(), None], pa.int64()),
                    pa.array([*np.diff(bounds).tolist(), len(counts)], pa.int64()),
                    pa.array([*lists, None], pa.binary()),
                    pa.array([None] * n + [ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([None] * n + [counts], pa.list_(pa.int64())),
                ],
                ["block", "term", "n", "positions", "ids", "counts"],
            )

    rows = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    return stored(
        rows.mapInArrow(run, "block long, term long, n long, positions binary, ids array<long>, counts array<long>"), "postings"
    )


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, terms): the term hashes of each item with a word, as 8-byte numbers."""

    def run(batches):
        for batch in batches:
            data, offsets = tb.raw(batch.column("text"))
            hashes, first = tb.words(data, offsets, tb.ALNUM)
            cells = [hashes[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(cells, pa.binary())], ["item", "terms"])

    rows = items.select(F.coalesce(column(id_col).cast("string"), F.lit("")).alias("item"), column(text_col).alias("text"))
    return rows.mapInArrow(run, "item string, terms binary").filter(F.octet_length("terms") > 0)


def windows(cells: list[tuple[str, bytes]], window: int = WINDOW):
    """Slices of (terms of each distinct window, a list of them; the items that have it)."""
    held: dict[bytes, set[str]] = {}
    for item, cell in cells:
        size = 8 * window
        for at in range(0, max(len(cell) - size, 0) + 1, 8):
            held.setdefault(cell[at : at + size], set()).add(item)
            if len(held) >= SLICE_WINDOWS:
                yield held
                held = {}
    if held:
        yield held


def matches(postings: DataFrame, sought: dict[bytes, set[str]]) -> DataFrame:
    """(block, place, spans, items, near) for documents (place in the block) with a match: spans of
    exact matches as pairs of word numbers in the document, ids of the items that match exactly, and
    of those that match in proximity. sought: terms of at most SLICE_WINDOWS windows to their items."""
    spark = postings.sparkSession
    terms = np.unique(np.concatenate([np.frombuffer(cell, np.int64) for cell in sought]))
    wanted = F.broadcast(spark.createDataFrame(pa.table({"term": terms}), "term long"))
    lists = postings.filter("term is not null").join(wanted, "term", "left_semi")
    counts = {r.term: r.n for r in lists.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    plan = []
    for cell, items in sought.items():
        terms = np.frombuffer(cell, np.uint64).view(np.int64).tolist()
        rare = sorted(range(len(terms)), key=lambda i: (counts.get(terms[i], 0), i))
        if all(t in counts for t in terms):
            plan.append((terms, rare, sorted(items)))
    shared = spark.sparkContext.broadcast(plan)

    def run(key, table):
        known = {t.as_py(): i for i, t in enumerate(table.column("term"))}
        home = known.pop(None)
        sizes = np.array(table.column("counts")[home].as_py(), np.int64)
        firsts = np.concatenate(([0], np.cumsum(sizes + _GAP)))[:-1]
        cells, lists = table.column("positions"), {}

        def places(term: int) -> np.ndarray:
            if term not in lists:
                lists[term] = np.cumsum(np.frombuffer(cells[known[term]].as_buffer(), "<u4").astype(np.int64))
            return lists[term]

        spans: dict[int, list[int]] = {}
        exact: dict[int, set[str]] = {}
        near: dict[int, set[str]] = {}
        for terms, rare, items in shared.value:
            if not all(terms[i] in known for i in rare):
                continue
            lead = rare[0]
            close = places(terms[lead])
            for i in rare[1:]:
                other = places(terms[i])
                at = np.searchsorted(other, close - SLOP)
                close = close[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= close + SLOP)]
                if not len(close):
                    break
            if not len(close):
                continue
            starts = close - lead
            for i in rare[1:]:
                other, want = places(terms[i]), starts + i
                at = np.searchsorted(other, want)
                starts = starts[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == want)]
            for doc in np.unique(np.searchsorted(firsts, close, side="right") - 1).tolist():
                near.setdefault(doc, set()).update(items)
            for doc, start in zip((np.searchsorted(firsts, starts, side="right") - 1).tolist(), starts.tolist()):
                exact.setdefault(doc, set()).update(items)
                spans.setdefault(doc, []).extend((start - int(firsts[doc]), start - int(firsts[doc]) + len(terms)))
        docs = sorted(near)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(docs), pa.int64()),
                "place": pa.array(docs, pa.int64()),
                "spans": pa.array([spans.get(d, []) for d in docs], pa.list_(pa.int64())),
                "items": pa.array([sorted(exact.get(d, ())) for d in docs], pa.list_(pa.string())),
                "near": pa.array([sorted(near[d]) for d in docs], pa.list_(pa.string())),
            }
        )

    return lists.unionByName(postings.filter("term is null")).groupBy("block").applyInArrow(
        run, "block long, place long, spans array<long>, items array<string>, near array<string>"
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items, spans, items) of each row.

    n_hit: words inside an occurrence of a window of an item; spans: those occurrences as pairs of
    word numbers, end exclusive, merged; items: the items with an occurring window as strings, in
    order; n_near_items: items with a window whose words all lie within SLOP words of its rarest.
    Null and empty texts, of documents as of items, have no words; an item of fewer words than a
    window is one window. Items that share an id are one item, a null id counts as ''. Repeated
    documents each get their row. An empty table of documents gives an empty table, an empty
    benchmark no hits. Other columns are not looked at.
    """
    spark = docs.sparkSession
    cells = stored(item_terms(items, item_col, item_text_col), "items")
    vocabulary = _vocabulary(cells)
    postings = index(docs, vocabulary, id_col, text_col)
    schema = "block long, place long, spans array<long>, items array<string>, near array<string>"
    found = spark.createDataFrame([], schema)
    for sought in windows([(r.item, bytes(r.terms)) for r in cells.toLocalIterator()], window):
        found = found.unionByName(stored(matches(postings, sought), "matches"))
    whole = found.groupBy("block", "place").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.size(F.array_distinct(F.flatten(F.collect_list("near")))).cast("long").alias("n_near_items"),
    )
    directory = postings.filter("term is null").select("block", F.posexplode(F.arrays_zip("ids", "counts")).alias("place", "_doc"))
    directory = directory.select(
        "block", F.col("place").cast("long").alias("place"), F.col("_doc.ids").alias("doc_id"), F.col("_doc.counts").alias("n_words")
    )
    rows = directory.join(whole, ["block", "place"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array().cast("array<long>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near_items", F.lit(0).cast("long")).alias("n_near_items"),
    )
    return rows.mapInArrow(
        _merged_spans,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean,"
        " n_near_items long, spans array<long>, items array<string>",
    )


def _merged_spans(batches):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items", "spans", "items"]
    for batch in batches:
        spans, hit, digest = [], [], []
        for cell, items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
            whole: list[int] = []
            for a, b in sorted(zip(cell[::2], cell[1::2])):
                if whole and a <= whole[-1]:
                    whole[-1] = max(whole[-1], b)
                else:
                    whole += [a, b]
            spans.append(whole)
            hit.append(sum(whole[1::2]) - sum(whole[::2]))
            digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        n_items = [len(x) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                pa.array(hit, pa.int64()),
                pa.array(n_items, pa.int64()),
                pa.array(digest, pa.string()),
                pa.array([h > 0 for h in hit], pa.bool_()),
                batch.column("n_near_items"),
                pa.array(spans, pa.list_(pa.int64())),
                batch.column("items"),
            ],
            names,
        )


#: Distinct words of a benchmark that an index is restricted to; beyond it, all terms are stored.
VOCABULARY = 2_000_000


def _vocabulary(cells: DataFrame) -> np.ndarray | None:
    """The sorted distinct terms of the items if there are at most VOCABULARY, else None."""

    def run(batches):
        for batch in batches:
            seen = [np.frombuffer(c.as_buffer(), np.int64) for c in batch.column("terms")]
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(seen)))], ["term"])

    terms = cells.mapInArrow(run, "term long").distinct()
    if terms.count() > VOCABULARY:
        return None
    return np.sort(terms.toArrow().column("term").to_numpy().view(np.uint64))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without a hit, with all their columns. Rows without an id, and rows that share
    an id with another text, are judged each by its own text."""
    gone, key = free_name(docs, "_gone"), free_name(docs, "_key")
    docs = keyed(docs, key, id_col, text_col)
    bad = contamination(docs, items, id_col=key, text_col=text_col).filter("contaminated")
    bad = stored(bad.select(F.col("doc_id").alias(gone)).distinct(), "contaminated")
    return docs.join(hinted(bad), F.col(key) == F.col(gone), "left_anti").drop(key)
