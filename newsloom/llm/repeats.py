"""Removal of long repeated byte strings by a run-length compressed index.

A byte goes if a string of LENGTH bytes over it begins earlier too, in a smaller document or earlier
in the same one. To bring equal strings together, each window of LENGTH bytes names an anchor: the
leftmost of its GRAM-byte strings with the smallest hash. Equal windows have equal anchors. A run of
neighbouring windows with one anchor is a context; contexts are dealt out by their anchor's hash.

Equal contexts are folded first, in the task that reads them and again where they meet: all but the
earliest are repeats as a whole. Only where an anchor has several different contexts can some of their
windows be equal. These contexts are fetched from the texts and each is cut in two: windows with half of
their other bytes or more before the anchor, and the rest. Equal windows are in the same half, and agree in
its core: the anchor with the bytes before it, or behind it, that all windows of the half have. Halves are
dealt out by their cores, so an anchor with many surroundings does not stay in one task, and a half whose
core no other has is done. Over the different ones left, bucket by bucket, a run-length Burrows-Wheeler
index is built; each streams its matching statistics against it, and a window whose match is long enough
and begins earlier is a repeat.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsloom.llm import textbytes as tb
from newsloom.llm.run_index import DEPTH as LENGTH, repeated_windows
from newsloom.llm.tables import column, keyed, stored

GRAM = 32
_GRAMS = LENGTH - GRAM + 1  # in a window
_HALF = (LENGTH - GRAM) // 2  # bytes before the anchor from which a window is in the first half
#: Bytes of text for each bucket, contexts that a task folds at once, and contexts cut at once.
BUCKET_BYTES = 16 << 20
FOLD = 1_000_000
CUT = 1 << 14
_CHUNK = 1 << 22  # windows of one text worked on at once; places in a chunk fit 24 bits
_LOW = np.uint64(0xFFFFFF)


def _sliding_smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each width neighbours, from running minima of blocks in both directions."""
    n = len(keys)
    room = -(-n // width) * width
    blocks = np.full(room, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def contexts(data: np.ndarray, offsets: np.ndarray):
    """(row, first window, number of windows, bytes from there to the anchor, anchor hash, context hash) of
    all contexts."""
    if len(data) > _CHUNK + LENGTH and len(offsets) == 2:
        for at in range(0, len(data) - LENGTH + 1, _CHUNK):
            piece = data[at : at + _CHUNK + LENGTH - 1]
            for row, first, *more in contexts(piece, np.array([0, len(piece)])):
                yield row, first + at, *more
        return
    if len(data) < LENGTH:
        return
    sums, back = tb.prefix_hashes(data)
    grams = tb.mix((sums[GRAM:] - sums[:-GRAM]) * back[: len(data) - GRAM + 1])
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_smallest(keys, _GRAMS) & _LOW).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int8)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    inside[offsets[long]] += 1
    inside[offsets[long + 1] - LENGTH + 1] -= 1
    inside = np.cumsum(inside[: len(at)], dtype=np.int8).astype(bool)
    turn = np.ones(len(at) + 1, bool)
    turn[1:-1] = (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
    edges = np.flatnonzero(turn)
    first, stop = edges[:-1], edges[1:]
    kept = inside[first]
    first, stop = first[kept], stop[kept]
    row = np.searchsorted(offsets, first, side="right") - 1
    whole = tb.span_hashes(sums, back, first, stop + LENGTH - 1)
    yield row, first - offsets[row], stop - first, at[first] - first, grams[at[first]], whole


_CONTEXT = np.dtype([("anchor", "<u8"), ("whole", "<u8"), ("doc", "<i8"), ("first", "<u4"), ("n", "u1"), ("lead", "u1")])
_SPAN = np.dtype([("doc", "<i8"), ("start", "<u4"), ("end", "<u4")])


def _earliest(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(earliest of equal contexts, later ones), of contexts in any order."""
    if not len(found):
        return found, found
    order = np.argsort(found["whole"])
    whole = found["whole"][order]
    same = np.zeros(len(whole) + 1, bool)
    same[1:-1] = whole[1:] == whole[:-1]
    several = same[1:] | same[:-1]
    alone, found = found[order[~several]], found[order[several]]
    found = found[np.lexsort((found["first"], found["doc"], found["whole"], found["anchor"]))]
    new = np.ones(len(found), bool)
    new[1:] = (found["whole"][1:] != found["whole"][:-1]) | (found["anchor"][1:] != found["anchor"][:-1])
    lead = found[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = (found["doc"] != lead["doc"]) | (found["first"] != lead["first"])
    return np.concatenate((alone, found[new])), found[later]


def _spans(found: np.ndarray) -> np.ndarray:
    """The merged byte spans of contexts."""
    found = found[np.lexsort((found["first"], found["doc"]))]
    start = found["first"].astype(np.int64)
    end = start + found["n"] + LENGTH - 1
    return merged(found["doc"], start, end)


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal spans of spans sorted by doc and start."""
    out = np.zeros(0, _SPAN)
    if len(doc):
        which = np.concatenate(([0], np.cumsum(doc[1:] != doc[:-1])))
        room = int(end.max()) + 1
        reach = np.maximum.accumulate(which * room + end)
        new = np.concatenate(([True], which[1:] * room + start[1:] > reach[:-1]))
        at = np.flatnonzero(new)
        out = np.zeros(len(at), _SPAN)
        out["doc"], out["start"] = doc[at], start[at]
        last = np.append(at[1:], len(doc)) - 1
        out["end"] = reach[last] - which[last] * room
    return out


def _dealt(found: np.ndarray, kind: int, key: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket with its part of found as bytes."""
    to = (tb.mix(key.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    to, found = to[order], found[order]
    at = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
    stop = np.append(at[1:], len(to))
    cells = [found[a:b].tobytes() for a, b in zip(at.tolist(), stop.tolist())]
    return pa.RecordBatch.from_arrays(
        [pa.array(to[at], pa.int32()), pa.array([kind] * len(at), pa.int32()), pa.array(cells, pa.binary())], ["bucket", "kind", "cell"]
    )


def _read(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, kind, cell): contexts (kind 0) by anchor, folded, and spans that are repeats (kind 1)."""

    def fold(held):
        found = np.concatenate(held)
        first, later = _earliest(found)
        if len(first):
            yield _dealt(first, 0, first["anchor"], buckets)
        if len(later):
            spans = _spans(later)
            yield _dealt(spans, 1, spans["doc"], buckets)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            data, offsets = tb.raw(batch.column("text"))
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for at, piece, bounds in tb.sliced(data, offsets):
                for row, first, count, lead, anchor, whole in contexts(piece, bounds):
                    found = np.zeros(len(row), _CONTEXT)
                    found["anchor"], found["whole"], found["doc"] = anchor, whole, ids[at + row]
                    found["first"], found["n"], found["lead"] = first, count, lead
                    held.append(found)
                    n += len(found)
                    if n >= FOLD:
                        yield from fold(held)
                        held, n = [], 0
        if held:
            yield from fold(held)

    return docs.mapInArrow(run, "bucket int, kind int, cell binary")


_FOUND = "id long, spans binary, contexts binary"


def _met(table):
    """For the rows of a bucket: spans that are repeats, and contexts whose anchor has others, by document."""
    kinds = table.column("kind").to_numpy()
    cells = [c.as_buffer() for c in table.column("cell")]
    of = lambda kind, dtype: np.concatenate(
        [np.zeros(0, dtype), *[np.frombuffer(c, dtype) for c, k in zip(cells, kinds) if k == kind]]
    )
    found, known = of(0, _CONTEXT), of(1, _SPAN)
    order = np.argsort(found["anchor"], kind="stable")
    anchor = found["anchor"][order]
    same = np.zeros(len(anchor) + 1, bool)
    same[1:-1] = anchor[1:] == anchor[:-1]
    first, later = _earliest(found[order[same[1:] | same[:-1]]])
    first = first[np.argsort(first["anchor"])]
    anchor = first["anchor"]
    same = np.zeros(len(anchor) + 1, bool)
    same[1:-1] = anchor[1:] == anchor[:-1]
    several = first[same[1:] | same[:-1]]
    spans = np.concatenate((known, _spans(later)))
    spans = spans[np.lexsort((spans["start"], spans["doc"]))]
    several = several[np.lexsort((several["first"], several["doc"]))]
    ids = np.union1d(spans["doc"], several["doc"])
    cut = lambda x: [p.tobytes() for p in np.split(x, np.searchsorted(x["doc"], ids[1:]))] if len(ids) else []
    return pa.table(
        {"id": pa.array(ids, pa.int64()), "spans": pa.array(cut(spans), pa.binary()), "contexts": pa.array(cut(several), pa.binary())}
    )


_TEXTS = np.dtype([("core", "<u8"), ("doc", "<i8"), ("first", "<u4"), ("size", "<u4")])


def halves(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(index of the context, first byte, end, start of the core) of the halves of contexts, bytes counted
    from the document's first one. The core of a first half has _HALF bytes before the anchor, that of a second the
    more bytes behind it; all windows of the half have them."""
    first, n, lead = (found[c].astype(np.int64) for c in ("first", "n", "lead"))
    before = np.clip(lead - _HALF + 1, 0, n)
    a, b = np.flatnonzero(before), np.flatnonzero(before < n)
    start = np.concatenate((first[a], first[b] + before[b]))
    end = np.concatenate((first[a] + before[a], first[b] + n[b])) + LENGTH - 1
    core = np.concatenate((first[a] + lead[a] - _HALF, first[b] + lead[b]))
    return np.concatenate((a, b)), start, end, core


_CORE = GRAM + _HALF


def _fetched(buckets: int):
    """From rows (id, text, contexts): rows (bucket, places, bytes) of halves of contexts with their bytes."""

    def cut(data, offsets, found, row):
        sums, back = tb.prefix_hashes(data)
        for at in range(0, len(found), CUT):
            part, base = found[at : at + CUT], offsets[row[at : at + CUT]]
            which, start, end, core = halves(part)
            base = base[which]
            places = np.zeros(len(which), _TEXTS)
            places["core"] = tb.span_hashes(sums, back, base + core, base + core + _CORE)
            places["doc"], places["first"], places["size"] = part["doc"][which], start, end - start
            to = (tb.mix(places["core"]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            to, places, begin = to[order], places[order], (base + start)[order]
            edges = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1], [True])))
            size = places["size"].astype(np.int64)
            before = np.cumsum(size) - size
            body = data[np.repeat(begin - before, size) + np.arange(size.sum())].tobytes()
            before = np.append(before, len(body))
            cells = [places[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
            bodies = [body[before[a] : before[b]] for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[edges[:-1]], pa.int32()), pa.array(cells, pa.binary()), pa.array(bodies, pa.binary())],
                ["bucket", "places", "bytes"],
            )

    def run(batches):
        for batch in batches:
            data, offsets = tb.raw(batch.column("text"))
            held = [np.concatenate([np.frombuffer(c.as_buffer(), _CONTEXT) for c in cells]) for cells in batch.column("contexts")]
            for at, piece, bounds in tb.sliced(data, offsets):
                here = held[at : at + len(bounds) - 1]
                yield from cut(piece, bounds, np.concatenate(here), np.repeat(np.arange(len(here)), [len(h) for h in here]))

    return run


def _shared_cores(places: np.ndarray) -> np.ndarray:
    """Which places have a core that others have too."""
    _, which, counts = np.unique(places["core"], return_inverse=True, return_counts=True)
    return counts[which] > 1


def _matched(table):
    """Spans of the bucket's halves of contexts that begin earlier too, by document."""
    cells = [np.frombuffer(c.as_buffer(), _TEXTS) for c in table.column("places")]
    body = b"".join(c.as_buffer().to_pybytes() for c in table.column("bytes"))
    places = np.concatenate([np.zeros(0, _TEXTS), *cells])
    ends = np.cumsum(places["size"].astype(np.int64))
    kept = _shared_cores(places)
    places, ends = places[kept], ends[kept]
    order = np.lexsort((places["first"], places["doc"]))
    again = (places["doc"][order[1:]] == places["doc"][order[:-1]]) & (places["first"][order[1:]] == places["first"][order[:-1]])
    order = order[np.concatenate((np.ones(min(len(order), 1), bool), ~again))]  # a row of the table may be there twice
    places, ends = places[order], ends[order]
    texts = [body[e - n : e] for e, n in zip(ends.tolist(), places["size"].tolist())]
    del body
    # Of equal halves all but the earliest are repeats as a whole.
    known = set()
    new = np.array([not (t in known or known.add(t)) for t in texts], bool)
    whole = places[~new]
    doc, start, end = [whole["doc"]], [whole["first"].astype(np.int64)], [whole["first"].astype(np.int64) + whole["size"]]
    kept = np.flatnonzero(new)
    kept = kept[_shared_cores(places[kept])]
    for place, flags in zip(places[kept], repeated_windows([texts[i] for i in kept.tolist()])):
        edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
        if len(edge):
            doc.append(np.full(len(edge) // 2, place["doc"]))
            start.append(int(place["first"]) + edge[::2])
            end.append(int(place["first"]) + edge[1::2] + LENGTH - 1)
    doc, start, end = (np.concatenate(x) for x in (doc, start, end))
    order = np.lexsort((start, doc))
    spans = merged(doc[order], start[order], end[order])
    ids = np.unique(spans["doc"])
    cells = [p.tobytes() for p in np.split(spans, np.searchsorted(spans["doc"], ids[1:]))] if len(ids) else []
    return pa.table({"id": pa.array(ids, pa.int64()), "spans": pa.array(cells, pa.binary())})


def _buckets(spark: SparkSession, docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, spans) of (id, text): for each document with repeats, lists of its spans as binary."""
    spark = docs.sparkSession
    buckets = _buckets(spark, docs)
    met = stored(_read(docs, buckets).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_met, _FOUND), "met")
    wanted = met.filter(F.octet_length("contexts") > 0).groupBy("id").agg(F.collect_list("contexts").alias("contexts"))
    wanted = stored(wanted, "contexts")
    texts = docs.join(wanted, "id").select("id", "text", "contexts")
    fetched = texts.mapInArrow(_fetched(buckets), "bucket int, places binary, bytes binary")
    more = fetched.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_matched, "id long, spans binary")
    spans = met.filter(F.octet_length("spans") > 0).select("id", "spans").unionByName(stored(more, "matched"))
    return stored(spans.groupBy("id").agg(F.collect_list("spans").alias("spans")), "spans")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_bytes, n_bytes, n_removed, n_spans, kept_sha256): what is left of each text.

    A byte is removed if it is covered by LENGTH bytes that begin earlier too: in a document of smaller
    id, or at an earlier place of the same one. Strings are judged on the input and may overlap; no
    string crosses documents. text_bytes are the remaining bytes, which need not be valid UTF-8 where
    a character was cut. Rows repeated with their id and text are one document and each get its row.
    Rows without an id are documents of their own before all others; these, and the texts of an id
    that has several, are in the order of their digests. Null and empty texts have no bytes. An empty
    table gives an empty table; other columns are not looked at.
    """
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    rows = keyed(rows, "id", "doc_id", "text")
    spans = repeated_spans(rows.select("id", "text"))

    def run(batches):
        for batch in batches:
            columns = [[], [], [], [], []]
            for text, cells in zip(batch.column("text"), batch.column("spans")):
                whole = text.as_buffer().to_pybytes() if text.is_valid else b""
                known = [np.frombuffer(c.as_buffer(), _SPAN) for c in cells] if cells.is_valid else []
                found = np.concatenate([np.zeros(0, _SPAN), *known])
                found = found[np.lexsort((found["end"], found["start"]))]
                found = merged(np.zeros(len(found), np.int64), found["start"].astype(np.int64), found["end"].astype(np.int64))
                edges = [0, *np.column_stack((found["start"], found["end"])).ravel().tolist(), len(whole)]
                left = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
                values = (left, len(whole), len(whole) - len(left), len(found), hashlib.sha256(left).hexdigest())
                for c, v in zip(columns, values):
                    c.append(v)
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    names = ["doc_id", "text_bytes", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return rows.join(spans, "id", "left").select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, text_bytes binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
