"""Near duplicates by SetSketch registers.

A document is its set of distinct five-word shingles. Its sketch holds, for each register, the
smallest of the elements' exponential variates on a logarithmic scale, truncated to 16 bits, so that
sketches of parts merge by the larger register. Equal registers are as likely as two sets are
alike: bands of registers find candidates, the joint likelihood of the registers of two documents
estimates their similarity, and links are confirmed on the whole sets.

Copies with one and the same set are one class before any candidate is sought. A bucket is first
compared with its smallest member only; what then lies in one component needs no further pair.
Documents of a bucket that are still apart are compared with each other in blocks, by estimate, and
verified if the estimate allows it. So a bucket of thousands of near copies gives about as many
pairs as it has members, and no bucket is cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm import textbytes as tb
from newsloom.llm.graph import components
from newsloom.llm.tables import column, free_name, hinted, keyed, partitions, stored

SHINGLE = 5
BANDS, ROWS = 32, 3  # documents of similarity 0.75 miss each other once in 40 million pairs
REGISTERS = BANDS * ROWS
BASE, RATE, LARGEST = 1.001, 20.0, 65535  # of the logarithmic register scale
#: Pairs that pass the estimate are verified; at similarity 0.75 it lies six deviations higher.
LEAST_ESTIMATE = 0.5
BLOCK = 1024
#: Rows of a task that compares documents still apart; a row costs up to BLOCK comparisons, whatever its bytes.
ROWS_APART = 4096

_SALT = np.uint64(0xA24BAED4963EE407)
_FACTORS = tb.splitmix(REGISTERS, 4242) | np.uint64(1)


def shingle_sets(texts: pa.Array):
    """For each text its sorted distinct shingle hashes; empty without words."""
    data, offsets = tb.raw(texts)
    for _, piece, bounds in tb.sliced(data, offsets):
        hashes, first = tb.words(piece, bounds, tb.SPACED)
        n = len(hashes)
        rolled = hashes.copy()
        for k in range(1, SHINGLE):
            rolled = (rolled ^ (rolled >> np.uint64(29))) * _SALT
            rolled[: max(n - k, 0)] += hashes[k:]
        rolled = tb.mix(rolled)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= SHINGLE:
                yield _distinct(rolled[a : b - SHINGLE + 1])
            elif a == b:
                yield hashes[:0]
            else:
                whole = np.array([b - a], np.uint64)
                for k in range(a, b):
                    whole = tb.mix(whole * _SALT + hashes[k])
                yield whole


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))]


def smallest(elements: np.ndarray) -> np.ndarray:
    """For each register the smallest hash of the elements, taken in blocks."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(elements), 4096):
        np.minimum(low, (elements[i : i + 4096, None] * _FACTORS).min(axis=0), out=low)
    return low


def registers(low: np.ndarray) -> np.ndarray:
    """Truncated registers floor(1 - log_b(h)) of exponential variates h with rate RATE."""
    uniform = (low.astype(np.float64) + 0.5) / 2.0**64
    h = -np.log1p(-np.minimum(uniform, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LARGEST).astype(np.uint16)


def merged(sketches: np.ndarray) -> np.ndarray:
    """The sketch of a union from the sketches (one a row) of its parts."""
    return sketches.max(axis=0)


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Most likely similarity of sets of sizes nx and ny, from how many registers of the one are
    larger, smaller and equal (one pair a row)."""
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    equal = x.shape[1] - more - less
    u = nx / (nx + ny)
    v = 1 - u
    c = (BASE - 1) / BASE
    p = lambda z: -np.log1p(-np.clip(z, 1e-12, 1) * c) / np.log(BASE)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        return more * np.log(up) + less * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    golden = (5**0.5 - 1) / 2
    for _ in range(30):
        a, b = high - golden * (high - low), low + golden * (high - low)
        right = likelihood(a) < likelihood(b)
        low, high = np.where(right, a, low), np.where(right, high, b)
    return (low + high) / 2


def likely(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, least: float = LEAST_ESTIMATE) -> np.ndarray:
    """Whether estimate() is at least so much. The likelihood is concave, so its slope there tells."""
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    equal = REGISTERS - more - less
    u = nx / (nx + ny)
    v = 1 - u
    possible = np.minimum(u / v, v / u) >= least
    c, log = (BASE - 1) / BASE, np.log(BASE)
    a, b = np.clip(u - v * least, 1e-12, 1), np.clip(v - u * least, 1e-12, 1)
    up, down = -np.log1p(-a * c) / log, -np.log1p(-b * c) / log
    up_slope, down_slope = -v * c / ((1 - a * c) * log), -u * c / ((1 - b * c) * log)
    rest = np.maximum(1 - up - down, 1e-12)
    return possible & (more * up_slope / up + less * down_slope / down - equal * (up_slope + down_slope) / rest >= 0)


def _as_rows(cell: pa.Array, dtype, width: int) -> np.ndarray:
    data, offsets = np.frombuffer(cell.buffers()[2], np.uint8), np.frombuffer(cell.buffers()[1], np.int32)
    at = offsets[cell.offset : cell.offset + len(cell) + 1]
    return data[at[0] : at[-1]].view(dtype).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _whole(batch: pa.RecordBatch, name: str) -> pa.Array:
    cell = batch.column(name)
    return cell.combine_chunks() if isinstance(cell, pa.ChunkedArray) else cell


def sketched(docs: DataFrame) -> DataFrame:
    """(id, n, f1, f2, sketch) of (id, text): set size, fingerprints and registers of the set."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n, f1, f2, rows = [], [], [], []
                for found in shingle_sets(part.column("text")):
                    n.append(len(found))
                    f1.append(found.sum(dtype=np.uint64))
                    f2.append(np.bitwise_xor.reduce(tb.mix(found + _SALT)) if len(found) else np.uint64(0))
                    rows.append(smallest(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(n, pa.int64()),
                        pa.array(np.array(f1, np.uint64).view(np.int64)),
                        pa.array(np.array(f2, np.uint64).view(np.int64)),
                        _binary(registers(np.array(rows, np.uint64).reshape(-1, REGISTERS))),
                    ],
                    ["id", "n", "f1", "f2", "sketch"],
                )

    return docs.select("id", "text").mapInArrow(run, "id long, n long, f1 long, f2 long, sketch binary")


def banded(classes: DataFrame) -> DataFrame:
    """(bucket, id): a row for each band of each class."""

    def run(batches):
        salt = tb.splitmix(BANDS, 99)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                cells = _as_rows(_whole(part, "sketch"), np.uint16, REGISTERS).astype(np.uint64)
                cells = cells.reshape(-1, BANDS, ROWS)
                key = salt[None, :]
                for k in range(ROWS):
                    key = tb.mix(key + cells[:, :, k])
                ids = np.repeat(part.column("id").to_numpy(zero_copy_only=False), BANDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(ids, pa.int64())], ["bucket", "id"]
                )

    return classes.select("id", "sketch").mapInArrow(run, "bucket long, id long")


def plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose registers make the wanted similarity likely enough to verify."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (_as_rows(_whole(batch, c), np.uint16, REGISTERS) for c in ("sketch_a", "sketch_b"))
                nx, ny = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                good = pa.array(likely(x, y, nx, ny))
                yield batch.select(["a", "b"]).filter(good)

    side = lambda s: sketches.select(
        F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")
    )
    near = 100 * F.least("n_a", "n_b") >= 75 * F.greatest("n_a", "n_b")
    return (
        pairs.join(side("b"), "b").join(side("a"), "a").filter(near)
        .select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long").distinct()
    )


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike: 100 * intersection >= 75 * union."""

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(c.as_buffer(), np.uint64) for c in (x, y))
                both = np.sort(np.concatenate((x, y)), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= 75 * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda s: sets.select(F.col("id").alias(s), F.col("set").alias(f"set_{s}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def apart(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """What to compare yet of documents that share a bucket but no component, members being
    (bucket, id, component, size) with the size of the component. Rows (id, other, whole): two
    documents without a link so far (whole is false), or a document and a larger component of which
    a member in the bucket is plausible, to be compared with all of it (whole is true, other names
    the component). So a document next to a large component is one row, not one for each member.
    Members meet block by block."""

    def run(table):
        ids, component, size, side, n = (table.column(c).to_numpy() for c in ("id", "component", "size", "side", "n"))
        cells = _as_rows(table.column("sketch").combine_chunks(), np.uint16, REGISTERS)
        # One end of a pair at least is outside of the block's largest component.
        names, counts = np.unique(component, return_counts=True)
        outside = component != names[counts.argmax()]
        places = np.arange(len(ids))
        rows = [np.zeros((0, 3), np.int64)]
        # Two documents that share several buckets meet in that of their first common band.
        shift = (16 * np.arange(ROWS)).astype(np.uint64)
        bands = (cells.reshape(-1, BANDS, ROWS).astype(np.uint64) << shift).sum(axis=2, dtype=np.uint64)
        band = (bands == bands[0]).all(axis=0).argmax()
        earlier = np.ascontiguousarray(bands[:, :band])
        for i in np.flatnonzero(outside).tolist():
            fresh = (component != component[i]) & (~outside | (places > i)) & ((side != side[i]) | (side[i] == 0))
            other = np.flatnonzero(fresh & (100 * np.minimum(n, n[i]) >= 75 * np.maximum(n, n[i])))
            other = other[~(earlier[other] == earlier[i]).any(axis=1)]
            other = other[(cells[other] == cells[i]).sum(axis=1) >= 0.4 * REGISTERS]
            if not len(other):
                continue
            other = other[likely(cells[i : i + 1], cells[other], float(n[i]), n[other].astype(float))]
            single = (size[other] == 1) & (size[i] == 1)
            larger = (size[other] > size[i]) | ((size[other] == size[i]) & (component[other] > component[i]))
            found = np.empty((len(other), 3), np.int64)
            found[:, 0] = np.where(single, np.minimum(ids[other], ids[i]), np.where(larger, ids[i], ids[other]))
            found[:, 1] = np.where(single, np.maximum(ids[other], ids[i]), np.where(larger, component[other], component[i]))
            found[:, 2] = ~single
            rows.append(np.unique(found, axis=0))
        found = np.unique(np.concatenate(rows), axis=0)
        return pa.table({"id": found[:, 0], "other": found[:, 1], "whole": found[:, 2].astype(bool)})

    torn = members.groupBy("bucket").agg(
        F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_size")
    ).filter("_low < _high")
    blocks = F.ceil(F.col("_size") / BLOCK).cast("int")
    torn = torn.select("bucket", blocks.alias("blocks"))
    placed = stored(members.join(torn, "bucket").withColumn("block", _part("id", "blocks")), "placed")
    # A stated number of tasks, which Spark does not join by their few bytes.
    rows = placed.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    dealt = (
        placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(sketches.select("id", "n", "sketch"), "id")
        .select(
            "bucket",
            F.least("block", "with").alias("i"),
            F.greatest("block", "with").alias("j"),
            "id",
            "component",
            "size",
            F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2).alias("side"),
            "n",
            "sketch",
        )
    )
    dealt = dealt.repartition(partitions(members.sparkSession, rows, ROWS_APART), "bucket", "i", "j")
    return dealt.groupBy("bucket", "i", "j").applyInArrow(run, "id long, other long, whole boolean").distinct()


def _part(name: str, parts: str) -> Column:
    return F.pmod(F.xxhash64(name), F.col(parts)).cast("int")


def linked_to_component(tests: DataFrame, at: DataFrame, sets: DataFrame) -> DataFrame:
    """For (id, component) to test: a link (a, b) between the document and a member of the component,
    if there is one. Members and documents are dealt in blocks; a task finds the intersections
    of a document with all members of its block at once, from the members' elements in order."""

    def run(table):
        ids, tested = table.column("id").to_numpy(), table.column("tested").to_numpy(zero_copy_only=False)
        held = [np.frombuffer(c.as_buffer(), np.uint64) for c in table.column("set")]
        members, wanted = np.flatnonzero(~tested), np.flatnonzero(tested)
        a, b = [], []
        if len(members) and len(wanted):
            sizes = np.array([len(held[m]) for m in members])
            elements = np.concatenate([held[m] for m in members])
            whose = np.repeat(np.arange(len(members)), sizes)
            order = np.argsort(elements, kind="stable")
            elements, whose = elements[order], whose[order]
            for w in wanted.tolist():
                first = np.searchsorted(elements, held[w])
                length = np.searchsorted(elements, held[w], side="right") - first
                hits = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
                shared = np.bincount(whose[hits], minlength=len(members))
                alike = np.flatnonzero(100 * shared >= 75 * (sizes + len(held[w]) - shared))
                if len(alike):
                    a.append(ids[w])
                    b.append(ids[members[alike[0]]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    count = lambda n: F.ceil(F.count("*") / n).cast("int")
    shape = (
        at.join(tests.select("component").distinct(), "component", "left_semi").groupBy("component")
        .agg(count(BLOCK // 2).alias("blocks")).join(tests.groupBy("component").agg(count(BLOCK).alias("lots")), "component")
    )
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = at.select(F.col("node").alias("id"), "component").join(shape, "component")
    members = members.select("id", "component", _part("id", "blocks").alias("block"), every("lots").alias("lot"), F.lit(False).alias("tested"))
    wanted = tests.join(shape, "component")
    wanted = wanted.select("id", "component", every("blocks").alias("block"), _part("id", "lots").alias("lot"), F.lit(True).alias("tested"))
    dealt = members.unionByName(wanted).join(sets, "id")
    return dealt.groupBy("component", "block", "lot").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row.

    Rows whose shingle sets have 100 * intersection >= 75 * union are linked; component_id is the
    smallest id that can be reached, itself included, and kept marks that id. A null or empty text
    has no shingles and links with nothing, also not with other empty ones. Rows that share an id
    are one node; rows without an id are in no group (component_id null, kept true). An empty table
    gives an empty table. Other columns are not looked at.
    """
    docs = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    rows = stored(sketched(docs), "sketches")
    classes = stored(
        rows.filter("n > 0 and id is not null").groupBy("f1", "f2", "n").agg(
            F.min("id").alias("id"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    bands = banded(classes)
    shared = bands.groupBy("bucket").agg(F.count("*").alias("size"), F.min("id").alias("center")).filter("size > 1")
    members = stored(bands.join(shared, "bucket").select("bucket", "id", "center"), "members")

    ids = members.select("id").distinct()
    sketches = stored(classes.join(hinted(ids), "id", "left_semi"), "candidates")

    def sets_of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = pa.array([s.tobytes() for s in shingle_sets(part.column("text"))], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("id"), found], ["id", "set"])

    texts = docs.join(hinted(ids), "id", "left_semi").select("id", "text")
    sets = stored(texts.mapInArrow(sets_of, "id long, set binary"), "sets")

    # Each document with the smallest center of its buckets, then with its other centers, then with
    # whatever shares a bucket and is still in another component.
    star = members.filter("center < id").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    first = plausible(star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), sketches)
    tested = stored(first, "tested")
    links = stored(confirmed(tested, sets), "links")
    at = components(links)
    second = stored(plausible(_split(star, at).join(tested, ["a", "b"], "left_anti"), sketches), "tested")
    links, at = _with(links, at, confirmed(second, sets))
    sizes = at.groupBy("component").agg(F.count("*").alias("size"))
    placed = _at(members, at, "id", "component").join(sizes, "component", "left").fillna(1, ["size"])
    rest = stored(apart(placed, sketches), "rest")
    pairs = rest.filter("not whole").select(F.col("id").alias("a"), F.col("other").alias("b"))
    tests = rest.filter("whole").select("id", F.col("other").alias("component"))
    pairs = pairs.join(tested.unionByName(second), ["a", "b"], "left_anti")
    links, at = _with(links, at, confirmed(pairs, sets).unionByName(linked_to_component(tests, at, sets)))
    at = at.select(F.col("node").alias("id"), "component")
    groups = classes.select("f1", "f2", "n", "id").join(at, "id", "left")
    groups = groups.select("f1", "f2", "n", F.coalesce("component", "id").alias("component"))
    whose = rows.select("id", "n", "f1", "f2").join(groups, ["f1", "f2", "n"], "left")
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "id"))
    return whose.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == component)).alias("kept"),
    )


def _at(df: DataFrame, at: DataFrame, name: str, to: str) -> DataFrame:
    """df with the component of column name as column to; its own if it has no link."""
    where = at.select(F.col("node").alias(name), F.col("component").alias("_component"))
    return df.join(where, name, "left").withColumn(to, F.coalesce("_component", name)).drop("_component")


def _with(links: DataFrame, at: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links with more, and the components of both."""
    more = stored(more, "links")
    if more.isEmpty():
        return links, at
    links = links.unionByName(more)
    return links, components(links)


def _split(pairs: DataFrame, at: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    return _at(_at(pairs, at, "a", "_x"), at, "b", "_y").filter("_x != _y").select("a", "b")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that near_duplicates() keeps, with all their columns. Rows without an id are
    documents of their own before all others, as are the texts of an id that has several. Rows
    that share a kept id and its text all stay."""
    gone, key = free_name(docs, "_gone"), free_name(docs, "_key")
    docs = keyed(docs, key, id_col, text_col)
    found = near_duplicates(docs, key, text_col).filter("not kept").select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(hinted(found), F.col(key) == F.col(gone), "left_anti").drop(key)
