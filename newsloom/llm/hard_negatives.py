"""Hard negatives by a vertical scan (BOND) over blocks of vectors.

A task turns its rows into blocks that hold one array for each dimension, with its least and largest value. For
an anchor the dimensions are read in the order in which its own components fall in size. After every few, the
rows whose sum so far cannot reach what is sought, or must exceed it, whatever the remaining dimensions bring
within the block's bounds, leave the set of candidates; what is left at the end has its exact score. What
is sought tightens as better rows are found.

There are two scans: the first finds each anchor's positives, whose scores give the windows of scores in which
the second looks for rows of other labels. Anchors go to the tasks in batches of bounded size, and the
vectors, which never move, are scanned for each batch.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm.tables import column, stored
from newsloom.operators.ranking import keep_first, top_k

#: Anchors that are handed to every task at once, and bytes of their vectors.
ANCHOR_ROWS, ANCHOR_BYTES = 8192, 32 << 20
BLOCK_ROWS = 16_384
#: Rows of a task's first block, whose best raise what the other rows must reach.
FIRST_ROWS = 512
STEP = 8  # dimensions that are read between two looks at the bounds


class Block:
    """Some rows by dimension. Components are whole numbers, held as doubles where sums stay exact."""

    def __init__(self, ids: np.ndarray, labels: pa.Array, vectors: np.ndarray):
        self.ids = ids
        coded = labels.dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.code_of = {x: i for i, x in enumerate(coded.dictionary.to_pylist())}
        self.columns = np.ascontiguousarray(vectors.T)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def of_label(self, label, same: bool) -> np.ndarray:
        code = self.code_of.get(label, -1)
        return np.flatnonzero((self.codes == code) == same)

    def scan(self, q: np.ndarray, rows: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of all given rows that score between low and high."""
        d = min(len(q), len(self.columns))
        order = np.argsort(-np.abs(q[:d]), kind="stable")
        order = order[q[order] != 0]
        ends = q[order] * self.least[order], q[order] * self.most[order]
        rest_most, rest_least = (np.append(np.cumsum(f(*ends)[::-1])[::-1], 0) for f in (np.maximum, np.minimum))
        sums = np.zeros(len(rows), self.columns.dtype)
        for at in range(0, len(order), STEP):
            dims, after = order[at : at + STEP], min(at + STEP, len(order))
            part = self.columns[dims] if len(rows) == len(self.ids) else self.columns[dims[:, None], rows]
            sums = sums + q[dims] @ part
            kept = (sums + rest_most[after] >= low) & (sums + rest_least[after] <= high)
            if not kept.all():
                rows, sums = rows[kept], sums[kept]
            if not len(rows):
                return rows, sums
        kept = (sums >= low) & (sums <= high)
        return rows[kept], sums[kept]


class Best:
    """The best rows so far, higher scores first, ties to the smaller id."""

    def __init__(self, k: int, low: float = -math.inf, high: float = math.inf):
        self.k, self.low, self.high = k, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def needed(self) -> float:
        """The least score that can still enter."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, ids: np.ndarray, scores: np.ndarray):
        kept = (scores >= self.needed()) & (scores <= self.high)
        ids, scores = np.concatenate((self.ids, ids[kept])), np.concatenate((self.scores, scores[kept].astype(np.int64)))
        order = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[order], scores[order]


class Anchors:
    """A batch of anchors as tasks get it."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("id").to_pylist()
        self.labels = table.column("label").to_pylist()
        self.vectors = matrix(table.column("v").combine_chunks())
        names = table.schema.names
        self.windows = table.column("windows").to_pylist() if "windows" in names else None


def matrix(lists: pa.Array) -> np.ndarray:
    """Lists as rows of one width; missing components are 0."""
    size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(size.max()) if len(size) else 0
    if (size == width).all():
        return values.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = values
    return out


def _exact(anchors: np.ndarray, vectors: np.ndarray) -> type:
    """The type in which all scores are exact."""
    top = [max(-int(x.min()), int(x.max())) if x.size else 0 for x in (anchors, vectors)]
    bound = top[0] * top[1] * max(1, min(anchors.shape[1], vectors.shape[1]))
    if bound >= 1 << 62:
        raise OverflowError("a score does not fit into 64 bits")
    return np.float64 if bound < 1 << 52 else np.int64


def _blocks(batches) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(ids, labels, vectors) of a few hundred rows first, then of up to BLOCK_ROWS."""
    held, n, want = [], 0, FIRST_ROWS

    def made(rows: pa.Table):
        label = rows.column("label").combine_chunks()
        return rows.column("id").to_numpy(), label, matrix(rows.column("v").combine_chunks())

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        while n >= want:
            table = pa.Table.from_batches(held)
            yield made(table.slice(0, want))
            rest = table.slice(want)
            held, n, want = rest.to_batches(), rest.num_rows, BLOCK_ROWS
    if n:
        yield made(pa.Table.from_batches(held))


def _task(shared, start: Callable, same: bool, names: list[str]):
    """A task that scans its rows for each anchor. start gives the sets that an anchor fills, by the
    columns that name them."""

    def run(batches):
        anchors = Anchors(shared.value)
        sets = [start(anchors, i) for i in range(len(anchors.ids))]
        for ids, labels, vectors in _blocks(batches):
            kind = _exact(anchors.vectors, vectors)
            block, queries = Block(ids, labels, vectors.astype(kind)), anchors.vectors.astype(kind)
            rows_of: dict = {}
            for i, (own, label) in enumerate(zip(anchors.ids, anchors.labels)):
                if label not in rows_of:
                    rows_of[label] = block.of_label(label, same)
                low = min((b.needed() for _, b in sets[i]), default=math.inf)
                high = max((b.high for _, b in sets[i]), default=-math.inf)
                rows, scores = block.scan(queries[i], rows_of[label], low, high)
                other = block.ids[rows] != own
                for _, best in sets[i]:
                    best.add(block.ids[rows][other], scores[other])
        found = [(a, *key, best) for a, mine in zip(anchors.ids, sets) for key, best in mine]
        n = [len(x[-1].ids) for x in found]
        heads = [pa.array(np.repeat(np.array([x[c] for x in found], np.int64), n)) for c in range(len(names) - 2)]
        tails = [np.concatenate([getattr(x[-1], c) for x in found] or [np.zeros(0, np.int64)]) for c in ("ids", "scores")]
        yield pa.RecordBatch.from_arrays([*heads, *[pa.array(x) for x in tails]], names)

    return run


def _scanned(vectors: DataFrame, anchors: DataFrame, start: Callable, same: bool, keys: list[str], k: int) -> DataFrame:
    """The k best of each anchor and key, a scan of the vectors for each batch of anchors."""
    spark, names = vectors.sparkSession, ["anchor_id", *keys, "other_id", "score"]
    schema = ", ".join(f"{c} long" for c in names)
    n, width = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    each = max(1, min(ANCHOR_ROWS, ANCHOR_BYTES // (8 * max(1, width))))
    # Batches are made by a hash; half of the room is left for those that come out larger.
    n_batches = 1 if n <= each else math.ceil(2 * n / each)
    batch = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(n_batches))
    parts = []
    for i in range(n_batches):
        shared = spark.sparkContext.broadcast(anchors.where(batch == i).toArrow())
        found = vectors.select("id", "label", "v").mapInArrow(_task(shared, start, same, names), schema)
        best = top_k(found, ["anchor_id", *keys], [F.desc("score"), F.col("other_id")], k, two_rounds=True)
        parts.append(best if n_batches == 1 else stored(best, "best"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def usable(rows: DataFrame, anchors: Column, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v, anchor): rows that take part, components as whole numbers floor(scale * x)."""
    vector, x = column(vector_col), lambda x: x.cast("double")
    unfit = F.exists(vector, lambda c: c.isNull() | F.isnan(x(c)) | (F.abs(x(c)) == float("inf")))
    held = rows.where(column(id_col).isNotNull() & column(label_col).isNotNull() & vector.isNotNull() & ~unfit).select(
        column(id_col).cast("long").alias("id"),
        column(label_col).alias("label"),
        F.transform(vector, lambda c: F.floor(x(c) * scale)).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    held = stored(held, "vectors")
    if held.groupBy("id").count().where("count > 1").isEmpty():
        return held
    return stored(keep_first(held, [F.col("id")], [F.col("label"), F.col("v"), F.col("anchor").desc()]), "vectors")


def mined(
    rows: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    anchors is a condition on rows. A row's score is the inner product of the whole components floor(scale * x)
    with the anchor's. An anchor's positives are its best other rows of the same label; to each come the best rows of
    other labels that score from low to high percent of the positive. Ties go to the smaller id.

    Rows with a null id, label or vector, or a component that is null or not finite, take no part. Rows that
    share an id count once, the first by label and vector. Shorter vectors count as ending in zeros. An
    anchor without positives, and a positive without negatives or with a score below 0, gives no row; nor
    does an empty table. A score beyond 62 bits is an error.
    """
    vectors = usable(rows, anchors, scale, id_col, label_col, vector_col)
    chosen = vectors.where("anchor").select("id", "label", "v")
    near = _scanned(vectors, chosen, lambda a, i: [((), Best(positives))], True, [], positives)
    score = F.col("score")
    near = near.where(score >= 0).select(
        "anchor_id",
        F.col("other_id").alias("positive_id"),
        score.alias("positive_score"),
        F.ceil(score * low / F.lit(100).cast("decimal(20,0)")).cast("long").alias("low"),
        F.floor(score * high / F.lit(100).cast("decimal(20,0)")).cast("long").alias("high"),
    )
    near = stored(near, "positives")
    windows = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set(F.struct("low", "high")).alias("windows"))
    start = lambda a, i: [((w["low"], w["high"]), Best(negatives, w["low"], w["high"])) for w in a.windows[i]]
    hard = _scanned(vectors, chosen.join(windows, "id"), start, False, ["low", "high"], negatives)
    return near.join(hard, ["anchor_id", "low", "high"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
