"""Exact nearest neighbours of a batch of queries.

Vectors stay where the scan puts them. Each task multiplies its Arrow batches with the whole
query batch and keeps a running top-k per query, so a task emits k rows per query however
many vectors it read; a ranked window merges the tasks. A query batch too large to hand to every
task is cut into blocks, and the vectors are scanned once for each; they are never shuffled.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.operators.ranking import top_k
from newsloom.operators.sizing import fits
from newsloom.session import checkpoint

MAX_QUERY_ROWS = 8192
MAX_QUERY_BYTES = 64 << 20
# Tasks that scan the vectors for a block of many, if there are no more cores; each brings k rows of every query.
BLOCK_TASKS = 16
# Queries and vectors that are multiplied at once: a product of 16 MB.
_TILES = 512, 4096

RANK_DIGITS = 9
RESULT = "query_id long, id long, score double, k long"


def _kernel(metric: str, digits: int):
    """Functions that run inside tasks; they carry their imports so that workers need only
    numpy and pyarrow."""
    TILE_QUERIES, TILE_VECTORS = _TILES

    def matrix(column):
        import numpy as np

        if hasattr(column, "combine_chunks"):
            column = column.combine_chunks()
        n = len(column)
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        if n and values.size % n:
            raise ValueError("vectors of different dimensions in one table")
        return values.reshape(n, -1)

    class Queries:
        """A block of queries, read from Arrow columns."""

        def __init__(self, table):
            import numpy as np

            self.ids = np.asarray(table.column("query_id").to_pylist(), dtype=np.int64)
            self.k = np.asarray(table.column("k").to_pylist(), dtype=np.int64)
            self.vectors = matrix(table.column("query_vec"))
            self.squares = (self.vectors**2).sum(axis=1)
            names = table.schema.names
            self.filters = table.column("cell_filter").to_pylist() if "cell_filter" in names else None
            self.by_cell = None
            if "cells" in names:
                self.by_cell = {}
                for i, cells in enumerate(table.column("cells").to_pylist()):
                    for cell in cells:
                        self.by_cell.setdefault(cell, []).append(i)
            self.known = {}

        def wanting(self, cell):
            """Positions of the queries that look into a cell of the vector table."""
            import numpy as np

            if self.by_cell is not None:
                return np.asarray(self.by_cell.get(cell, []), dtype=np.int64)
            if self.filters is None:
                return np.arange(len(self.ids))
            if cell not in self.known:
                hits = [i for i, f in enumerate(self.filters) if f is None or (cell is not None and f in cell)]
                self.known[cell] = np.asarray(hits, dtype=np.int64)
            return self.known[cell]

    class Best:
        """Running top-k per query, best first, ties to the lower id."""

        def __init__(self, queries):
            import numpy as np

            self.q = queries
            self.ids = [np.empty(0, np.int64) for _ in queries.ids]
            self.scores = [np.empty(0) for _ in queries.ids]

        def add(self, batch):
            import numpy as np

            ids = batch.column("id").to_numpy(zero_copy_only=False)
            if len(ids) == 0:
                return
            vectors = matrix(batch.column("embedding"))
            if vectors.shape[1] != self.q.vectors.shape[1]:
                raise ValueError("queries and vectors differ in dimension")
            if "cell" not in batch.schema.names:
                self._add(ids, vectors, np.arange(len(self.q.ids)))
                return
            column = batch.column("cell").dictionary_encode(null_encoding="encode")
            codes = column.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            ends = np.searchsorted(codes[order], np.arange(len(column.dictionary)), side="right")
            first = 0
            for cell, end in zip(column.dictionary.to_pylist(), ends.tolist()):
                rows, first = order[first:end], end
                wanted = self.q.wanting(cell)
                if len(wanted) and len(rows):
                    self._add(ids[rows], vectors[rows], wanted)

        def _add(self, ids, vectors, wanted):
            for i in range(0, len(wanted), TILE_QUERIES):
                for j in range(0, len(ids), TILE_VECTORS):
                    self._tile(ids[j : j + TILE_VECTORS], vectors[j : j + TILE_VECTORS], wanted[i : i + TILE_QUERIES])

        def _tile(self, ids, vectors, wanted):
            import numpy as np

            dots = self.q.vectors[wanted] @ vectors.T
            squares = (vectors**2).sum(axis=1)
            if metric == "cosine":
                scale = np.sqrt(self.q.squares[wanted])[:, None] * np.sqrt(squares)[None, :]
                value = np.divide(dots, scale, out=np.zeros_like(dots), where=scale > 0)
                better = np.round(value, digits)
            else:
                value = np.sqrt(np.maximum(self.q.squares[wanted][:, None] + squares[None, :] - 2 * dots, 0))
                better = -np.round(value, digits)
            # The k-th best value of each query in this tile; everything below it is out.
            k_most = min(int(self.q.k[wanted].max()), len(ids))
            ranked = -np.sort(-np.partition(better, len(ids) - k_most, axis=1)[:, len(ids) - k_most :], axis=1)
            for row, i in enumerate(wanted):
                k = int(self.q.k[i])
                if k < 1:
                    continue
                worth = np.arange(len(ids))
                if len(ids) > k:
                    worth = np.flatnonzero(better[row] >= ranked[row, k - 1])
                all_ids = np.concatenate([self.ids[i], ids[worth]])
                all_scores = np.concatenate([self.scores[i], value[row][worth]])
                key = np.round(all_scores, digits)
                order = np.lexsort((all_ids, -key if metric == "cosine" else key))[:k]
                self.ids[i], self.scores[i] = all_ids[order], all_scores[order]

        def table(self):
            import numpy as np
            import pyarrow as pa

            lengths = [len(x) for x in self.ids]
            return pa.table(
                {
                    "query_id": pa.array(np.repeat(self.q.ids, lengths)),
                    "id": pa.array(np.concatenate(self.ids) if lengths else np.empty(0, np.int64)),
                    "score": pa.array(np.concatenate(self.scores) if lengths else np.empty(0)),
                    "k": pa.array(np.repeat(self.q.k, lengths)),
                }
            )

    return Queries, Best


def by_similarity(metric: str = "cosine", score: str = "score", doc: str = "id") -> list[Column]:
    value = F.round(score, RANK_DIGITS)
    return [value.desc() if metric == "cosine" else value.asc(), F.col(doc).asc()]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    max_k: int,
    metric: str = "cosine",
    max_query_rows: int = MAX_QUERY_ROWS,
) -> DataFrame:
    """(query_id, id, score, rank) of the k nearest vectors of each query.

    vectors: id, embedding, and optionally cell, a part of the table (an inverted list, a
    lower-cased source). queries: query_id, query_vec, k (more than max_k is an error), and optionally cells
    (the parts to look into) or cell_filter (a text the part must contain, null for all).
    score is the cosine similarity or the Euclidean distance, by metric.
    """
    vectors = vectors.where("id is not null and embedding is not null")
    wanted = [c for c in ("query_id", "query_vec", "k", "cells", "cell_filter") if c in queries.columns]
    queries = queries.where("query_vec is not null").select(*wanted)
    too_many = F.raise_error(F.concat(F.lit(f"k above {max_k}: "), F.col("k").cast("string")))
    queries = queries.withColumn("k", F.when(F.col("k") <= max_k, F.col("k")).otherwise(too_many))
    kept = ["id", "embedding"] + (["cell"] if "cell" in vectors.columns else [])
    vectors = vectors.select(*kept)
    if fits(queries, max_query_rows, MAX_QUERY_BYTES):
        found = _scan(vectors, queries, metric)
    else:
        found = _by_blocks(vectors, queries, metric, max_k, max_query_rows)
    # Every task brings up to k rows of a query; the merged list is cut to its own k again.
    return top_k(found, ["query_id"], by_similarity(metric), max_k).where("rank <= k").drop("k")


def _scan(vectors: DataFrame, queries: DataFrame, metric: str) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(queries.toArrow())
    Queries, Best = _kernel(metric, RANK_DIGITS)

    def task(batches):
        table = shared.value
        if table.num_rows == 0:
            return
        best = Best(Queries(table))
        for batch in batches:
            best.add(batch)
        yield from best.table().to_batches()

    return vectors.mapInArrow(task, RESULT)


def _by_blocks(vectors: DataFrame, queries: DataFrame, metric: str, max_k: int, max_query_rows: int) -> DataFrame:
    """One scan of the vectors for each block of queries; the best of a block are written before the
    next is read, so one block is in memory at a time."""
    kept = checkpoint(queries)
    width = kept.agg(F.max(F.size("query_vec"))).first()[0] or 1
    rows = min(max_query_rows, max(1, MAX_QUERY_BYTES // (8 * width)))
    # Blocks are made by a hash; half of the room is left for those that come out larger.
    n_blocks = max(1, math.ceil(2 * kept.count() / rows))
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks))
    vectors = vectors.coalesce(max(BLOCK_TASKS, vectors.sparkSession.sparkContext.defaultParallelism))
    parts = []
    for i in range(n_blocks):
        best = top_k(_scan(vectors, kept.where(block == i), metric), ["query_id"], by_similarity(metric), max_k)
        parts.append(checkpoint(best.drop("rank")))
    return reduce(DataFrame.unionByName, parts)
