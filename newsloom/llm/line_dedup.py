"""Removal of repeated runs of lines by content-defined chunks.

Each line has a hash, and a rolling hash runs over the hashes of WINDOW lines. A chunk ends after a line
at which the rolling hash has its low bits zero, so where a passage is cut depends on its own lines
alone: after lines are inserted before it, its chunks are the same again within WINDOW lines. Chunks
of two lines or more that occur again anywhere are removed, all but the earliest, after their
bytes were compared.

Chunks meet by two 64-bit hashes, counted map-side, so that one in a third of all documents is one row
a task. Only chunks whose hashes repeat move with their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm.tables import column, hinted, keyed, let, stored

WINDOW = 3
#: A chunk has about so many lines.
LINES = 4
_FACTOR, _SHIFT = 31, 1024


def line_hash(line: Column) -> Column:
    """32 bits of a line's digest."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def chunks(text: Column) -> Column:
    """The chunks of a text in order: array of (n_lines, body), the lines joined by line feeds."""

    def ends(hashes: Column) -> Column:
        def ends_here(i: Column) -> Column:
            rolling = F.lit(0).cast("long")
            for k in range(WINDOW):
                rolling = rolling + F.coalesce(F.get(hashes, i - k), F.lit(0)) * (_FACTOR**k)
            return (i == F.size(hashes) - 1) | (F.floor(rolling / _SHIFT).cast("long") % LINES == 0)

        return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), ends_here)

    def cut(lines: Column) -> Column:
        def of(last: Column) -> Column:
            def one(end: Column, k: Column) -> Column:
                start = F.coalesce(F.get(last, k - 1) + 1, F.lit(0))
                body = F.array_join(F.slice(lines, start + 1, end - start + 1), "\n")
                return F.struct((end - start + 1).cast("long").alias("n_lines"), body.alias("body"))

            return F.transform(last, one)

        return let(let(F.transform(lines, line_hash), ends), of)

    return let(F.split(text, "\n"), cut)


def _keys(body: Column) -> list[Column]:
    return [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(7), body).alias("k2")]


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """(id, places) of (id, text): for each document with chunks that occur earlier, their places."""
    placed = rows.select("id", F.posexplode(chunks(F.col("text"))).alias("place", "chunk")).filter("chunk.n_lines > 1")
    placed = placed.select("id", "place", F.col("chunk.body").alias("body")).filter(F.length("body") > 0)
    keyed = placed.select("id", "place", *_keys(F.col("body")))
    often = keyed.groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2")
    often = stored(often, "often")
    found = placed.select("*", *_keys(F.col("body"))).join(hinted(often, 16), ["k1", "k2"])
    found = stored(found, "chunks")
    # Grouping by the body compares bytes; a hash two different bodies share makes two groups.
    first = found.groupBy("k1", "k2", "body").agg(F.min(F.struct("id", "place")).alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select("k1", "k2", F.col("body").alias("same"), "first")
    later = found.join(first, ["k1", "k2"]).filter("body = same and struct(id, place) > first")
    return stored(later.groupBy("id").agg(F.collect_set("place").alias("places")), "places")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept_text, n_lines, n_chunks, n_removed_lines, n_removed_chunks, kept_sha256) of each row.

    Lines are split at line feeds. A chunk of two lines or more goes if the same bytes are a chunk of
    a smaller id, or an earlier one of the same document; a chunk of empty lines only has no bytes to
    compare and stays. What is left is joined by line feeds. Rows repeated with their id and text are
    one document and each get its row. Rows without an id are documents of their own before all others;
    these, and the texts of an id that has several, are in the order of their digests. A null or empty
    text is one empty line. An empty table gives an empty table; other columns are not looked at.
    """
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    rows = keyed(rows, "id", "doc_id", "text")
    gone = repeated_chunks(rows.dropDuplicates(["id"]) if _has_repeated_ids(rows) else rows)
    whole = rows.join(hinted(gone, F.size("places") * 4 + 24), "id", "left").select(
        "doc_id", F.explode(F.array(chunks(F.col("text")))).alias("all"), F.coalesce("places", F.array().cast("array<int>")).alias("places")
    )
    every = F.sequence(F.lit(0), F.size("all") - 1)
    at = lambda places: F.transform(places, lambda i: F.get("all", i))
    split = F.struct(at(F.array_except(every, "places")).alias("kept"), at(F.array_intersect(every, "places")).alias("gone"))
    split = F.explode(F.array(split))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + x["n_lines"])
    parts = whole.select("doc_id", "all", split.alias("s"))
    text = F.array_join(F.transform("s.kept", lambda c: c["body"]), "\n")
    return parts.select("doc_id", "all", "s", F.explode(F.array(text)).alias("kept_text")).select(
        "doc_id",
        "kept_text",
        total(F.col("all")).alias("n_lines"),
        F.size("all").cast("long").alias("n_chunks"),
        total(F.col("s.gone")).alias("n_removed_lines"),
        F.size("s.gone").cast("long").alias("n_removed_chunks"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def _has_repeated_ids(rows: DataFrame) -> bool:
    return not rows.groupBy("id").count().filter("count > 1").isEmpty()
