"""Places of regex matches in texts, with built-in functions only.

Matches of a pattern and the text between them give every match's place by running sums of lengths
in code points. Sums are taken in blocks, so a text with n matches takes little more than n steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm.tables import column, let

_BLOCK = 128


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def running_totals(numbers: Column) -> Column:
    """Sums of the first one, two, three ... of an array of longs that isn't empty."""

    def of(x: Column) -> Column:
        n_blocks = F.ceil(F.size(x) / _BLOCK).cast("int")
        block = lambda k, n: F.slice(x, k * _BLOCK + 1, n)
        sums = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda k: total(block(k, F.lit(_BLOCK))))
        before = let(sums, lambda s: F.transform(s, lambda _, k: total(F.slice(s, F.lit(1), k))))
        return let(
            before,
            lambda b: F.transform(
                x,
                lambda _, i: F.get(b, F.floor(i / _BLOCK).cast("int"))
                + total(block(F.floor(i / _BLOCK).cast("int"), i % _BLOCK + 1)),
            ),
        )

    return let(numbers, of)


#: A match: code points from start to before end, its text and up to 40 code points before it.
MATCH = "array<struct<start:bigint,end:bigint,value:string,before:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern that matches no empty string."""

    def placed(found: Column) -> Column:
        def of(gaps: Column) -> Column:
            length = lambda c: F.length(c).cast("long")
            steps = F.transform(
                found, lambda _, i: length(F.get(gaps, i)) + F.when(i > 0, length(F.get(found, i - 1))).otherwise(0)
            )
            return let(
                running_totals(steps),
                lambda starts: F.transform(
                    found,
                    lambda value, i: F.struct(
                        F.get(starts, i).alias("start"),
                        (F.get(starts, i) + length(value)).alias("end"),
                        value.alias("value"),
                        F.right(F.get(gaps, i), F.lit(40)).alias("before"),
                    ),
                ),
            )

        return F.when(F.size(found) > 0, let(F.split(text, pattern, -1), of)).otherwise(F.array().cast(MATCH))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def tagged(found: Column, kind: int) -> Column:
    """Spans that sort by start, then kind."""
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of tagged spans, by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), line), ",")


def clear_of(found: Column, taken: Column) -> Column:
    """The matches that overlap none of the tagged spans."""
    return F.filter(found, lambda m: ~F.exists(taken, lambda t: (t["start"] < m["end"]) & (m["start"] < t["end"])))


def sampled(docs: DataFrame, rows: int, id_col: str) -> DataFrame:
    """About so many rows of docs, all if there are no more, chosen by a hash of the id. Used only
    to fit classifiers."""
    n = docs.count()
    if n <= rows:
        return docs
    return docs.filter(F.pmod(F.xxhash64(column(id_col), F.lit(11)), F.lit(1 << 30)) < int(rows / n * (1 << 30)))
