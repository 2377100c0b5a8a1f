"""Mixing sources to target weights by capped water-filling.

Each source has a weight and at most max_epochs passes over its words. The words wanted are dealt out
by weight; a source that would need more passes is held at its cap, and what it can't give is dealt
out again among the others, until no source is above its cap. Sorted by cap per unit of weight,
the held sources come first, so running sums give the same fixed point in one pass over the sources.

A source whose target is 1.37 passes gives every document once, and 37% of its words a second
time: documents in a seeded random order up to that point. The order comes from a hash of the id, so
that reruns agree. A histogram of the hashes' first bits finds the bin in which a source's mix ends,
and only the documents of that bin are put in order, so no source is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsloom.llm.tables import column, free_name, hinted, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the hash that make up a bin of the histogram.
BIN_DIGITS = 4


def n_words(text: Column) -> Column:
    """Number of words; 0 for null. Counted at each word's last character."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: list[int]) -> DataFrame:
    """(source, size, weight): weights repeat along the sources by code point, null last. sources
    has one row a source."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    return sources.withColumn("weight", cycle[(place % len(weights)).cast("int")])


def targets(sources: DataFrame, budget: Column, max_epochs: int) -> DataFrame:
    """(source, size, weight, target) for sources with size and weight. budget: words in all, as a
    column over the total size named total. Target is a quotient of whole numbers, rounded once."""
    cap = F.col("size") * max_epochs
    by_need = W.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    held = by_need.rowsBetween(W.unboundedPreceding, -1)
    rest = by_need.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy().orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = (
        sources.withColumn("total", F.sum("size").over(everything))
        .withColumn("_left", budget - F.coalesce(F.sum(cap).over(held), F.lit(0)))
        .withColumn("_weights", F.sum("weight").over(rest))
        # Held at the cap if even the level that remains here lifts the source above it.
        .withColumn("_held", F.col("_left") * F.col("weight") >= cap * F.col("_weights"))
    )
    free = F.when(~F.col("_held"), F.struct("_left", "_weights"))
    level = F.first(free, ignorenulls=True).over(by_need.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    shared = F.col("weight") * F.col("_level._left") / F.col("_level._weights")
    return levels.withColumn("_level", level).select(
        "source", "size", "weight", F.when(F.col("_held"), cap.cast("double")).otherwise(shared.cast("double")).alias("target")
    )


def _order(id_col: Column, text: Column, seed: int) -> Column:
    """The place of a row in the seeded order: by its id, without one by its text, so that rows without an id
    are not taken as one block."""
    own = F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), own)).cast("binary"))


def planned(
    docs: DataFrame,
    weights: list[int],
    share: tuple[int, int] = (3, 2),
    max_epochs: int = 2,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, str]:
    """docs with one more column, and its name: a struct of size (words), source_size, target (of the
    source) and copies.

    share: words of the mix as a fraction of all words. A null text has size 0, a null source is a
    source of its own, at the last place. Documents of a source are taken copies = whole passes
    times, and once more in the order of md5(seed:id) while half of the document still lies below
    the rest of the target; rows that share an id are taken alike, rows without one by their text. Nothing
    is taken twice more than another, and never more than max_epochs times. An empty table gives an
    empty table.
    """
    mix, size, key, rule = (free_name(docs, c) for c in ("_mix", "_size", "_order", "_rule"))
    sized = docs.withColumns({size: n_words(column(text_col)), key: _order(column(id_col), column(text_col), seed)})
    slim = stored(
        sized.select(
            column(source_col).alias("source"),
            F.col(size).alias("n"),
            F.col(key).alias("k"),
            F.substring(key, 1, BIN_DIGITS).alias("b"),
        ),
        "sizes",
    )
    bins = slim.groupBy("source", "b").agg(F.sum("n").alias("n"))
    sizes = bins.groupBy("source").agg(F.sum("n").alias("size"))
    plan = targets(cyclic_weights(sizes, weights), F.col("total") * share[0] / share[1], max_epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0)
    plan = plan.select("source", "size", "target", whole.alias("whole")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("size")
    )
    # The bin of each source in which its last, partial pass ends.
    before = F.sum("n").over(W.partitionBy("source").orderBy("b").rowsBetween(W.unboundedPreceding, -1))
    edges = (
        bins.withColumn("before", F.coalesce(before, F.lit(0))).alias("x")
        .join(hinted(plan, 64).alias("p"), F.expr("x.source <=> p.source"))
        .filter("x.before <= p.rest and p.rest < x.before + x.n")
        .select("x.source", "x.b", "x.before", "p.rest")
    )
    inside = (
        slim.groupBy("source", "b", "k").agg(F.sum("n").alias("n")).alias("x")
        .join(hinted(edges, 64).alias("e"), F.expr("x.source <=> e.source and x.b = e.b"))
        .select("x.source", "x.k", "x.n", "e.before", "e.rest")
        .withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy("source").orderBy("k")))
    )
    last = inside.filter(2 * F.col("upto") - F.col("n") <= 2 * F.col("rest")).groupBy("source").agg(F.max("k").alias("last"))
    ends = edges.groupBy("source").agg(F.min("b").alias("b"))
    rules = (
        plan.alias("p")
        .join(ends.alias("e"), F.expr("p.source <=> e.source"), "left")
        .join(last.alias("l"), F.expr("p.source <=> l.source"), "left")
        .select(
            F.struct(
                F.col("p.source").alias("source"),
                F.col("p.size").alias("size"),
                F.col("p.target").alias("target"),
                F.col("p.whole").alias("whole"),
                F.col("p.rest").alias("rest"),
                # All documents up to this place in the order are taken once more.
                F.coalesce("l.last", "e.b", F.lit("")).alias("last"),
            ).alias(rule)
        )
    )
    of = F.col(rule)
    once = (of["rest"] > 0) & (F.col(key) <= of["last"])
    found = sized.join(hinted(rules, 64), column(source_col).eqNullSafe(of["source"]))
    taken = F.struct(
        F.col(size).alias("size"),
        of["size"].alias("source_size"),
        of["target"].alias("target"),
        (of["whole"] + once.cast("long")).cast("long").alias("copies"),
    )
    return found.withColumn(mix, taken).drop(size, key, rule), mix


def mixed(docs: DataFrame, weights: list[int], **how) -> DataFrame:
    """docs with the columns size, source_size, target and copies; see planned(). Columns of docs with
    these names are replaced."""
    found, mix = planned(docs, weights, **how)
    names = ["size", "source_size", "target", "copies"]
    kept = [column(c) for c in docs.columns if c.lower() not in names]
    return found.select(*kept, *[F.col(mix)[n].alias(n) for n in names])


def repeated(docs: DataFrame, weights: list[int], **how) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it has copies."""
    found, mix = planned(docs, weights, **how)
    time = free_name(found, "_time")
    rows = found.filter(F.col(mix)["copies"] > 0)
    rows = rows.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(mix)["copies"].cast("int"))))
    return rows.select(*[column(c) for c in docs.columns])
