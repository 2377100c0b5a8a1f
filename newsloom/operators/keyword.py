"""Inverted index and BM25-style scores.

The index is split by document: one shuffle brings each text to its partition, where tokens
are counted and later scored without moving again, because hash(doc_id) also clusters
(doc_id, token) and (query_id, doc_id). A token that occurs in a third of all documents is
therefore spread over all partitions and never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from newsloom.functions import text as tx
from newsloom.operators import keyword_scan
from newsloom.operators.ranking import top_k
from newsloom.operators.sizing import broadcast_if_small, fits
from newsloom.session import checkpoint

# The scoring constants.
K1 = 1.2
B = 0.75
REPEAT_BONUS = 0.1
EPSILON = 1e-9
MAX_CANDIDATES = 2000

# Documents of a block, about, and bands of lengths.
BLOCK_DOCS = 32
BANDS = 64
# The rarest words that give the first threshold occur in so many documents for each one sought.
RARE_DEPTH = 2
# Collections of so many documents are searched by blocks; in smaller ones more steps cost more.
PRUNED_FROM = 1_000_000

# What one task of an index built on the fly scores: pairs of a document and a query, and bytes of text.
PAIRS_PER_TASK = 400_000
TEXT_PER_TASK = 12 << 20
# Bytes of text for a word, about, where only the words were counted.
BYTES_PER_WORD = 7
# Batches of so many queries, and of so many pairs, are scored share by share: see keyword_scan.
SCANNED_QUERIES = 1_000
SCANNED_PAIRS = 50_000_000
# A stored index is scored share by share from so many pairs on.
STORED_PAIRS = 10_000_000
# Rows of postings from which a task makes rows of blocks at once.
BLOCK_ROWS = 2_000_000
# More tasks than this cost more than they save; a task's share grows from here on.
MAX_TASKS = 16_384

# Batches with up to so many different words filter by a list in the plan.
SHORT_WORD_LIST = 200

# Scores are ranked at this precision, so that the order in which partial sums arrive
# cannot swap equal documents; ties go to the lower id.
RANK_DIGITS = 9


@dataclass
class KeywordIndex:
    """postings(token, doc_id, tf, dl), doc_stats(doc_id, dl), term_stats(token, df), and where
    it is stored, the one row of corpus_stats(n_docs, avg_dl) and blocks(token, block, max_tf, min_dl,
    parts), what a word can bring at most in a block of documents. An index built on the fly can be dealt to
    the tasks again for a number of queries, by dealt; parts is the number of its shares then."""

    postings: DataFrame
    doc_stats: DataFrame
    term_stats: DataFrame
    stored_corpus_stats: DataFrame | None = None
    blocks: DataFrame | None = None
    dealt: Callable[[int], KeywordIndex] | None = None
    parts: int | None = None

    def corpus_stats(self) -> DataFrame:
        if self.stored_corpus_stats is not None:
            return self.stored_corpus_stats
        return corpus_stats(self.doc_stats)


def corpus_stats(doc_stats: DataFrame) -> DataFrame:
    """One row: documents, counting those without tokens, and their mean length."""
    return doc_stats.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avg_dl"),
    )


def moved_stats(before: DataFrame, removed: DataFrame, added: DataFrame) -> DataFrame:
    """corpus_stats after documents went and came: before is its row so far, removed and added are
    doc_stats. Lengths are whole numbers, so their sum comes back from the mean."""
    went, came = (d.agg(F.struct(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl"))).scalar() for d in (removed, added))
    n = F.col("n_docs") - went["n"] + came["n"]
    words = F.round(F.col("n_docs") * F.col("avg_dl")) - went["dl"] + came["dl"]
    mean = F.when(n > 0, words / n).otherwise(0.0)
    return before.select(n.alias("n_docs"), mean.alias("avg_dl"))


def build(articles: DataFrame, body: Column | None = None) -> KeywordIndex:
    """Index of articles(id, title, summary), or of one text expression given as body."""
    sized = [F.col("title"), F.col("summary")] if body is None else [body]
    body = _body() if body is None else body
    texts = articles.select(F.col("id").alias("doc_id"), body.alias("body"))

    def dealt(n_queries: int) -> KeywordIndex:
        # A task holds the pairs that it scores. Documents are counted for that: the bytes by which Spark joins
        # partitions say little about their number, and nothing about that of the queries.
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in sized), F.lit(0))
        n, length = articles.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
        at_once = min(articles.sparkSession.sparkContext.defaultParallelism, length >> 20)
        # Two at least: a single one would not be dealt out by doc_id, and scoring would rely on that.
        parts = max(2, at_once, math.ceil(n * n_queries / PAIRS_PER_TASK), math.ceil(length / TEXT_PER_TASK))
        parts = min(parts, MAX_TASKS)
        return replace(_index(texts.repartition(parts, "doc_id")), parts=parts)

    # The cleaned texts move once. Cleaning stays before the shuffle: its Python step would
    # hide from Spark how the rows after it are partitioned.
    return replace(_index(texts.repartition("doc_id")), dealt=dealt)


def _index(texts: DataFrame) -> KeywordIndex:
    """Index of texts(doc_id, body) that were dealt out by doc_id."""
    # The outer explode keeps Spark from inferring a not-empty filter on the tokens, which it
    # would push below the shuffle, tokenising every text twice.
    postings = _counted(texts, "doc_id")
    # Lengths come from the texts, not from the postings: documents without tokens count too.
    doc_stats = texts.select("doc_id", F.size(tx.tokens(F.col("body"))).alias("dl"))
    return KeywordIndex(postings, doc_stats, term_stats(postings))


def _counted(texts: DataFrame, *dealt: str) -> DataFrame:
    """Postings of texts(doc_id, body) that were dealt out by the columns dealt."""
    ids = list(dict.fromkeys([*dealt, "doc_id"]))
    return (
        texts.select(*ids, tx.tokens(F.col("body")).alias("toks"))
        .select(*ids, F.size("toks").alias("dl"), F.explode_outer("toks").alias("tok"))
        .where("tok is not null")
        .select(*ids, "dl", F.lower("tok").alias("token"))
        .groupBy(*ids, "dl", "token")
        .agg(F.count("*").cast("int").alias("tf"))
        .select("token", "doc_id", "tf", "dl")
    )


def stored_postings(articles: DataFrame, n_docs: int, parts: int | None = None) -> DataFrame:
    """Postings of articles(id, title, summary), n_docs of them, to be stored: dealt out by the parts of which blocks
    are made, or by finer ones, so that a block's rows come from few files. parts is that of the blocks that are there."""
    parts = block_parts(n_docs) if parts is None else parts * math.ceil(block_parts(n_docs) / parts)
    part = F.pmod(F.xxhash64("id"), F.lit(parts).cast("long")).alias("_dealt")
    texts = articles.select(part, F.col("id").alias("doc_id"), _body().alias("body"))
    return _counted(texts.repartition("_dealt"), "_dealt")


def _body() -> Column:
    return tx.indexed_text(F.col("title"), F.col("summary"))


def lengths(articles: DataFrame) -> DataFrame:
    """doc_stats of articles(id, title, summary), to be stored: texts are not moved for it."""
    return articles.select(F.col("id").alias("doc_id"), F.size(tx.tokens(_body())).alias("dl"))


def term_stats(postings: DataFrame) -> DataFrame:
    return postings.groupBy("token").agg(F.count("*").alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, token, qcnt) of the words of each query; blank queries have none."""
    return (
        queries.select("query_id", F.explode_outer(tx.tokens(F.col("query"))).alias("tok"))
        .where("tok is not null")
        .select("query_id", F.lower("tok").alias("token"))
        .groupBy("query_id", "token")
        .agg(F.count("*").alias("qcnt"))
    )


def block_of(doc_id: Column, dl: Column, parts: Column) -> Column:
    """A document's block: documents of like length, where a word weighs alike, dealt out to parts."""
    band = F.least(F.floor(2 * F.log2(dl + 1)), F.lit(BANDS - 1)).cast("long")
    return F.pmod(F.xxhash64(doc_id), parts.cast("long")) * BANDS + band


def block_parts(n_docs: int) -> int:
    """Parts of a collection; the documents of one fall into about eight bands of lengths."""
    return max(1, n_docs // (8 * BLOCK_DOCS))


def blocks(postings: DataFrame, parts: Column) -> DataFrame:
    """The largest count and the least length among the documents of a block that hold a word. Rows
    of a block may repeat, as they do after updates and where several tasks read its postings; rows of documents
    that are gone do no harm. Nothing moves: each task folds what it reads."""
    block = block_of(F.col("doc_id"), F.col("dl"), parts).alias("block")

    def fold(held):
        import pyarrow as pa

        found = pa.Table.from_batches(held).group_by(["token", "block"], use_threads=False)
        found = found.aggregate([("tf", "max"), ("dl", "min")])
        names = {"token": "token", "block": "block", "tf_max": "max_tf", "dl_min": "min_dl"}
        return found.select(list(names)).rename_columns(list(names.values())).to_batches()

    def task(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= at_once:
                yield from fold(held)
                held, n = [], 0
        if n:
            yield from fold(held)

    at_once = BLOCK_ROWS
    found = postings.select("token", block, "tf", "dl").mapInArrow(task, "token string, block long, max_tf int, min_dl int")
    return found.withColumn("parts", parts.cast("int"))


def saturation(tf: Column, dl: Column, avg_dl: Column, k1: float = K1, b: float = B) -> Column:
    """What a word's count is worth in a document; grows with tf, falls with dl."""
    denominator = tf + k1 * (1 - b + b * (dl / (avg_dl + EPSILON)))
    return tf * (k1 + 1) / (denominator + EPSILON)


def scores(index: KeywordIndex, queries: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """(query_id, doc_id, score) of every document sharing a word with a query."""
    if index.dealt is not None:
        index = index.dealt(queries.count())
    weighted, asked_for, hint = _weighted(index, queries)
    return _scored(asked_for(index.postings).join(hint(weighted), "token"), k1, b)


def _scored(matches: DataFrame, k1: float, b: float) -> DataFrame:
    value = F.col("weight") * saturation(F.col("tf"), F.col("dl"), F.col("avg_dl"), k1, b)
    return matches.groupBy("query_id", "doc_id").agg(F.sum(value).alias("score"))


def pruned_scores(index: KeywordIndex, queries: DataFrame, k: int, k1: float = K1, b: float = B) -> DataFrame:
    """Rows of scores() that hold at least the k best of each query, ties with the k-th included.

    A query's rarest words alone give k documents a score that the k-th best must reach. A block of documents in
    which all words of the query together cannot bring as much is passed over; every document of the other
    blocks is scored in full. Needs the index's blocks.
    """
    weighted, asked_for, hint = _weighted(index, queries)
    weighted = checkpoint(weighted)
    open_blocks = checkpoint(_open_blocks(index, weighted, asked_for, hint, k, k1, b))
    matches = _in_blocks(asked_for(index.postings), index).join(hint(weighted), "token")
    matches = matches.join(broadcast_if_small(open_blocks), ["query_id", "block"], "left_semi")
    return _scored(matches, k1, b)


def _open_blocks(index: KeywordIndex, weighted: DataFrame, asked_for, hint, k: int, k1: float, b: float) -> DataFrame:
    """(query_id, block) of the blocks that may hold one of the k best documents of a query."""
    before = W.partitionBy("query_id").orderBy("df", "token").rowsBetween(W.unboundedPreceding, -1)
    seen = F.coalesce(F.sum("df").over(before), F.lit(0))
    rare = weighted.withColumn("_seen", seen).where(F.col("_seen") < RARE_DEPTH * k).drop("_seen")
    first = top_k(_scored(asked_for(index.postings).join(hint(rare), "token"), k1, b), ["query_id"], by_score(), k, two_rounds=True)
    reached = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))

    # Bounds move once: a block's place clusters its words and its queries.
    bounds = asked_for(index.blocks.select("token", "block", "max_tf", "min_dl")).repartition("block")
    bounds = bounds.groupBy("token", "block").agg(F.max("max_tf").alias("tf"), F.min("min_dl").alias("dl"))
    value = F.col("weight") * saturation(F.col("tf"), F.col("dl"), F.col("avg_dl"), k1, b)
    most = bounds.join(hint(weighted), "token").groupBy("query_id", "block").agg(F.sum(value).alias("most"))
    # Sums that arrive in another order differ in the last digits, and ranks look at RANK_DIGITS.
    reaches = F.col("least").isNull() | (F.col("most") * (1 + EPSILON) + 2 * 10.0**-RANK_DIGITS >= F.col("least"))
    reached = broadcast_if_small(checkpoint(reached))
    return most.join(reached, "query_id", "left").where(reaches).select("query_id", "block")


def _in_blocks(postings: DataFrame, index: KeywordIndex) -> DataFrame:
    parts = index.blocks.select("parts").limit(1).scalar()
    return postings.withColumn("block", block_of(F.col("doc_id"), F.col("dl"), parts))


def _weighted(index: KeywordIndex, queries: DataFrame):
    """(query_id, token, df, weight, avg_dl) of the queries' words that the index holds; the filter on the words
    of the batch; and a hint for joins with the words, by their counted size."""
    terms = query_terms(queries)
    # The weighted terms have the rows of the terms, so one check covers both.
    hint = F.broadcast if fits(terms) else (lambda side: side)
    asked_for = _asked_for(hint(terms.select("token").distinct()))
    # Document frequencies of the words asked for, nothing else.
    df = asked_for(index.term_stats)
    corpus = index.corpus_stats().select(F.struct("n_docs", "avg_dl").alias("c")).scalar()
    idf = F.log((corpus.getField("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1.0)
    weighted = terms.join(df, "token").select(
        "query_id",
        "token",
        "df",
        (idf * (1.0 + REPEAT_BONUS * (F.col("qcnt") - 1))).alias("weight"),
        corpus.getField("avg_dl").alias("avg_dl"),
    )
    return weighted, asked_for, hint


def _asked_for(words: DataFrame):
    """Filter on the words of the batch. Spark moves it below the counting of an index built on
    the fly. A short list of words is put into the plan: a stored index, sorted by token, then
    skips the parts of its files that hold none of them."""
    first = [row.token for row in words.limit(SHORT_WORD_LIST + 1).collect()]
    if len(first) <= SHORT_WORD_LIST:
        return lambda table: table.where(F.col("token").isin(first))
    return lambda table: table.join(words, "token", "left_semi")


def by_score(score: str = "score", doc: str = "doc_id") -> list[Column]:
    return [F.round(score, RANK_DIGITS).desc(), F.col(doc).asc()]


def best(index: KeywordIndex, queries: DataFrame, k: int = MAX_CANDIDATES, prune: bool | None = None) -> DataFrame:
    """(query_id, doc_id, score, rank) of the k best documents of each query. prune says whether blocks of documents
    are passed over where the index has any; by default in collections of PRUNED_FROM documents or more."""
    if prune is None:
        prune = index.blocks is not None and (index.corpus_stats().first().n_docs or 0) >= PRUNED_FROM
    if scanned(index, queries):
        # Few rows come that are not among the best, and those of a query are in one place.
        found = _scan(index, queries, k) if index.dealt is not None else _scan_stored(index, queries, k, prune)
        return top_k(found, ["query_id"], by_score(), k)
    found = pruned_scores(index, queries, k) if prune else scores(index, queries)
    return candidates(found, k)


def scanned(index: KeywordIndex, queries: DataFrame) -> bool:
    """Whether a batch has so many pairs with the documents that best() does not move them."""
    ids = [queries.schema["query_id"], index.postings.schema["doc_id"]]
    if any(not isinstance(f.dataType, T.LongType) for f in ids):
        return False
    n = queries.count()
    if index.dealt is not None:
        return n >= SCANNED_QUERIES and n * index.doc_stats.count() >= SCANNED_PAIRS
    return index.stored_corpus_stats is not None and n * (index.corpus_stats().first().n_docs or 0) >= STORED_PAIRS


def _scan(index: KeywordIndex, queries: DataFrame, k: int) -> DataFrame:
    # Pairs are not held by the tasks, so texts alone tell how many there are.
    index = index.dealt(0)
    weighted = checkpoint(_weighted(index, queries)[0].select("query_id", "token", "weight"))
    avg_dl = index.corpus_stats().first().avg_dl
    shares = keyword_scan.shares(_of_words(index.postings, weighted), index.parts)
    return keyword_scan.best(shares, weighted, avg_dl, k, K1, B, EPSILON, RANK_DIGITS)


def _of_words(postings: DataFrame, weighted: DataFrame) -> DataFrame:
    """The postings of the batch's words, where these can be handed to the tasks: no posting moves."""
    words = weighted.select("token").distinct()
    return postings.join(F.broadcast(words), "token", "left_semi") if fits(words) else postings


def _scan_stored(index: KeywordIndex, queries: DataFrame, k: int, prune: bool) -> DataFrame:
    weighted, asked_for, hint = _weighted(index, queries)
    weighted = checkpoint(weighted)
    stats = index.corpus_stats().first()
    postings = _of_words(index.postings, weighted)
    if prune:
        # Documents of blocks that are open to no query stay out; the scan's own bound holds for each query.
        some = checkpoint(_open_blocks(index, weighted, asked_for, hint, k, K1, B).select("block").distinct())
        if fits(some):
            postings = _in_blocks(postings, index).join(F.broadcast(some), "block", "left_semi")
    postings = postings.select("token", "doc_id", "tf", "dl")
    # The files of an index hold whole documents as they were written; if that no longer holds, postings move once.
    files = len(index.postings.inputFiles())
    shares = keyword_scan.shares(postings, files) if files else None
    if shares is None or not keyword_scan.whole(shares):
        length = (stats.n_docs or 0) * (stats.avg_dl or 0.0) * BYTES_PER_WORD
        cores = postings.sparkSession.sparkContext.defaultParallelism
        parts = min(MAX_TASKS, max(cores, math.ceil(length / TEXT_PER_TASK)))
        shares = keyword_scan.shares(postings.repartition(parts, "doc_id"), parts)
    weighted = weighted.select("query_id", "token", "weight")
    return keyword_scan.best(shares, weighted, stats.avg_dl, k, K1, B, EPSILON, RANK_DIGITS)


def candidates(scored: DataFrame, k: int = MAX_CANDIDATES) -> DataFrame:
    """The k best documents of each query."""
    return top_k(scored, ["query_id"], by_score(), k, two_rounds=True)


def search(index: KeywordIndex, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id, score, rank) of the k best documents of each query."""
    return best(index, queries, k)
