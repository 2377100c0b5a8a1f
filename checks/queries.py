"""Every operator as a query over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks import sql, tables as t
from newsloom import configure
from newsloom.functions import dates, rules, text as tx, vectors as vec
from newsloom.operators import codes, compare, dedup, embed, fusion, ivf, keyword, knn, merge, rule_table, stats
from newsloom.operators.sizing import MAX_BROADCAST_BYTES, broadcast_if_small
from newsloom.plans import build, ingest, search
from newsloom.session import shared_dir
from newsloom.sources import feeds, json_articles, matrices, snapshots
from newsloom.streaming import articles as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

def now():
    return F.lit("2024-03-01 00:00:00").cast("timestamp")


N_LISTS = 16
# Of the trained lists, and of the given ones, one for each of ten labels: as many as it takes for a
# recall of 0.9 on these vectors, which hardly cluster.
N_PROBES = 12
N_GIVEN_PROBES = 8
SOURCE_NAMES = ["src1", "SRC7", "c12"]
# Names a query may use for the test sources, and the words that make it a source query.
ALIASES = [(f"src{i}", f"Src{i}") for i in range(19, -1, -1)]
SOURCE_WORDS = ["báo", "trang", "src"]
URL_RULES = [
    ("cheap-pills", "spam"),
    ("spam", "spam"),
    ("blog.", "blog"),
    ("blog.th", "never reached"),
    ("//m.", "mobile"),
    ("www.", "site"),
]


def query(name: str, oracle: str | None = None):
    def register(make):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(configure(spark), sf_dir.rstrip("/"))

        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = oracle
        return make

    return register


def rounded(c: str, digits: int = 6):
    return F.round(c, digits).alias(c)


def keyword_index(spark, d):
    return keyword.build(t.documents(spark, d))


# Keyword search ---------------------------------------------------------------------------


@query(
    "keyword_search",
    f"""WITH {sql.KEYWORD}
SELECT query_id, rank, doc_id, {sql.sanitise(sql.FIRST_LINE)} AS title, source, round(score, 6) AS score
FROM kw JOIN documents USING (doc_id) WHERE rank <= 10""",
)
def _(spark, d):
    docs = t.documents(spark, d)
    found = keyword.search(keyword.build(docs), t.queries(spark, d), 10)
    return found.join(docs.withColumnRenamed("id", "doc_id"), "doc_id").select(
        "query_id", "rank", "doc_id", tx.sanitise(F.col("title")).alias("title"), "source", rounded("score")
    )


def _search(mode: str, sort: str):
    def run(spark, d):
        arts = t.articles(spark, d)
        corpus = search.Corpus(
            arts,
            keyword.build(arts) if mode != "semantic" else None,
            search.exact(t.vectors(spark, d)) if mode != "keyword" else None,
        )
        wanted = t.vector_queries(spark, d) if mode != "keyword" else t.queries(spark, d)
        return search.search(corpus, wanted.withColumns({"mode": F.lit(mode), "sort": F.lit(sort)}))

    return run


_KW = "SELECT query_id, doc_id, score FROM kw"
_SEM = "SELECT query_id, doc_id, score FROM sem WHERE score >= 0.35"
_HYB = "SELECT query_id, doc_id, hybrid AS score FROM fused WHERE hybrid >= 0.35"
query("keyword_search_newest", f"WITH {sql.KEYWORD}, {sql.ARTICLES} {sql.results(_KW, True)}")(_search("keyword", "newest"))
query("semantic_search", f"WITH {sql.HYBRID}, {sql.ARTICLES} {sql.results(_SEM, False)}")(_search("semantic", "relevance"))
query("hybrid_search", f"WITH {sql.HYBRID}, {sql.ARTICLES} {sql.results(_HYB, False)}")(_search("hybrid", "relevance"))
query("hybrid_search_newest", f"WITH {sql.HYBRID}, {sql.ARTICLES} {sql.results(_HYB, True)}")(_search("hybrid", "newest"))


@query(
    "mixed_mode_search",
    f"""WITH {sql.HYBRID}, {sql.ARTICLES},
wish AS (
  SELECT item_id AS query_id, CASE WHEN contains(text, chr(10)) THEN 'semantic' WHEN length(text) > 200 THEN 'keyword' ELSE 'hybrid' END AS mode,
         1 + length(text) % 50 AS topk, CASE WHEN contains(text, ',') THEN 'newest' ELSE 'relevance' END AS sort
  FROM benchmark JOIN embeddings ON vec_id = item_id
),
deep AS (
  SELECT n.query_id, n.id AS doc_id, 1 / (1 + (1 - n.cosine)) AS score
  FROM near n JOIN wish w USING (query_id) WHERE n.rank <= greatest(6 * w.topk, 60)
),
deep_n AS (
  SELECT query_id, doc_id, score, CASE WHEN hi - lo < 1e-9 THEN 0 ELSE (score - lo) / (hi - lo) END AS norm
  FROM (SELECT *, min(score) OVER w AS lo, max(score) OVER w AS hi FROM deep WINDOW w AS (PARTITION BY query_id))
),
cand AS (
  SELECT query_id, doc_id, score FROM deep JOIN wish USING (query_id) WHERE mode = 'semantic' AND score >= 0.35
  UNION ALL SELECT query_id, doc_id, score FROM kw JOIN wish USING (query_id) WHERE mode = 'keyword'
  UNION ALL
  SELECT query_id, doc_id, h FROM (
    SELECT coalesce(s.query_id, k.query_id) AS query_id, coalesce(s.doc_id, k.doc_id) AS doc_id,
           0.55::DOUBLE * coalesce(s.norm, 0) + 0.45::DOUBLE * coalesce(k.norm, 0) AS h
    FROM deep_n s FULL JOIN kw_n k ON s.query_id = k.query_id AND s.doc_id = k.doc_id
  ) JOIN wish USING (query_id) WHERE mode = 'hybrid' AND h >= 0.35
)
SELECT query_id, rank, doc_id, round(score, 6) AS score, coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S'), '') AS published
FROM (
  SELECT c.query_id, c.doc_id, c.score, a.ts, w.topk,
         row_number() OVER (PARTITION BY c.query_id ORDER BY CASE WHEN w.sort = 'newest' THEN a.ts END DESC NULLS LAST,
                            round(c.score, 9) DESC, c.doc_id) AS rank
  FROM cand c JOIN wish w USING (query_id) JOIN (SELECT id, date_trunc('second', ts) AS ts FROM articles) a ON a.id = c.doc_id
) WHERE rank <= topk""",
)
def _(spark, d):
    arts = t.articles(spark, d)
    corpus = search.Corpus(arts, keyword.build(arts), search.exact(t.vectors(spark, d)))
    text = F.col("query")
    wanted = t.vector_queries(spark, d).withColumns(
        {
            "mode": F.when(F.contains(text, F.lit("\n")), "semantic").when(F.length(text) > 200, "keyword").otherwise("hybrid"),
            "topk": F.length(text) % 50 + 1,
            "sort": F.when(F.contains(text, F.lit(",")), "newest").otherwise("relevance"),
        }
    )
    published = F.coalesce(F.date_format("published_ts", "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    return search.ranked(corpus, wanted).select(
        "query_id", "rank", "doc_id", rounded("score"), published.alias("published")
    )


query("inverted_index_postings", f"WITH {sql.POSTINGS} SELECT token, doc_id, tf FROM postings")(
    lambda spark, d: keyword_index(spark, d).postings.select("token", "doc_id", "tf")
)
query("term_stats", f"WITH {sql.POSTINGS} SELECT token, df FROM term_stats")(
    lambda spark, d: keyword_index(spark, d).term_stats
)
query("doc_lengths", f"WITH {sql.POSTINGS} SELECT doc_id, dl FROM doc_stats")(
    lambda spark, d: keyword_index(spark, d).doc_stats
)
query(
    "doc_length_stats",
    f"WITH {sql.POSTINGS} SELECT count(*) AS n_docs, round(avg(dl), 6) AS avg_dl FROM doc_stats",
)(lambda spark, d: keyword_index(spark, d).corpus_stats().select("n_docs", rounded("avg_dl")))
query(
    "query_terms",
    f"WITH {sql.KEYWORD} SELECT query_id, token, qcnt FROM terms",
)(lambda spark, d: keyword.query_terms(t.queries(spark, d)))
query(
    "keyword_candidate_cap",
    f"WITH {sql.KEYWORD} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM kw",
)(
    lambda spark, d: keyword.candidates(keyword.scores(keyword_index(spark, d), t.queries(spark, d))).select(
        "query_id", "doc_id", "rank", rounded("score")
    )
)
query(
    "minmax_normalised_scores",
    f"WITH {sql.HYBRID} SELECT query_id, doc_id, round(norm, 6) AS norm FROM kw_n",
)(
    lambda spark, d: fusion.min_max(
        keyword.candidates(keyword.scores(keyword_index(spark, d), t.queries(spark, d)))
    ).select("query_id", "doc_id", rounded("norm"))
)


@query(
    "fused_candidates",
    f"""WITH {sql.HYBRID}
SELECT query_id, doc_id, round(semantic, 6) AS semantic, round(keyword, 6) AS keyword, round(hybrid, 6) AS hybrid FROM fused""",
)
def _(spark, d):
    queries = search.prepare(t.vector_queries(spark, d))
    semantic = search.semantic_candidates(search.exact(t.vectors(spark, d)), queries)
    keyworded = keyword.candidates(keyword.scores(keyword_index(spark, d), queries))
    return fusion.fuse(semantic, keyworded).select(
        "query_id", "doc_id", rounded("semantic"), rounded("keyword"), rounded("hybrid")
    )


# Vector search ----------------------------------------------------------------------------


def nearest(spark, d, k, metric="cosine"):
    wanted = t.vector_queries(spark, d).withColumn("k", F.lit(k))
    return knn.nearest(t.vectors(spark, d), wanted, k, metric)


query(
    "semantic_exact_topk",
    f"WITH {sql.VECTORS} SELECT query_id, id, rank, round(cosine, 6) AS score FROM near WHERE rank <= 10",
)(lambda spark, d: nearest(spark, d, 10).select("query_id", "id", "rank", rounded("score")))


@query(
    "semantic_search_minsim",
    f"""WITH {sql.VECTORS}
SELECT query_id, id AS doc_id, round(1 / (1 + (1 - cosine)), 6) AS similarity FROM near
WHERE rank <= 60 AND 1 / (1 + (1 - cosine)) >= 0.35""",
)
def _(spark, d):
    queries = search.prepare(t.vector_queries(spark, d).withColumn("mode", F.lit("semantic")))
    found = search.semantic_candidates(search.exact(t.vectors(spark, d)), queries)
    kept = found.where(fusion.reaches_minimum(F.lit("semantic"), F.col("score")))
    return kept.select("query_id", "doc_id", F.round("score", 6).alias("similarity"))


@query(
    "semantic_topk_display",
    f"""WITH {sql.VECTORS}, {sql.ARTICLES}
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS shown, id, round(cosine, 6) AS cosine,
       title, category, source, language, published,
       CASE WHEN length(summary) > 200 THEN substr(summary, 1, 200) || '...' ELSE summary END AS summary, link
FROM near JOIN articles USING (id) WHERE rank <= 20""",
)
def _(spark, d):
    arts = t.articles(spark, d)
    corpus = search.Corpus(arts, neighbours=search.exact(t.vectors(spark, d)))
    shown = search.semantic_topk(corpus, t.vector_queries(spark, d), 20)
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("query_id").orderBy("rank"))
    return shown.withColumn("shown", place).drop("rank").withColumn("cosine", F.round("cosine", 6))


@query(
    "quick_search_display",
    f"""WITH {sql.VECTORS}, {sql.ARTICLES}, shown AS (
  SELECT query_id, rank, id, title, round(cosine, 3) AS similarity, count(*) OVER (PARTITION BY query_id) AS n
  FROM near JOIN articles USING (id) WHERE rank <= 20
)
SELECT query_id, rank, id, title, similarity, greatest(n - 5, 0) AS more FROM shown WHERE rank <= 5""",
)
def _(spark, d):
    corpus = search.Corpus(t.articles(spark, d), neighbours=search.exact(t.vectors(spark, d)))
    shown = search.first_shown(search.semantic_topk(corpus, t.vector_queries(spark, d), 20), 5)
    return shown.select("query_id", "rank", "id", "title", F.round("cosine", 3).alias("similarity"), "more")


query(
    "l2_knn_batch",
    """WITH q AS (
  SELECT item_id AS query_id, embedding::DOUBLE[] AS qv FROM benchmark JOIN embeddings ON vec_id = item_id
),
far AS (SELECT query_id, vec_id AS id, list_distance(qv, embedding::DOUBLE[]) AS score FROM q, embeddings)
SELECT query_id, id, rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6), id) AS rank FROM far
) WHERE rank <= 10""",
)(lambda spark, d: nearest(spark, d, 10, "l2").select("query_id", "id", "rank", rounded("score")))

_FILTERED = f"""WITH {sql.VECTORS},
wish AS (SELECT doc_id AS query_id, lower(source) AS wanted FROM documents),
placed AS (
  SELECT s.query_id, s.id, s.cosine, contains(lower(d.source), w.wanted) AS passes,
         row_number() OVER (PARTITION BY s.query_id ORDER BY round(cosine, 9) DESC, id) AS overall
  FROM sims s JOIN documents d ON d.doc_id = s.id JOIN wish w USING (query_id)
)"""
query(
    "semantic_filtered_by_source",
    f"""{_FILTERED}
SELECT query_id, id, rank, round(cosine, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, id) AS rank FROM placed WHERE passes
) WHERE rank <= 10""",
)(
    lambda spark, d: compare.exact_filtered(
        t.vectors(spark, d), t.documents(spark, d), t.filtered_queries(spark, d), 10
    ).select("query_id", "id", "rank", rounded("score"))
)

_POST = f"""{_FILTERED},
cut AS (
  SELECT n.query_id, n.id, n.cosine FROM near n JOIN placed p USING (query_id, id) WHERE n.rank <= 30 AND p.passes
)"""


@query(
    "postfilter_shortfall",
    f"""{_POST}
SELECT query_id, id, rank, round(cosine, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, id) AS rank FROM cut
) WHERE rank <= 10""",
)
def _(spark, d):
    found = nearest(spark, d, 30)
    kept = compare.post_filtered(found, t.documents(spark, d), t.filtered_queries(spark, d), 10)
    return kept.select("query_id", "id", "rank", rounded("score"))


def index(spark, d, metric="cosine"):
    return ivf.build(t.vectors(spark, d), N_LISTS, metric=metric)


def given_index(spark, d):
    """An index whose lists are given: one for each label, around the label's first vector."""
    rows = t.table(spark, d, "embeddings")
    first = rows.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    centroids = first.select(F.col("label").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return ivf.IvfIndex(ivf.assign(t.vectors(spark, d), centroids), centroids)


_LISTS = """centroids AS (SELECT label AS cell, min_by(embedding, vec_id)::DOUBLE[] AS c FROM embeddings GROUP BY label),
listed AS (
  SELECT vec_id AS id, cell FROM embeddings, centroids
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(embedding::DOUBLE[], c) DESC, cell) = 1
),
probes AS (
  SELECT query_id, cell, row_number() OVER (PARTITION BY query_id ORDER BY round(list_cosine_similarity(qv, c), 9) DESC, cell) AS probe
  FROM q, centroids
)"""


@query(
    "ann_comparison",
    f"""{_POST}, {_LISTS},
best AS (
  SELECT query_id, id, cosine, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, id) AS n
  FROM near JOIN listed USING (id) JOIN probes USING (query_id, cell) WHERE probe <= {N_GIVEN_PROBES}
),
exact AS (
  SELECT query_id, id, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, id) AS rank FROM placed WHERE passes
  ) WHERE rank <= 10
),
approx AS (
  SELECT query_id, id, rank FROM (
    SELECT b.*, row_number() OVER (PARTITION BY query_id ORDER BY round(b.cosine, 9) DESC, id) AS rank
    FROM best b JOIN placed p USING (query_id, id) WHERE b.n <= 30 AND p.passes
  ) WHERE rank <= 10
),
n AS (
  SELECT query_id, (SELECT count(*) FROM exact e WHERE e.query_id = q.query_id) AS exact_count,
         (SELECT count(*) FROM approx a WHERE a.query_id = q.query_id) AS approx_count,
         (SELECT count(*) FROM approx a JOIN exact e USING (query_id, id) WHERE a.query_id = q.query_id) AS common_results,
         coalesce((SELECT string_agg(id::VARCHAR, ',' ORDER BY rank) FROM exact e WHERE e.query_id = q.query_id), '') AS exact_ids,
         coalesce((SELECT string_agg(id::VARCHAR, ',' ORDER BY rank) FROM approx a WHERE a.query_id = q.query_id), '') AS approx_ids
  FROM q JOIN wish USING (query_id)
)
SELECT *, CASE WHEN least(exact_count, approx_count) = 0 THEN 0
          ELSE round(common_results / least(exact_count, approx_count), 6) END AS accuracy FROM n""",
)
def _(spark, d):
    near = codes.approximate(codes.build(given_index(spark, d)), N_GIVEN_PROBES)
    compared = compare.compare(t.vectors(spark, d), near, t.documents(spark, d), t.filtered_queries(spark, d), 10)
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["index"].cast("string")), ",")
    return compared.select(
        "query_id",
        ids("exact_results").alias("exact_ids"),
        ids("approx_results").alias("approx_ids"),
        *["exact_count", "approx_count", "common_results", rounded("accuracy")],
    )


query(
    "ivf_exhaustive",
    f"WITH {sql.VECTORS} SELECT query_id, id, rank, round(cosine, 6) AS score FROM near WHERE rank <= 10",
)(
    lambda spark, d: ivf.search(
        index(spark, d), t.vector_queries(spark, d).withColumn("k", F.lit(10)), 10, N_LISTS
    ).select("query_id", "id", "rank", rounded("score"))
)


@query(
    "ivf_search",
    f"""WITH {sql.VECTORS}, {_LISTS}
SELECT query_id, id, rank, round(cosine, 6) AS score FROM (
  SELECT query_id, id, cosine, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, id) AS rank
  FROM sims JOIN listed USING (id) JOIN probes USING (query_id, cell) WHERE probe <= {N_GIVEN_PROBES}
) WHERE rank <= 10""",
)
def _(spark, d):
    wanted = t.vector_queries(spark, d).withColumn("k", F.lit(10))
    return codes.search(codes.build(given_index(spark, d)), wanted, 10, N_GIVEN_PROBES).select("query_id", "id", "rank", rounded("score"))


@query(
    "recall_vs_nprobe",
    f"""WITH {sql.VECTORS}, {_LISTS}
SELECT nprobe, count(DISTINCT query_id) AS n_queries,
       round(count(*) FILTER (WHERE probe <= nprobe) / (count(DISTINCT query_id) * 10), 6) AS recall
FROM near JOIN listed USING (id) JOIN probes USING (query_id, cell), (VALUES (1), (2), (4), (8), (10)) v(nprobe)
WHERE rank <= 10 GROUP BY nprobe""",
)
def _(spark, d):
    wanted = t.vector_queries(spark, d).withColumn("k", F.lit(10))
    exact, given, rows = nearest(spark, d, 10), given_index(spark, d), None
    for nprobe in (1, 2, 4, 8, 10):
        row = compare.recall_at_k(exact, ivf.search(given, wanted, 10, nprobe), 10)
        row = row.select(F.lit(nprobe).alias("nprobe"), "n_queries", rounded("recall"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


query("recall_by_corpus_size")(
    lambda spark, d: compare.recall_by_size(
        t.vectors(spark, d), t.vector_queries(spark, d), 10, 5, N_LISTS, N_PROBES
    )
)
query(
    "index_info",
    "SELECT (SELECT max(len(embedding)) FROM embeddings) AS dim, (SELECT count(*) FROM documents) AS article_count, "
    "(SELECT count(*) FROM embeddings) AS vector_count",
)(lambda spark, d: embed.index_info(t.documents(spark, d), t.vectors(spark, d)))


@query(
    "cosine_of_next",
    """SELECT a.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine,
  round(sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])), 6) AS length
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _(spark, d):
    a = t.vectors(spark, d)
    b = a.select((F.col("id") - 1).alias("id"), F.col("embedding").alias("next"))
    return a.join(b, "id").select(
        "id",
        F.round(vec.cosine(F.col("embedding"), F.col("next")), 6).alias("cosine"),
        F.round(vec.norm(F.col("embedding")), 6).alias("length"),
    )


@query(
    "model_embeddings",
    f"""WITH parts AS (SELECT doc_id AS id, {sql.embedding_cleanup(sql.FIRST_LINE)} AS t, {sql.embedding_cleanup('text')} AS s FROM documents),
clean AS (SELECT id, substr(CASE WHEN t <> '' AND s <> '' THEN t || '. ' || s ELSE t || s END, 1, 2000) AS text FROM parts),
raw AS (
  SELECT id, length(text)::DOUBLE AS a, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS b,
         (length(text) - length(replace(text, ' ', '')))::DOUBLE AS c FROM clean WHERE length(text) > 10
)
SELECT id, round(a / sqrt(a * a + b * b + c * c), 4) AS x, round(b / sqrt(a * a + b * b + c * c), 4) AS y,
       round(c / sqrt(a * a + b * b + c * c), 4) AS z FROM raw""",
)
def _(spark, d):
    # A stand-in model with three features per text: length, letters e, blanks.
    def load():
        return lambda texts: [[len(x), x.count("e"), x.count(" ")] for x in texts]

    out = embed.with_model(embed.article_texts(t.documents(spark, d)), load)
    part = lambda i: F.round(F.col("embedding")[i].cast("double"), 4)
    return out.select("id", part(0).alias("x"), part(1).alias("y"), part(2).alias("z"))


@query("hashed_embeddings")
def _(spark, d):
    texts = embed.article_texts(t.documents(spark, d))
    return embed.hashed(embed.fit_hashed(texts), texts).select(
        "id", F.size("embedding").alias("dim"), F.round(vec.norm(F.col("embedding")), 4).alias("length")
    )


@query("hashed_semantic_search")
def _(spark, d):
    texts = embed.article_texts(t.documents(spark, d))
    model = embed.fit_hashed(texts)
    wanted = embed.hashed(model, embed.query_texts(t.queries(spark, d)), "query_vec").withColumn("k", F.lit(10))
    return knn.nearest(embed.hashed(model, texts), wanted, 10).select("query_id", "id", "rank", rounded("score"))


# Listings and statistics ------------------------------------------------------------------

_NAMES = ", ".join(f"('{n}')" for n in SOURCE_NAMES)
query(
    "source_listing",
    f"""WITH {sql.ARTICLES}, hits AS (
  SELECT n AS asked, a.* FROM (VALUES {_NAMES}) v(n) JOIN articles a ON contains(lower(a.source), lower(n))
)
SELECT asked, rank, id, title, published, total FROM (
  SELECT *, row_number() OVER (PARTITION BY asked ORDER BY published DESC, id) AS rank,
         count(*) OVER (PARTITION BY asked) AS total FROM hits
) WHERE rank <= 20""",
)(
    lambda spark, d: search.source_listing(t.articles(spark, d), SOURCE_NAMES).select(
        "asked", "rank", "id", "title", "published", "total"
    )
)
query("available_sources", "SELECT DISTINCT source FROM documents")(
    lambda spark, d: stats.sources(t.documents(spark, d))
)
query(
    "corpus_totals",
    f"WITH {sql.ARTICLES} SELECT count(*) AS articles, count(DISTINCT source) AS sources, "
    "count(DISTINCT category) AS categories FROM articles",
)(lambda spark, d: stats.totals(t.articles(spark, d)))
query(
    "corpus_stats",
    f"WITH {sql.ARTICLES}, {sql.STATS} SELECT dimension, name, cnt, round(pct, 6) AS pct FROM stats",
)(lambda spark, d: stats.counts(t.articles(spark, d)).select("dimension", "name", "cnt", rounded("pct")))
query(
    "top_n_per_dimension",
    f"""WITH {sql.ARTICLES}, {sql.STATS} SELECT dimension, name, cnt, rank FROM stats
WHERE dimension = 'language' OR rank <= CASE dimension WHEN 'source' THEN 10 ELSE 8 END""",
)(
    lambda spark, d: stats.top_n(stats.counts(t.articles(spark, d)), {"source": 10, "category": 8}).select(
        "dimension", "name", "cnt", "rank"
    )
)
query(
    "quick_stats",
    f"""WITH {sql.ARTICLES}, n AS (
  SELECT 'category' AS dimension, category AS name, count(*) AS cnt FROM articles GROUP BY category
  UNION ALL SELECT 'language', language, count(*) FROM articles GROUP BY language
)
SELECT dimension, name, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY cnt DESC, name NULLS FIRST) AS rank FROM n
) WHERE dimension = 'language' OR rank <= 5""",
)(lambda spark, d: stats.quick_stats(t.articles(spark, d)).select("dimension", "name", "cnt", "rank"))
query(
    "stats_report_lines",
    f"""WITH {sql.ARTICLES}, {sql.STATS}
SELECT dimension, rank, format('{{:<25}}{{:>5}} bài ({{:5.1f}}%)', name, cnt, pct) AS line FROM stats""",
)(lambda spark, d: stats.lines(stats.counts(t.articles(spark, d))).select("dimension", "rank", "line"))
query(
    "stats_report",
    f"""WITH {sql.ARTICLES}, {sql.STATS}
SELECT CASE dimension WHEN 'category' THEN 1 WHEN 'language' THEN 2 ELSE 3 END AS block, rank + 1 AS row,
       format('{{:<25}}{{:>5}} bài ({{:5.1f}}%)', name, cnt, pct) AS line FROM stats
UNION ALL SELECT 0, 0, '{stats.REPORT_TITLE}' UNION ALL SELECT 0, 1, repeat('=', 70) UNION ALL SELECT 0, 2, ''
UNION ALL SELECT 0, 3, '{stats.REPORT_TOTAL}' || count(*) FROM articles
UNION ALL SELECT 0, 4, '{stats.REPORT_STAMP}2024-03-01 00:00:00' UNION ALL SELECT 0, 5, ''
UNION ALL SELECT 1, 0, '{stats.REPORT_SECTIONS["category"]}' UNION ALL SELECT 2, 0, '{stats.REPORT_SECTIONS["language"]}'
UNION ALL SELECT 3, 0, '{stats.REPORT_SECTIONS["source"]}'
UNION ALL SELECT b, 1, repeat('-', 40) FROM (VALUES (1), (2), (3)) v(b)
UNION ALL SELECT b, 2000000000, '' FROM (VALUES (1), (2), (3)) v(b)""",
)(lambda spark, d: stats.report(t.articles(spark, d), "2024-03-01 00:00:00"))
query(
    "crawl_report_lines",
    f"""WITH {sql.ARTICLES}, c AS (SELECT * REPLACE (coalesce(category, 'Unknown') AS category) FROM articles),
n AS (
  SELECT 'category' AS dimension, category AS name, count(*) AS cnt, 25 AS w FROM c GROUP BY category
  UNION ALL SELECT 'language', language, count(*), 15 FROM c GROUP BY language
  UNION ALL SELECT 'source', source, count(*), 20 FROM c GROUP BY source
)
SELECT dimension, rank, rpad(name, w::INT, ' ') || format(' {{:>4}} bài ({{:5.1f}}%)', cnt, 100.0::DOUBLE * cnt / (SELECT count(*) FROM c)) AS line
FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY cnt DESC, name) AS rank FROM n)
WHERE dimension <> 'source' OR rank <= 15""",
)(
    lambda spark, d: stats.lines(
        stats.top_n(stats.counts(t.articles(spark, d).fillna("Unknown", ["category"]), False), {"source": 15}), True
    ).select("dimension", "rank", "line")
)

# Merge ------------------------------------------------------------------------------------

query(
    "searchable_articles",
    f"""WITH {sql.ARTICLES}
SELECT id, link FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS n FROM articles)
WHERE n = 1 AND length(concat_ws('. ', nullif({sql.embedding_cleanup('title')}, ''), nullif({sql.embedding_cleanup('summary')}, ''))) > 10""",
)(lambda spark, d: build.searchable(t.articles(spark, d)).select("id", "link"))
query(
    "dedup_first_by_link",
    f"""WITH {sql.ARTICLES}
SELECT id, link, title FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS n FROM articles) WHERE n = 1""",
)(lambda spark, d: dedup.first_by_link(t.articles(spark, d)).select("id", "link", "title"))


def merged(spark, d, **options):
    existing, incoming = t.recrawl(spark, d)
    return merge.upsert(existing, incoming, now(), **options)


query(
    "merge_upsert",
    f"""WITH {sql.RECRAWL}
SELECT CASE WHEN kind = 0 THEN id ELSE (SELECT max(doc_id) FROM documents) + row_number() OVER (PARTITION BY kind = 0 ORDER BY place) END AS id,
       title, md5(summary) AS summary_md5, link, published, category, language, source, crawled_time, kind > 0 AS is_new
FROM merged""",
)(
    lambda spark, d: merged(spark, d).articles.select(
        "id",
        "title",
        F.md5("summary").alias("summary_md5"),
        *["link", "published", "category", "language", "source", "crawled_time", "is_new"],
    )
)
query(
    "merge_counts",
    f"""WITH {sql.RECRAWL}
SELECT sum(n_old)::BIGINT AS existing, sum(n_new)::BIGINT AS incoming, count(*) FILTER (WHERE n_old = 0) AS added,
       (sum(n_new) - count(*) FILTER (WHERE n_old = 0))::BIGINT AS merged, (sum(n_old) + count(*) FILTER (WHERE n_old = 0))::BIGINT AS total
FROM bases""",
)(lambda spark, d: merged(spark, d).counters)


@query(
    "new_only_by_link",
    f"""WITH {sql.RECRAWL}
SELECT link, seq, title FROM rows_in WHERE kind > 0 AND link <> '' AND link NOT IN (SELECT link FROM rows_in WHERE kind = 0)""",
)
def _(spark, d):
    existing, incoming = t.recrawl(spark, d)
    fresh = dedup.new_by_link(incoming, existing)
    return fresh.select("link", (F.col("seq") % (1 << 40)).alias("seq"), "title")


@query(
    "normalise_articles",
    f"""WITH {sql.ARTICLES}
SELECT id, title, '' AS summary, '' AS link, published, coalesce(category, 'Unknown') AS category, language, source,
       '2024-03-01T00:00:00' AS crawled_time FROM articles""",
)
def _(spark, d):
    partial = t.articles(spark, d).withColumn("id", F.col("id").cast("string")).drop("summary", "link", "crawled_time")
    return merge.normalise(partial, now())


@query(
    "incremental_index_update",
    f"""WITH everything AS (
  SELECT doc_id AS id, {sql.sanitise(sql.FIRST_LINE)} || ' ' || {sql.sanitise('text')} AS body FROM documents
  UNION ALL
  SELECT 1000000000 + page_id, {sql.sanitise("regexp_extract(html, '<title>([^<]*)</title>', 1)")} || ' ' || {sql.sanitise('html')} FROM pages
)
SELECT token, count(DISTINCT id) AS df, count(*) AS tf
FROM (SELECT id, lower(unnest(regexp_extract_all(body, '{sql.WORDS}'))) AS token FROM everything) GROUP BY token""",
)
def _(spark, d):
    # Starts from an index that holds all documents, and wrong texts for the labelled ones;
    # adds the pages and puts the labelled documents right.
    docs = t.documents(spark, d).select("id", "title", "summary")
    labelled = t.table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    # Ids alone; texts would be moved and sorted to meet them.
    labelled = broadcast_if_small(labelled, max_rows=MAX_BROADCAST_BYTES // 16)
    edited = docs.join(labelled, "id")
    wrong = edited.select("id", F.lit("old title").alias("title"), F.reverse("summary").alias("summary"))
    start = keyword.build(docs.join(labelled, "id", "left_anti").unionByName(wrong))
    pages = t.table(spark, d, "pages").select(
        (F.col("page_id") + 1_000_000_000).alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("summary"),
    )
    updated = build.update_keywords(start, pages.unionByName(edited), edited.select("id"))
    tf = updated.postings.groupBy("token").agg(F.sum("tf").alias("tf"))
    return updated.term_stats.join(tf, "token")


# Text, dates and rules --------------------------------------------------------------------


@query(
    "sanitised_pages",
    f"""SELECT page_id, {sql.sanitise('html')} AS text, substr({sql.sanitise('html')}, 1, 240) AS short,
  CASE WHEN regexp_matches(lower(url), '^https?://') THEN url ELSE '' END AS link FROM pages""",
)
def _(spark, d):
    pages = t.table(spark, d, "pages")
    html = F.col("html")
    return pages.select(
        "page_id",
        tx.sanitise(html).alias("text"),
        tx.sanitise(html, 240).alias("short"),
        tx.safe_url(F.concat(F.lit(" \t"), F.col("url"), F.lit(" "))).alias("link"),
    )


@query(
    "embed_text_prepared",
    f"""SELECT * FROM (
  SELECT page_id AS id, substr(CASE WHEN t <> '' AND s <> '' THEN t || '. ' || s ELSE t || s END, 1, 2000) AS text
  FROM (SELECT page_id, {sql.embedding_cleanup("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS t, {sql.embedding_cleanup('html')} AS s FROM pages)
  UNION ALL
  SELECT 1000000000 + doc_id, substr(CASE WHEN s <> '' THEN s ELSE '' END, 1, 2000)
  FROM (SELECT doc_id, {sql.embedding_cleanup('text')} AS s FROM documents)
) WHERE length(text) > 10""",
)
def _(spark, d):
    pages = t.table(spark, d, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("summary"),
    )
    docs = t.documents(spark, d).select(
        (F.col("id") + 1_000_000_000).alias("id"), F.lit(None).cast("string").alias("title"), "summary"
    )
    return embed.article_texts(pages.unionByName(docs))


query(
    "query_texts_prepared",
    f"SELECT item_id AS query_id, {sql.embedding_cleanup('text')} AS text FROM benchmark",
)(lambda spark, d: embed.query_texts(t.queries(spark, d)))
query(
    "tokens_per_page",
    f"""SELECT page_id, lower(tok) AS token, count(*) AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, '{sql.WORDS}')) AS tok FROM pages) GROUP BY 1, 2""",
)(
    lambda spark, d: t.table(spark, d, "pages")
    .select("page_id", F.explode_outer(tx.tokens(F.col("html"))).alias("tok"))
    .where("tok is not null")
    .groupBy("page_id", F.lower("tok").alias("token"))
    .agg(F.count("*").alias("n"))
)


def dated_orders(spark, d):
    at = F.col("o_orderdate").cast("timestamp")
    shifted = at + F.expr("interval 5000 days")
    seconds = F.unix_timestamp(shifted)
    forms = [
        F.date_format(at, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(at, "yyyy-MM-dd HH:mm"),
        F.date_format(at, "yyyy-MM-dd"),
        F.date_format(at, "dd/MM/yyyy HH:mm:ss"),
        F.date_format(at, "dd/MM/yyyy HH:mm"),
        F.concat(F.lit("  "), F.date_format(at, "dd/MM/yyyy")),
        F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0700")),
        F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")),
        F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00")),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".250Z")),
        seconds.cast("string"),
        (seconds * 1000).cast("string"),
        F.concat(F.lit("on "), F.date_format(at, "yyyy-MM-dd")),
    ]
    form = F.pmod(F.col("o_orderkey"), F.lit(len(forms)))
    rendered = forms[-1]
    for i, text in enumerate(forms[:-1]):
        rendered = F.when(form == i, text).otherwise(rendered)
    return t.table(spark, d, "orders").select("o_orderkey", rendered.alias("published"))


query(
    "parse_dates",
    f"SELECT o_orderkey, published, strftime(expected, '%Y-%m-%d %H:%M:%S.%g') AS parsed FROM ({sql.DATED})",
)(
    lambda spark, d: dated_orders(spark, d).withColumn(
        "parsed", F.date_format(dates.first_datetime(["published"]), "yyyy-MM-dd HH:mm:ss.SSS")
    )
)
query(
    "format_dates",
    f"SELECT o_orderkey, coalesce(strftime(expected, '%d/%m/%Y %H:%M'), '') AS shown FROM ({sql.DATED})",
)(
    lambda spark, d: dated_orders(spark, d).select(
        "o_orderkey", dates.format_datetime(dates.parse_datetime(F.col("published"))).alias("shown")
    )
)
_KIND = sql.first_match("url", URL_RULES, "'other'")
query(
    "classify_urls",
    f"""SELECT page_id, {_KIND} AS kind, {sql.category('url')} AS category, {sql.language('url')} AS language,
  {sql.source('url')} AS source FROM pages""",
)(
    lambda spark, d: t.table(spark, d, "pages").select(
        "page_id",
        rules.first_match(F.col("url"), URL_RULES, F.lit("other")).alias("kind"),
        rules.category_of_url(F.col("url")).alias("category"),
        rules.language_of_url(F.col("url")).alias("language"),
        rules.source_of_url(F.col("url")).alias("source"),
    )
)


_URL_PATTERN = "split_part(url, '/', 3) || '/' || left(split_part(url, '/', 4), 3)"
query(
    "classify_urls_by_table",
    f"""WITH rules AS (
  SELECT -page_id AS priority, 'rule ' || page_id AS label,
         CASE WHEN page_id % 3 = 0 THEN upper({_URL_PATTERN}) ELSE {_URL_PATTERN} END AS pattern FROM pages
)
SELECT page_id, coalesce(arg_min(label, priority), 'other') AS kind FROM pages LEFT JOIN rules ON contains(url, pattern) GROUP BY page_id""",
)(lambda spark, d: classified_by_table(spark, d))


def classified_by_table(spark, d):
    """A rule for each page, the later page's first; every third is in upper case and finds nothing."""
    pages = t.table(spark, d, "pages")
    pattern = F.expr(_URL_PATTERN)
    rows = pages.select(
        (-F.col("page_id")).alias("priority"),
        F.when(F.col("page_id") % 3 == 0, F.upper(pattern)).otherwise(pattern).alias("pattern"),
        F.concat(F.lit("rule "), F.col("page_id").cast("string")).alias("label"),
    )
    return pages.select("page_id", rule_table.first_match(F.col("url"), rows, F.lit("other"), case_rules=0).alias("kind"))


def routing_queries(spark, d):
    line, source = F.col("title"), F.col("source")
    asked = (
        F.when(F.col("language") == "en", F.concat(F.lit("báo "), source))
        .when(F.col("language") == "fr", F.concat(F.lit("từ "), source, F.lit(" "), line))
        .when(F.col("language") == "es", F.concat(F.lit("Trang "), F.upper(source), F.lit(" "), line))
        .otherwise(line)
    )
    return t.documents(spark, d).select(F.col("id").alias("query_id"), asked.alias("query"))


_LINE = "split_part(text, chr(10), 1)"
_ROUTES = f"""
typed AS (
  SELECT doc_id AS query_id, CASE lang WHEN 'en' THEN 'báo ' || source WHEN 'fr' THEN 'từ ' || source || ' ' || {_LINE}
         WHEN 'es' THEN 'Trang ' || upper(source) || ' ' || {_LINE} ELSE {_LINE} END AS query
  FROM documents
),
named AS (
  SELECT *, CASE WHEN {" OR ".join(f"contains(lower(query), '{w}')" for w in SOURCE_WORDS)}
            THEN {sql.first_match("lower(query)", ALIASES, "NULL")} END AS source_name,
         {sql.first_match("lower(query)", [(p, p) for p, _ in ALIASES], "''")} AS alias
  FROM typed
),
stripped AS (
  SELECT *, replace(replace(replace(replace(replace(lower(query), 'báo', ''), 'trang', ''), 'nguồn', ''), 'từ', ''), 'của', '') AS no_fill
  FROM named
),
rest AS (
  SELECT *, {sql.strip("CASE WHEN alias = '' THEN no_fill ELSE replace(no_fill, alias, '') END")} AS rest FROM stripped
),
routed AS (
  SELECT query_id, query, CASE WHEN source_name IS NULL THEN 'content' WHEN length(rest) < 3 THEN 'source' ELSE 'mixed' END AS route,
         source_name, CASE WHEN source_name IS NULL THEN query WHEN length(rest) >= 3 THEN rest END AS content_query
  FROM rest
)"""
query("route_queries", f"WITH {_ROUTES} SELECT * FROM routed")(
    lambda spark, d: search.route(routing_queries(spark, d), ALIASES, SOURCE_WORDS)
)

def news_queries(spark, d):
    """Queries naming one of the news sources, which one by the length of the document."""
    names = F.array(*[F.lit(alias) for alias, _ in rules.SOURCE_ALIASES])
    docs = t.table(spark, d, "documents")
    alias = F.element_at(names, (F.col("n_chars") % len(rules.SOURCE_ALIASES) + 1).cast("int"))
    text = F.concat(F.lit("Đọc báo "), alias, F.lit(" "), t.first_line(F.col("text")))
    return docs.select(F.col("doc_id").alias("query_id"), text.alias("query"))


_ALIAS_LIST = "[" + ", ".join(f"'{a}'" for a, _ in rules.SOURCE_ALIASES) + "]"
query(
    "route_queries_news",
    f"""WITH typed AS (
  SELECT doc_id AS query_id, 'Đọc báo ' || {_ALIAS_LIST}[n_chars % 24 + 1] || ' ' || {_LINE} AS query FROM documents
),
named AS (SELECT *, {sql.first_match("lower(query)", rules.SOURCE_ALIASES, "NULL")} AS source_name FROM typed),
rest AS (
  SELECT *, {sql.strip("replace(replace(replace(replace(replace(replace(lower(query), 'báo', ''), 'trang', ''), 'nguồn', ''), 'từ', ''), 'của', ''), lower(source_name), '')")} AS rest
  FROM named
)
SELECT query_id, query, CASE WHEN length(rest) < 3 THEN 'source' ELSE 'mixed' END AS route, source_name,
       CASE WHEN length(rest) >= 3 THEN rest END AS content_query FROM rest""",
)(lambda spark, d: search.route(news_queries(spark, d), strip_alias=False))


@query(
    "routed_search",
    f"""WITH {_ROUTES}, {sql.hybrid("SELECT query_id, content_query AS query FROM routed WHERE route = 'content'")},
{sql.ARTICLES},
content AS (
  SELECT query_id, 'content' AS route, rank, doc_id, hybrid AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(hybrid, 9) DESC, doc_id) AS rank
    FROM fused JOIN documents USING (doc_id) WHERE hybrid >= 0.35
  ) WHERE rank <= 10
),
mixed_sims AS (
  SELECT r.query_id, lower(r.source_name) AS wanted, v.vec_id AS doc_id,
         list_cosine_similarity(e.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score
  FROM routed r JOIN embeddings e ON e.vec_id = r.query_id, embeddings v WHERE r.route = 'mixed'
),
mixed_near AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS n FROM mixed_sims
),
mixed AS (
  SELECT query_id, 'mixed' AS route, rank, doc_id, score FROM (
    SELECT m.*, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank
    FROM mixed_near m JOIN documents d USING (doc_id) WHERE n <= 30 AND contains(lower(d.source), wanted)
  ) WHERE rank <= 10
),
names AS (SELECT DISTINCT source_name FROM routed WHERE route = 'source'),
listing AS (
  SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY published DESC, id) AS rank
  FROM names JOIN articles a ON contains(lower(a.source), lower(source_name))
)
SELECT query_id, route, rank, doc_id, round(score, 6) AS score FROM content
UNION ALL SELECT query_id, route, rank, doc_id, round(score, 6) FROM mixed
UNION ALL SELECT query_id, route, rank, id, NULL FROM routed JOIN listing USING (source_name) WHERE route = 'source' AND rank <= 10""",
)
def _(spark, d):
    arts = t.articles(spark, d)
    corpus = search.Corpus(arts, keyword.build(arts), search.exact(t.vectors(spark, d)))
    given = t.vectors(spark, d).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    found = search.routed_search(
        corpus, routing_queries(spark, d), lambda q: q.join(given, "query_id", "left"), 10, ALIASES, SOURCE_WORDS
    )
    return found.withColumn("score", F.round("score", 6))


# Ingest, storage and streams ---------------------------------------------------------------


def ingested(spark, d, **limits):
    items, feed_list = t.feed_items(spark, d)
    url = F.col("feed")
    classified = feed_list.withColumns(
        {
            "category": rules.category_of_url(url),
            "language": rules.language_of_url(url),
            "source": rules.source_of_url(url),
        }
    )
    return ingest.ingest(items, classified, F.lit("2024-03-01T00:00:00"), **limits)


query(
    "ingest_quota",
    f"""WITH {sql.FEEDS}
SELECT id, title, link, {sql.category('feed')} AS category, {sql.language('feed')} AS language, {sql.source('feed')} AS source
FROM numbered""",
)(lambda spark, d: ingested(spark, d).articles.select("id", "title", "link", "category", "language", "source"))
query(
    "ingest_feed_outcomes",
    f"""WITH {sql.FEEDS},
listed AS (
  SELECT feed_seq, 'https://' || host || '/rss' AS feed, count(*) AS entries FROM host_rows GROUP BY ALL
  UNION ALL SELECT feed_seq, 'https://world.example/' || lang, count(*) FROM lang_rows GROUP BY ALL
)
SELECT feed_seq, feed, entries, (SELECT count(*) FROM taken t WHERE t.feed_seq = l.feed_seq) AS accepted, 'ok' AS status FROM listed l""",
)(lambda spark, d: ingested(spark, d).feeds)


_OUTCOMES = f"""WITH {sql.FEEDS},
listed AS (
  SELECT feed_seq, count(*) AS entries FROM host_rows GROUP BY ALL
  UNION ALL SELECT feed_seq, count(*) FROM lang_rows GROUP BY ALL
),
given AS (SELECT l.feed_seq, count(t.page_id) AS n FROM listed l LEFT JOIN taken t USING (feed_seq) GROUP BY l.feed_seq),
room AS (SELECT *, 100 - coalesce(sum(n) OVER (ORDER BY feed_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM given)
"""
query(
    "ingest_capped",
    f"""WITH {sql.FEEDS} SELECT id, link FROM numbered WHERE id < 100""",
)(lambda spark, d: ingested(spark, d, max_articles=100).articles.select("id", "link"))
query(
    "ingest_totals",
    f"""{_OUTCOMES}
SELECT count(*) FILTER (WHERE room > 0) AS successful_feeds, 0 AS failed_feeds,
       sum(least(n, greatest(room, 0)))::BIGINT AS total_articles FROM room""",
)(lambda spark, d: ingested(spark, d, max_articles=100).totals)


# Feeds of documents by language, each with a category by its address, and one without items.
_DOC_FEEDS = {
    "en": "https://www.bbc.co.uk/rss/technology.xml",
    "fr": "https://vnexpress.net/rss/the-thao.rss",
    "de": "https://vnexpress.net/rss/khoa-hoc.rss",
    "es": "https://tuoitre.vn/rss/the-gioi.rss",
    "none": "https://vnexpress.net/rss/gone.rss",
}


def doc_feeds(spark, d):
    """(items, feeds): documents in the feed of their language; equal texts share a link."""
    feeds_ = [(i, lang, url) for i, (lang, url) in enumerate(_DOC_FEEDS.items())]
    listed = spark.createDataFrame(feeds_, "feed_seq long, lang string, feed string")
    items = t.table(spark, d, "documents").join(F.broadcast(listed), "lang").select(
        "feed_seq",
        F.col("doc_id").alias("entry_seq"),
        t.first_line(F.col("text")).alias("title"),
        F.md5("text").alias("link"),
        F.lit("").alias("summary"),
        F.lit("").alias("published"),
    )
    return items, listed.drop("lang")


_FEED_ROWS = ", ".join(f"({i}, '{lang}', '{url}')" for i, (lang, url) in enumerate(_DOC_FEEDS.items()))
_QUOTA_CASE = " ".join(f"WHEN '{name}' THEN {n}" for name, n in rules.FEED_QUOTAS.items())


def _doc_feeds_sql(quota: str) -> str:
    return f"""feeds AS (SELECT *, {quota} AS quota FROM (VALUES {_FEED_ROWS}) v(feed_seq, lang, feed)),
firsts AS (
  SELECT md5(text) AS link, min(doc_id) AS doc_id, feed_seq, any_value(quota) AS quota
  FROM documents JOIN feeds USING (lang) GROUP BY ALL
),
owned AS (SELECT * FROM firsts),
taken AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_seq ORDER BY doc_id) AS n FROM owned) WHERE n <= quota
),
numbered AS (SELECT row_number() OVER (ORDER BY feed_seq, doc_id) - 1 AS id, link, feed_seq FROM taken)"""


query("ingest_large_quota", f"WITH {_doc_feeds_sql('500')} SELECT id, link FROM numbered")(
    lambda spark, d: large_quota(spark, d)
)


def large_quota(spark, d):
    items, feed_list = doc_feeds(spark, d)
    done = ingest.ingest(items, ingest.classify(feed_list).withColumn("quota", F.lit(500)), F.lit("2024-03-01T00:00:00"))
    return done.articles.select("id", "link")


@query(
    "ingest_classified",
    f"""WITH {_doc_feeds_sql(f"CASE {sql.category('feed')} {_QUOTA_CASE} ELSE {rules.DEFAULT_QUOTA} END")},
given AS (
  SELECT f.feed_seq, f.feed, (SELECT count(*) FROM documents WHERE lang = f.lang) AS entries,
         (SELECT count(*) FROM taken t WHERE t.feed_seq = f.feed_seq) AS n FROM feeds f
),
room AS (SELECT *, 150 - coalesce(sum(n) OVER (ORDER BY feed_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM given)
SELECT feed_seq, feed, entries, least(n, greatest(room, 0))::BIGINT AS accepted,
       CASE WHEN room <= 0 THEN 'not read' WHEN entries = 0 THEN 'failed' ELSE 'ok' END AS status FROM room""",
)
def _(spark, d):
    """Quotas by category; the crawl ends after 150 articles."""
    items, feed_list = doc_feeds(spark, d)
    return ingest.ingest(items, ingest.classify(feed_list), F.lit("2024-03-01T00:00:00"), max_articles=150).feeds


@query(
    "ingest_failed_feed",
    f"""WITH {_doc_feeds_sql(f"CASE {sql.category('feed')} {_QUOTA_CASE} ELSE {rules.DEFAULT_QUOTA} END")}
SELECT feed_seq, (SELECT count(*) FROM taken t WHERE t.feed_seq = f.feed_seq) AS accepted,
       CASE WHEN lang = 'none' THEN 'failed' ELSE 'ok' END AS status FROM feeds f""",
)
def _(spark, d):
    items, feed_list = doc_feeds(spark, d)
    done = ingest.ingest(items, ingest.classify(feed_list), F.lit("2024-03-01T00:00:00"))
    return done.feeds.select("feed_seq", "accepted", "status")


@query(
    "dates_of_ten_keys",
    f"""SELECT o_orderkey, o_orderdate + to_days((o_orderkey % 10)::INT) AS published_ts FROM orders""",
)
def _(spark, d):
    """Every order has a date in the key of its last digit and later ones; earlier keys hold junk or null."""
    orders = t.table(spark, d, "orders")
    place = F.col("o_orderkey") % 10

    def value(i: int):
        date = F.date_format(F.date_add("o_orderdate", F.lit(i)), "yyyy-MM-dd")
        junk = F.when(F.col("o_orderkey") % 3 == 0, F.lit("soon"))
        return F.when(place <= i, date).otherwise(junk)

    dated = orders.select("o_orderkey", *[value(i).alias(key) for i, key in enumerate(dates.DATE_KEYS)])
    return dated.select("o_orderkey", dates.first_datetime(dates.DATE_KEYS).cast("timestamp_ntz").alias("published_ts"))


def fresh_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/newsloom-{uuid.uuid4().hex}"


@query(
    "snapshot_round_trip",
    f"""WITH {sql.POSTINGS}
SELECT 'articles' AS name, count(*) AS n FROM documents UNION ALL SELECT 'embeddings', count(*) FROM embeddings
UNION ALL SELECT 'lists', count(*) FROM embeddings UNION ALL SELECT 'centroids', {N_LISTS}
UNION ALL SELECT 'postings', count(*) FROM postings UNION ALL SELECT 'doc_stats', count(*) FROM doc_stats
UNION ALL SELECT 'term_stats', count(*) FROM term_stats UNION ALL SELECT 'corpus_stats', 1""",
)
def _(spark, d):
    root = fresh_folder(spark)
    snapshots.save(spark, root, build.tables(t.documents(spark, d), t.vectors(spark, d), N_LISTS), "2024-03-01 00:00:00")
    rows = None
    stored = snapshots.load(spark, root)
    for name in ("articles", "embeddings", "lists", "centroids", "postings", "doc_stats", "term_stats", "corpus_stats"):
        row = stored[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query(
    "stored_hybrid_search",
    f"""WITH {sql.HYBRID}
SELECT query_id, rank, doc_id, round(hybrid, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(hybrid, 9) DESC, doc_id) AS rank
  FROM fused JOIN documents USING (doc_id) WHERE hybrid >= 0.35
) WHERE rank <= 10""",
)
def _(spark, d):
    # The same search over an index written and read back, with all lists probed.
    root = fresh_folder(spark)
    snapshots.save(spark, root, build.tables(t.documents(spark, d), t.vectors(spark, d), N_LISTS), "2024-03-01 00:00:00")
    corpus = build.corpus(snapshots.load(spark, root), nprobe=N_LISTS)
    return search.ranked(corpus, t.vector_queries(spark, d)).select("query_id", "rank", "doc_id", rounded("score"))


def _stored_keyword(spark, d):
    root = fresh_folder(spark)
    snapshots.save(spark, root, build.word_tables(t.documents(spark, d)), "2024-03-01 00:00:00")
    return build.words(snapshots.load(spark, root))


# Over an index written and read back, passing over blocks of documents that cannot be among the best.
_TEN_BEST = f"WITH {sql.KEYWORD} SELECT query_id, doc_id, rank, round(score, 6) AS score FROM kw WHERE rank <= 10"
query("stored_keyword_search", _TEN_BEST)(
    lambda spark, d: keyword.best(_stored_keyword(spark, d), t.queries(spark, d), 10, prune=True).select(
        "query_id", "doc_id", "rank", rounded("score")
    )
)
query("stored_keyword_candidates", SQL["keyword_candidate_cap"])(
    lambda spark, d: keyword.best(_stored_keyword(spark, d), t.queries(spark, d), prune=True).select(
        "query_id", "doc_id", "rank", rounded("score")
    )
)


@query("report_file", f"SELECT line FROM ({SQL['stats_report']})")
def _(spark, d):
    folder = fresh_folder(spark)
    snapshots.write_report(stats.report(t.articles(spark, d), "2024-03-01 00:00:00"), folder)
    return spark.read.text(folder).withColumnRenamed("value", "line")


@query("comparison_file", SQL["ann_comparison"])
def _(spark, d):
    folder = fresh_folder(spark)
    near = codes.approximate(codes.build(given_index(spark, d)), N_GIVEN_PROBES)
    compared = compare.compare(t.vectors(spark, d), near, t.documents(spark, d), t.filtered_queries(spark, d), 10)
    snapshots.write_comparison(compared, folder)
    back = spark.read.schema(compared.schema).json(folder)
    ids = lambda c: F.array_join(F.transform(c, lambda x: x["index"].cast("string")), ",")
    return back.select(
        "query_id",
        ids("exact_results").alias("exact_ids"),
        ids("approx_results").alias("approx_ids"),
        *["exact_count", "approx_count", "common_results", rounded("accuracy")],
    )


@query(
    "json_round_trip",
    f"""WITH {sql.ARTICLES}
SELECT id, title, md5(summary) AS summary_md5, link, published, category, language, source, crawled_time FROM articles""",
)
def _(spark, d):
    folder = fresh_folder(spark)
    json_articles.write(t.articles(spark, d), folder)
    back = json_articles.read_lines(spark, folder, now())
    return back.select(
        "id",
        "title",
        F.md5("summary").alias("summary_md5"),
        *["link", "published", "category", "language", "source", "crawled_time"],
    )


def json_dump(spark, d, wrapped: bool) -> str:
    """The articles as four JSON files in one folder: without category, those of odd id lack the field
    and the others have it null. Returns the folder."""
    arts = t.articles(spark, d).select("id", "title", "link", "source", "category")
    absent, null = F.to_json(F.struct(*arts.columns)), F.to_json(F.struct(*arts.columns), {"ignoreNullFields": "false"})
    rows = arts.select((F.col("id") % 4).alias("part"), "id", F.when(F.col("id") % 2 == 1, absent).otherwise(null).alias("item"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("id", "item"))), lambda x: x["item"])
    files = rows.groupBy("part").agg(F.concat(F.lit("["), F.array_join(items, ",\n"), F.lit("]")).alias("value"))
    if wrapped:
        files = files.withColumn("value", F.concat(F.lit('{"dim": 64, "articles": '), F.col("value"), F.lit("}")))
    folder = fresh_folder(spark)
    files.write.partitionBy("part").text(folder)
    return folder


def json_read(spark, d, wrapped: bool, range_bytes: int | None = None):
    """The four files, read last file first, whole or in ranges. seq shows the order."""
    folder = json_dump(spark, d, wrapped)
    paths = [f"{folder}/part={i}" for i in (3, 2, 1, 0)]
    if range_bytes is None:
        found = json_articles.read(spark, paths, now())
    else:
        found = json_articles.read_list(spark, paths, now(), range_bytes)
    place = F.row_number().over(Window.partitionBy("source").orderBy("seq"))
    return found.select("id", "title", "link", "category", "language", "source", "crawled_time", place.alias("place"))


_JSON_READ = f"""WITH {sql.ARTICLES}
SELECT id, title, link, CASE WHEN category IS NULL AND id % 2 = 1 THEN 'Unknown' ELSE category END AS category,
       'Unknown' AS language, source, '2024-03-01T00:00:00' AS crawled_time,
       row_number() OVER (PARTITION BY source ORDER BY id % 4 DESC, id) AS place FROM articles"""
query("json_list_read", _JSON_READ)(lambda spark, d: json_read(spark, d, False))
query("json_wrapped_read", _JSON_READ)(lambda spark, d: json_read(spark, d, True))
query("json_ranges_read", _JSON_READ)(lambda spark, d: json_read(spark, d, False, range_bytes=64 << 10))


@query(
    "matrix_round_trip",
    """SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, len(embedding) AS width, embedding[1]::DOUBLE AS first_value,
  embedding[len(embedding)]::DOUBLE AS last_value FROM embeddings WHERE embedding IS NOT NULL""",
)
def _(spark, d):
    """The vectors written as a matrix of several files and read again in ranges of rows."""
    folder = f"{fresh_folder(spark)}/matrix"
    vectors = t.table(spark, d, "embeddings").where("embedding is not null")
    matrices.write(vectors, folder, "vec_id", rows_per_file=300)
    back = matrices.read(spark, folder, partition_bytes=16 << 10)
    return back.select(
        "id",
        F.size("embedding").cast("long").alias("width"),
        F.element_at("embedding", 1).cast("double").alias("first_value"),
        F.element_at("embedding", -1).cast("double").alias("last_value"),
    )


@query(
    "merge_null_fields",
    f"""WITH {sql.ARTICLES}, kept AS (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY link ORDER BY id) = 1)
SELECT id, CASE WHEN category IS NULL AND id % 2 = 0 THEN 'late' WHEN category IS NULL THEN 'Unknown' ELSE category END AS category FROM kept""",
)
def _(spark, d):
    """Articles read with null and absent categories, merged with rows that have one."""
    folder = json_dump(spark, d, False)
    read = json_articles.read(spark, [f"{folder}/part={i}" for i in range(4)], now())
    first = dedup.first_by_link(read.drop("seq")).withColumn("seq", F.col("id"))
    late = first.withColumn("category", F.lit("late"))
    return merge.upsert(first, late, now()).articles.select("id", "category")


@query(
    "stream_first_links",
    "SELECT 'https://example.org/' || md5(text) AS link, count(DISTINCT text) AS n FROM documents GROUP BY 1",
)
def _(spark, d):
    folder = fresh_folder(spark)
    items = t.stream(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("https://example.org/"), F.md5("text")).alias("link"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("doc_id") % 86_400).alias("landed_at"),
    )
    unique = streaming.first_links(items, "landed_at", "2 days")
    streaming.to_parquet(unique, f"{folder}/items", f"{folder}/state").awaitTermination()
    stored = spark.read.schema("id long, link string, landed_at timestamp").parquet(f"{folder}/items")
    return stored.groupBy("link").agg(F.count("*").alias("n"))


@query(
    "feed_files",
    """SELECT page_id::VARCHAR AS published, regexp_replace(url, '[?#].*$', '') AS link,
  trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, md5(html) AS summary_md5 FROM pages""",
)
def _(spark, d):
    # Pages landed as feed files, then read as feeds.
    folder = fresh_folder(spark)
    items = t.table(spark, d, "pages").select(
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_replace("url", "[?#].*$", "").alias("link"),
        F.base64("html").alias("description"),
        F.col("page_id").cast("string").alias("pubDate"),
    )
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(folder)
    back = feeds.read(spark, folder)
    return back.select("published", "link", "title", F.md5(F.unbase64("summary")).alias("summary_md5"))


@query(
    "completed_embeddings",
    f"""SELECT doc_id AS id, 64 AS dim, vec_id IS NOT NULL AS stored
FROM documents LEFT JOIN embeddings ON vec_id = doc_id WHERE vec_id IS NOT NULL OR length({sql.embedding_cleanup('text')}) > 10""",
)
def _(spark, d):
    docs = t.documents(spark, d).withColumn("title", F.lit(""))
    stored = t.vectors(spark, d).join(docs.select("id"), "id", "left_semi")
    model = embed.fit_hashed(embed.article_texts(docs), 64)
    done = build.complete_embeddings(docs, stored, lambda texts: embed.hashed(model, texts))
    known = stored.select("id", F.lit(True).alias("stored"))
    return done.join(known, "id", "left").select(
        "id", F.size("embedding").alias("dim"), F.coalesce("stored", F.lit(False)).alias("stored")
    )


_MERGED_WORDS = f"""{sql.RECRAWL},
ids AS (
  SELECT *, CASE WHEN kind = 0 THEN id ELSE (SELECT max(doc_id) FROM documents) + row_number() OVER (PARTITION BY kind = 0 ORDER BY place) END AS doc
  FROM merged
),
merged_words AS (
  SELECT doc, lower(unnest(regexp_extract_all({sql.sanitise('title')} || ' ' || {sql.sanitise('summary')}, '{sql.WORDS}'))) AS token FROM ids
)"""


@query(
    "merge_and_update_index",
    f"WITH {_MERGED_WORDS} SELECT token, count(DISTINCT doc) AS df, count(*) AS tf FROM merged_words GROUP BY token",
)
def _(spark, d):
    # A stored collection takes a merge; its word statistics must be those of a fresh build.
    existing, incoming = t.recrawl(spark, d)
    articles = existing.drop("seq")
    model = embed.fit_hashed(embed.article_texts(articles))

    def encode(texts):
        return embed.hashed(model, texts)

    root = fresh_folder(spark)
    first = build.tables(articles, build.embedded(articles, encode), N_LISTS, iterations=2)
    snapshots.save(spark, root, first, "2024-03-01 00:00:00")
    after, _ = build.merge_and_update(snapshots.load(spark, root), incoming, encode, now())
    version = snapshots.save(spark, root, after, "2024-03-02 00:00:00")
    stored = snapshots.load(spark, root, version)
    tf = stored["postings"].groupBy("token").agg(F.sum("tf").alias("tf"))
    return stored["term_stats"].join(tf, "token")


@query(
    "stream_merge",
    f"""WITH {sql.ARTICLES}
SELECT row_number() OVER (ORDER BY id) - 1 AS id, link, title FROM (
  SELECT *, row_number() OVER (PARTITION BY link ORDER BY id) AS n FROM articles
) WHERE n = 1""",
)
def _(spark, d):
    # Documents land as a stream; every batch is merged into the stored articles.
    root = fresh_folder(spark)
    items = t.stream(spark, d, "documents").select(
        F.col("doc_id").alias("seq"),
        t.first_line(F.col("text")).alias("title"),
        F.concat(F.lit("https://example.org/"), F.md5("text")).alias("link"),
        F.col("lang").alias("language"),
        "source",
    )

    def handle(batch, number):
        build.merge_batch(batch.sparkSession, root, batch, now(), "2024-03-01 00:00:00", number=number)

    streaming.each_batch(items, handle, f"{root}/state").awaitTermination()
    return snapshots.load(spark, root)["articles"].select("id", "link", "title")


@query(
    "stream_index_update",
    f"""WITH {sql.ARTICLES}, kept AS (
  SELECT *, {sql.sanitise('title')} || ' ' || {sql.sanitise('summary')} AS body FROM articles
  QUALIFY row_number() OVER (PARTITION BY link ORDER BY id) = 1
)
SELECT token, count(DISTINCT id) AS df, count(*) AS tf
FROM (SELECT id, lower(unnest(regexp_extract_all(body, '{sql.WORDS}'))) AS token FROM kept) GROUP BY token""",
)
def _(spark, d):
    """Batches that update the indexes: first the English documents, then all of them; the second
    batch comes twice, as after a failure. Word statistics must be those of a fresh build."""
    root = fresh_folder(spark)
    items = t.articles(spark, d).withColumn("seq", F.col("id")).drop("id")
    model = embed.fit_hashed(embed.article_texts(t.articles(spark, d)), 64)
    encode = lambda texts: embed.hashed(model, texts)
    for number, batch in enumerate([items.where("language = 'en'"), items, items]):
        build.merge_batch(spark, root, batch, now(), "2024-03-01 00:00:00", encode, 4, min(number, 1))
    stored = snapshots.load(spark, root)
    tf = stored["postings"].groupBy("token").agg(F.sum("tf").alias("tf"))
    return stored["term_stats"].join(tf, "token")


query(
    "recall_by_corpus_size_exhaustive",
    """SELECT (SELECT count(*) FROM embeddings) * s // 5 AS corpus_size,
  (SELECT count(*) FROM benchmark JOIN embeddings ON vec_id = item_id) AS n_queries, 1.0::DOUBLE AS recall FROM range(1, 6) r(s)""",
)(lambda spark, d: compare.recall_by_size(t.vectors(spark, d), t.vector_queries(spark, d), 10, 5, 4, 4))
