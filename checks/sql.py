"""The SQL each query is checked against."""

from __future__ import annotations

from newsloom.functions import rules

WORDS = r"([\p{L}\p{N}_]{2,}|\x{130})"
SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"

# Entities that occur in the pages; cut-off ones lack the semicolon.
ENTITIES = {"&lt;?": "<", "&gt;?": ">", "&quot;?": '"', "&#39;?": "''", "&copy;?": "©", "&middot;?": "·", "&amp;?": "&"}


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def squeeze(c: str) -> str:
    return strip(f"regexp_replace({c}, '[{SPACE}]+', ' ', 'g')")


def unescape(c: str) -> str:
    for entity, character in ENTITIES.items():
        c = f"regexp_replace({c}, '{entity}', '{character}', 'g')"
    return c


def sanitise(c: str) -> str:
    text = unescape(f"coalesce({c}, '')")
    return squeeze(f"regexp_replace({text}, '<[^>]+>', ' ', 'g')")


def embedding_cleanup(c: str) -> str:
    c = f"regexp_replace({c}, '<[^>]+>', '', 'g')"
    c = f"regexp_replace({c}, 'http[^{SPACE}]+', '', 'g')"
    c = rf"regexp_replace({c}, '[^\p{{L}}\p{{N}}_{SPACE},.!?;:()\-]', ' ', 'g')"
    return squeeze(c)


def blank(c: str) -> str:
    return f"NOT coalesce(regexp_matches({c}, '[^{SPACE}]'), false)"


def first_match(c: str, pairs, default: str) -> str:
    whens = " ".join(f"WHEN contains({c}, '{p}') THEN '{label}'" for p, label in pairs)
    return f"CASE {whens} ELSE {default} END"


FIRST_LINE = "split_part(text, chr(10), 1)"
BODY = f"{FIRST_LINE} || ' ' || text"

ARTICLES = f"""
articles AS (
  SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, d.text AS summary,
         'https://example.org/' || md5(d.text) AS link,
         strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS published,
         CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS category,
         d.lang AS language, d.source, e.ts,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S') AS crawled_time
  FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN events e ON e.event_id = d.doc_id
)"""

POSTINGS = f"""
texts AS (
  SELECT doc_id, regexp_extract_all({BODY}, '{WORDS}') AS toks FROM documents
),
doc_stats AS (SELECT doc_id, len(toks) AS dl FROM texts),
postings AS (
  SELECT token, doc_id, count(*) AS tf
  FROM (SELECT doc_id, lower(unnest(toks)) AS token FROM texts) GROUP BY token, doc_id
),
term_stats AS (SELECT token, count(*) AS df FROM postings GROUP BY token)"""

ASKED = "asked AS (SELECT item_id AS query_id, text AS query FROM benchmark)"

_KEYWORD = f"""{POSTINGS},
terms AS (
  SELECT query_id, token, count(*) AS qcnt
  FROM (SELECT query_id, lower(unnest(regexp_extract_all(query, '{WORDS}'))) AS token FROM asked)
  GROUP BY query_id, token
),
corpus AS (SELECT count(*) AS n, avg(dl) AS avg_dl FROM doc_stats),
scored AS (
  SELECT query_id, doc_id,
         sum(ln((n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1)
             * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * (dl / (avg_dl + 1e-9))) + 1e-9))
             * (1 + 0.1::DOUBLE * (qcnt - 1))) AS score
  FROM terms JOIN postings USING (token) JOIN term_stats USING (token) JOIN doc_stats USING (doc_id), corpus
  GROUP BY query_id, doc_id
),
kw AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored
  ) WHERE rank <= 2000
)"""

_VECTORS = """
q AS (
  SELECT query_id, embedding::DOUBLE[] AS qv FROM asked JOIN embeddings ON vec_id = query_id
),
sims AS (
  SELECT query_id, vec_id AS id, list_cosine_similarity(qv, embedding::DOUBLE[]) AS cosine
  FROM q, embeddings
),
near AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cosine, 9) DESC, id) AS rank FROM sims
)"""

_HYBRID = f"""{_KEYWORD}, {_VECTORS},
sem AS (
  SELECT query_id, id AS doc_id, 1 / (1 + (1 - cosine)) AS score FROM near WHERE rank <= 60
),
sem_n AS (
  SELECT query_id, doc_id, score, CASE WHEN hi - lo < 1e-9 THEN 0 ELSE (score - lo) / (hi - lo) END AS norm
  FROM (SELECT *, min(score) OVER w AS lo, max(score) OVER w AS hi FROM sem WINDOW w AS (PARTITION BY query_id))
),
kw_n AS (
  SELECT query_id, doc_id, score, CASE WHEN hi - lo < 1e-9 THEN 0 ELSE (score - lo) / (hi - lo) END AS norm
  FROM (SELECT *, min(score) OVER w AS lo, max(score) OVER w AS hi FROM kw WINDOW w AS (PARTITION BY query_id))
),
fused AS (
  SELECT coalesce(s.query_id, k.query_id) AS query_id, coalesce(s.doc_id, k.doc_id) AS doc_id,
         s.score AS semantic, k.score AS keyword,
         0.55::DOUBLE * coalesce(s.norm, 0) + 0.45::DOUBLE * coalesce(k.norm, 0) AS hybrid
  FROM sem_n s FULL JOIN kw_n k ON s.query_id = k.query_id AND s.doc_id = k.doc_id
)"""


KEYWORD = f"{ASKED}, {_KEYWORD}"
VECTORS = f"{ASKED}, {_VECTORS}"
HYBRID = f"{ASKED}, {_HYBRID}"


def hybrid(asked: str) -> str:
    """The hybrid search for other queries than the benchmark passages."""
    return f"asked AS ({asked}), {_HYBRID}"


def results(candidates: str, newest: bool) -> str:
    """Search results from candidates(query_id, doc_id, score), in the display form."""
    first = "ts DESC NULLS LAST," if newest else ""
    return f"""
SELECT query_id, rank, doc_id, title, source, category, summary, '' || link AS link,
       coalesce(strftime(ts, '%d/%m/%Y %H:%M'), '') AS published, round(score, 4) AS score
FROM (
  SELECT c.query_id, c.doc_id, c.score, a.ts,
         {sanitise('a.title')} AS title, {sanitise('a.source')} AS source, {sanitise('a.category')} AS category,
         substr({sanitise('a.summary')}, 1, 240) AS summary, a.link,
         row_number() OVER (PARTITION BY c.query_id ORDER BY {first} round(c.score, 9) DESC, c.doc_id) AS rank
  FROM ({candidates}) c JOIN (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM articles) a ON a.id = c.doc_id
) WHERE rank <= 10"""


DATED = """
SELECT o_orderkey,
  CASE o_orderkey % 14
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M:%S')
    WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y %H:%M')
    WHEN 5 THEN '  ' || strftime(o_orderdate, '%d/%m/%Y')
    WHEN 6 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' +0700'
    WHEN 7 THEN strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S') || ' GMT'
    WHEN 8 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+07:00'
    WHEN 9 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
    WHEN 10 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.250Z'
    WHEN 11 THEN epoch(o_orderdate + INTERVAL 5000 DAY)::BIGINT::VARCHAR
    WHEN 12 THEN (epoch(o_orderdate + INTERVAL 5000 DAY)::BIGINT * 1000)::VARCHAR
    ELSE 'on ' || strftime(o_orderdate, '%Y-%m-%d')
  END AS published,
  CASE WHEN o_orderkey % 14 IN (0, 1, 2, 3, 4, 5, 7, 9) THEN o_orderdate
       WHEN o_orderkey % 14 IN (6, 8) THEN o_orderdate - INTERVAL 7 HOUR
       WHEN o_orderkey % 14 = 10 THEN o_orderdate + INTERVAL 250 MILLISECOND
       WHEN o_orderkey % 14 IN (11, 12) THEN o_orderdate + INTERVAL 5000 DAY
  END AS expected
FROM orders"""

STATS = f"""
label AS (
  SELECT coalesce(nullif({strip('category')}, ''), 'Unknown') AS category,
         coalesce(nullif({strip('language')}, ''), 'Unknown') AS language,
         coalesce(nullif({strip('source')}, ''), 'Unknown') AS source
  FROM articles
),
counted AS (
  SELECT 'category' AS dimension, category AS name, count(*) AS cnt FROM label GROUP BY category
  UNION ALL SELECT 'language', language, count(*) FROM label GROUP BY language
  UNION ALL SELECT 'source', source, count(*) FROM label GROUP BY source
),
stats AS (
  SELECT dimension, name, cnt, 100.0::DOUBLE * cnt / (SELECT count(*) FROM label) AS pct,
         row_number() OVER (PARTITION BY dimension ORDER BY cnt DESC, name) AS rank
  FROM counted
)"""

RECRAWL = f"""{ARTICLES},
base AS (
  SELECT * REPLACE (CASE WHEN length(summary) < 400 THEN '' ELSE link END AS link) FROM articles
),
rows_in AS (
  SELECT 0 AS kind, id AS seq, id, CASE WHEN language = 'de' THEN '' ELSE title END AS title, summary, link, published,
         coalesce(category, '') AS category, CASE WHEN language = 'es' THEN ' ' ELSE language END AS language,
         source, crawled_time
  FROM base
  UNION ALL
  SELECT 1, b.id, NULL, CASE WHEN toxic = 1 THEN '' ELSE title END,
         CASE WHEN quality = 1 THEN summary || ' ' || summary ELSE summary END, link, published, category, language,
         source,
         CASE WHEN toxic = 1 THEN '' WHEN quality = 1 THEN strftime(date_trunc('second', ts) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S') ELSE 'unknown' END
  FROM base b JOIN labels l ON l.doc_id = b.id
  UNION ALL
  SELECT 2, page_id, NULL, regexp_extract(html, '<title>([^<]*)</title>', 1), html,
         regexp_replace(url, '[?#].*$', ''), '', 'page', regexp_extract(html, 'lang="([^"]*)"', 1),
         regexp_extract(url, '^https?://([^/]+)', 1), '2024-02-01T00:00:00'
  FROM pages
),
keyed AS (
  SELECT *, row_number() OVER (ORDER BY kind, seq) AS place,
         CASE WHEN link <> '' THEN 'L:' || link
              ELSE 'F:' || {strip('title')} || chr(1) || {strip('source')} || chr(1) || {strip('published')} || chr(1) || {strip('category')} END AS key
  FROM rows_in
),
bases AS (
  SELECT key, coalesce(max(place) FILTER (WHERE kind = 0), min(place)) AS base_place,
         count(*) FILTER (WHERE kind = 0) AS n_old, count(*) FILTER (WHERE kind > 0) AS n_new
  FROM keyed GROUP BY key
),
chain AS (
  SELECT k.* FROM keyed k JOIN bases b USING (key) WHERE k.kind > 0 OR k.place = b.base_place
),
folded AS (
  SELECT key,
         list_reduce(list(summary ORDER BY place), lambda a, b: CASE WHEN {blank('b')} THEN a WHEN {blank('a')} OR length(b) > length(a) * 1.2::DOUBLE THEN b ELSE a END) AS summary,
         list_reduce(list(title ORDER BY place), lambda a, b: CASE WHEN {blank('a')} AND NOT ({blank('b')}) THEN b ELSE a END) AS title,
         list_reduce(list(published ORDER BY place), lambda a, b: CASE WHEN {blank('a')} AND NOT ({blank('b')}) THEN b ELSE a END) AS published,
         list_reduce(list(category ORDER BY place), lambda a, b: CASE WHEN {blank('a')} AND NOT ({blank('b')}) THEN b ELSE a END) AS category,
         list_reduce(list(language ORDER BY place), lambda a, b: CASE WHEN {blank('a')} AND NOT ({blank('b')}) THEN b ELSE a END) AS language,
         list_reduce(list(source ORDER BY place), lambda a, b: CASE WHEN {blank('a')} AND NOT ({blank('b')}) THEN b ELSE a END) AS source,
         list_reduce(list(crawled_time ORDER BY place), lambda a, b:
           CASE WHEN try_cast(a AS TIMESTAMP) IS NOT NULL AND try_cast(b AS TIMESTAMP) IS NOT NULL
                  THEN CASE WHEN b::TIMESTAMP >= a::TIMESTAMP THEN b ELSE a END
                WHEN try_cast(b AS TIMESTAMP) IS NOT NULL THEN b
                WHEN try_cast(a AS TIMESTAMP) IS NOT NULL THEN a
                WHEN b <> '' THEN b ELSE a END) AS crawled_time
  FROM chain GROUP BY key
),
merged AS (
  SELECT k.kind, k.place, k.id, k.link, b.base_place,
         CASE WHEN b.base_place = k.place THEN f.title ELSE k.title END AS title,
         CASE WHEN b.base_place = k.place THEN f.summary ELSE k.summary END AS summary,
         CASE WHEN b.base_place = k.place THEN f.published ELSE k.published END AS published,
         CASE WHEN b.base_place = k.place THEN f.category ELSE k.category END AS category,
         CASE WHEN b.base_place = k.place THEN f.language ELSE k.language END AS language,
         CASE WHEN b.base_place = k.place THEN f.source ELSE k.source END AS source,
         CASE WHEN b.base_place = k.place THEN f.crawled_time ELSE k.crawled_time END AS crawled_time
  FROM keyed k JOIN bases b USING (key) JOIN folded f USING (key)
  WHERE k.kind = 0 OR b.base_place = k.place
)"""

FEEDS = r"""
pg AS (
  SELECT page_id, regexp_replace(url, '[?#].*$', '') AS link,
         regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         regexp_extract(url, '^https?://([^/]+)', 1) AS host,
         regexp_extract(url, '^https?://[^/]+/([a-z]+)/', 1) AS lang
  FROM pages
),
host_rows AS (
  SELECT *, min(page_id) OVER (PARTITION BY host) AS feed_seq,
         row_number() OVER (PARTITION BY host, link ORDER BY page_id) AS copy FROM pg
),
host_taken AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS n FROM host_rows WHERE copy = 1
  ) WHERE n <= 3
),
lang_rows AS (
  SELECT *, 1099511627776 + min(page_id) OVER (PARTITION BY lang) AS feed_seq,
         row_number() OVER (PARTITION BY lang, link ORDER BY page_id) AS copy FROM pg
),
lang_taken AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY page_id) AS n
    FROM lang_rows WHERE copy = 1 AND link NOT IN (SELECT link FROM host_taken)
  ) WHERE n <= 20
),
taken AS (
  SELECT feed_seq, 'https://' || host || '/rss' AS feed, page_id, link, title FROM host_taken
  UNION ALL SELECT feed_seq, 'https://world.example/' || lang, page_id, link, title FROM lang_taken
),
numbered AS (SELECT *, row_number() OVER (ORDER BY feed_seq, page_id) - 1 AS id FROM taken)"""


def category(c: str) -> str:
    fallback = first_match(f"lower({c})", rules.CATEGORY_FALLBACK, f"'{rules.CATEGORY_DEFAULT}'")
    return first_match(f"lower({c})", rules.CATEGORY_RULES, f"({fallback})")


def language(c: str) -> str:
    names = [(d, "Vietnamese") for d in rules.VIETNAMESE_DOMAINS] + [(d, "English") for d in rules.ENGLISH_DOMAINS]
    return first_match(c, names, f"'{rules.LANGUAGE_DEFAULT}'")


def source(c: str) -> str:
    return first_match(c, rules.SOURCE_RULES, f"'{rules.SOURCE_DEFAULT}'")
