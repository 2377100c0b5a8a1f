"""Operators on hand-made fixtures, against plain restatements of what they should give."""

import math
import random
from collections import Counter
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.operators import compare, dedup, embed, fusion, ivf, keyword, knn, merge, ranking, sizing, stats
from newsloom.plans import ingest, search
from newsloom.schemas import ARTICLE, TEXT_FIELDS


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# Ranking and sizes


def test_top_k_and_positions_with_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SALTS", 3)
    rng = random.Random(1)
    rows = [(i, 0 if rng.random() < 0.4 else rng.randint(1, 40), rng.randint(0, 50)) for i in range(3000)]
    df = frame(spark, rows, "id long, g long, v long").repartition(6)
    want = {}
    for i, g, v in sorted(rows, key=lambda r: (-r[2], r[0])):
        want.setdefault(g, []).append(i)
    for two_rounds in (False, True):
        out = ranking.top_k(df, ["g"], [F.col("v").desc(), F.col("id").asc()], 7, two_rounds=two_rounds)
        got = {}
        for r in out.orderBy("g", "rank").collect():
            got.setdefault(r.g, []).append(r.id)
        assert got == {g: ids[:7] for g, ids in want.items()}
    placed = ranking.dense_positions(df, [F.col("id")]).collect()
    assert {r.id: r.position for r in placed} == {i: i for i in range(3000)}


def test_fits(spark):
    df = frame(spark, [("x" * 100,)] * 50, "s string")
    assert sizing.fits(df, 50, 10_000)
    assert not sizing.fits(df, 49, 10_000)
    assert not sizing.fits(df, 50, 1_000)
    assert sizing.fits(df.where("false"), 0, 0)


def test_held_keeps_rows_and_types(spark):
    df = frame(spark, [(1, "a", [1.0, 2.0]), (2, None, None)], "id long, s string, v array<float>")
    small = sizing.held(df)
    assert small.schema == df.schema and small.collect() == df.collect()
    wide = df.select("*", F.repeat(F.lit("x"), 5_000_000).alias("t"))
    assert sizing.held(wide) is wide


# Keyword search


def bm25(docs, query):
    words = lambda t: [w.lower() for w in t.replace(",", " ").replace(".", " ").split() if len(w) > 1]
    toks = {i: words(t) for i, t in docs.items()}
    n, avg = len(docs), sum(len(x) for x in toks.values()) / len(docs)
    df = Counter(w for x in toks.values() for w in set(x))
    scores = Counter()
    for w, q in Counter(words(query)).items():
        for i, x in toks.items():
            tf = x.count(w)
            if tf:
                idf = math.log((n - df[w] + 0.5) / (df[w] + 0.5) + 1)
                den = tf + 1.2 * (0.25 + 0.75 * len(x) / (avg + 1e-9))
                scores[i] += idf * tf * 2.2 / (den + 1e-9) * (1 + 0.1 * (q - 1))
    return scores


def corpus(spark, n=120, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = {i: " ".join(["the"] * (i % 3) + rng.choices(vocabulary, k=rng.randint(0, 30))) for i in range(n)}
    docs[n] = ""
    df = frame(spark, [(i, None, t) for i, t in docs.items()], "id long, title string, summary string")
    return docs, df.repartition(5)


QUERIES = [(1, "w1 w2 the"), (2, "w3 w3 w3 w4"), (3, "unknownword"), (4, "a w"), (5, "  "), (6, "The W7, w7.")]


@pytest.mark.parametrize("bound, listed", [(10**6, 200), (10**6, 2), (0, 2)])
def test_keyword_scores(spark, monkeypatch, bound, listed):
    """Also with words joined instead of listed, and with no broadcast at all."""
    monkeypatch.setattr(keyword, "fits", lambda df: sizing.fits(df, bound))
    monkeypatch.setattr(keyword, "SHORT_WORD_LIST", listed)
    docs, df = corpus(spark)
    queries = frame(spark, QUERIES, "query_id long, query string")
    got = {}
    for r in keyword.scores(keyword.build(df), queries).collect():
        got.setdefault(r.query_id, {})[r.doc_id] = r.score
    for q, text in QUERIES:
        want = bm25(docs, text)
        assert got.get(q, {}).keys() == want.keys()
        for i, score in want.items():
            assert got[q][i] == pytest.approx(score, rel=1e-12)


def test_documents_without_words_count(spark):
    _, df = corpus(spark)
    index = keyword.build(df)
    stats_row = index.corpus_stats().first()
    assert stats_row.n_docs == 121
    assert index.doc_stats.where("dl = 0").count() >= 1


def test_candidate_cap_keeps_the_best(spark):
    rows = [(1, i, float(i % 50)) for i in range(3000)] + [(2, 1, 1.0)]
    df = frame(spark, rows, "query_id long, doc_id long, score double").repartition(7)
    kept = keyword.candidates(df, 100)
    want = sorted(range(3000), key=lambda i: (-(i % 50), i))[:100]
    assert [r.doc_id for r in kept.where("query_id = 1").orderBy("rank").collect()] == want


# Vectors


def vectors(spark, n=300, dim=12, seed=2):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).astype(np.float32)
    data[10] = 0
    data[20:60] = data[20]  # copies, so that ties must go to the lower id
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return data, frame(spark, rows, "id long, embedding array<float>").repartition(5)


def exact_top(data, q, k, metric, allowed=None):
    d = data.astype(float)
    if metric == "cosine":
        scale = np.linalg.norm(d, axis=1) * np.linalg.norm(q)
        value = np.divide(d @ q, scale, out=np.zeros(len(d)), where=scale > 0)
        key = -np.round(value, 9)
    else:
        value = np.sqrt(np.maximum((q @ q) + (d**2).sum(axis=1) - 2 * d @ q, 0))
        key = np.round(value, 9)
    order = [i for i in np.lexsort((np.arange(len(d)), key)) if allowed is None or i in allowed]
    return order[:k]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("max_rows", [8192, 3])
def test_nearest_is_exact_on_both_paths(spark, monkeypatch, metric, max_rows):
    monkeypatch.setattr(knn, "_TILES", (2, 70))
    data, df = vectors(spark)
    rng = np.random.default_rng(9)
    asked = np.vstack([rng.normal(size=(6, 12)), data[20:21].astype(float)])
    depth = [1, 3, 5, 8, 50, 300, 10]
    rows = [(i, [float(x) for x in q], k) for i, (q, k) in enumerate(zip(asked, depth))]
    queries = frame(spark, rows, "query_id long, query_vec array<double>, k int")
    got = {}
    for r in knn.nearest(df, queries, 300, metric, max_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    for i, (q, k) in enumerate(zip(asked, depth)):
        assert got[i] == exact_top(data, q, k, metric)


def test_nearest_with_source_filter(spark):
    data, df = vectors(spark)
    articles = frame(spark, [(i, f"Src{i % 12}") for i in range(300)], "id long, source string")
    rows = [(0, [1.0] * 12, "SRC1"), (1, [0.5] * 12, None), (2, [0.5] * 12, "src11"), (3, [1.0] * 12, "zzz"), (4, [1.0] * 12, "")]
    queries = frame(spark, rows, "query_id long, query_vec array<double>, filter_source string")
    got = {}
    for r in compare.exact_filtered(df, articles, queries, 8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.id)
    for i, q, name in rows:
        allowed = {j for j in range(300) if (name or "").lower() in f"src{j % 12}"}
        assert got.get(i, []) == exact_top(data, np.array(q), 8, "cosine", allowed)


def test_too_large_k_is_refused(spark):
    _, df = vectors(spark)
    queries = frame(spark, [(1, [1.0] * 12, 9)], "query_id long, query_vec array<double>, k int")
    with pytest.raises(Exception, match="k above 5"):
        knn.nearest(df, queries, 5).collect()


def test_mixed_dimensions_are_refused(spark):
    df = frame(spark, [(1, [1.0, 2.0]), (2, [1.0])], "id long, embedding array<float>")
    queries = frame(spark, [(1, [1.0, 2.0], 1)], "query_id long, query_vec array<double>, k int")
    with pytest.raises(Exception, match="dimension"):
        knn.nearest(df, queries, 1).collect()
    articles = frame(spark, [(1,)], "id long")
    with pytest.raises(Exception, match="dimension"):
        embed.index_info(articles, df).collect()


def test_inverted_file(spark):
    data, df = vectors(spark)
    rows = [(i, [float(x) for x in data[i * 7]], 10) for i in range(20) if i * 7 != 10]
    queries = frame(spark, rows, "query_id long, query_vec array<double>, k int")
    exact = knn.nearest(df, queries, 10).cache()
    index = ivf.build(df, 8)
    assert index.vectors.count() == 300
    recalls = []
    for nprobe in (1, 2, 4, 8):
        recalls.append(compare.recall_at_k(exact, ivf.search(index, queries, 10, nprobe), 10).first().recall)
    assert recalls == sorted(recalls)
    assert recalls[-1] == 1.0
    exact.unpersist()


def test_agreement_and_lists(spark):
    schema = "query_id long, id long, score double, rank int"
    exact = frame(spark, [(1, i, 1.0 - i / 10, i) for i in range(1, 5)] + [(2, 1, 1.0, 1)], schema)
    approx = frame(spark, [(1, 2, 0.8, 1), (1, 9, 0.1, 2), (3, 1, 1.0, 1)], schema)
    got = {r.query_id: (r.exact_count, r.approx_count, r.common_results, r.accuracy) for r in compare.agreement(exact, approx).collect()}
    assert got == {1: (4, 2, 1, 0.5), 2: (1, 0, 0, 0.0), 3: (0, 1, 0, 0.0)}


def test_compare_returns_nested_lists(spark):
    _, df = vectors(spark)
    articles = frame(spark, [(i, "s") for i in range(300)], "id long, source string")
    queries = frame(spark, [(0, [1.0] * 12), (1, [2.0, -1.0] * 6)], "query_id long, query_vec array<double>")
    near = ivf.approximate(ivf.build(df, 4), 4)
    for row in compare.compare(df, near, articles, queries, 5).collect():
        assert row.accuracy == 1.0 and row.common_results == 5
        assert [x["index"] for x in row.exact_results] == [x["index"] for x in row.approx_results]
        similar = [x.similarity for x in row.exact_results]
        assert similar == sorted(similar, reverse=True)


# Fusion and search


def test_min_max(spark):
    rows = [(1, 1, 5.0), (2, 1, 3.0), (2, 2, 3.0), (3, 1, 1.0), (3, 2, 2.0), (3, 3, 5.0)]
    out = fusion.min_max(frame(spark, rows, "query_id long, doc_id long, score double"))
    got = {(r.query_id, r.doc_id): r.norm for r in out.collect()}
    assert got == {(1, 1): 0.0, (2, 1): 0.0, (2, 2): 0.0, (3, 1): 0.0, (3, 2): 0.25, (3, 3): 1.0}


def test_fuse_takes_the_union(spark):
    schema = "query_id long, doc_id long, score double"
    s = frame(spark, [(1, 1, 0.0), (1, 2, 1.0)], schema)
    k = frame(spark, [(1, 2, 4.0), (1, 3, 8.0)], schema)
    got = {r.doc_id: round(r.hybrid, 6) for r in fusion.fuse(s, k).collect()}
    assert got == {1: 0.0, 2: 0.55, 3: 0.45}


def small_corpus(spark):
    rows = [
        (1, "alpha beta", "gamma", "http://a/1", "2024-01-01", "c", "src1"),
        (2, "alpha", "alpha alpha", "ftp://a/2", "", None, "src1"),
        (3, "beta", "<b>alpha</b>", "http://a/3", "2024-03-01", "c", "src2"),
        (4, "delta", "epsilon", "http://a/4", "2024-02-01", "c", "src2"),
    ]
    names = "id long, title string, summary string, link string, published string, category string, source string"
    articles = frame(spark, rows, names)
    embeddings = frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (9, [1.0, 0.1])], "id long, embedding array<float>")
    return search.Corpus(articles, keyword.build(articles), search.exact(embeddings))


def test_search_modes_sorts_and_limits(spark):
    schema = "query_id long, query string, query_vec array<double>, topk int, mode string, sort string"
    rows = [
        (1, "alpha", [1.0, 0.0], 10, "keyword", "relevance"),
        (2, "alpha", [1.0, 0.0], 10, "KEYWORD", "newest"),
        (3, "alpha", [1.0, 0.0], 1, "keyword", "newest"),
        (4, "alpha", [1.0, 0.0], 10, "semantic", "relevance"),
        (5, "   ", [1.0, 0.0], 10, "semantic", "relevance"),
        (6, "zzz", [1.0, 0.0], 10, "keyword", "relevance"),
        (7, "alpha", [1.0, 0.0], 10, None, None),
    ]
    out = search.search(small_corpus(spark), frame(spark, rows, schema)).orderBy("query_id", "rank").collect()
    ids = {}
    for r in out:
        ids.setdefault(r.query_id, []).append(r.doc_id)
    assert ids[1][0] == 2 and set(ids[1]) == {1, 2, 3}
    assert ids[2] == [3, 1, 2]  # newest first, undated last
    assert ids[3] == [3]
    assert ids[4] == [1, 2]  # 3 is below the minimum, 9 is no article
    assert 5 not in ids and 6 not in ids
    assert 7 in ids
    by_doc = {(r.query_id, r.doc_id): r for r in out}
    assert by_doc[(2, 3)].published == "01/03/2024 00:00" and by_doc[(2, 3)].summary == "alpha"
    assert by_doc[(2, 2)].link == "" and by_doc[(2, 2)].category == "" and by_doc[(2, 2)].published == ""
    assert by_doc[(4, 2)].score == 0.5


def test_unknown_mode_is_refused(spark):
    queries = frame(spark, [(1, "alpha", [1.0, 0.0], "fuzzy")], "query_id long, query string, query_vec array<double>, mode string")
    with pytest.raises(Exception, match="unknown search mode"):
        search.search(small_corpus(spark), queries).collect()


def test_source_listing_orders(spark):
    rows = [(1, "VnExpress", "05/02/2024"), (2, "vnexpress sport", "2024-01-01"), (3, "BBC", ""), (4, "BBC", None), (5, "VnExpress", "05/02/2024")]
    articles = frame(spark, rows, "id long, source string, published string")
    out = search.source_listing(articles, ["VNEXPRESS", "bbc", "none"], 2).orderBy("asked", "rank").collect()
    assert [(r.asked, r.id, r.total) for r in out] == [("VNEXPRESS", 2, 3), ("VNEXPRESS", 1, 3), ("bbc", 3, 2), ("bbc", 4, 2)]
    out = search.source_listing(articles, ["vnexpress"], 3, by_date=True).orderBy("rank").collect()
    assert [r.id for r in out] == [1, 5, 2]


# Statistics


def test_counts_and_shares(spark):
    rows = [("a", "vi", "s1"), (" a", "vi", "s1"), ("", "en", "s2"), (None, "vi", None)]
    counted = stats.counts(frame(spark, rows, "category string, language string, source string"))
    got = {(r.dimension, r.name): (r.cnt, r.pct) for r in counted.collect()}
    assert got[("category", "a")] == (2, 50.0) and got[("category", "Unknown")] == (2, 50.0)
    assert got[("source", "Unknown")] == (1, 25.0)
    shares = counted.groupBy("dimension").agg(F.sum("pct").alias("p")).collect()
    assert all(r.p == pytest.approx(100.0) for r in shares)
    raw = stats.counts(frame(spark, rows, "category string, language string, source string"), fill_unknown=False)
    assert raw.where("dimension = 'category'").count() == 4


# Merge


def restated_fold(old, new):
    """What a merge should give, row by row."""

    def key(a):
        if a["link"]:
            return a["link"]
        return tuple(a[k].strip() for k in ("title", "source", "published", "category"))

    def iso(text):
        try:
            return datetime.fromisoformat(text)
        except ValueError:
            return None

    out = [dict(a) for a in old]
    place = {key(a): i for i, a in enumerate(out)}
    free = max([a["id"] for a in out], default=-1)
    added = 0
    seen = {}
    for a in new:
        k = key(a)
        if k not in place:
            free, added = free + 1, added + 1
            place[k] = len(out)
            out.append({**a, "id": free})
            continue
        seen.setdefault(k, []).append(a)
    for k, rows in seen.items():
        base = out[place[k]]
        for name in TEXT_FIELDS:
            if name != "summary" and not base[name].strip():
                base[name] = next((r[name] for r in rows if r[name].strip()), base[name])
        times = [base["crawled_time"]] + [r["crawled_time"] for r in rows]
        for r in rows:
            summary = r["summary"]
            if summary.strip() and (not base["summary"].strip() or len(summary) > 1.2 * len(base["summary"])):
                base["summary"] = summary
        good = [(iso(x), i, x) for i, x in enumerate(times) if iso(x)]
        texts = [x for x in times if x]
        base["crawled_time"] = max(good)[2] if good else texts[-1] if texts else "2024-05-05T00:00:00"
    return out, added, sum(map(len, seen.values()))


def random_article(rng, id_, links):
    return {
        "id": id_,
        "title": rng.choice(["", "t1", "t2", " "]),
        "summary": rng.choice(["", "  ", "a" * rng.randint(1, 60)]),
        "link": rng.choice(["", "http://hot/", "http://hot/"] + [f"http://l/{j}" for j in range(links)]),
        "published": rng.choice(["", "p"]),
        "category": rng.choice(["", "Unknown", "c1"]),
        "language": rng.choice(["", "en"]),
        "source": rng.choice(["s", "s "]),
        "crawled_time": rng.choice(["", "garbage", f"2024-01-0{rng.randint(1, 9)}", f"2024-01-0{rng.randint(1, 9)}T10:00:00"]),
    }


def merge_frame(spark, rows):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ARTICLE) + ", seq long"
    return spark.createDataFrame([[*(a[n] for n in ARTICLE.names), i] for i, a in enumerate(rows)], schema)


NOW = "2024-05-05 00:00:00"


@pytest.mark.parametrize("seed, chunk_bits, broadcast", [(1, 20, True), (2, 3, True), (3, 5, False)])
def test_merge_equals_the_restatement(spark, monkeypatch, seed, chunk_bits, broadcast):
    monkeypatch.setattr(merge, "CHUNK_BITS", chunk_bits)
    monkeypatch.setattr(merge, "fits", lambda df: broadcast)
    rng = random.Random(seed)
    old = [random_article(rng, i, 20) for i in range(60)]
    new = [random_article(rng, None, 30) for _ in range(500)]
    want, added, duplicates = restated_fold(old, new)
    done = merge.upsert(merge_frame(spark, old), merge_frame(spark, new), F.lit(NOW).cast("timestamp"))
    got = [r.asDict() for r in done.articles.orderBy("position").collect()]
    assert [{n: g[n] for n in ARTICLE.names} for g in got] == want
    row = done.counters.first()
    assert (row.existing, row.incoming, row.added, row.merged, row.total) == (60, 500, added, duplicates, len(want))


def test_summary_rule_depends_on_order(spark):
    def article(length, id_=None):
        return {**dict.fromkeys(TEXT_FIELDS, ""), "link": "x", "summary": "a" * length, "id": id_, "crawled_time": "2024-01-01"}

    for lengths, final in [([10, 13, 14], 13), ([10, 12], 10), ([10, 13, 12, 16], 16), ([0, 3, 2], 3)]:
        old, *new = [article(n) for n in lengths]
        old["id"] = 5
        done = merge.upsert(merge_frame(spark, [old]), merge_frame(spark, new), F.lit(NOW).cast("timestamp"))
        rows = done.articles.collect()
        assert [(r.id, len(r.summary)) for r in rows] == [(5, final)]


def test_merge_is_idempotent_and_handles_empty_sides(spark):
    rng = random.Random(8)
    rows = [{**random_article(rng, i, 30), "link": f"http://x/{i}", "crawled_time": "2024-01-01"} for i in range(30)]
    now = F.lit(NOW).cast("timestamp")
    again = merge.upsert(merge_frame(spark, rows), merge_frame(spark, rows), now)
    got = [{n: r[n] for n in ARTICLE.names} for r in again.articles.orderBy("position").collect()]
    assert got == rows
    none = merge_frame(spark, rows).where("false")
    assert merge.upsert(none, merge_frame(spark, rows), now).articles.count() == 30
    assert merge.upsert(merge_frame(spark, rows), none, now).counters.first().total == 30


def test_merge_can_keep_incoming_ids(spark):
    now = F.lit(NOW).cast("timestamp")
    blank = {**dict.fromkeys(TEXT_FIELDS, ""), "crawled_time": ""}
    old = [{**blank, "id": 7, "link": "a"}]
    new = [{**blank, "id": 100, "link": "b"}, {**blank, "id": None, "link": "c"}]
    kept = merge.upsert(merge_frame(spark, old), merge_frame(spark, new), now, keep_incoming_ids=True)
    assert {r.link: r.id for r in kept.articles.collect()} == {"a": 7, "b": 100, "c": 9}
    given = merge.upsert(merge_frame(spark, old), merge_frame(spark, new), now)
    assert {r.link: r.id for r in given.articles.collect()} == {"a": 7, "b": 8, "c": 9}


def test_normalise(spark):
    now = F.lit(NOW).cast("timestamp")
    df = frame(spark, [("12", None, "x"), ("abc", "t", "y")], "id string, title string, extra string")
    rows = merge.normalise(df, now).collect()
    assert (rows[0].id, rows[0].title, rows[0].category, rows[0].crawled_time) == (12, "", "Unknown", "2024-05-05T00:00:00")
    assert rows[1].id is None and rows[1].extra == "y"
    assert merge.normalise(df, now, absent_only=True).first().title is None


def test_dedup_keys(spark):
    names = "id long, link string, title string, source string, published string, category string"
    rows = [(1, "a", "t", "s", "p", "c"), (2, "a", "u", "s", "p", "c"), (3, "", "t", "s", "p", "c"), (4, None, " t", "s ", "p", "c"), (5, "", "v", "s", "p", "c")]
    df = frame(spark, rows, names)
    assert sorted(r.id for r in dedup.first_by_link(df).collect()) == [1, 3, 5]
    known = frame(spark, [("a",), ("a",), ("",), (None,)], "link string")
    fresh = frame(spark, [(1, "a"), (2, "b"), (3, ""), (4, None)], "id long, link string")
    assert [r.id for r in dedup.new_by_link(fresh, known).collect()] == [2]


# Ingest


def sequential_ingest(feeds, items, limit):
    seen, out, status = set(), [], {}
    for f, (_, quota) in sorted(feeds.items()):
        if len(out) >= limit:
            status[f] = "not read"
            continue
        rows = items.get(f, [])
        status[f] = "ok" if rows else "failed"
        taken = 0
        for e, link in rows:
            if len(out) >= limit or taken >= quota:
                break
            if link in seen:
                continue
            seen.add(link)
            out.append((len(out), f, e, link))
            taken += 1
    return out, status


@pytest.mark.parametrize("seed, limit", [(1, 10_000), (2, 10_000), (3, 25), (4, 10_000)])
def test_ingest_equals_reading_feed_by_feed(spark, seed, limit):
    rng = random.Random(seed)
    feeds = {f: (f"http://f{f}/rss", rng.randint(1, 8)) for f in range(12)}
    items = {f: [(e, f"l{rng.randint(0, 60)}") for e in range(rng.choice([0, 5, 30, 80]))] for f in feeds}
    want, status = sequential_ingest(feeds, items, limit)
    rows = [(f, e, "t", link, None, f"{f}/{e}") for f, entries in items.items() for e, link in entries]
    item_frame = frame(spark, rows, "feed_seq long, entry_seq long, title string, link string, summary string, published string")
    feed_frame = ingest.classify(frame(spark, [(f, url) for f, (url, _) in feeds.items()], "feed_seq long, feed string"))
    quotas = frame(spark, [(f, q) for f, (_, q) in feeds.items()], "feed_seq long, own int")
    feed_frame = feed_frame.join(quotas, "feed_seq").withColumn("quota", F.col("own")).drop("own")
    done = ingest.ingest(item_frame, feed_frame, F.lit("now"), limit)
    got = [(r.id, r.link, r.published) for r in done.articles.orderBy("id").collect()]
    assert got == [(i, link, f"{f}/{e}") for i, f, e, link in want]
    assert {r.feed_seq: r.status for r in done.feeds.collect()} == status
    total = done.totals.first()
    assert total.total_articles == len(want)
    assert total.failed_feeds == sum(s == "failed" for s in status.values())


# Embeddings


def test_model_is_given_clean_texts_in_batches(spark):
    articles = frame(spark, [(i, f"title {i}", "<p>some text</p>") for i in range(70)] + [(99, "short", "")], "id long, title string, summary string")

    def load():
        def model(texts):
            assert 0 < len(texts) <= 32
            return [[3.0 * len(t), 4.0 * len(t)] for t in texts]

        return model

    out = embed.with_model(embed.article_texts(articles), load).collect()
    assert len(out) == 70
    assert all(r.embedding == pytest.approx([0.6, 0.8]) for r in out)


def test_hashed_embeddings_find_the_same_text(spark):
    docs, df = corpus(spark, 40)
    texts = embed.article_texts(df)
    model = embed.fit_hashed(texts)
    ids = [i for i, t in docs.items() if len(t) > 40][:5]
    queries = frame(spark, [(i, docs[i]) for i in ids], "query_id long, query string")
    wanted = embed.hashed(model, embed.query_texts(queries), "query_vec").withColumn("k", F.lit(1))
    found = knn.nearest(embed.hashed(model, texts), wanted, 1).collect()
    assert {r.query_id: r.id for r in found} == {i: i for i in ids}
