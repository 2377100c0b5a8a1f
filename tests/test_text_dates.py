"""Text and date expressions on hand-made values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates, rules, text as tx
from newsloom.plans import search


def one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, clean",
    [
        (None, ""),
        ("plain", "plain"),
        ("  a  b c\n", "a b c"),
        ("&lt;b&gt;bold&lt;/b&gt; x", "bold x"),
        ("<p>one</p><p>two</p>", "one two"),
        ("&amp;lt; &eacute;&#39;", "&lt; é'"),
        ("a < b", "a < b"),
    ],
)
def test_sanitise(spark, value, clean):
    assert one(spark, value, tx.sanitise) == clean


@pytest.mark.parametrize(
    "value, clean",
    [
        ("HTTP://x.y", "HTTP://x.y"),
        ("  https://x.y \t", "https://x.y"),
        ("ftp://x.y", ""),
        ("javascript:alert(1)", ""),
        (None, ""),
    ],
)
def test_safe_url(spark, value, clean):
    assert one(spark, value, tx.safe_url) == clean


@pytest.mark.parametrize(
    "value, clean",
    [
        ("<b>bold</b>face", "boldface"),
        ("see https://a.b/c?d=1 now", "see now"),
        ("a&amp;b #1 – ok_(yes)!", "a amp;b 1 ok_(yes)!"),
        ("http", "http"),
        (None, ""),
    ],
)
def test_embedding_cleanup(spark, value, clean):
    assert one(spark, value, tx.embedding_cleanup) == clean


@pytest.mark.parametrize(
    "value, words",
    [
        ("Bóng đá, A I 2024!", ["Bóng", "đá", "2024"]),
        ("bóng", ["bo", "ng"]),  # a decomposed accent splits the word
        ("İ x", ["İ"]),  # lower case of this one letter is two characters long
        ("snake_case __", ["snake_case", "__"]),
        ("", []),
        (None, []),
    ],
)
def test_tokens(spark, value, words):
    assert one(spark, value, tx.tokens) == words


def test_embedding_text_and_limits(spark):
    rows = [("t", "s"), ("t", None), ("", "s"), (None, None), ("a" * 1999, "b" * 10), ("1234567890", ""), ("12345678901", "")]
    df = spark.createDataFrame(rows, "t string, s string")
    out = df.select(tx.embedding_text(F.col("t"), F.col("s")).alias("x")).select("x", tx.embeddable(F.col("x"))).collect()
    assert [r[0] for r in out[:4]] == ["t. s", "t", "s", ""]
    assert out[4][0] == "a" * 1999 + "."
    assert [r[1] for r in out] == [False, False, False, False, True, False, True]


def test_preview_and_report_line(spark):
    assert one(spark, "abcdef", lambda c: tx.preview(c, 3)) == "abc..."
    assert one(spark, "abc", lambda c: tx.preview(c, 3)) == "abc"
    for count, pct, name in [(12, 6.25, "Thể thao"), (123456, 100.0, "x" * 30), (0, 0.05, "")]:
        line = one(spark, name, lambda c: tx.report_line(c, F.lit(count), F.lit(pct)))
        assert line == f"{name:<25}{count:>5} bài ({pct:5.1f}%)"
        line = one(spark, name, lambda c: tx.report_line(c, F.lit(count), F.lit(pct), 15, " ", 4))
        assert line == f"{name:<15} {count:>4} bài ({pct:5.1f}%)"


@pytest.mark.parametrize(
    "value, parsed",
    [
        ("2024-01-31 10:20:30", datetime(2024, 1, 31, 10, 20, 30)),
        ("2024-1-3 1:2", datetime(2024, 1, 3, 1, 2)),
        ("2024-01-31", datetime(2024, 1, 31)),
        ("31/01/2024 10:20:30", datetime(2024, 1, 31, 10, 20, 30)),
        ("3/1/2024  1:2", datetime(2024, 1, 3, 1, 2)),
        ("31/01/2024", datetime(2024, 1, 31)),
        ("Wed, 31 Jan 2024 10:20:30 +0700", datetime(2024, 1, 31, 3, 20, 30)),
        ("wed, 31 JAN 2024 10:20:30 -01:30", datetime(2024, 1, 31, 11, 50, 30)),
        ("Wed, 31 Jan 2024 10:20:30 GMT", datetime(2024, 1, 31, 10, 20, 30)),
        ("Wed, 31 Jan 2024 10:20:30 Z", datetime(2024, 1, 31, 10, 20, 30)),
        ("Wed, 31 Jan 2024 10:20:30 XYZ", None),
        ("Wed, 31 Anj 2024 10:20:30 GMT", None),
        ("Wed 31 Jan 2024 10:20:30 GMT", None),
        ("2024-01-31T10:20:30", datetime(2024, 1, 31, 10, 20, 30)),
        ("2024-01-31T10:20:30Z", datetime(2024, 1, 31, 10, 20, 30)),
        ("2024-01-31T10:20:30+0700", datetime(2024, 1, 31, 3, 20, 30)),
        ("2024-01-31T10:20:30.5", datetime(2024, 1, 31, 10, 20, 30, 500000)),
        ("2024-01-31T10:20:30.123456+07:00", datetime(2024, 1, 31, 3, 20, 30, 123456)),
        ("2024-01-31T10:20", None),
        ("1706696430", datetime(2024, 1, 31, 10, 20, 30)),
        ("1706696430999", datetime(2024, 1, 31, 10, 20, 30)),
        ("17066964309", datetime(2510, 10, 27, 18, 11, 49)),
        ("253402300800", None),
        ("170669643", None),
        ("  2024-01-31 ", datetime(2024, 1, 31)),
        ("2024-02-30", None),
        ("2024-01-31 25:00", None),
        ("0000-01-01", None),
        ("yesterday", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_datetime(spark, value, parsed):
    got = one(spark, value, lambda c: F.date_format(dates.parse_datetime(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    want = None if parsed is None else parsed.strftime("%Y-%m-%d %H:%M:%S.%f")
    if value == "17066964309":
        assert got.startswith("2510-10")
    else:
        assert got == want


def test_first_datetime_and_format(spark):
    df = spark.createDataFrame([("", "bad", "31/01/2024 10:20"), ("2024-02-01", "", None)], "published string, date string, updatedAt string")
    out = df.select(dates.format_datetime(dates.first_datetime(df.columns))).collect()
    assert [r[0] for r in out] == ["31/01/2024 10:20", "01/02/2024 00:00"]
    assert one(spark, None, lambda c: dates.format_datetime(dates.first_datetime([]))) == ""


@pytest.mark.parametrize(
    "url, category, language, source",
    [
        ("https://vnexpress.net/rss/the-thao.rss", "Thể thao", "Vietnamese", "VnExpress"),
        ("https://x.vn/bong-da-viet-nam.rss", "Bóng đá", "Other", "Other"),
        ("https://feeds.bbci.co.uk/news/science_and_environment/rss.xml", "Khoa học", "English", "BBC"),
        ("https://www.skysports.com/rss/1", "Thể thao", "English", "Sky Sports"),
        ("https://a.b/NEWS", "Tin quốc tế", "Other", "Other"),
        ("https://a.b/rss", "Tin mới nhất", "Other", "Other"),
        ("https://a.b/", "Thế giới", "Other", "Other"),
    ],
)
def test_url_rules(spark, url, category, language, source):
    assert one(spark, url, rules.category_of_url) == category
    assert one(spark, url, rules.language_of_url) == language
    assert one(spark, url, rules.source_of_url) == source


def test_quota(spark):
    assert one(spark, "Du lịch", rules.feed_quota) == 80
    assert one(spark, "Golf", rules.feed_quota) == 100


@pytest.mark.parametrize(
    "query, strip_alias, want",
    [
        ("báo VnExpress", True, ("source", "VnExpress", None)),
        ("kinh tế từ báo bbc", True, ("mixed", "BBC", "kinh tế")),
        ("chứng khoán hôm nay", True, ("content", None, "chứng khoán hôm nay")),
        ("của tôi", True, ("content", None, "của tôi")),
        ("báo dantri", True, ("source", "Dân Trí", None)),
        ("báo dantri", False, ("mixed", "Dân Trí", "dantri")),
        ("tin trên cnn ab", True, ("mixed", "CNN", "tin trên  ab")),
        ("cnn ab", True, ("source", "CNN", None)),
        ("", True, ("content", None, "")),
    ],
)
def test_route(spark, query, strip_alias, want):
    df = spark.createDataFrame([(1, query)], "query_id long, query string")
    row = search.route(df, strip_alias=strip_alias).first()
    assert (row.route, row.source_name, row.content_query) == want
