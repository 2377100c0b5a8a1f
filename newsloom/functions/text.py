"""Text clean-up, tokens and display strings.

Python's and Java's regex classes differ, so the Unicode ones are spelled out: SPACE is every
white-space character, WORD every letter, number or underscore.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

SPACE = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"

# Word runs of two or more characters. U+0130 is the one character whose lower case is
# longer than itself, so it passes the length test even when it stands alone.
TOKEN = rf"([{WORD}]{{2,}}|\x{{130}})"


def strip(c: Column) -> Column:
    """Trim Unicode white space at both ends (the built-in trim takes only blanks)."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def is_blank(c: Column) -> Column:
    return F.coalesce(~c.rlike(rf"[^{SPACE}]"), F.lit(True))


def squeeze(c: Column) -> Column:
    """White space runs to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(c, rf"[{SPACE}]+", " "))


def _unescape_udf():
    @F.pandas_udf(T.StringType())
    def unescape(texts: pd.Series) -> pd.Series:
        import html

        return texts.map(html.unescape, na_action="ignore")

    return unescape


def unescape_entities(c: Column) -> Column:
    """HTML entities to characters. Spark has no built-in; only texts with an & reach Python."""
    return F.coalesce(_unescape_udf()(F.when(F.contains(c, F.lit("&")), c)), c)


def _without_markup(c: Column) -> Column:
    """Entities to characters, then tags to blanks; most texts hold neither."""
    text = unescape_entities(F.coalesce(c, F.lit("")))
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, "<[^>]+>", " ")).otherwise(text)


def sanitise(c: Column, max_length: int | None = None) -> Column:
    """Plain text of an HTML fragment: entities first, then tags to blanks, then squeeze."""
    text = squeeze(_without_markup(c))
    return text if max_length is None else F.substring(text, 1, max_length)


def safe_url(c: Column) -> Column:
    url = strip(F.coalesce(c, F.lit("")))
    return F.when(F.lower(url).rlike("^https?://"), url).otherwise("")


def embedding_cleanup(c: Column) -> Column:
    """Clean-up before the embedding model: no tags, no URLs, only words and plain punctuation."""
    return _plain(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", ""))


def _plain(text: Column) -> Column:
    text = F.regexp_replace(text, rf"http[^{SPACE}]+", "")
    # Everything else, white space included, becomes one blank.
    return F.trim(F.regexp_replace(text, rf"[^{WORD},.!?;:()\-]+", " "))


def _cleanup_start(c: Column, n: int) -> Column:
    """embedding_cleanup(c), or of a long text a beginning of that, of n characters or more. Twice as many are cleaned
    first, up to a tag that they do not close, and without the last word; if that leaves too few, the whole text is."""
    start = F.regexp_replace(F.substring(c, 1, 2 * n), r"<[^>]*+\z", "")
    start = F.regexp_replace(F.regexp_replace(start, "<[^>]+>", ""), rf"(?<![^{SPACE}])[^{SPACE}]++\z", "")
    # In an array the cleaned text is looked at without being cleaned again.
    enough = F.get(F.filter(F.array(_plain(start)), lambda t: F.length(t) >= n), F.lit(0))
    whole = embedding_cleanup(c)
    return F.when(F.length(c) > 2 * n, F.coalesce(enough, whole)).otherwise(whole)


# The model's input limit and the shortest text worth embedding.
EMBED_MAX_CHARS = 2000
EMBED_MIN_CHARS = 10


def embedding_text(title: Column, summary: Column, max_chars: int = EMBED_MAX_CHARS) -> Column:
    """'title. summary', or whichever of the two is there, cut to the model's input limit."""
    cleaned = F.array(_cleanup_start(title, max_chars), _cleanup_start(summary, max_chars))
    parts = F.array_join(F.filter(cleaned, lambda t: t != ""), ". ")
    return F.substring(parts, 1, max_chars)


def embeddable(text: Column) -> Column:
    return F.length(text) > EMBED_MIN_CHARS


def tokens(c: Column) -> Column:
    """Word runs of a text; lower() the exploded tokens, which keeps that step in codegen."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(TOKEN), F.lit(1))


def indexed_text(title: Column, summary: Column) -> Column:
    """Text the keyword index is built on. White space is left as it is: tokens ignore it."""
    return F.concat_ws(" ", _without_markup(title), _without_markup(summary))


def preview(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def one_decimal(c: Column) -> Column:
    """'%5.1f': half-even on the exact value, right-aligned to five."""
    return _pad_left(F.call_function("format_number", c, F.lit("0.0")), 5)


def _pad_left(c: Column, width: int) -> Column:
    return F.when(F.length(c) < width, F.lpad(c, width, " ")).otherwise(c)


def _pad_right(c: Column, width: int) -> Column:
    return F.when(F.length(c) < width, F.rpad(c, width, " ")).otherwise(c)


def report_line(
    name: Column, count: Column, pct: Column, name_width: int = 25, gap: str = "", count_width: int = 5
) -> Column:
    """One line of the statistics report: padded name, padded count, share in percent."""
    return F.concat(
        _pad_right(name, name_width),
        F.lit(gap),
        _pad_left(count.cast("string"), count_width),
        F.lit(" bài ("),
        one_decimal(pct),
        F.lit("%)"),
    )


def merge_key(link: Column, title: Column, source: Column, published: Column, category: Column) -> Column:
    """Identity of an article: its link, or else the four stripped fields.

    The prefixes keep the two name spaces apart, so a link can never equal a field key.
    """
    parts = [strip(F.coalesce(c, F.lit(""))) for c in (title, source, published, category)]
    fields = F.to_json(F.array(*parts))
    has_link = F.coalesce(link, F.lit("")) != ""
    return F.when(has_link, F.concat(F.lit("L:"), link)).otherwise(F.concat(F.lit("F:"), fields))
