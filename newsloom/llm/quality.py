"""Quality rules as a short-circuit cascade.

A rule is a name, the measures it needs and a test that is true for rejected documents. On a sample
the cost of a rule is timed and its rejections are counted, the rules are put in order of rejections
per cost, and the cascade evaluates them in that order as one CASE: a document that fails a rule is
not tested by later ones, and their measures, which are computed inside the branches, cost nothing
for it. The order changes the work and the name of the first failing rule, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm.tables import column, free_name, let, stored

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
#: Rows of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NOT_SPACE + "+")).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SYMBOL)).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, window: int = 3) -> Column:
    """Words that lie in a window of words found twice or more in the text. Windows are sorted by a
    hash of their words, so equal ones are neighbours; the work is n log n in the words."""

    def repeated(found: Column) -> Column:
        """Sorted first places of the windows that occur again, from windows sorted by hash."""
        n = F.size(found)
        again = F.filter(
            found,
            lambda x, i: ((i > 0) & (F.get(found, i - 1)["h"] == x["h"])) | ((i < n - 1) & (F.get(found, i + 1)["h"] == x["h"])),
        )
        return F.sort_array(F.transform(again, lambda x: x["p"]))

    def covered(places: Column) -> Column:
        """Words in windows that start at the places; windows may overlap."""
        fresh = F.transform(
            places, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1), p + window) - p).cast("long")
        )
        return F.aggregate(fresh, F.lit(0).cast("long"), lambda total, x: total + x)

    def of(w: Column) -> Column:
        hashed = lambda p: F.xxhash64(*[F.get(w, p + k) for k in range(window)])
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda p: F.struct(hashed(p).alias("h"), p.alias("p")))
        return F.when(F.size(w) > window, let(F.sort_array(windows), lambda s: let(repeated(s), covered))).otherwise(0)

    return let(words(text), of).cast("long")


MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words,
    "word_chars": word_chars,
    "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines,
    "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """rejects(m) is true for a document to reject; m(name) gives a measure as a column."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


#: The first two are the base rules. The others reject text that is hardly prose: words far too short
#: or long on average, a symbol for every third word, lines mostly repeated.
RULES = (
    Rule("too_few_words", lambda m: m("n_words") < 50),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
    Rule("symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("repeated_lines", lambda m: (m("n_dup_lines") >= 5) & (15 * m("n_dup_lines") > m("n_words"))),
)
BASE = ("too_few_words", "repeated_words")


def measures_of(text: Column) -> Callable[[str], Column]:
    return lambda name: MEASURES[name](text)


def ordered(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second, most first, as measured on about sample_rows rows. A rule that
    rejects none of them comes last, cheaper ones first."""
    texts, n = docs.select(F.coalesce(column(text_col), F.lit("")).alias("text")), docs.count()
    sample = stored(texts.sample(min(1.0, sample_rows / max(n, 1)), seed=5), "sample")
    measures, found = measures_of(F.col("text")), []
    for rule in rules:
        start = time.perf_counter()
        rejected = sample.filter(rule.rejects(measures)).count()
        found.append((-rejected / max(time.perf_counter() - start, 1e-6), time.perf_counter() - start, rule))
    return [rule for *_, rule in sorted(found, key=lambda x: x[:2])]


def first_failed(rules, measures: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, null if none does. One CASE, so later rules aren't evaluated."""
    chain = None
    for rule in rules:
        chain = F.when(rule.rejects(measures), rule.name) if chain is None else chain.when(rule.rejects(measures), rule.name)
    return F.lit(None).cast("string") if chain is None else chain


def assessed(docs: DataFrame, rules=RULES, text_col: str = "text", order: bool = True) -> DataFrame:
    """docs with all measures, base_failed, kept and failed_rule (the first rule of the cascade that
    rejects). A null text has no words and fails. Columns with these names are replaced; an empty
    table gives an empty table. Every measure is wanted here, so each is computed once and the
    cascade reads the columns; accepted() is the form that saves work."""
    rules = ordered(docs, rules, text_col) if order else list(rules)
    text = free_name(docs, "_text")
    new = [*MEASURES, "base_failed", "kept", "failed_rule"]
    rows = docs.withColumn(text, F.coalesce(column(text_col), F.lit("")))
    rows = rows.drop(*[c for c in new if c.lower() != text_col.lower()])
    rows = rows.withColumns({name: measure(column(text)) for name, measure in MEASURES.items()}).drop(text)
    base = [r for r in rules if r.name in BASE]
    rows = rows.withColumn("failed_rule", first_failed(rules, F.col))
    return rows.withColumns(
        {"base_failed": first_failed(base, F.col).isNotNull(), "kept": F.col("failed_rule").isNull()}
    )


def accepted(docs: DataFrame, rules=RULES, text_col: str = "text", order: bool = True) -> DataFrame:
    """The rows that no rule rejects, with their own columns. Measures are computed inside the
    branches of the cascade, so a document that fails early is spared the rest."""
    rules = ordered(docs, rules, text_col) if order else list(rules)
    text = F.coalesce(column(text_col), F.lit(""))
    return docs.filter(first_failed(rules, measures_of(text)).isNull())
