"""First-match substring rules held in a table, for lists too long to be one expression.

A short list becomes the CASE of functions.rules. A longer one becomes automata that find all patterns
in one walk over a text; its length then costs nothing more for a row. Only the text goes to Python.
"""

from __future__ import annotations

import uuid

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from newsloom.functions import rules as listed
from newsloom.operators import ranking

#: Rules that stay an expression.
CASE_RULES = 100
#: Rules and characters of one automaton; a longer list takes several, one after the other.
AUTOMATON_RULES = 100_000
AUTOMATON_CHARS = 4_000_000


def _slices(ordered: DataFrame) -> list[list[tuple[str, str]]]:
    """The rules in order, in lists of bounded size."""
    placed = ranking.dense_positions(ordered, [F.col("priority"), F.col("pattern")])
    spots = placed.select("pattern", "label", "position", (F.col("position") / AUTOMATON_RULES).cast("long").alias("_slice"))
    # Inside a slice of rules, further cuts by length: the window's rows are bounded by AUTOMATON_RULES.
    so_far = F.sum(F.length("pattern").cast("long")).over(W.partitionBy("_slice").orderBy("position"))
    cut = spots.withColumn("_cut", ((so_far - 1) / AUTOMATON_CHARS).cast("long"))
    keys = cut.select("_slice", "_cut").distinct().orderBy("_slice", "_cut").collect()
    held = []
    for key in keys:
        part = cut.where((F.col("_slice") == key["_slice"]) & (F.col("_cut") == key["_cut"])).orderBy("position")
        held.append([(r.pattern, r.label) for r in part.select("pattern", "label").collect()])
    return held


def _built(rules: list[tuple[str, str]]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, (pattern, _) in enumerate(rules):
        found.add_word(pattern, number)
    found.make_automaton()
    # A pattern that holds one of an earlier rule never decides.
    alive = ahocorasick.Automaton()
    for number, (pattern, _) in enumerate(rules):
        if min(n for _, n in found.iter(pattern)) == number:
            alive.add_word(pattern, number)
    alive.make_automaton()
    return alive


_KEPT: dict[str, ahocorasick.Automaton] = {}
_MOST_KEPT = 8


def _kept(key: str, rules: list[tuple[str, str]]) -> ahocorasick.Automaton:
    """The automaton of a list, built once in a worker; an old one makes room."""
    if key not in _KEPT:
        while len(_KEPT) >= _MOST_KEPT:
            del _KEPT[next(iter(_KEPT))]
        _KEPT[key] = _built(rules)
    return _KEPT[key]


def _scan(c: Column, held, key: str) -> Column:
    """Label of the first of the rules found in c, or null."""

    @F.pandas_udf("string")
    def label(texts: pd.Series) -> pd.Series:
        rules = held.value
        automaton = _kept(key, rules)
        out = []
        for text in texts:
            number = min((n for _, n in automaton.iter(text)), default=-1) if text else -1
            out.append(rules[number][1] if number >= 0 else None)
        return pd.Series(out, dtype=object)

    return label(c)


def first_match(c: Column, rules: DataFrame, default: Column | None = None, case_rules: int = CASE_RULES) -> Column:
    """Label of the first rule of (priority, pattern, label) whose pattern is a literal part of c.

    The smallest priority decides, of equal ones the smaller pattern, then the smaller label. A rule without a priority
    comes before all others, one without a pattern never matches, an empty pattern is in every text, and a label that is
    null counts as no match but lets later rules have their turn. A null text has no match; without one the result is
    default, or null. The rules are read when this is called.
    """
    spark = rules.sparkSession
    usable = rules.where("pattern is not null and label is not null")
    first = F.min(F.struct("priority", "label")).alias("first")
    ordered = usable.groupBy("pattern").agg(first).select("first.priority", "pattern", "first.label")
    head = ordered.orderBy("priority", "pattern").limit(case_rules + 1).collect()
    if len(head) <= case_rules:
        return listed.first_match(c, [(r.pattern, r.label) for r in head], default)
    # Rules behind an empty pattern never decide; its label is what texts without an earlier match get.
    empty = ordered.where("pattern = ''").first()
    if empty is not None:
        before = F.struct("priority", "pattern") < F.struct(F.lit(empty.priority).cast(ordered.schema["priority"].dataType), F.lit(""))
        ordered = ordered.where(before)
    results = [_scan(c, spark.sparkContext.broadcast(part), uuid.uuid4().hex) for part in _slices(ordered)]
    if empty is not None:
        results.append(F.when(c.isNotNull(), F.lit(empty.label)))
    if default is not None:
        results.append(default)
    return F.coalesce(*results) if results else F.lit(None).cast("string")
