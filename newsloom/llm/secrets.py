"""Secrets in texts: patterns, and character Markov models for what has no pattern.

Two models give the probability of a string from each character to the next: one of random strings,
one of ordinary identifiers. They are trained on a bounded sample of documents, whose strings are
labelled by the patterns: what a pattern finds is random, words outside of it are ordinary. A
string is a secret if the logarithm of the ratio of the two likelihoods is large enough, in all and
for each step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm import spans
from newsloom.llm.tables import column, free_name, let

#: Base kinds: the pattern, and what its match must be to count. Letters in either case where the
#: pattern says so are those of ASCII.
ASSIGN = r"""(?i)(?=[pstaPSTA])(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

#: Strings that the models judge: 20 characters or more with a digit among them.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
IDENTIFIER = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_][A-Za-z0-9_]{2,}+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: Documents of the sample, and the least log-likelihood ratio of a secret, in all and a step.
SAMPLE_ROWS = 20_000
LEAST_RATIO, LEAST_STEP = 12.0, 0.5
#: Weight of a character's own frequency against that of the step to it, in steps.
BACKOFF = 30.0


def base(text: Column) -> list[Column]:
    """Matches of the three base kinds."""
    assign = F.filter(
        spans.matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= 6
    )
    return [assign, spans.matches(text, ACCESS), spans.matches(text, HEX)]


@dataclass(frozen=True)
class Model:
    """ratio[128 * a + b]: log-likelihood ratio of character b after a, random against ordinary."""

    ratio: tuple[float, ...]


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Both models from about sample_rows documents. Without any sample all steps are alike and nothing
    is a secret."""
    sample = spans.sampled(docs, sample_rows, id_col).select(F.coalesce(column(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    found = F.flatten(F.array(*[F.transform(m, lambda x: x["value"]) for m in base(text)]))
    random = F.transform(found, lambda v: F.regexp_extract(v, "([A-Za-z0-9+/_.=-]+)$", 1))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), ACCESS, " "), HEX, " ")
    ordinary = F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))
    strings = sample.select(
        F.explode(
            F.concat(
                F.transform(random, lambda v: F.struct(v.alias("v"), F.lit(1).alias("label"))),
                F.transform(ordinary, lambda v: F.struct(v.alias("v"), F.lit(0).alias("label"))),
            )
        ).alias("s")
    )
    steps = F.explode(
        let(F.split("s.v", ""), lambda c: F.transform(F.slice(c, 2, F.size(c)), lambda b, i: F.concat(F.get(c, i), b)))
    )
    # At most as many rows as pairs of characters, twice.
    counted = strings.select("s.label", steps.alias("step")).groupBy("label", "step").count().collect()
    counts = {(r.label, r.step): r["count"] for r in counted if len(r.step) == 2}
    after = {(label, a): sum(counts.get((label, a + b), 0) for b in ALPHABET) for label in (0, 1) for a in ALPHABET}
    alone = {(label, b): 1 + sum(counts.get((label, a + b), 0) for a in ALPHABET) for label in (0, 1) for b in ALPHABET}
    every = [sum(alone[label, b] for b in ALPHABET) for label in (0, 1)]
    ratio = [0.0] * (128 * 128)

    def chance(label: int, a: str, b: str) -> float:
        """Of b after a; where a is rare, mostly that of b alone."""
        return (counts.get((label, a + b), 0) + BACKOFF * alone[label, b] / every[label]) / (after[label, a] + BACKOFF)

    for a in ALPHABET:
        for b in ALPHABET:
            ratio[128 * ord(a) + ord(b)] = math.log(chance(1, a, b) / chance(0, a, b))
    return Model(tuple(ratio))


def log_ratio(value: Column, model: Model) -> Column:
    """Sum of the steps' log-likelihood ratios."""
    table = F.split(F.lit(",".join(f"{x:.5f}" for x in model.ratio)), ",").cast("array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    steps = let(
        codes, lambda c: F.transform(F.slice(c, 2, F.size(c)), lambda b, i: F.get(table, (F.get(c, i) * 128 + b).cast("int")))
    )
    return F.aggregate(steps, F.lit(0.0), lambda a, x: a + x)


def is_random(value: Column, model: Model) -> Column:
    ratio = log_ratio(value, model)
    return let(ratio, lambda r: (r >= LEAST_RATIO) & (r >= LEAST_STEP * (F.length(value) - 1)))


def scanned(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with n_assign, n_access, n_hex, n_random, base_sha256 and spans.

    Spans are kind:start:end in code points, end exclusive, by start, then kind; base_sha256 is the
    digest of the base kinds' spans alone. A random span overlaps no base span. A null or empty text
    has none. Columns with these names are replaced; an empty table gives an empty table.
    """
    text, found = free_name(docs, "_scanned"), free_name(docs, "_found")
    rows = docs.withColumn(text, F.coalesce(column(text_col), F.lit("")))
    rows = rows.drop("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")

    def of(b: Column) -> Column:
        free = spans.clear_of(F.filter(spans.matches(column(text), CANDIDATE), lambda m: is_random(m["value"], model)), b)
        return F.struct(b.alias("base"), spans.tagged(free, 3).alias("more"))

    tagged = F.flatten(F.array(*[spans.tagged(m, k) for k, m in enumerate(base(column(text)))]))
    # explode() keeps the optimizer from computing the spans anew for every column made of them.
    rows = rows.withColumn(found, F.explode(F.array(let(tagged, of))))
    b, more = F.col(f"{found}.base"), F.col(f"{found}.more")
    count = lambda k: F.size(F.filter(b, lambda s: s["kind"] == k)).cast("long")
    return rows.withColumns(
        {
            "n_assign": count(0),
            "n_access": count(1),
            "n_hex": count(2),
            "n_random": F.size(more).cast("long"),
            "base_sha256": F.sha2(spans.joined(b, KINDS), 256),
            "spans": spans.joined(F.concat(b, more), KINDS),
        }
    ).drop(text, found)
