"""Personal data by weak supervision.

Four base kinds have exact patterns. Other candidates, number-like strings, addresses written around
an at sign and names after a title, are judged by labelers that each vote on a span: patterns of
national formats, gazetteers of titles, domain endings and calling codes, and words of the context
before it. Expectation-maximisation estimates from the votes alone how reliable each labeler is and
how likely each combination of votes is to be personal data. Those estimates are the labels for a
logistic classifier over the span's own shape and its votes, which decides.

Training sees a bounded sample of documents, aggregated to the distinct combinations of votes and
shape; applying it is one expression over the text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm import spans
from newsloom.llm.tables import column, free_name, let

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone", "other"]

#: What the labelers judge besides the base kinds.
CANDIDATE = (
    r"(?<![0-9A-Za-z.+-])\(?[0-9][0-9\x20().-]{5,28}[0-9](?![0-9A-Za-z])"
    r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9.-]{1,100}"
    r"|(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]+"
)
#: Fixed lists of the gazetteer and context labelers.
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof"]
ENDINGS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk"]
CALLING_CODES = ["1", "7", "33", "34", "39", "44", "49", "55", "81", "86", "91"]
CONTEXT = ["phone", "tel", "call", "fax", "mobile", "mail", "contact", "card", "ssn", "account", "iban", "born", "name", "address"]

SAMPLE_ROWS = 20_000
ROUNDS = 60
RIDGE = 1.0


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    def point(c: Column, i: Column) -> Column:
        d = c.cast("long")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return spans.total(F.transform(F.split(F.reverse(number), ""), point)) % 10 == 0


def _is_ip(m: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(m["value"], r"\."), lambda p: let(part(p), lambda x: (F.length(x) <= 3) & (x.cast("int") <= 255)))


def _is_card(m: Column) -> Column:
    return let(digits(m["value"]), lambda d: F.when(F.length(d).between(14, 19), passes_luhn(d)).otherwise(False))


def base(text: Column) -> list[Column]:
    """Matches of the four base kinds."""
    return [
        spans.matches(text, EMAIL),
        F.filter(spans.matches(text, IP), _is_ip),
        F.filter(spans.matches(text, CARD), _is_card),
        F.filter(spans.matches(text, PHONE), lambda m: F.length(digits(m["value"])).between(10, 15)),
    ]


#: Each labeler gives 1 or 0 for a match.
LABELERS = {
    "base_pattern": lambda m: m["value"].rlike(f"^(?:{EMAIL}|{IP})$|^{PHONE}$")
    | let(digits(m["value"]), lambda d: (F.length(d) >= 14) & _is_card(m)),
    "national_number": lambda m: m["value"].rlike(r"^(?:\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$"),
    "gazetteer": lambda m: m["value"].rlike(
        rf"^(?:{'|'.join(TITLES)})\b|\.(?:{'|'.join(ENDINGS)})$|^\+?(?:{'|'.join(CALLING_CODES)})[\x20(.-]"
    ),
    "context": lambda m: m["before"].rlike(rf"(?i)\b(?:{'|'.join(CONTEXT)})s?\b"),
}

#: Shape of a match, as yes or no.
SHAPE = {
    "has_at": lambda m: m["value"].contains("@") | m["value"].rlike(r"[(\[]at[)\]]"),
    "has_plus": lambda m: m["value"].startswith("+"),
    "many_digits": lambda m: F.length(digits(m["value"])) >= 10,
    "mostly_digits": lambda m: 2 * F.length(digits(m["value"])) >= F.length(m["value"]),
    "has_groups": lambda m: F.regexp_count(m["value"], F.lit(r"[\x20().-]+")) >= 2,
    "capital": lambda m: m["value"].rlike("[A-Z]"),
}


def votes_of(m: Column) -> Column:
    """Votes and shape of a match as a string of 0 and 1."""
    return F.concat(*[F.when(test(m), "1").otherwise("0") for test in [*LABELERS.values(), *SHAPE.values()]])


@dataclass(frozen=True)
class Model:
    """reliability: of each labeler the chance of a vote for personal data and for other spans.
    weights: of the classifier, the constant first."""

    reliability: tuple[tuple[float, float], ...]
    prior: float
    weights: tuple[float, ...]


def fit(patterns: dict[str, int]) -> Model:
    """EM over the labelers' votes, then a logistic classifier on its posteriors. patterns: spans of
    each combination of votes and shape."""
    n = len(LABELERS)
    rows = [([int(c) for c in p[:n]], [1.0, *map(float, p)], count) for p, count in sorted(patterns.items())]
    posterior = [0.9 if sum(votes[:2]) else 0.1 for votes, _, _ in rows]
    reliability, prior = [(0.7, 0.1)] * n, 0.5
    for _ in range(ROUNDS if rows else 0):
        yes = sum(q * c for q, (_, _, c) in zip(posterior, rows))
        no = sum((1 - q) * c for q, (_, _, c) in zip(posterior, rows))
        prior = (yes + 1) / (yes + no + 2)
        reliability = [
            (
                (sum(q * c * v[j] for q, (v, _, c) in zip(posterior, rows)) + 1) / (yes + 2),
                (sum((1 - q) * c * v[j] for q, (v, _, c) in zip(posterior, rows)) + 0.2) / (no + 2),
            )
            for j in range(n)
        ]
        for i, (votes, _, _) in enumerate(rows):
            odds = math.log(prior / (1 - prior))
            for v, (a, b) in zip(votes, reliability):
                odds += math.log(a / b) if v else math.log((1 - a) / (1 - b))
            posterior[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    weights = np.zeros(1 + n + len(SHAPE))
    if rows:
        x, c = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
        for _ in range(30):  # Newton's method with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = x.T @ (c * (np.array(posterior) - p)) - RIDGE * weights
            curve = (x * (c * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(weights))
            weights = weights + np.linalg.solve(curve, slope)
    else:
        weights[0] = -1.0
    return Model(tuple(reliability), prior, tuple(map(float, weights)))


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The model from about sample_rows documents: base spans and candidates, by votes and shape."""
    sample = spans.sampled(docs, sample_rows, id_col).select(F.coalesce(column(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    found = F.concat(*base(text), spans.matches(text, CANDIDATE))
    rows = sample.select(F.explode(found).alias("m")).select(votes_of(F.col("m")).alias("votes"))
    # At most 2 ** 10 rows.
    return fit({r.votes: r["count"] for r in rows.groupBy("votes").count().collect()})


def is_personal(m: Column, model: Model) -> Column:
    tests = [*LABELERS.values(), *SHAPE.values()]
    score = F.lit(model.weights[0])
    for w, test in zip(model.weights[1:], tests):
        score = score + F.when(test(m), F.lit(w)).otherwise(0.0)
    return score >= 0


def scanned(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone, n_other, base_sha256 and spans.

    Spans are kind:start:end in code points, end exclusive, by start, then kind; base_sha256 is the
    digest of the base kinds' spans alone. Other spans overlap no base span. A null or empty text
    has none. Columns with these names are replaced; an empty table gives an empty table.
    """
    text, found = free_name(docs, "_scanned"), free_name(docs, "_found")
    rows = docs.withColumn(text, F.coalesce(column(text_col), F.lit("")))
    rows = rows.drop("n_email", "n_ip", "n_card", "n_phone", "n_other", "base_sha256", "spans")

    def of(b: Column) -> Column:
        judged = F.filter(spans.matches(column(text), CANDIDATE), lambda m: is_personal(m, model))
        return F.struct(b.alias("base"), spans.tagged(spans.clear_of(judged, b), 4).alias("more"))

    tagged = F.flatten(F.array(*[spans.tagged(m, k) for k, m in enumerate(base(column(text)))]))
    # explode() keeps the optimizer from computing the spans anew for every column made of them.
    rows = rows.withColumn(found, F.explode(F.array(let(tagged, of))))
    b, more = F.col(f"{found}.base"), F.col(f"{found}.more")
    count = lambda k: F.size(F.filter(b, lambda s: s["kind"] == k)).cast("long")
    return rows.withColumns(
        {
            **{f"n_{kind}": count(k) for k, kind in enumerate(KINDS[:4])},
            "n_other": F.size(more).cast("long"),
            "base_sha256": F.sha2(spans.joined(b, KINDS), 256),
            "spans": spans.joined(F.concat(b, more), KINDS),
        }
    ).drop(text, found)
