"""Toxic documents by a string kernel machine over short pieces of text.

Two strings are alike as far as they share subsequences of three characters, each weighted by a decay for
every character it skips; insults with a changed ending, inserted characters or characters set apart
keep most of their subsequences. A document is a bag of pieces: its words, windows of long words, and runs of
single characters joined ("i d i o t").

The machine is a support vector machine on Nyström features, the kernel against landmark strings times
the inverse root of the landmarks' own kernel matrix. Labels are of documents, not of pieces: examples are the
pieces with a fragment that toxic documents share, weighted for and against by the documents of either
class that hold them, and ordinary pieces; in each round the pieces that the machine takes for insults join. Insults with a letter put in
are examples too.
A document's score adds up, for each of its pieces, how much more often pieces of such a value occur in
toxic documents than in clean ones, so a long text is not toxic for one chance likeness.

A linear function of the features is one weight for each subsequence of the landmarks. So a piece is scored
by looking up its own subsequences, whatever the number of landmarks, and each distinct piece once a
worker while it is remembered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm import textbytes as tb
from newsloom.llm.tables import column, hinted, stored
from newsloom.operators.ranking import top_k

DECAY = 0.7  # weight of a subsequence for each character that it skips
WINDOW, STEP = 24, 12  # bytes of a piece at most, and between the windows of a longer one
LANDMARKS = 160
ROUNDS = 2
#: Labelled documents of each class that the model is fitted on at most, chosen by a hash.
ROWS_PER_CLASS = 3000
#: Ordinary strings of clean documents among the examples, about.
ORDINARY = 12_000
FRAGMENT = 5  # bytes of the fragments that choose the first examples
TELLING = 20.0  # log-likelihood ratio from which a fragment speaks for toxic documents
#: Pieces that the machine takes for insults and that join the examples in a round, at most.
JOINING = 4000
STRETCHED = 24  # insults that join the examples with a letter put in
COST = 4.0
CLEARLY = 1.0  # log ratio of rates from which a bin of values speaks for toxic documents
EDGES = np.linspace(-1.2, 1.2, 25)  # of the bins of a piece's value
#: Distinct pieces whose scores a worker remembers before it starts anew.
REMEMBERED = 2_000_000

#: Symbols of the kernel: letters in either case, digits, other characters by the low bits of each byte;
#: 0 are the ASCII characters that only make gaps.
BITS = 7
SYMBOL = np.zeros(256, np.uint8)
SYMBOL[0x41:0x5B] = SYMBOL[0x61:0x7B] = np.arange(1, 27)
SYMBOL[0x30:0x3A] = np.arange(27, 37)
SYMBOL[0x80:] = 37 + (np.arange(128) & 63)


# Pieces


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row of each) of the pieces of some texts, at most WINDOW bytes each."""
    starts, ends = tb.spans(tb.SPACED[data], offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    characters = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    single = characters[ends] - characters[starts] == 1
    follows = np.zeros(len(starts), bool)
    follows[1:] = single[1:] & single[:-1] & (rows[1:] == rows[:-1])
    heads = np.flatnonzero(single & ~follows)
    tails = np.flatnonzero(single & ~np.append(follows[1:], False))
    long_run = tails - heads >= 2
    runs, stops = starts[heads[long_run]], ends[tails[long_run]]
    starts, ends = np.concatenate((starts, runs)), np.concatenate((ends, stops))
    rows = np.concatenate((rows, rows[heads[long_run]]))
    order = np.argsort(rows, kind="stable")
    return _windows(starts[order], ends[order], rows[order])


def _windows(starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = np.maximum(0, -(-(ends - starts - WINDOW) // STEP)) + 1
    which = np.repeat(np.arange(len(starts)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    begins = starts[which] + nth * STEP
    return begins, np.minimum(begins + WINDOW, ends[which]), rows[which]


def long_texts_cut(data: np.ndarray, offsets: np.ndarray, most: int = tb.SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As textbytes.sliced(), but a row of more bytes comes in several parts, cut after a word of two
    or more characters where there is one."""
    for first, piece, bounds in tb.sliced(data, offsets, most):
        if len(piece) <= 2 * most:
            yield first, piece, bounds
            continue
        at = 0
        while at < len(piece):
            end = min(at + most, len(piece))
            if end < len(piece):
                word = tb.SPACED[piece[at:end]]
                cuts = np.flatnonzero(word[:-2] & word[1:-1] & ~word[2:])
                end = at + (int(cuts[-1]) + 2 if len(cuts) else end - at)
            yield first, piece[at:end], np.array([0, end - at])
            at = end


# Kernel


@lru_cache(maxsize=WINDOW + 1)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    places = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return places, (DECAY ** (places[:, 2] - places[:, 0] - 2)).astype(np.float64)


def _by_length(strings: np.ndarray, lengths: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, codes of their subsequences) for rows of one length at a time; 0 stands for a gap."""
    for n in range(3, WINDOW + 1):
        every, places = np.flatnonzero(lengths == n), _triples(n)[0]
        for rows in np.array_split(every, max(1, -(-len(every) * len(places) // most))):
            if len(rows):
                s = strings[rows][:, places].astype(np.int32)
                codes = s[..., 0] << 2 * BITS | s[..., 1] << BITS | s[..., 2]
                codes[(s == 0).any(axis=2)] = 0
                yield rows, codes


def norms(strings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Root of each string's kernel with itself, by the usual recursion over its prefixes."""
    found = np.zeros(len(strings))
    for n in range(3, WINDOW + 1):
        for rows in np.array_split(w := np.flatnonzero(lengths == n), max(1, len(w) // 4096)):
            if not len(rows):
                continue
            s = strings[rows][:, :n].T
            below = np.ones((n + 1, n + 1, len(rows)))
            for step in range(3):
                last, total = np.zeros((n + 1, n + 1, len(rows))), np.zeros(len(rows))
                for i in range(n):
                    run = np.zeros(len(rows))
                    for j in range(n):
                        same = ((s[i] == s[j]) & (s[i] > 0)) * below[i, j]
                        run = DECAY * run + same
                        last[i + 1, j + 1] = DECAY * last[i, j + 1] + run
                        total += same
                below = last
            found[rows] = np.sqrt(total)
    return found


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(a row of symbols for each string, lengths)."""
    out = np.zeros((len(words), WINDOW), np.uint8)
    for i, w in enumerate(words):
        out[i, : len(w)] = SYMBOL[np.frombuffer(w, np.uint8)]
    return out, np.array([len(w) for w in words], np.int64)


class Landmarks:
    """Strings that others are compared with."""

    def __init__(self, strings: np.ndarray, lengths: np.ndarray):
        size = norms(strings, lengths)
        keep = size > 0
        strings, lengths, size = strings[keep], lengths[keep], size[keep]
        self.n = len(strings)
        self.place = np.zeros(1 << 3 * BITS, np.int32)
        found = list(_by_length(strings, lengths))
        codes = np.unique(np.concatenate([np.zeros(1, np.int32), *[c.ravel() for _, c in found]]))
        self.codes = codes[codes > 0]
        self.place[self.codes] = np.arange(1, len(self.codes) + 1)
        self.weights = np.zeros((len(self.codes) + 1, self.n))
        for rows, c in found:
            decay = _triples(int(lengths[rows[0]]))[1]
            for row, own in zip(rows, self.place[c]):
                np.add.at(self.weights[:, row], own, decay)
        self.weights[0] = 0
        self.weights /= np.maximum(size, 1e-300)
        value, vector = np.linalg.eigh(self.kernel(strings, lengths))
        good = value > 1e-8
        self.root = vector[:, good] / np.sqrt(value[good])

    def kernel(self, strings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Normalised kernel of each string with each landmark; 0 for strings without subsequences."""
        out, size = np.zeros((len(strings), self.n)), norms(strings, lengths)
        for rows, codes in _by_length(strings, lengths, 1 << 18):
            decay, part = _triples(int(lengths[rows[0]]))[1], np.zeros((len(rows), self.n))
            for t, place in enumerate(self.place[codes].T):
                hit = np.flatnonzero(place)
                part[hit] += decay[t] * self.weights[place[hit]]
            out[rows] = part / np.where(size[rows] > 0, size[rows], 1)[:, None]
        return out


@dataclass
class Model:
    """Weights of subsequences by code and an offset, what a piece of each bin of values adds to a
    document, and the line from the sum to a probability."""

    weights: np.ndarray
    offset: float
    evidence: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def values(self, strings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The machine's value of each piece, above 0 for insults."""
        total, size = np.zeros(len(strings)), norms(strings, lengths)
        for rows, codes in _by_length(strings, lengths):
            total[rows] = self.weights[codes] @ _triples(int(lengths[rows[0]]))[1]
        return np.where(size > 0, total / np.where(size > 0, size, 1), 0) + self.offset


def _fitted(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps; the last column of x is
    the offset, which is not held small."""
    v, held = np.zeros(x.shape[1]), np.ones(x.shape[1])
    held[-1] = 1e-6
    lost = lambda v: 0.5 * (held * v**2).sum() + (weight * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()
    for _ in range(50):
        inside = y * (x @ v) < 1
        xi, wi = x[inside], 2 * weight[inside]
        slope = held * v + xi.T @ (wi * (xi @ v - y[inside]))
        step = np.linalg.solve(np.diag(held) + xi.T @ (xi * wi[:, None]), slope)
        size, now = 1.0, lost(v)
        while size > 1e-6 and lost(v - size * step) > now - 1e-4 * size * (slope @ step):
            size /= 2
        v = v - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return v


def _line(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic line through the bags' values, both classes of equal weight, targets drawn in a little."""
    n = np.array([max(1, (labels == 0).sum()), max(1, (labels == 1).sum())])
    target = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight, x, v = 1 / n[labels], np.stack([values, np.ones(len(values))], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -500, 500)))
        curve = x.T @ (x * (weight * p * (1 - p) + 1e-9)[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (weight * (p - target)) + 1e-6 * v)
        step *= min(1, 5 / max(1e-9, np.abs(step).max()))
        v = v - step
        if np.abs(step).max() < 1e-9:
            break
    return float(v[0]), float(v[1])


def _spread(kernel_with, count: int, want: int, weight: np.ndarray) -> list[int]:
    """Strings that lie far from those chosen before, heavy ones first."""
    chosen, near = [], np.zeros(count)
    for _ in range(min(want, count)):
        worth = weight * (1 - near)
        k = int(np.argmax(worth))
        if worth[k] <= 1e-9:
            break
        chosen.append(k)
        near = np.maximum(near, kernel_with(k))
    return chosen


def _with_insertions(examples: dict[bytes, tuple[float, float]]) -> dict[bytes, tuple[float, float]]:
    """The examples, and the most usual clear insults with a letter put in at some places, for less weight."""
    clear = [w for w, (toward, against) in examples.items() if toward > 10 * against and 4 <= len(w) < WINDOW]
    out = dict(examples)
    for word in sorted(clear, key=lambda w: (-examples[w][0], w))[:STRETCHED]:
        for at in sorted({2, len(word) // 2, len(word) - 2}):
            letter = bytes([97 + zlib.crc32(word + bytes([at])) % 26])
            out.setdefault(word[:at] + letter + word[at:], (examples[word][0] / 6, 0.0))
    return out


def machine(examples: dict[bytes, tuple[float, float]], landmarks: int = LANDMARKS) -> Model:
    """The machine for example strings with their weights for and against being an insult."""
    examples = _with_insertions(examples)
    words = sorted(examples)
    s, n = symbols(words)
    toward, against = np.array([examples[w] for w in words], float).T
    size = norms(s, n)
    good, bad = np.flatnonzero((toward > against) & (size > 0)), np.flatnonzero((toward <= against) & (size > 0))
    # Landmarks: half from the insults, far from each other, half from the rest, dealt evenly.
    heavy = good[np.argsort(-toward[good], kind="stable")[: 8 * landmarks]]
    own = Landmarks(s[heavy], n[heavy])
    alike = own.kernel(s[heavy], n[heavy])
    chosen = heavy[_spread(lambda k: alike[:, k], len(heavy), landmarks // 2, np.sqrt(toward[heavy]))]
    even = bad[np.unique(np.linspace(0, len(bad) - 1, landmarks - len(chosen)).astype(int))] if len(bad) else bad
    both = np.concatenate((chosen, even))
    marks = Landmarks(s[both], n[both])
    x = np.concatenate((marks.kernel(s, n) @ marks.root, np.ones((len(s), 1))), axis=1)
    y = np.concatenate((np.ones(len(s)), -np.ones(len(s))))
    weight = np.concatenate((toward / toward.sum(), against / against.sum())) * COST * len(s)
    used = weight > 0
    v = _fitted(np.concatenate((x, x))[used], y[used], weight[used])
    weights = np.zeros(1 << 3 * BITS, np.float32)
    weights[marks.codes] = (marks.weights[1:] @ (marks.root @ v[:-1])).astype(np.float32)
    return Model(weights, float(v[-1]), np.zeros(len(EDGES) + 1))


# Spark jobs


class Scorer:
    """Values of pieces, each distinct one worked out once."""

    def __init__(self, model: Model):
        self.model, self.keys, self.values = model, np.zeros(0, np.uint64), np.zeros(0)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, rows, value of each piece), by row."""
        starts, ends, rows = pieces(data, offsets)
        known = SYMBOL[data]
        sums, back = tb.prefix_hashes(known)
        keys, first, which = np.unique(tb.span_hashes(sums, back, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)
        at = np.searchsorted(self.keys, keys)
        inside = np.minimum(at, max(0, len(self.keys) - 1))
        new = np.flatnonzero(self.keys[inside] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            lengths = (ends - starts)[first[new]]
            strings = np.zeros((len(new), WINDOW), np.uint8)
            places = starts[first[new]][:, None] + np.arange(WINDOW)
            inside = np.arange(WINDOW) < lengths[:, None]
            strings[inside] = known[places[inside]]
            found = self.model.values(strings, lengths)
            self.keys, self.values = np.insert(self.keys, at[new], keys[new]), np.insert(self.values, at[new], found)
        return starts, ends, rows, self.values[np.searchsorted(self.keys, keys)][which]


def _values(model):
    """A task that gives the value of each of some strings."""

    def run(batches):
        for batch in batches:
            found = model.value.values(*symbols(batch.column("word").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, "value"])

    return run


def _judged(model):
    """A task that gives for each row the sum of its pieces' evidence, the largest value, the first piece that has
    it, and the number of pieces in each bin."""

    def run(batches):
        score, bins = Scorer(model.value), len(EDGES) + 1
        for batch in batches:
            n = batch.num_rows
            total, most, word, counts = np.zeros(n), np.full(n, -np.inf), [b""] * n, np.zeros((n, bins), np.int64)
            for first, data, bounds in long_texts_cut(*tb.raw(batch.column("text"))):
                starts, ends, rows, found = score(data, bounds)
                if not len(rows):
                    continue
                bin_of = np.searchsorted(EDGES, found)
                np.add.at(counts, (first + rows, bin_of), 1)
                heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                best = np.maximum.reduceat(found, heads)
                at = np.flatnonzero(found == np.repeat(best, np.diff(np.append(heads, len(rows)))))
                at = at[np.append(True, rows[at][1:] != rows[at][:-1])]
                for k, v in zip(at.tolist(), best.tolist()):
                    row = first + int(rows[k])
                    if v > most[row]:
                        most[row], word[row] = v, data[starts[k] : ends[k]].tobytes()
            total = counts @ model.value.evidence
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, n * bins + 1, bins), pa.int32()), pa.array(counts.ravel()))
            kept = [c for c in batch.schema.names if c != "text"]
            made = [pa.array(total), pa.array(word, pa.binary()), listed]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], [*kept, "total", "word", "counts"])

    return run


def _words(batches):
    """The distinct pieces of each row."""
    for batch in batches:
        keys, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "label"))
        for first, data, bounds in long_texts_cut(*tb.raw(batch.column("text"))):
            starts, ends, rows = pieces(data, bounds)
            low, whole = tb.LOWER[data], tb.LOWER[data].tobytes()
            sums, back = tb.prefix_hashes(low)
            keyed = tb.span_hashes(sums, back, starts, ends) ^ tb.mix(rows.astype(np.uint64))
            kept = np.unique(keyed, return_index=True)[1]
            words = [whole[a:b] for a, b in zip(starts[kept].tolist(), ends[kept].tolist())]
            at = first + rows[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at]), pa.array(labels[at]), pa.array(words, pa.binary())], ["row", "label", "word"]
            )


def held_out(doc_id: Column) -> Column:
    """Whether labels of this id are kept from the fit: crc32 of the id as text divides by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _examples(docs: DataFrame, labels: DataFrame, rows_per_class: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(row, label, text) of a bounded number of labelled documents of each class."""
    known = (
        labels.select(column(id_col).alias("id"), column(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    dealt = F.xxhash64("id", F.lit(5))
    chosen = top_k(known, ["label"], [dealt, F.col("id")], rows_per_class, two_rounds=True).select("id", "label")
    texts = docs.select(column(id_col).alias("id"), column(text_col).alias("text")).where("text is not null")
    found = stored(texts.join(F.broadcast(chosen), "id").withColumn("row", F.monotonically_increasing_id()), "labelled")
    n = found.count()
    if n > 2 * rows_per_class:  # several texts have one id
        part = F.pmod(F.xxhash64("id", "text", "row"), F.lit(1 << 30))
        found = found.where(part < int(2 * rows_per_class / n * (1 << 30)))
    return found.select("row", "label", "text")


def _share(k: Column, n: Column, expected: Column) -> Column:
    return F.when(k > 0, k * F.log(k / (n * expected))).otherwise(0.0)


def _tallied(rows: DataFrame, counts: dict[int, int]) -> DataFrame:
    """(word, toxic, clean, worth): in how many documents of each class a piece occurs, and how much the most telling of
    its fragments speaks for the toxic ones."""
    words = stored(rows.repartition("row").mapInArrow(_words, "row long, label int, word binary"), "pieces")
    each = F.sequence(F.lit(1), F.greatest(F.length("word") - (FRAGMENT - 1), F.lit(1)))
    fragments = F.explode(F.array_distinct(F.transform(each, lambda i: F.substring(F.col("word"), i, F.lit(FRAGMENT)))))
    toxic, clean = (F.sum((F.col("label") == k).cast("long")) for k in (1, 0))
    seen = words.select("row", "label", fragments.alias("fragment")).distinct()
    tally = seen.groupBy("fragment").agg(toxic.alias("toxic"), clean.alias("clean"))
    n, share = F.col("toxic") + F.col("clean"), F.lit(counts[1] / (counts[0] + counts[1]))
    ratio = 2 * (_share(F.col("toxic"), n, share) + _share(F.col("clean"), n, 1 - share))
    telling = tally.where(F.col("toxic") > n * share).select("fragment", ratio.alias("worth"))
    telling = stored(telling.where(F.col("worth") > TELLING / 4), "fragments")
    held = words.groupBy("word").agg(toxic.alias("toxic"), clean.alias("clean"))
    worth = held.select("word", fragments.alias("fragment")).join(hinted(telling, 24), "fragment").groupBy("word")
    return stored(held.join(worth.agg(F.max("worth").alias("worth")), "word", "left"), "tally")


def trained(
    docs: DataFrame,
    labels: DataFrame,
    rows_per_class: int = ROWS_PER_CLASS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """The model for labelled documents whose ids are not held out.

    Rows with a null id, text or label, or another label than 0 and 1, teach nothing; an id labelled both ways
    counts as toxic; repeated rows count as often as they occur. At most rows_per_class ids of a class
    are used, and about as many rows. With one class alone, or nothing that tells the classes apart, every
    document gets the same score, the smoothed share of toxic rows.
    """
    spark = docs.sparkSession
    rows = _examples(docs, labels, rows_per_class, id_col, text_col, label_col)
    counts = {0: 0, 1: 0} | {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    share = (counts[1] + 1) / (counts[0] + counts[1] + 2)
    level = Model(np.zeros(1 << 3 * BITS, np.float32), 0.0, np.zeros(len(EDGES) + 1), 0.0, float(np.log(share / (1 - share))))
    if not counts[0] or not counts[1]:
        return level
    tally = _tallied(rows, counts)
    best, n = tally.agg(F.max("worth"), F.count(F.when(F.col("clean") > 0, 1))).first()
    if best is None:
        return level
    weighed = ["word", (F.col("toxic") / counts[1]).alias("toward"), (F.col("clean") / counts[0]).alias("against")]
    # The heaviest alone where fragments of more pieces are telling.
    telling = tally.where(F.col("worth") >= min(TELLING, best / 2)).orderBy(F.desc("toxic"), "word").limit(JOINING)
    examples = {bytes(r.word): (r.toward, r.against) for r in telling.select(*weighed).collect()}
    dealt = F.pmod(F.xxhash64("word"), F.lit(1 << 30))
    ordinary = tally.where((F.col("clean") > 0) & (dealt < int(min(1, ORDINARY / max(1, n)) * (1 << 30))))
    least = 1 / counts[0]
    for r in ordinary.select("word").collect():
        examples.setdefault(bytes(r.word), (0.0, least))
    model = None
    for last in [False] * ROUNDS + [True]:
        if not any(a > b and len(w) > 2 for w, (a, b) in examples.items()) or not any(b for _, b in examples.values()):
            return level
        model = machine(examples)
        if last:
            break
        shared = spark.sparkContext.broadcast(model)
        found = tally.mapInArrow(_values(shared), "word binary, toxic long, clean long, worth double, value double")
        joining = found.where("value > -0.5").orderBy(F.desc(F.col("toxic") + F.col("clean")), "word").limit(JOINING)
        for r in joining.select(*weighed).collect():
            examples[bytes(r.word)] = (r.toward, r.against)
    judged = "row long, label int, total double, word binary, counts array<long>"
    found = rows.mapInArrow(_judged(spark.sparkContext.broadcast(model)), judged).select("label", "counts").toArrow()
    label = found.column("label").to_numpy(zero_copy_only=False)
    held = found.column("counts").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
    model.evidence = _evidence(held, label)
    model.slope, model.shift = _line(held @ model.evidence, label)
    return model


def _evidence(counts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Log ratio of the rates at which pieces of each bin occur in toxic and clean documents. Neighbouring
    bins are pooled where the ratio would fall with the value, and all bins that do not clearly speak for
    toxic documents are one."""
    toxic, clean = counts[labels == 1].sum(axis=0).astype(float), counts[labels == 0].sum(axis=0).astype(float)
    n, m = max(1.0, toxic.sum()), max(1.0, clean.sum())
    ratio = lambda k, l: np.log((k + 2 * n / (n + m)) / n) - np.log((l + 2 * m / (n + m)) / m)
    # Bins that no piece fell into go to their neighbours, halfway.
    filled = np.flatnonzero(toxic + clean)
    if not len(filled):
        return np.zeros(len(toxic))
    widths = np.diff(np.concatenate(([0], (filled[1:] + filled[:-1]) // 2 + 1, [len(toxic)])))
    pools: list[list[float]] = []  # toxic, clean, bins
    for k, l, width in zip(toxic[filled], clean[filled], widths.tolist()):
        pools.append([k, l, width])
        while len(pools) > 1 and ratio(*pools[-2][:2]) > ratio(*pools[-1][:2]):
            pools[-2:] = [[a + b for a, b in zip(*pools[-2:])]]
    rest = [p for p in pools if ratio(*p[:2]) < CLEARLY]
    low = ratio(sum(p[0] for p in rest), sum(p[1] for p in rest)) if rest else 0.0
    return np.concatenate([np.full(int(p[2]), low if ratio(*p[:2]) < CLEARLY else ratio(*p[:2])) for p in pools])


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, worst): a row for each row of docs.

    score is the probability of the toxic class, predicted 1 from 0.5 on, worst the piece most like an insult. A
    null, empty or blank text has no piece, so no evidence either way. A row without an id counts as held
    out. Repeated rows score alike; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text"))
    found = rows.mapInArrow(_judged(shared), "doc_id long, total double, word binary, counts array<long>")
    x = F.lit(model.slope) * F.col("total") + F.lit(model.shift)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(x, F.lit(500.0)), F.lit(-500.0))))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"),
        F.make_valid_utf8(F.col("word").cast("string")).alias("worst"),
    )
