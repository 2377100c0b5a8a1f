"""A run-compressed Burrows-Wheeler index of one text, for matches of at most DEPTH bytes.

Suffixes are sorted by their first DEPTH bytes, equal ones by place. Of the transform only its runs
are kept, with the suffix sampled at the first and last row of each run, and the smallest place of
each group of suffixes that agree in DEPTH bytes. Queries stream through from their last byte to
their first: while the row's byte is the query's, the match grows by a step back in the text; else
it goes on from the sampled end of the nearest run of that byte above or below, whichever shares
more bytes with the match so far. All queries take each step together, as arrays.
"""

from __future__ import annotations

import numpy as np

DEPTH = 100
#: Stands before, between and after the texts; no UTF-8 text has it.
SEPARATOR = 0xFF
_WORDS = -(-DEPTH // 8)


_LOW = np.uint64(0xFFFFFFFF)
_HIGH = np.uint64(32)


def _places(rank: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """The sequence sorted by rank; equal ranks keep their order."""
    keys = (rank[sequence].astype(np.uint64) << _HIGH) | np.arange(len(sequence), dtype=np.uint64)
    keys.sort()
    return sequence[(keys & _LOW).astype(np.int64)]


def _ranked(places: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Rank of each place by keys that places are sorted by."""
    new = np.zeros(len(places), bool)
    for key in keys:
        found = key[places]
        new[1:] |= found[1:] != found[:-1]
    rank = np.empty(len(places), np.int64)
    rank[places] = np.cumsum(new)
    return rank


def _shifted(rank: np.ndarray, by: int) -> np.ndarray:
    """rank at by places further; behind the end, less than all."""
    out = np.zeros(len(rank), np.int64)
    out[: max(len(rank) - by, 0)] = rank[by:] + 1
    return out


def depth_ranks(text: np.ndarray) -> np.ndarray:
    """Rank of each suffix by its first DEPTH bytes; equal ranks for equal bytes. Suffixes sorted so far,
    moved back, are in the order of what follows; a sort by the rank before completes it."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(4, np.uint8))).astype(np.int64)
    first = np.zeros(n, np.int64)
    for k in range(4):
        first = (first << 8) | padded[k : k + n]
    places = _places(first, np.arange(n))
    rank, size = _ranked(places, first), 4
    while size < DEPTH:
        by = min(size, DEPTH - size)
        places = _places(rank, np.concatenate((np.arange(max(n - by, 0), n), places[places >= by] - by)))
        rank = _ranked(places, rank, _shifted(rank, by))
        size += by
    return rank


class RunIndex:
    """text: bytes that begin with a separator."""

    def __init__(self, text: np.ndarray):
        self.size = len(text)
        held = np.concatenate((text, np.full(DEPTH + _WORDS * 8, SEPARATOR, np.uint8)))
        self.words = np.ndarray(self.size + DEPTH, ">u8", held, strides=(1,))  # the 8 bytes from each place on
        rank = depth_ranks(text)
        places = _places(rank, np.arange(self.size))
        last = text[places - 1]
        starts = np.flatnonzero(np.concatenate(([True], last[1:] != last[:-1])))
        ends = np.append(starts[1:], len(text)) - 1
        self.start, self.byte = starts, last[starts].astype(np.int64)
        self.first, self.last = places[starts], places[ends]
        sorted_rank = rank[places]
        self.group = np.flatnonzero(np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1])))
        self.earliest = places[self.group]
        # Runs by byte, with the number of the byte in earlier runs and of smaller bytes.
        lengths = ends - starts + 1
        order = np.argsort(self.byte, kind="stable")
        self.by_byte = self.byte[order] * len(starts) + order
        before = np.cumsum(lengths[order]) - lengths[order]
        self.row = np.empty(len(starts), np.int64)
        self.row[order] = before  # row to which the first row of the run steps
        self.order = order

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal bytes from places a and b on, DEPTH at most."""
        shared = np.full(len(a), DEPTH, np.int64)
        open_ = np.arange(len(a))
        for word in range(_WORDS):
            differ = (self.words[a[open_] + 8 * word] ^ self.words[b[open_] + 8 * word]).astype(np.uint64)
            ended = differ != 0
            equal = 8 * word + sum((differ[ended] < np.uint64(1 << bits)).astype(np.int64) for bits in range(8, 64, 8))
            shared[open_[ended]] = np.minimum(equal, DEPTH)
            open_ = open_[~ended]
            if not len(open_):
                break
        return shared

    def stream(self, starts: np.ndarray, lengths: np.ndarray, queries: np.ndarray):
        """Matching statistics of the queries (bytes from starts on, so long), from their ends. Yields
        (queries that still run, place in the query, length of the longest match that begins there, up
        to DEPTH, row of the index)."""
        order = np.argsort(-lengths, kind="stable")
        active = np.searchsorted(-lengths[order], -np.arange(1, int(lengths.max(initial=0)) + 1), side="right")
        n = len(order)
        row, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        stops = (starts + lengths)[order]
        runs = len(self.start)
        for step, m in enumerate(active.tolist()):
            byte = queries[stops[:m] - 1 - step].astype(np.int64)
            run = np.searchsorted(self.start, row[:m], side="right") - 1
            miss = np.flatnonzero(self.byte[run] != byte)
            if len(miss):
                at = np.searchsorted(self.by_byte, byte[miss] * runs + run[miss])
                below, above = np.minimum(at, runs - 1), np.maximum(at - 1, 0)
                has_below, has_above = (self.byte[self.order[x]] == byte[miss] for x in (below, above))
                has_above &= at > 0
                below, above = self.order[below], self.order[above]
                here, grown = self.earliest_place(row[miss]), size[miss]
                down = np.where(has_below, np.minimum(self._shared(here, self.first[below]), grown), -1)
                up = np.where(has_above, np.minimum(self._shared(here, self.last[above]), grown), -1)
                go_up = up > down
                run[miss] = np.where(go_up, above, below)
                ends = np.append(self.start[1:], self.size) - 1
                row[miss] = np.where(go_up, ends[above], self.start[below])
                size[miss] = np.maximum(up, down)
            known = size[:m] >= 0
            row[:m] = np.where(known, self.row[run] + row[:m] - self.start[run], 0)
            size[:m] = np.where(known, np.minimum(size[:m] + 1, DEPTH), 0)
            yield order[:m], lengths[order[:m]] - 1 - step, size[:m], row[:m]

    def earliest_place(self, rows: np.ndarray) -> np.ndarray:
        """The smallest place of the DEPTH bytes that the rows' suffixes begin with."""
        return self.earliest[np.searchsorted(self.group, rows, side="right") - 1]


def repeated_windows(contexts: list[bytes]) -> list[np.ndarray]:
    """For each text, which of its windows of DEPTH bytes begin earlier too, in an earlier text of the list
    or at an earlier place of the same one."""
    if not contexts:
        return []
    lengths = np.array([len(c) for c in contexts], np.int64)
    mark = bytes([SEPARATOR])
    text = np.frombuffer(mark + mark.join(contexts) + mark, np.uint8)
    starts = np.concatenate(([1], 1 + np.cumsum(lengths + 1)[:-1]))
    index = RunIndex(text)
    flags = np.zeros(len(text), bool)
    for which, at, size, row in index.stream(starts, lengths, text):
        full = np.flatnonzero(size >= DEPTH)
        if len(full):
            places = starts[which[full]] + at[full]
            flags[places] = index.earliest_place(row[full]) < places
    return [flags[s : s + max(n - DEPTH + 1, 0)] for s, n in zip(starts.tolist(), lengths.tolist())]
