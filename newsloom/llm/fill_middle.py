"""Fill-in-the-middle texts over seekable compressed frames.

A text is stored as independent zstandard frames of bounded size, with the units, characters and bytes before
each. A cut at a unit is found by the counts and one decompressed frame, whatever the text's length;
outputs and their digests are read frame by frame in order, so no text is whole in memory after it was
framed. A unit is a run of ASCII letters or one other character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from newsloom.llm import textbytes as tb
from newsloom.llm.tables import column

FRAME_BYTES = 1 << 16
LEVEL = 1
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Markers of an output; a text that holds one stays plain.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_FRAME = "struct<units:bigint,chars:bigint,bytes:bigint,joined:boolean,data:binary>"
#: Rows whose frames are looked at as Python objects at once.
_ROWS = 256


def unit_starts(data: np.ndarray, joined: bool = False) -> np.ndarray:
    """Whether a unit begins at each byte. joined: a letter comes before the first."""
    letter, first = _LETTER[data], (data & 0xC0) != 0x80
    before = np.empty(len(data), bool)
    before[1:] = letter[:-1]
    before[:1] = joined
    return first & ~(letter & before)


def _cuts(data: np.ndarray, offsets: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(where frames begin, number of frames of each row); frames of a row end between characters."""
    size = np.diff(offsets)
    n = -(-size // most)
    which = np.repeat(np.arange(len(size)), n)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[which] + nth * most
    for _ in range(3):
        at = at - ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)
    return at, n


def _frame_batch(most: int):
    def run(batches):
        packed = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "text"]
            for first, data, offsets in tb.sliced(*tb.raw(batch.column("text"))):
                rows = len(offsets) - 1
                starts = np.zeros(len(data) + 1, bool)
                starts[:-1] = unit_starts(data)
                edge = offsets[:-1][offsets[:-1] < len(data)]
                starts[edge] |= np.diff(offsets)[offsets[:-1] < len(data)] > 0
                units = np.concatenate(([0], np.cumsum(starts[:-1])))
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
                at, n = _cuts(data, offsets, most)
                of = np.repeat(offsets[:-1], n)
                ends = np.append(at[1:], len(data))
                view = memoryview(np.ascontiguousarray(data))
                frames = pa.StructArray.from_arrays(
                    [
                        pa.array(units[at] - units[of]),
                        pa.array(chars[at] - chars[of]),
                        pa.array(at - of),
                        pa.array((at > of) & _LETTER[data[at - 1]] if len(data) else at > of),
                        pa.array([packed.compress(view[a:b]) for a, b in zip(at.tolist(), ends.tolist())], pa.binary()),
                    ],
                    ["units", "chars", "bytes", "joined", "data"],
                )
                listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), frames)
                totals = [pa.array(np.diff(x[offsets])) for x in (units, chars)] + [pa.array(np.diff(offsets))]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(first, rows) for c in rest], *totals, pa.array(_marked(data, offsets)), listed],
                    [*rest, "n", "n_chars", "n_bytes", "marked", "frames"],
                )

    return run


def _marked(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row holds a marker."""
    hit = np.flatnonzero((data[:-2] == 0x3C) & (data[2:] == 0x3E)) if len(data) > 2 else np.zeros(0, np.int64)
    hit = hit[np.isin(data[hit + 1], [m[1] for m in MARKERS])]
    row = np.searchsorted(offsets, hit, side="right") - 1
    out = np.zeros(len(offsets) - 1, bool)
    out[row[hit + 3 <= offsets[row + 1]]] = True
    return out


class Text:
    """A framed text; holds one decompressed frame at a time."""

    def __init__(self, frames: list[dict], n: int, n_chars: int, n_bytes: int, unpacker=None):
        self.frames, self.n, self.n_chars, self.n_bytes = frames, n, n_chars, n_bytes
        self.unpacker = unpacker or zstandard.ZstdDecompressor()
        self.units, self.bytes = ([f[k] for f in frames] for k in ("units", "bytes"))
        self.held, self.read = -1, b""

    def frame(self, k: int) -> bytes:
        if k != self.held:
            self.held, self.read = k, self.unpacker.decompress(self.frames[k]["data"])
        return self.read

    def place(self, unit: int) -> tuple[int, int]:
        """(characters, bytes) before the unit-th unit, all of them for n."""
        if unit >= self.n:
            return self.n_chars, self.n_bytes
        k = int(np.searchsorted(self.units, unit, side="right")) - 1
        data = np.frombuffer(self.frame(k), np.uint8)
        at = int(np.flatnonzero(unit_starts(data, self.frames[k]["joined"]))[unit - self.units[k]])
        return self.frames[k]["chars"] + int(((data[:at] & 0xC0) != 0x80).sum()), self.bytes[k] + at

    def stream(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes from start to end, a frame's part at a time."""
        k = int(np.searchsorted(self.bytes, start, side="right")) - 1
        while start < end:
            stop = self.bytes[k + 1] if k + 1 < len(self.frames) else self.n_bytes
            part = self.frame(k)[start - self.bytes[k] : min(end, stop) - self.bytes[k]]
            yield part
            start, k = start + len(part), k + 1


class Output:
    """What becomes of a text: markers and parts of the text in order, read by place like a file."""

    def __init__(self, text: Text, parts: list[bytes | tuple[int, int]]):
        self.text, self.parts = text, parts
        sizes = [len(p) if isinstance(p, bytes) else p[1] - p[0] for p in parts]
        self.at = np.concatenate(([0], np.cumsum(sizes))).tolist()

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        end = self.at[-1] if end is None else end
        for part, a, b in zip(self.parts, self.at, self.at[1:]):
            low, high = max(start, a) - a, min(end, b) - a
            if low < high:
                if isinstance(part, bytes):
                    yield part[low:high]
                else:
                    yield from self.text.stream(part[0] + low, part[0] + high)

    def marks(self) -> dict[bytes, int]:
        """Where each marker stands, found by reading the output."""
        found, tail, at = {}, b"", 0
        for part in self.stream():
            window = tail + part
            for m in MARKERS:
                k = window.find(m)
                if k >= 0:
                    found.setdefault(m, at - len(tail) + k)
            at, tail = at + len(part), window[-2:]
        return found


def restored(output: Output, form: str) -> Iterator[bytes]:
    """The text, from its output and form alone."""
    if form == "plain":
        yield from output.stream()
        return
    marks = output.marks()
    order = sorted(marks, key=marks.get)
    ends = dict(zip(order, [*[marks[m] for m in order[1:]], output.at[-1]]))
    for m in (PREFIX, MIDDLE, SUFFIX):
        yield from output.stream(marks[m] + len(m), ends[m])


def transform(text: Text, form: str, cuts: tuple[int, int]) -> tuple[Output, int | None, int | None]:
    """(output, characters of the prefix, characters of the middle) for cuts after so many units."""
    if form == "plain":
        return Output(text, [(0, text.n_bytes)]), None, None
    (a_chars, a), (b_chars, b) = text.place(cuts[0]), text.place(cuts[1])
    prefix, middle, suffix = (0, a), (a, b), (b, text.n_bytes)
    parts = [PREFIX, prefix, SUFFIX, suffix] if form == "psm" else [SUFFIX, suffix, PREFIX, prefix]
    return Output(text, [*parts, MIDDLE, middle]), a_chars, b_chars - a_chars


def _digest(parts: Iterator[bytes]) -> str:
    made = hashlib.sha256()
    for part in parts:
        made.update(part)
    return made.hexdigest()


def _transforming(with_output: bool):
    names = ["prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for r in (r for k in range(0, batch.num_rows, _ROWS) for r in batch.slice(k, _ROWS).to_pylist()):
                text = Text(r["frames"], r["n"], r["n_chars"], r["n_bytes"], unpacker)
                output, prefix, middle = transform(text, r["form"], (r["low"], r["high"]))
                row = prefix, middle, _digest(output.stream()), _digest(restored(output, r["form"]))
                rows.append((*row, b"".join(output.stream()).decode()) if with_output else row)
            made, types = zip(*rows) if rows else [[]] * (4 + with_output), [*kinds, *[pa.string()] * with_output]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "n", "form")], *[pa.array(list(x), t) for x, t in zip(made, types)]],
                ["doc_id", "n", "form", *names, *["output"] * with_output],
            )

    return run


def framed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """(doc_id, n, n_chars, n_bytes, marked, frames): a row for each row of docs.

    n are the text's units, marked whether it holds a marker. A null text counts as empty and has no frame. Other
    columns are not looked at; repeated rows are framed each.
    """
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text"))
    schema = f"doc_id long, n long, n_chars long, n_bytes long, marked boolean, frames array<{_FRAME}>"
    return rows.mapInArrow(_frame_batch(frame_bytes), schema)


def _dealt(doc_id: Column) -> list[Column]:
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _planned(frames: DataFrame) -> DataFrame:
    """Framed texts with their form and cuts."""
    h1, h2, h3, h4 = _dealt(F.col("doc_id"))
    cuts = [h % (F.col("n") + 1) for h in (h1, h2)]
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(h4 % 100 < SPM_PERCENT, "spm").otherwise("psm")
    low, high = F.least(*cuts).alias("low"), F.greatest(*cuts).alias("high")
    return frames.select("doc_id", "n", "n_chars", "n_bytes", form.alias("form"), low, high, "frames")


def transformed(frames: DataFrame, with_output: bool = False) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of framed texts, and
    with_output the output itself.

    The cuts and the form are drawn from a hash of the id, so rows that share an id, or have none, share the
    draw; an empty text and one that holds a marker are plain, without characters of parts. Cuts may meet,
    leaving parts empty. restored_sha256 is that of the text rebuilt from the output and the form.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
    return _planned(frames).mapInArrow(_transforming(with_output), schema + ", output string" * with_output)
