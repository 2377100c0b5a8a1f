"""Token ids in Arrow files of equal-length sequences.

Documents are dealt out by ranges of their id. A task encodes its texts one after the other, appends
the end id to each and packs the ids into sequences of equal length, which it writes as batches of
fixed-size lists into one Arrow IPC file; a mask marks the ids, so the padding at the end of a file
is known. Files are read by memory map or range request: any sequence is a slice, without a copy.
The directory that is returned says in which file, and where in it, each document lies.

A file's name is new for each attempt of a task and the directory only names those of the attempts
that succeeded, so a lost executor or a repeated task leaves nothing that is read.
"""

from __future__ import annotations

import json
import pathlib
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from newsloom.llm import textbytes as tb
from newsloom.llm.tables import column, new_folder, partitions, stored

SEQUENCE = 2048  # ids in a sequence
BATCH = 256  # sequences in a batch
ROWS_PER_FILE = 20_000
#: Distinct pieces of text whose ids a worker remembers before it starts anew.
REMEMBERED = 2_000_000
#: Bytes of text that are encoded at once, at least one row, and pieces that the library is given at once: what it
#: returns for a piece is many times the piece, and freed memory stays with the worker.
SLICE_BYTES = 512 << 10
PIECES = 4096

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_BLANK = ~tb.SPACED
_PRINTED = np.zeros(256, bool)
_PRINTED[0x21:0x7F] = True
_OPENS = _PRINTED.copy()
_OPENS[0xC3:0xCA] = True  # first bytes of the letters U+00C0 to U+027F
_PLAIN = np.zeros(256, bool)
_PLAIN[:128] = True


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of pieces that a byte-level tokenizer with the usual word pattern encodes on their own as
    it does in the text: before a space that a printed character follows, between a letter and
    another ASCII character, before white space and around a single line feed. Where such a place
    isn't certain, there is no cut."""
    n = len(data)
    cut = np.zeros(n, bool)
    now, old = data[1:], data[:-1]
    cut[1:] = (_LETTER[old] & _PLAIN[now] & ~_LETTER[now]) | (_PRINTED[old] & _BLANK[now])
    cut[:-1] |= (old == 0x20) & _OPENS[now]
    cut[2:] |= (data[1:-1] == 0x0A) & _PRINTED[data[:-2]] & _OPENS[data[2:]]
    inner = offsets[1:-1]
    # A space at the end of a text has no follower in it, and the first characters no predecessors.
    last = inner[inner > 0] - 1
    last = last[data[last] == 0x20]
    before = data[np.maximum(last - 1, 0)]
    cut[last] = (last > 0) & _PRINTED[before]
    second = inner[inner + 1 < n] + 1
    cut[second] &= ~((data[second - 1] == 0x0A) & ~_follows(data, second))
    cut[offsets[:-1][offsets[:-1] < n]] = True
    return np.flatnonzero(cut)


def _follows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a cut before these bytes is due to the byte before or after them alone."""
    now, old = data[at], data[at - 1]
    next_ = data[np.minimum(at + 1, len(data) - 1)]
    return (_LETTER[old] & _PLAIN[now] & ~_LETTER[now]) | (_PRINTED[old] & _BLANK[now]) | ((now == 0x20) & _OPENS[next_])


#: Pre-tokenizer, and fields of it, for which pieces() is right.
_CUTTABLE = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def described(path: str) -> tuple[bool, list[str], int]:
    """(whether texts of the tokenizer may be encoded by pieces, its added tokens, its largest id)."""
    text = pathlib.Path(path).read_text(encoding="utf-8")
    made = json.loads(text)
    split, model = made.get("pre_tokenizer") or {}, made.get("model") or {}
    added = made.get("added_tokens") or []
    cuttable = (
        not made.get("normalizer")
        and all(split.get(k) == v for k, v in _CUTTABLE.items())
        and model.get("type", "BPE") == "BPE"
        and not model.get("dropout")
        and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    return cuttable, [t["content"] for t in added if t["content"]], max(*model["vocab"].values(), *[t["id"] for t in added], 0)


class Encoder:
    """Ids of texts. Each distinct piece is encoded once by the tokenizers library and remembered; texts of a
    tokenizer whose pieces depend on their surroundings are encoded whole."""

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.cuttable, added, _ = described(path)
        self.added = None
        if added and not special_as_text:
            # The longest that begins first, as the library takes them.
            self.added = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(added, key=len, reverse=True)))
        self.forget()

    def forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.order = np.zeros(0, np.int64)
        self.text, self.text_at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts that lie there, how many each has)."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(starts), PIECES):
            bounds = zip(starts[at : at + PIECES].tolist(), ends[at : at + PIECES].tolist())
            made = self._encode([data[a:b].tobytes().decode() for a, b in bounds])
            counts.append(np.fromiter(map(len, made), np.int64, len(made)))
            ids.append(np.fromiter((i for one in made for i in one), np.uint32, int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, where each row's begin, with the end appended)."""
        if not self.cuttable:
            return self._plainly(data, offsets)
        starts = self._starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        sums, back = tb.prefix_hashes(data)
        keys, first, which = np.unique(tb.span_hashes(sums, back, starts, ends), return_index=True, return_inverse=True)
        del sums, back
        lengths = ends - starts
        known = self._remember(keys, data, starts[first], lengths[first])
        if known is None or not _alike(data, starts, lengths, first[which]):
            return self._plainly(data, offsets)
        place = known[which]
        n = (self.ids_at[1:] - self.ids_at[:-1])[place]
        ids = self.ids[_ranges(self.ids_at[place], n)]
        total = np.concatenate(([0], np.cumsum(n)))
        return ids, total[np.searchsorted(starts, offsets)]

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces. An added token is a piece, and what lies around it is a text of its own."""
        found = self._added(data, offsets)
        if not len(found):
            return pieces(data, offsets)
        starts = pieces(data, np.unique(np.concatenate((offsets, found.ravel()))))
        token = np.searchsorted(found[:, 0], starts, side="left") - 1
        return starts[(token < 0) | (starts >= found[token, 1])]

    def _added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(start, end) of each added token in a text."""
        found, at, whole = [], 0, data.tobytes() if self.added else b""
        while self.added and (m := self.added.search(whole, at)):
            end = int(offsets[np.searchsorted(offsets, m.start(), side="right")])
            if m.end() > end:  # it would run into the next text; a shorter one may fit
                m, at = self.added.match(whole, m.start(), end), m.start() + 1
            if m:
                found.append(m.span())
                at = m.end()
        return np.array(found, np.int64).reshape(-1, 2)

    def _remember(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray | None:
        """Places of the pieces in the memory, after adding new ones; None if two differ under one key."""
        if len(self.keys) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        held = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        held[inside] = self.keys[at[inside]] == keys[inside]
        place = np.empty(len(keys), np.int64)
        place[held] = self.order[at[held]]
        seen = place[held]
        if not np.array_equal(self.text_at[seen + 1] - self.text_at[seen], lengths[held]) or not np.array_equal(
            self.text[_ranges(self.text_at[seen], lengths[held])], data[_ranges(starts[held], lengths[held])]
        ):
            return None
        new = np.flatnonzero(~held)
        if len(new):
            place[new] = len(self.keys) + np.arange(len(new))
            flat, n = self._encoded(data, starts[new], starts[new] + lengths[new])
            self.ids = np.concatenate((self.ids, flat))
            self.ids_at = np.concatenate((self.ids_at, self.ids_at[-1] + np.cumsum(n)))
            self.text = np.concatenate((self.text, data[_ranges(starts[new], lengths[new])]))
            self.text_at = np.concatenate((self.text_at, self.text_at[-1] + np.cumsum(lengths[new])))
            # Both lists are sorted, so the new keys go in by position.
            self.order = np.insert(self.order, at[new], place[new])
            self.keys = np.insert(self.keys, at[new], keys[new])
        return place

    def _plainly(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, n = self._encoded(data, offsets[:-1], offsets[1:])
        return ids, np.concatenate(([0], np.cumsum(n)))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[0], starts[0] + 1, ... of all ranges, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _alike(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> bool:
    """Whether each piece has the bytes of the piece that stands for it."""
    if not np.array_equal(lengths, lengths[first]):
        return False
    other = np.flatnonzero(starts != starts[first])
    return np.array_equal(
        data[_ranges(starts[other], lengths[other])], data[_ranges(starts[first][other], lengths[other])]
    )


@lru_cache(maxsize=1)
def encoder(path: str, special_as_text: bool) -> Encoder:
    """One encoder a worker, so that it keeps what it remembers from batch to batch."""
    return Encoder(path, special_as_text)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Packs ids into sequences and writes them as batches of fixed-size lists."""

    def __init__(self, uri: str, sequence: int, kind: pa.DataType):
        where, path = _filesystem(uri)
        self.sequence, self.kind = sequence, kind
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.stream = where.open_output_stream(path)
        self.file = pa.ipc.new_file(self.stream, self.schema)
        self.held: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: np.ndarray):
        self.held.append(ids)
        self.n += len(ids)
        if self.n >= BATCH * self.sequence:
            whole = np.concatenate(self.held)
            full = len(whole) // (BATCH * self.sequence) * (BATCH * self.sequence)
            for at in range(0, full, BATCH * self.sequence):
                self._write(whole[at : at + BATCH * self.sequence], BATCH * self.sequence)
            self.held, self.n = [whole[full:]], len(whole) - full

    def _write(self, ids: np.ndarray, n: int):
        room = -(-n // self.sequence) * self.sequence
        values = np.zeros(room, self.kind.to_pandas_dtype())
        values[:n] = ids
        mask = np.zeros(room, bool)
        mask[:n] = True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (values, mask)]
        self.file.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self):
        if self.n:
            self._write(np.concatenate(self.held), self.n)
        self.file.close()
        self.stream.close()


class Reader:
    """Random access to the ids of one file. A sequence, and a document inside a batch, is a view."""

    def __init__(self, uri: str):
        where, path = _filesystem(uri)
        source = pa.memory_map(path) if where.type_name == "local" else where.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.sequence = self.file.schema.field("ids").type.list_size
        self.batch, self.values = -1, None

    def _batch(self, k: int) -> np.ndarray:
        if k != self.batch:
            self.batch, self.values = k, self.file.get_batch(k).column(0).flatten().to_numpy()
        return self.values

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from the file's start-th on."""
        each, parts = BATCH * self.sequence, []
        while n > 0:
            k, at = divmod(start, each)
            parts.append(self._batch(k)[at : at + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.zeros(0, np.uint32)])

    def sequences(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of all sequences of the k-th batch, a row a sequence."""
        found = self.file.get_batch(k)
        ids, mask = (found.column(i).flatten().to_numpy(zero_copy_only=i == 0) for i in (0, 1))
        return ids.reshape(-1, self.sequence), mask.reshape(-1, self.sequence)


def _made(spark: SparkSession, folder: str) -> str:
    """The folder, made where it isn't there, with the file system that Spark would take it from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    return re.sub("^file:/+", "file:///", system.makeQualified(path).toString())


def write(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    sequence: int = SEQUENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_as_text: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Writes the token files and returns their directory (doc_id, part, file, at, n_tokens).

    Strings of the tokenizer's added tokens become those tokens wherever a text holds them, as the library's encode()
    has it without other settings; with special_as_text they are ordinary text. Ids take 16 bits where the
    tokenizer's all fit. A folder without a scheme is one of the cluster's default file system.

    Documents follow each other by ascending id, null ids first; rows that share an id in the order
    in which the table is read. A null or empty text has the end id alone. An empty table gives no
    file and an empty directory. Other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    kind = pa.uint16() if max(described(tokenizer_path)[2], end_id) < 1 << 16 else pa.uint32()
    uri = _made(spark, folder)

    def run(batches):
        encode, part, file, writer, at = encoder(tokenizer_path, special_as_text), TaskContext.get().partitionId(), None, None, 0
        try:
            for batch in batches:
                data, offsets = tb.raw(batch.column("text"))
                ids_of = batch.column("doc_id")
                for first, piece, bounds in tb.sliced(data, offsets, SLICE_BYTES):
                    if writer is None:
                        file = f"{uri}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
                        writer = Writer(file, sequence, kind)
                    ids, where = encode(piece, bounds)
                    rows = len(bounds) - 1
                    n = np.diff(where) + 1
                    whole = np.insert(ids, where[1:], end_id)
                    writer.add(whole.astype(kind.to_pandas_dtype()))
                    ends = at + np.cumsum(n)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids_of.slice(first, rows),
                            pa.array(np.full(rows, part), pa.int32()),
                            pa.array([file] * rows, pa.string()),
                            pa.array(ends - n, pa.int64()),
                            pa.array(n, pa.int64()),
                        ],
                        ["doc_id", "part", "file", "at", "n_tokens"],
                    )
                    at = int(ends[-1])
        finally:
            if writer is not None:
                writer.close()

    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"), column(text_col).alias("text"), F.monotonically_increasing_id().alias("_row")
    )
    n = partitions(spark, docs.count(), ROWS_PER_FILE)
    dealt = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "_row")
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_row").select("doc_id", "text")
    found = dealt.mapInArrow(run, "doc_id long, part int, file string, at long, n_tokens long")
    return stored(found, "directory")


def read(directory: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read from the files: where a document's ids begin among
    those of all documents, and a check sum of them as little-endian 32-bit numbers."""

    def run(batches):
        reader, name = None, None
        for batch in batches:
            sums = []
            for file, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                if file != name:
                    reader, name = Reader(file), file
                sums.append(zlib.crc32(reader.ids(at, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "part", "at", "n_tokens")] + [pa.array(sums, pa.int64())],
                ["doc_id", "part", "at", "n_tokens", "ids_crc32"],
            )

    # One row a file.
    sizes = directory.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    found = directory.mapInArrow(run, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return found.join(starts, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
