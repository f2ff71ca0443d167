"""Harmonic packing of tokenised documents into sequences without padding.

Lengths are cut to reciprocals of the capacity: ``capacity``, ``capacity / 2``, ``capacity / 4``
and so on down to 1. A document of n tokens becomes whole sequences and one piece for each binary
digit of the rest, largest first. Class k holds pieces of ``capacity / k`` tokens and each of its
bins takes exactly k of them, so every closed bin is full. Each task fills bins of its own; no
row is shuffled and no task waits for another.

What is left in open bins at the end of a task is laid out largest first, which fills whole
sequences again since sizes are powers of two; the last rest, under one capacity, becomes at most
log2(capacity) sequences whose lengths are powers of two. Nothing is padded.

Memory of a task: one Arrow batch, at most 2 * capacity open pieces and a bounded word cache.
A task that runs again gives the same rows, as its ids derive from the partition and the order in it.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from string import punctuation

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import TwoAges, byte_characters, per_worker

CAPACITY = 4096
END_ID = 2

#: Chunks between white space whose ids a task remembers, and the longest one worth it.
CACHE_ENTRIES = 600_000
CACHE_CHARS = 64
#: Of these, so many stay for the next task.
CACHE_AT_REST = 40_000

#: Stands between chunks that are encoded together; the vocabulary has one id for it.
MARK = "\x01"

#: Sequence numbers of one task start at its number times this.
TASK_STRIDE = 1 << 40

ROWS_OUT = 10_000


#: Letters that stay one letter when they are composed and lower-cased, whatever stands after them.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ſ]+")

#: What a file says of its tokenizer where a word of such letters, and the marks after it, go to the merges alone.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class ChunkTokenizer:
    """Ids of a text as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never looks across it, so blanks and line ends are safe
    places to cut a text; each distinct chunk is encoded once. A chunk that is a word of ``LETTERS`` is one
    match of the pattern, in lower case, and ASCII marks after it are another, so they go to the merges as they
    are; files of another kind encode all chunks whole. Names of special tokens that
    occur in a text are ordinary text.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self._by_word = (
            told.get("normalizer") == {"type": "Sequence", "normalizers": NORMALIZERS}
            and told.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": PRE_TOKENIZERS}
            and not told.get("post_processor")
            and all(t["special"] and not t["lstrip"] and not t["rstrip"] for t in told.get("added_tokens") or [])
        )
        self._characters = byte_characters()
        self._known = TwoAges(CACHE_ENTRIES)
        (self._mark,) = self._ids(MARK)

    def _match(self, text: str) -> bytes:
        """Ids of a text that is one match of the pattern, in lower case."""
        ids = [t.id for t in self._model.tokenize(text.encode().decode("latin-1").translate(self._characters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _remembered(self, match: str) -> tuple[bytes, bool]:
        """Ids of a match, and whether it came before."""
        ids = self._known.young.get(match)
        if ids is not None:
            return ids, True
        ids = self._known.older(match)
        seen = ids is not None
        if not seen:
            ids = self._match(match)
        if len(match) <= CACHE_CHARS:
            self._known.add(match, ids)
        return ids, seen

    def _word(self, chunk: str) -> bytes | None:
        """Ids of a word and its marks; None if the chunk is something else."""
        word = chunk.rstrip(punctuation)
        if not self._by_word or not LETTERS.fullmatch(word):
            return None
        ids, seen = self._remembered(word.lower())
        if len(word) < len(chunk):
            ids += self._remembered(chunk[len(word) :])[0]
        # Remembered as it stands only if the word came before, as most rare words come once.
        if seen and len(chunk) <= CACHE_CHARS:
            self._known.add(chunk, ids)
        return ids

    def _ids(self, text: str) -> list[int]:
        (encoding,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return encoding.ids

    def _encode(self, chunks: list[str]) -> dict[str, bytes]:
        """New chunks in one call, with a mark of one id between them."""
        import numpy as np

        alone = [c for c in chunks if MARK in c]
        found = {c: np.array(self._ids(c), "<u4").tobytes() for c in alone}
        chunks = [c for c in chunks if MARK not in c]
        ids = np.array(self._ids(f" {MARK} ".join(chunks)), "<u4")
        ends = [*(4 * np.flatnonzero(ids == self._mark)).tolist(), 4 * len(ids)]
        data, start = ids.tobytes(), 0
        for chunk, end in zip(chunks, ends):
            found[chunk] = data[start:end]
            start = end + 4
        return found

    def encode(self, text: str) -> bytes:
        known = self._known
        chunks = text.replace("\n", " ").split(" ")
        parts = list(map(known.young.get, chunks))
        if None in parts:
            places = [i for i, part in enumerate(parts) if part is None]
            found: dict[str, bytes | None] = {}
            for chunk in dict.fromkeys(chunks[i] for i in places):
                ids = found[chunk] = known.older(chunk)
                if ids is None:
                    found[chunk] = self._word(chunk)
                elif len(chunk) <= CACHE_CHARS:
                    known.add(chunk, ids)
            new = [chunk for chunk, ids in found.items() if ids is None]
            if new:
                encoded = self._encode(new)
                found.update(encoded)
                for chunk, ids in encoded.items():
                    if len(chunk) <= CACHE_CHARS:
                        known.add(chunk, ids)
            for i in places:
                parts[i] = found[chunks[i]]
        return b"".join(parts)

    def rest(self) -> None:
        """Between tasks only common chunks are kept."""
        self._known.shrink(CACHE_AT_REST)
        pa.default_memory_pool().release_unused()


def pieces(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, size) of the pieces of a document: whole sequences, then its binary digits."""
    start = 0
    while length - start >= capacity:
        yield start, capacity
        start += capacity
    size = capacity >> 1
    while start < length:
        if length - start >= size:
            yield start, size
            start += size
        size >>= 1


class Bins:
    """Open bins of one task, by class."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self._capacity, self._next = capacity, first_id
        self._open: dict[int, list[tuple]] = {}

    def add(self, piece: tuple, size: int) -> list[tuple]:
        """The rows of a bin that this piece fills, else nothing."""
        held = self._open.setdefault(size, [])
        held.append(piece)
        if len(held) * size < self._capacity:
            return []
        self._open[size] = []
        return self._sequence([(p, size) for p in held])

    def close(self) -> Iterator[tuple]:
        """What is left, largest first; the last rest by powers of two."""
        left = [(p, size) for size in sorted(self._open, reverse=True) for p in self._open[size]]
        total = sum(size for _, size in left)
        at = 0
        while at < len(left):
            # Sizes descend and divide one another, so each target is met exactly.
            target = self._capacity if total >= self._capacity else 1 << (total.bit_length() - 1)
            filled, first = 0, at
            while filled < target:
                filled += left[at][1]
                at += 1
            total -= target
            yield from self._sequence(left[first:at])

    def _sequence(self, members: list[tuple[tuple, int]]) -> list[tuple]:
        rows, offset = [], 0
        for piece, size in members:
            rows.append((*piece, self._next, offset))
            offset += size
        self._next += 1
        return rows


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the ids themselves (array of int). ``capacity`` is a power of two.
    A null or empty text has the end id alone; a null key stays null; each of several equal rows
    is packed on its own; other columns are ignored; an empty table gives no rows. A long text
    is encoded whole.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    schema = (
        f"`{key}` {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    )
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokenizer = per_worker(("chunks", tokenizer_path), lambda: ChunkTokenizer(tokenizer_path))
        bins = Bins(capacity, TaskContext.get().partitionId() * TASK_STRIDE)
        end = end_id.to_bytes(4, "little")
        keys = None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = dict(zip(names, zip(*rows)))
            arrays = {
                n: pa.array(columns[n], keys if n == key else pa.int64()) for n in names if n != "ids"
            }
            if with_ids:
                arrays["ids"] = pa.array(
                    [np.frombuffer(b, "<i4") for b in columns["ids"]], pa.list_(pa.int32())
                )
            return pa.RecordBatch.from_pydict(arrays)

        ready: list[tuple] = []
        part = None
        for part in batches:
            keys = part.column(0).type
            for doc, body in zip(part.column(0).to_pylist(), part.column(1)):
                ids = tokenizer.encode(body.as_py() or "") + end
                total = len(ids) >> 2
                for start, size in pieces(total, capacity):
                    own = ids[4 * start : 4 * (start + size)]
                    kept = own if with_ids else None
                    ready += bins.add((doc, start, size, zlib.crc32(own), total, kept), size)
                while len(ready) >= ROWS_OUT:
                    yield batch(ready[:ROWS_OUT])
                    del ready[:ROWS_OUT]
        ready += bins.close()
        del part
        tokenizer.rest()
        if ready:
            yield batch(ready)

    return rows.mapInArrow(run, schema)
