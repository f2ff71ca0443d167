"""Token ids of documents in files of separately compressed documents, in ascending order of their keys.

A folder holds

- ``dictionary.zdict``: one zstandard dictionary, trained on serialised id arrays of a bounded sample
  (``Settings.sample`` documents, the first ``Settings.sample_bytes`` of each);
- shard files: 8 bytes of magic, one zstandard frame a document (its ids as little-endian unsigned 32-bit
  integers), the index (an Arrow stream: key, offset, size, n_tokens), and a footer with the place, size and
  crc32 of the index and the SHA-256 of the dictionary;
- ``manifest``: a Parquet table of the shards that count: file, place in the order, documents, tokens and
  the range of keys.

A shard is opened by its footer and index, so one short document costs one seek and one small frame. A
reader refuses a dictionary whose hash is not the one in the footer.

Writing: one shuffle by range of (key, hash of the text, row number), which divides a key that many rows
share; each task encodes its range in order and streams it to shards of its own. Shards have names of
their own for each attempt and only the manifest makes them count, so a task that runs again leaves at
worst a file that nobody reads. The driver sees the sample and one manifest row a shard (256 MB of
frames). Memory of a task: one Arrow batch, the index of a shard and a bounded cache of chunks.

Nulls: a null text is an empty one (the end id alone); null keys come last, in shards like others. Repeated keys
and rows each keep their place; equal keys follow the hash of their texts. An empty table gives a folder
without shards and no rows. A very long text is one frame. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import itemgetter
from string import punctuation

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerline.llm.common import byte_characters, per_worker

END_ID = 2
MAGIC = b"LTOKENS1"
FOOTER = "<QQI32s8s"

#: Chunks of text whose ids a worker remembers, and the longest one worth it.
CACHE_ENTRIES = 650_000
CACHE_CHARS = 64
READ_BYTES = 8 << 20
ROWS_OUT = 10_000


@dataclass(frozen=True)
class Settings:
    #: The dictionary is fitted on at most ``sample`` documents of at most ``sample_bytes`` of ids each.
    sample: int = 1_000
    sample_bytes: int = 8 << 10
    dictionary_bytes: int = 32 << 10
    level: int = 1
    #: A shard is closed beyond so many bytes of frames or documents.
    shard_bytes: int = 256 << 20
    shard_documents: int = 1_000_000


class _Unsafe(Exception):
    """A text was cut before white space that other white space follows."""


class _Chunks(dict):
    """Ids of chunks, found when first asked for; the limit is kept by forgetting the older half.

    ``find`` gives the ids and whether to remember them.
    """

    def __init__(self, find) -> None:
        self._find, self._old = find, {}

    def __missing__(self, chunk: str) -> bytes:
        ids, kept = self._old.get(chunk), True
        if ids is None:
            ids, kept = self._find(chunk)
        if kept and len(chunk) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self._old = dict(self)
                self.clear()  # the same dict, so that bound methods stay good
            self[chunk] = ids
        return ids


class ByteLevelEncoder:
    """Ids of whole texts by a tokenizers file, as bytes of little-endian unsigned 32-bit integers.

    A byte-level tokenizer with the usual pattern starts a new match at each blank or line end that a
    visible character follows, so a text may be cut there and each distinct chunk is encoded once. A
    chunk that is a word goes to the merges alone, being one match, and a mark after a word is a match of
    its own. Files of another kind encode whole texts. Names of special tokens that occur in a text
    are ordinary text.
    """

    #: Where a text may be cut.
    CUT = re.compile(r"(?=[ \n]\S)")
    #: Letters before this code point are letters in every version of Unicode in use.
    OLD_LETTERS = "\u0530"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._model = self._tokenizer.model
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        before = told.get("pre_tokenizer") or {}
        self._cuts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not told.get("normalizer")
            and not told.get("post_processor")
            and all(t["special"] and not t["lstrip"] and not t["rstrip"] for t in told.get("added_tokens") or [])
        )
        if self._cuts:
            self._characters = byte_characters()
            self._line_end = self.whole("\n")
        #: By chunk: without its blank, or with its line end. First chunks of texts are apart.
        self._known, self._first = _Chunks(self._chunk), _Chunks(self._start)
        self._ends = _Chunks(lambda marks: (self._match(marks), True))

    def whole(self, text: str) -> bytes:
        (encoding,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return struct.pack(f"<{len(encoding.ids)}I", *encoding.ids)

    def _match(self, text: str) -> bytes:
        """Ids of a text that is one match of the pattern."""
        ids = [t.id for t in self._model.tokenize(text.encode().decode("latin-1").translate(self._characters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _is_word(self, text: str) -> bool:
        return text.isalpha() and (text.isascii() or max(text) < self.OLD_LETTERS)

    def _start(self, word: str) -> tuple[bytes, bool]:
        return self._match(word) if self._is_word(word) else self.whole(word), True

    def _chunk(self, chunk: str) -> tuple[bytes, bool]:
        seen = chunk[1:2] if chunk[:1] == "\n" else chunk[:1]
        if not seen or seen.isspace():
            raise _Unsafe
        # Letters, then marks to the end: two matches.
        body = chunk.rstrip(punctuation)
        word = body[1:] if body[:1] == "\n" else body
        if self._is_word(word):
            if len(body) < len(chunk):
                # Remembered with its marks only if the word came before, as most rare words come once.
                again = body in self._known
                return self._known[body] + self._ends[chunk[len(body) :]], again
            return self._match(f" {word}") if word is body else self._line_end + self._match(word), True
        return self.whole(chunk if chunk[0] == "\n" else f" {chunk}"), True

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self._cuts:
            return self.whole(text)
        first, *chunks = text.replace("\n", " \n").split(" ")
        if not first:  # the text begins with a cut
            first, *chunks = chunks
            first = first if text[0] == "\n" else f" {first}"
        try:
            return self._first[first] + self._joined(chunks)
        except _Unsafe:
            first, *chunks = self.CUT.split(text)
            if not first:
                first, *chunks = chunks
            return self._first[first] + self._joined([c[1:] if c[0] == " " else c for c in chunks])

    def _joined(self, chunks: list[str]) -> bytes:
        if len(chunks) < 2:
            return self._known[chunks[0]] if chunks else b""
        return b"".join(itemgetter(*chunks)(self._known))


def _open_folder(path: str):
    """(file system, folder on it), of any address that pyarrow reads."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def train_dictionary(arrays: Sequence[bytes], settings: Settings = Settings()) -> bytes:
    """A dictionary from serialised id arrays; of too few to train on, what they hold, or nothing."""
    import zstandard

    arrays = [a for a in arrays if a]
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, arrays).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sorted(set(arrays)))[-settings.dictionary_bytes :]


def _sample(documents: DataFrame, settings: Settings) -> list[str]:
    """Beginnings of the texts with the least hashes of their keys; at most ``sample`` of ``sample_bytes`` characters."""
    hashed = documents.select(F.xxhash64("key").alias("h"), "text")
    hashes = hashed.select("h").orderBy("h").limit(settings.sample).agg(F.max("h")).first()[0]
    if hashes is None:
        return []
    rows = hashed.where(F.col("h") <= hashes).limit(settings.sample)
    return [r[0] or "" for r in rows.select(F.substring("text", 1, settings.sample_bytes)).collect()]


class _Shard:
    """One open file; the index is kept until it is closed."""

    def __init__(self, folder: str, dictionary_hash: bytes, key_type: pa.DataType) -> None:
        self.name = f"shard-{uuid.uuid4().hex}.tokens"
        self._hash, self._key_type = dictionary_hash, key_type
        system, place = _open_folder(folder)
        self._out = system.open_output_stream(f"{place}/{self.name}")
        self._out.write(MAGIC)
        self.at, self.tokens = len(MAGIC), 0
        self.keys: list = []
        self._offsets: list[int] = []
        self._sizes: list[int] = []
        self._counts: list[int] = []

    def add(self, key: object, frame: bytes, count: int) -> None:
        self._out.write(frame)
        self.keys.append(key)
        self._offsets.append(self.at)
        self._sizes.append(len(frame))
        self._counts.append(count)
        self.at += len(frame)
        self.tokens += count

    def close(self) -> None:
        index = pa.table(
            [pa.array(self.keys, self._key_type), *map(pa.array, (self._offsets, self._sizes, self._counts))],
            ["key", "offset", "size", "n_tokens"],
        )
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, index.schema) as writer:
            writer.write_table(index)
        data = sink.getvalue()
        self._out.write(data)
        self._out.write(struct.pack(FOOTER, self.at, len(data), zlib.crc32(data), self._hash, MAGIC))
        self._out.close()


def write(
    documents: DataFrame,
    folder: str,
    tokenizer_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    settings: Settings = Settings(),
) -> str:
    """Encode all documents into a new folder that executors share; gives the folder back."""
    import numpy as np

    spark = documents.sparkSession
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()
    encoder = ByteLevelEncoder(tokenizer_path)
    sample = [(encoder.encode(t) + end)[: settings.sample_bytes] for t in _sample(rows, settings)]
    dictionary = train_dictionary(sample, settings)
    system, place = _open_folder(folder)
    system.create_dir(place, recursive=True)
    with system.open_output_stream(f"{place}/dictionary.zdict") as out:
        out.write(dictionary)
    hashed = hashlib.sha256(dictionary).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = per_worker(("byte level", tokenizer_path), lambda: ByteLevelEncoder(tokenizer_path))
        shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        compress = zstandard.ZstdCompressor(level=settings.level, **shared).compress
        partition, number, shard, kinds = TaskContext.get().partitionId(), 0, None, None

        def told() -> pa.RecordBatch:
            shard.close()
            keys = [k for k in shard.keys if k is not None]
            ends = [min(keys, default=None), max(keys, default=None)]
            own = [shard.name, partition, number, len(shard.keys), shard.tokens, *ends, len(keys) < len(shard.keys)]
            types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), kinds, kinds, pa.bool_()]
            names = ["file", "partition", "number", "documents", "tokens", "first_key", "last_key", "null_keys"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(own, types)], names)

        for batch in batches:
            kinds = batch.column(0).type
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard is None:
                    shard = _Shard(folder, hashed, kinds)
                ids = encoder.encode(body.as_py() or "") + end
                shard.add(name, compress(ids), len(ids) >> 2)
                if shard.at >= settings.shard_bytes or len(shard.keys) >= settings.shard_documents:
                    yield told()
                    shard, number = None, number + 1
        if shard is not None:
            yield told()

    order = [F.col("key").asc_nulls_last(), F.col("tie"), F.col("row")]
    ranged = (
        rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("key", "text")
    )
    schema = (
        "file string, partition int, number int, documents long, tokens long, "
        f"first_key {kind}, last_key {kind}, null_keys boolean"
    )
    ranged.mapInArrow(run, schema).write.parquet(f"{folder}/manifest")
    return folder


def _documents(folder: str, file: str, base: int, wanted: frozenset | None) -> Iterator[tuple]:
    """(key, start, ids) of the documents of a shard, or of the wanted keys in it, by its index."""
    import numpy as np

    system, place = _open_folder(folder)
    with system.open_input_stream(f"{place}/dictionary.zdict") as source:
        dictionary = source.read()
    shared = {}
    with system.open_input_file(f"{place}/{file}") as source:
        import zstandard

        source.seek(source.size() - struct.calcsize(FOOTER))
        at, size, crc, hashed, magic = struct.unpack(FOOTER, source.read(struct.calcsize(FOOTER)))
        source.seek(at)
        data = source.read(size)
        if magic != MAGIC or zlib.crc32(data) != crc:
            raise ValueError(f"{file} is not a whole shard")
        if hashlib.sha256(dictionary).digest() != hashed:
            raise ValueError(f"{file} was written with another dictionary")
        if dictionary:
            shared["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
        decompress = zstandard.ZstdDecompressor(**shared).decompress
        with pa.ipc.open_stream(data) as reader:
            index = reader.read_all()
        keys = index.column("key").to_pylist()
        offsets, sizes, counts = (index.column(n).to_numpy() for n in ("offset", "size", "n_tokens"))
        starts = base + np.cumsum(counts) - counts
        chosen = range(len(keys)) if wanted is None else [i for i, k in enumerate(keys) if k in wanted]
        block, first = b"", 0
        for i in chosen:
            offset, size = int(offsets[i]), int(sizes[i])
            if not first <= offset <= offset + size <= first + len(block):
                source.seek(offset)
                block, first = source.read(max(size, READ_BYTES) if wanted is None else size), offset
            ids = decompress(block[offset - first : offset - first + size])
            if len(ids) != 4 * counts[i]:
                raise ValueError(f"{file} does not hold what its index says")
            yield keys[i], int(starts[i]), ids


def read(
    spark: SparkSession, folder: str, *, key: str = "doc_id", keys: Sequence | None = None, with_ids: bool = True
) -> DataFrame:
    """key, start, n_tokens, ids_crc32 and, on demand, ids (array of long) of each document.

    ``start`` counts the ids of all documents before it. ``keys`` names the documents wanted: only shards
    whose range holds one of them are opened, and only their frames are read.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    kind = manifest.schema["first_key"].dataType.simpleString()
    # One row a shard.
    shards = sorted(manifest.collect(), key=lambda r: (r.partition, r.number))
    listed, base = [], 0
    wanted = None if keys is None else frozenset(keys)
    for shard in shards:
        inside = wanted is None or any(
            shard.null_keys if k is None else shard.first_key is not None and shard.first_key <= k <= shard.last_key
            for k in wanted
        )
        if inside:
            listed.append((shard.file, base))
        base += shard.tokens
    schema = f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    if not listed:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(*(c.to_pylist() for c in batch.columns)):
                held: list[tuple] = []
                size = 0
                for name, start, ids in _documents(folder, file, first, wanted):
                    held.append((name, start, len(ids) >> 2, zlib.crc32(ids), ids if with_ids else None))
                    size += len(ids) if with_ids else 0
                    if len(held) == ROWS_OUT or size > READ_BYTES:
                        yield as_batch(held)
                        held, size = [], 0
                if held:
                    yield as_batch(held)

    def as_batch(held: list[tuple]) -> pa.RecordBatch:
        import numpy as np

        names, starts, counts, sums, bodies = zip(*held)
        arrays = [pa.array(names, key_type), *(pa.array(v, pa.int64()) for v in (starts, counts, sums))]
        if with_ids:
            arrays.append(pa.array([np.frombuffer(b, "<u4").astype(np.int64) for b in bodies], pa.list_(pa.int64())))
        return pa.RecordBatch.from_arrays(arrays, [key, "start", "n_tokens", "ids_crc32", "ids"][: len(arrays)])

    key_type = to_arrow_type(manifest.schema["first_key"].dataType)
    files = spark.createDataFrame(listed, "file string, base long").repartition(len(listed))
    return files.mapInArrow(run, schema)


def digests(
    documents: DataFrame, folder: str, tokenizer_path: str, *, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Write the files, read them back: key, start, n_tokens, ids_crc32 of each document."""
    write(documents, folder, tokenizer_path, key=key, text=text, **options)
    return read(documents.sparkSession, folder, key=key, with_ids=False)
