"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; the decision at a node of the byte's binary tree has its own
context tree over the preceding bytes, as deep as ``DEPTH``. At each context a Krichevsky-Trofimov
estimator holds the counts of zeros and ones; the weighted probability of a context is half its own
estimate, half the product over its children, from the deepest contexts up. What a text costs then
mixes the estimators of all depths of its path by those posterior weights. A context that training
has not seen passes on the estimate of the one above it.

As Spark jobs:

1. Texts are normalised and written once with a chunk number (at most ``CHUNK_BYTES`` of text).
   Every n-gram of DEPTH + 1 bytes is counted per chunk, training texts with their count,
   the others with 0, as arrays by the two latest context bytes.
2. Grouped by those two bytes, a context subtree is weighted on its own. A part with more than
   ``GROUP_ENTRIES`` entries over all chunks is divided by the third context byte and folded over
   ``FOLD_CHUNKS`` chunks at a time until a group has as few arrays of distinct n-grams, at most 256 ** 3 each
   at depth 5; its nodes of two bytes are summed from those of three. The tops of the trees, 257
   contexts of 255 nodes and those of the divided parts, are summed on the driver and sent back.
3. Grouped again, each n-gram of each chunk gets its log probability, those of divided parts from
   the folded n-grams, ``JOINED`` chunks at a time; each chunk receives the
   entries of its own n-grams only, and its texts are scored with them.

Words are counted the same way, by 64-bit hash in ``BUCKETS`` groups, for the unigram score; a group
that is too large is divided by further bits of the hash.
Nothing that grows with the corpus is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerline.llm.common import LOWER, UPPER, remainder
from layerline.operators.scale import materialize, scratch_dir

DEPTH = 5
CHUNK_BYTES = 40 << 20
BUCKETS = 512
#: A part with more entries, over all chunks, is divided; its chunks are folded and joined back so many at a time.
GROUP_ENTRIES = 1 << 21
FOLD_CHUNKS = 16
JOINED = 64
#: Bytes counted at once, and distinct n-grams or words held before they leave a task.
COUNT_AT_ONCE = 1 << 21
HELD = 1 << 21
WORD_CACHE = 300_000
#: Text that is scored at once.
SCORED_BYTES = 1 << 18

#: Closes a text and stands before it; not a byte of UTF-8.
END = 255
SMOOTHING = 0.1
HALF = -0.6931471805599453

FOLD = str.maketrans(UPPER, LOWER)
FOLD_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())
GRAM, TOKEN = 0, 1


def normal_bytes(text: bytes) -> bytes:
    """Words with A to Z in lower case, one blank between them; bytes are split at blanks and \\t to \\r alone."""
    return b" ".join(text.translate(FOLD_BYTES).split())


def normal_text(text: str | None) -> bytes:
    return normal_bytes((text or "").encode("utf-8"))


class _Hashes(dict):
    """64-bit hashes of words, as 8 bytes; at most WORD_CACHE are kept."""

    def __missing__(self, word: bytes) -> bytes:
        import xxhash

        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = (xxhash.xxh64_intdigest(word) & 0x7FFF_FFFF_FFFF_FFFF).to_bytes(8, "little")
        return value


def word_hashes() -> Callable[[Sequence[bytes]], tuple]:
    """A function from normalised texts to the hashes of their words and how many each has.

    The end of a text is the empty word.
    """
    import numpy as np

    known = _Hashes()

    def of(bodies: Sequence[bytes]) -> tuple:
        hashed, end = known.__getitem__, known[b""]
        found = [b"".join(map(hashed, body.split())) + end for body in bodies]
        return np.frombuffer(b"".join(found), "<i8"), np.array([len(f) >> 3 for f in found], np.int64)

    return of


def grams(bodies: Sequence[bytes], depth: int) -> tuple:
    """The n-grams that end at each byte of each text and at its end, packed into integers; how many each text has."""
    import numpy as np

    before, end = bytes([END]) * depth, bytes([END])
    data = np.frombuffer(before + (end + before).join(bodies) + end, np.uint8)
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    n = len(data) - depth
    keys = np.zeros(n, np.int64)
    for i in range(depth + 1):
        keys <<= 8
        keys |= data[i : i + n]
    # What ends before the first byte of the next text belongs to neither.
    between = (np.cumsum(sizes + depth) - depth)[:-1, None] + np.arange(depth)
    inside = np.ones(n, bool)
    inside[between.ravel()] = False
    return keys[inside], sizes


def merged(held: tuple, fresh: tuple) -> tuple:
    """Two lists of sorted distinct keys with their counts as one; nothing is sorted again."""
    import numpy as np

    (keys, counts), (new, times) = held, fresh
    at = np.searchsorted(keys, new)
    known = keys[np.minimum(at, len(keys) - 1)] == new
    counts[at[known]] += times[known]
    rest = ~known
    return np.insert(keys, at[rest], new[rest]), np.insert(counts, at[rest], times[rest])


def lookup(keys, values, nothing) -> Callable:
    """A function from keys to values; all keys that it is asked for must be known, and no value be ``nothing``.

    Tables by a hash of the key hold the values of keys that have a place of their own, the next one those of the rest;
    what is left after three is searched for.
    """
    import numpy as np

    tables = []
    left, own = keys, values
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9):
        if not len(left):
            break
        shift = np.uint64(64 - (2 * len(left)).bit_length())

        def place(wanted, factor=np.uint64(factor), shift=shift):
            return (wanted.view(np.uint64) * factor >> shift).view(np.int64)

        places = place(left)
        numbers = np.arange(len(left), dtype=np.int32)
        last = np.zeros(1 << 64 - int(shift), np.int32)
        last[places] = numbers
        shared = np.zeros(len(last), bool)
        shared[places[last[places] != numbers]] = True
        del last
        rest = shared[places]
        table = np.full(len(shared), nothing, values.dtype)
        table[places[~rest]] = own[~rest]
        tables.append((place, table))
        left, own = left[rest], own[rest]
    order = np.argsort(left)
    left, own = left[order], own[order]

    def of(wanted):
        found = np.full(len(wanted), nothing, values.dtype)
        unknown = None
        for place, table in tables:
            if unknown is None:
                found = table[place(wanted)]
                unknown = np.flatnonzero(found == nothing)
            else:
                found[unknown] = table[place(wanted[unknown])]
                unknown = unknown[found[unknown] == nothing]
        if unknown is not None and len(unknown):
            found[unknown] = own[np.searchsorted(left, wanted[unknown])]
        return found

    return of


def log_gamma_tables():
    """lgamma(n + 1/2) and lgamma(n + 1) of whole numbers, by table and beyond it by series."""
    import numpy as np

    size = 1 << 16
    whole = np.arange(1, size, dtype=np.float64)
    half_table = np.concatenate([[0.5 * np.log(np.pi)], 0.5 * np.log(np.pi) + np.cumsum(np.log(whole - 0.5))])
    one_table = np.concatenate([[0.0], np.cumsum(np.log(whole))])

    def of(table, shift):
        def value(n):
            x = np.maximum(n, 8) + shift
            series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
            return np.where(n < size, table[np.minimum(n, size - 1)], series)

        return value

    return of(half_table, 0.5), of(one_table, 1.0)


def estimates(zeros, ones, tables):
    """Log block probability of a Krichevsky-Trofimov estimator."""
    import numpy as np

    half, one = tables
    return half(zeros) + half(ones) - np.log(np.pi) - one(zeros + ones)


def subtree(keys, counts, depth: int, bit: int, floor: int, tables):
    """One binary decision of all n-grams of a group, from the deepest contexts up to ``floor``.

    Gives the probability of each n-gram's own bit under its context of length ``floor``, and that
    context's nodes: (node, zeros, ones, log weighted probability).
    """
    import numpy as np

    symbol = keys & 255
    prefix = (1 << bit) | (symbol >> (8 - bit))
    one = (symbol >> (7 - bit)) & 1
    below = inner = None
    levels = []
    for length in range(depth, floor - 1, -1):
        context = (keys >> 8) & ((1 << (8 * length)) - 1)
        nodes, place = np.unique(context << 8 | prefix, return_inverse=True)
        ones = np.bincount(place, counts * one, len(nodes)).astype(np.int64)
        zeros = np.bincount(place, counts * (1 - one), len(nodes)).astype(np.int64)
        own = estimates(zeros, ones, tables)
        if below is None:
            weighted, share = own, np.ones(len(nodes))
        else:
            # each child once, under any of its n-grams
            first = np.unique(inner, return_index=True)[1]
            children = np.bincount(place[first], below, len(nodes))
            weighted = HALF + np.logaddexp(own, children)
            share = np.exp(np.minimum(0.0, HALF + own - weighted))
        levels.append((place, zeros, ones, share))
        below, inner = weighted, place
    chance = None
    for place, zeros, ones, share in levels:
        total = (zeros + ones)[place]
        local = (np.where(one == 1, ones[place], zeros[place]) + 0.5) / (total + 1.0)
        if chance is None:
            chance = local
        else:
            mixed = share[place] * local + (1 - share[place]) * chance
            chance = np.where(deeper > 0, mixed, local)
        deeper = total
    return chance, (nodes, zeros, ones, weighted)


def prepare(documents: DataFrame, key: str, text: str, held_out) -> DataFrame:
    """Normalised texts with chunk numbers, written once; later reads see the same chunks."""
    rows = documents.select(F.col(key).alias("key"), held_out.alias("held"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, filled = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = (t.as_buffer() for t in part.column(2))
                bodies = [normal_bytes(t.to_pybytes()) if t is not None else b"" for t in texts]
                chunks = []
                for body in bodies:
                    if filled and filled + len(body) > CHUNK_BYTES:
                        chunk, filled = chunk + 1, 0
                    filled += len(body)
                    chunks.append(chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunks, pa.int64()), part.column(0), part.column(1), pa.array(bodies, pa.binary())],
                    ["chunk", "key", "held", "body"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    frame = rows.mapInArrow(run, f"chunk long, key {kind}, held boolean, body binary")
    spark, path = documents.sparkSession, scratch_dir(documents.sparkSession, "ctw-texts")
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


COUNTS = "chunk long, kind int, part long, n long, keys binary, counts binary"


def count(texts: DataFrame, depth: int) -> DataFrame:
    """Distinct n-grams and words of each chunk with their training counts, as sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        hashes = word_hashes()

        def rows(chunk: int, kind: int, keys, counts) -> pa.RecordBatch:
            part = (keys >> 8) & 0xFFFF if kind == GRAM else keys % BUCKETS
            order = np.lexsort((keys, part))
            keys, counts, part = keys[order], counts[order], part[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            starts = [0, *cuts.tolist()]
            keys = _shortened(keys, kind, depth)
            # A chunk is less than 4 GB, and so are its counts.
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk] * len(starts), pa.int64()),
                    pa.array([kind] * len(starts), pa.int32()),
                    pa.array(part[starts], pa.int64()),
                    pa.array(np.diff([*starts, len(keys)]), pa.int64()),
                    pa.array([x.tobytes() for x in np.split(keys, cuts)], pa.binary()),
                    pa.array([x.astype("<u4").tobytes() for x in np.split(counts, cuts)], pa.binary()),
                ],
                ["chunk", "kind", "part", "n", "keys", "counts"],
            )

        held: dict[tuple[int, int], tuple] = {}  # (chunk, kind): sorted distinct keys, counts
        fresh: dict[tuple[int, bool], list[bytes]] = {}  # (chunk, trained): texts
        size = 0

        def settle() -> None:
            nonlocal size
            for (chunk, trained), bodies in fresh.items():
                for kind, keys in ((GRAM, grams(bodies, depth)[0]), (TOKEN, hashes(bodies)[0])):
                    found, times = np.unique(keys, return_counts=True)
                    own = found, times if trained else np.zeros_like(times)
                    held[chunk, kind] = merged(held[chunk, kind], own) if (chunk, kind) in held else own
            fresh.clear()
            size = 0

        last = None
        for batch in batches:
            for chunk, out, body in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                over = sum(len(k) for k, _ in held.values()) > HELD
                if size > COUNT_AT_ONCE or last is not None and chunk != last or over:
                    settle()
                    if over or chunk != last:
                        for (own, kind), counted in held.items():
                            yield rows(own, kind, *counted)
                        held.clear()
                last = chunk
                data = body.as_py()
                fresh.setdefault((chunk, not out), []).append(data)
                size += len(data) + 1
        settle()
        for (own, kind), counted in held.items():
            yield rows(own, kind, *counted)

    return texts.mapInArrow(run, COUNTS)


def _shortened(keys, kind: int, depth: int):
    """Without the two bytes that the part says, an n-gram of six bytes has four."""
    if kind != GRAM:
        return keys.astype("<i8")
    short = (keys >> 24) << 8 | keys & 255
    return short.astype("<u4" if depth <= 5 else "<i8")


def _restored(data: bytes, kind: int, part: int, depth: int):
    import numpy as np

    if kind != GRAM:
        return np.frombuffer(data, "<i8")
    short = np.frombuffer(data, "<u4" if depth <= 5 else "<i8").astype(np.int64)
    return (short >> 8) << 24 | part << 8 | short & 255


def _gathered(frame, depth: int, counted: str = "<u4"):
    """Distinct keys of a group with their summed counts, and where each row's keys are."""
    import numpy as np

    kind, part = int(frame["kind"].iloc[0]), int(frame["part"].iloc[0])
    lists = [_restored(b, kind, part, depth) for b in frame["keys"]]
    counts = np.concatenate([np.frombuffer(b, counted) for b in frame["counts"]])
    found, place = np.unique(np.concatenate(lists), return_inverse=True)
    edges = np.cumsum([0, *map(len, lists)])
    return found, np.bincount(place, counts, len(found)).astype(np.int64), place, edges


def large_parts(counts: DataFrame, depth: int) -> dict[tuple[int, int], int]:
    """(kind, part) of more than GROUP_ENTRIES entries, and how many times as many; at most 256 ** 2 + BUCKETS.

    Below three bytes of context a part has 256 n-grams and is not divided.
    """
    found = counts.groupBy("kind", "part").agg(F.sum("n").alias("n")).where(F.col("n") > GROUP_ENTRIES).collect()
    return {(r.kind, r.part): -(-r.n // GROUP_ENTRIES) for r in found if r.kind == TOKEN or depth > 2}


DIVIDED = "chunk long, kind int, part long, sub long, keys binary, counts binary"


def divided(counts: DataFrame, large: dict[tuple[int, int], int], depth: int) -> DataFrame:
    """Rows of large parts by third context byte, or by further bits of a word's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                kind, part = row["kind"], row["part"]
                keys = _restored(row["keys"], kind, part, depth)
                times = np.frombuffer(row["counts"], "<u4").astype("<i8")
                sub = (keys >> 24) & 255 if kind == GRAM else keys // BUCKETS % large[kind, part]
                order = np.argsort(sub, kind="stable")  # keys stay sorted
                keys, times, sub = keys[order], times[order], sub[order]
                cuts = np.flatnonzero(np.diff(sub)) + 1
                starts = [0, *cuts.tolist()]
                short = _shortened(keys, kind, depth)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array([row[n]] * len(starts), t) for n, t in
                          (("chunk", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()))),
                        pa.array(sub[starts], pa.int64()),
                        pa.array([x.tobytes() for x in np.split(short, cuts)], pa.binary()),
                        pa.array([x.tobytes() for x in np.split(times, cuts)], pa.binary()),
                    ],
                    ["chunk", "kind", "part", "sub", "keys", "counts"],
                )

    return counts.drop("n").mapInArrow(run, DIVIDED)


def folded_chunks(rows: DataFrame, chunks: int, depth: int) -> DataFrame:
    """Divided rows summed over chunks, until at most some FOLD_CHUNKS rows of each part are left."""

    def run(frame):
        import pandas as pd

        keys, times, _, _ = _gathered(frame, depth, "<i8")
        first = frame.iloc[0]
        kept = _shortened(keys, int(first["kind"]), depth).tobytes(), times.astype("<i8").tobytes()
        names = ["chunk", "kind", "part", "sub"]
        return pd.DataFrame([(*first[names], *kept)], columns=[*names, "keys", "counts"])

    while chunks > FOLD_CHUNKS:
        chunks = -(-chunks // FOLD_CHUNKS)
        dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("chunk"), F.lit(chunks).cast("long")))
        summed = dealt.groupBy("kind", "part", "sub", "chunk").applyInPandas(run, DIVIDED)
        rows = materialize(summed, "ctw-folded")
    return rows


def tops(counts: DataFrame, depth: int, large: DataFrame | None = None) -> tuple:
    """The depths 0 and 1, as arrays by latest byte and node, and depth 2 of divided parts.

    What they add to the probability of a one and of a zero, the factor of the deeper probability,
    and the estimates of depth 1 for a one and a zero. Then, of each part in ``large`` (folded rows),
    zeros, ones and the share of its own estimate, by node.
    """
    import numpy as np

    def run(frame):
        import pandas as pd

        keys, times, _, _ = _gathered(frame, depth)
        tables = log_gamma_tables()
        out = []
        for bit in range(8):
            _, (nodes, zeros, ones, weighted) = subtree(keys, times, depth, bit, 2, tables)
            out.append(
                pd.DataFrame(
                    {"byte": (nodes >> 8) & 255, "node": nodes & 255, "zeros": zeros, "ones": ones, "weighted": weighted}
                )
            )
        return pd.concat(out)

    schema = "byte long, node long, zeros long, ones long, weighted double"
    found = (
        counts.where(F.col("kind") == GRAM).groupBy("part").applyInPandas(run, schema)
        .groupBy("byte", "node")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
        .toArrow()  # at most 256 * 255 rows
    )

    def run_large(frame):
        import pandas as pd

        keys, times, _, _ = _gathered(frame, depth, "<i8")
        tables = log_gamma_tables()
        out = []
        for bit in range(8):
            _, (nodes, zeros, ones, weighted) = subtree(keys, times, depth, bit, 3, tables)
            out.append(pd.DataFrame({"node": nodes & 255, "zeros": zeros, "ones": ones, "weighted": weighted}))
        return pd.concat(out).assign(part=int(frame["part"].iloc[0]))

    byte, node = (found.column(n).to_numpy() for n in ("byte", "node"))
    tables = log_gamma_tables()
    zeros, ones = np.zeros((256, 256), np.int64), np.zeros((256, 256), np.int64)
    below = np.zeros((256, 256))
    zeros[byte, node], ones[byte, node] = found.column("zeros").to_numpy(), found.column("ones").to_numpy()
    below[byte, node] = found.column("weighted").to_numpy()
    second = {}
    if large is not None:
        wide = (
            large.where(F.col("kind") == GRAM).groupBy("part", "sub")
            .applyInPandas(run_large, "part long, node long, zeros long, ones long, weighted double")
            .groupBy("part", "node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("weighted"))
            .toArrow()  # 255 rows a divided part at most
        )
        part, node, z, o, w = (wide.column(n).to_numpy() for n in ("part", "node", "zeros", "ones", "weighted"))
        own = estimates(z, o, tables)
        up = HALF + np.logaddexp(own, w)
        share = np.exp(np.minimum(0.0, HALF + own - up))
        for into, values in ((zeros, z), (ones, o), (below, up)):
            np.add.at(into, (part & 255, node), values)
        for p in np.unique(part).tolist():
            at = part == p
            second[p] = np.zeros((3, 256))
            second[p][:, node[at]] = z[at], o[at], share[at]
    own = estimates(zeros, ones, tables)
    weighted = HALF + np.logaddexp(own, below)
    share = np.exp(np.minimum(0.0, HALF + own - weighted))
    all_zeros, all_ones = zeros.sum(axis=0), ones.sum(axis=0)
    root = estimates(all_zeros, all_ones, tables)
    root_share = np.exp(np.minimum(0.0, HALF + root - (HALF + np.logaddexp(root, weighted.sum(axis=0)))))
    rest = (1 - root_share) * (1 - share)

    def base(hits, all_hits):
        first = (all_hits + 0.5) / (all_zeros + all_ones + 1.0)
        second = (hits + 0.5) / (zeros + ones + 1.0)
        return np.where(zeros + ones > 0, root_share * first + (1 - root_share) * share * second, first)

    total = zeros + ones
    return (
        base(ones, all_ones),
        base(zeros, all_zeros),
        np.where(total > 0, rest, 0.0),
        (ones + 0.5) / (total + 1.0),
        (zeros + 0.5) / (total + 1.0),
        second,
    )


def vocabulary(counts: DataFrame, depth: int, large: DataFrame | None = None) -> tuple[int, int]:
    """Distinct training tokens and their number, with those of divided parts."""

    def summed(counted: str):
        def run(frame):
            import pandas as pd

            _, times, _, _ = _gathered(frame, depth, counted)
            return pd.DataFrame({"distinct": [int((times > 0).sum())], "total": [int(times.sum())]})

        return run

    schema = "distinct long, total long"
    found = counts.where(F.col("kind") == TOKEN).groupBy("part").applyInPandas(summed("<u4"), schema)
    if large is not None:
        words = large.where(F.col("kind") == TOKEN).groupBy("part", "sub")
        found = found.union(words.applyInPandas(summed("<i8"), schema))
    distinct, total = found.agg(F.sum("distinct"), F.sum("total")).first()
    return int(distinct or 0), int(total or 0)


ENTRIES = "chunk long, kind int, part long, keys binary, values binary"


def entries(
    counts: DataFrame, depth: int, top: tuple, rows: DataFrame | None = None, large: DataFrame | None = None, chunks: int = 0
) -> DataFrame:
    """For each chunk, the log10 probabilities of its n-grams and the training counts of its words.

    ``rows`` are the divided parts by chunk, ``large`` the same folded over chunks.
    """
    # five arrays of 256 * 256, and 3 * 256 numbers a divided part
    shared = counts.sparkSession.sparkContext.broadcast(top)

    def log_chances(keys, times, part: int):
        import numpy as np

        one_base, zero_base, rest, one_local, zero_local, second = shared.value
        tables = log_gamma_tables()
        logs = np.zeros(len(keys))
        byte, symbol = (keys >> 8) & 255, keys & 255
        floor = 3 if part in second else 2
        for bit in range(8):
            chance, (nodes, zeros, ones, _) = subtree(keys, times, depth, bit, floor, tables)
            node = (1 << bit) | (symbol >> (8 - bit))
            one = ((symbol >> (7 - bit)) & 1) == 1
            place = np.searchsorted(nodes, (keys >> 8 & (1 << 8 * floor) - 1) << 8 | node)
            known = (zeros + ones)[place] > 0
            if floor == 3:
                z, o, share = (x[node] for x in second[part])
                own = (np.where(one, o, z) + 0.5) / (z + o + 1.0)
                chance = np.where(known, share * own + (1 - share) * chance, own)
                known = z + o > 0
            base = np.where(one, one_base[byte, node], zero_base[byte, node])
            local = np.where(one, one_local[byte, node], zero_local[byte, node])
            # an unseen context of two bytes passes on the estimate of one byte
            logs += np.log10(base + rest[byte, node] * np.where(known, chance, local))
        return logs

    def valued(keys, times, frame):
        kind, part = int(frame["kind"].iloc[0]), int(frame["part"].iloc[0])
        return log_chances(keys, times, part).astype("<f4") if kind == GRAM else times.astype("<i8")

    def run(frame):
        import pandas as pd

        keys, times, place, edges = _gathered(frame, depth)
        values = valued(keys, times, frame)
        return pd.DataFrame(
            {
                "chunk": frame["chunk"],
                "kind": frame["kind"],
                "part": frame["part"],
                "keys": frame["keys"],
                "values": [values[place[a:b]].tobytes() for a, b in zip(edges, edges[1:])],
            }
        )

    found = counts.groupBy("kind", "part").applyInPandas(run, ENTRIES)
    if large is None:
        return found

    def run_large(frame):
        import pandas as pd

        keys, times, _, _ = _gathered(frame, depth, "<i8")
        first = frame.iloc[0]
        kept = _shortened(keys, int(first["kind"]), depth).tobytes(), valued(keys, times, frame).tobytes()
        names = ["kind", "part", "sub"]
        return pd.DataFrame([(*first[names], *kept)], columns=[*names, "keys", "values"])

    def looked_up(mine, model):
        import numpy as np

        mine = mine[["chunk", "kind", "part", "keys"]]
        if not len(mine):
            return mine.assign(values=[])
        kind, part = int(mine["kind"].iloc[0]), int(mine["part"].iloc[0])
        keys = _restored(model["keys"].iloc[0], kind, part, depth)
        values = np.frombuffer(model["values"].iloc[0], "<f4" if kind == GRAM else "<i8")
        lists = (_restored(b, kind, part, depth) for b in mine["keys"])
        return mine.assign(values=[values[np.searchsorted(keys, x)].tobytes() for x in lists])

    schema = "kind int, part long, sub long, keys binary, values binary"
    model = materialize(large.groupBy("kind", "part", "sub").applyInPandas(run_large, schema), "ctw-large")
    groups = max(1, -(-chunks // JOINED))
    mine = rows.drop("counts").withColumn("_g", F.pmod(F.xxhash64("chunk"), F.lit(groups).cast("long")))
    model = model.withColumn("_g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    by = ["kind", "part", "sub", "_g"]
    return found.union(mine.groupBy(*by).cogroup(model.groupBy(*by)).applyInPandas(looked_up, ENTRIES))


def score(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from rows whose crc32 of the key as text is not 0 modulo 10; null keys are learnt from.
    ``score`` is the log10 probability of the words, one blank between them, and the end;
    ``bits_per_byte`` its code length over those bytes (log probabilities of n-grams travel in single
    precision). A null text counts as empty: its end alone.
    Equal rows count and stay, other columns are ignored, an empty table gives no rows. Without
    training text every byte costs eight bits.
    """
    held_out = F.coalesce(remainder(F.col(key), 10) == 0, F.lit(False))
    texts = prepare(documents, key, text, held_out)
    counts = materialize(count(texts, depth), "ctw-counts")
    sizes = large_parts(counts, depth)
    rows = large = None
    chunks = 0
    if sizes:
        spark = documents.sparkSession
        # (kind, part) of at most 256 ** 2 + BUCKETS parts
        listed = F.broadcast(spark.createDataFrame(list(sizes), "kind int, part long"))
        by = ["kind", "part"]
        rows = materialize(divided(counts.join(listed, by, "left_semi").select(counts.columns), sizes, depth), "ctw-divided")
        counts = counts.join(listed, by, "left_anti").select(counts.columns)
        chunks = texts.select("chunk").distinct().count()
        large = folded_chunks(rows, chunks, depth)
    distinct, total = vocabulary(counts, depth, large)
    model = entries(counts, depth, tops(counts, depth, large), rows, large, chunks)
    kind = texts.schema["key"].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double"
    )

    def run(rows, own):
        import numpy as np
        import pandas as pd

        hashes = word_hashes()
        found = {}
        for which, kind in ((GRAM, "<f4"), (TOKEN, "<i8")):
            mine = own[own["kind"] == which]
            lists = [_restored(b, which, p, depth) for b, p in zip(mine["keys"], mine["part"])]
            found[which] = np.concatenate([np.empty(0, np.int64), *lists]), np.frombuffer(b"".join(mine["values"]), kind)
        # Log probabilities are 0 at most, and places 0 at least.
        gram_logs = lookup(*found.pop(GRAM), 1)
        word_keys, word_counts = found.pop(TOKEN)
        word_places = lookup(word_keys, np.arange(len(word_keys), dtype=np.int32), -1)
        base = np.log10((word_counts + SMOOTHING) / (total + SMOOTHING * (distinct + 1)))
        out = [[np.empty(0, np.int64)] * 2 + [np.empty(0)] * 3]

        def scored(bodies: list[bytes]) -> list:
            words, n_words = hashes(bodies)
            keys, n_bytes = grams(bodies, depth)
            at, starts = word_places(words), np.cumsum(n_words) - n_words
            values = np.add.reduceat(gram_logs(keys).astype(np.float64), np.cumsum(n_bytes) - n_bytes)
            known = np.add.reduceat((word_counts[at] > 0).astype(np.int64), starts)
            return [n_words, known, np.add.reduceat(base[at], starts), values, -values / np.log10(2) / n_bytes]

        block: list[bytes] = []
        size = 0
        for data in rows["body"]:
            block.append(data)
            size += len(data) + 1
            if size >= SCORED_BYTES:
                out.append(scored(block))
                block, size = [], 0
        if block:
            out.append(scored(block))
        names = ["n_tokens", "n_known", "base_score", "score", "bits_per_byte"]
        result = pd.DataFrame(dict(zip(names, map(np.concatenate, zip(*out)))))
        result.insert(0, key, rows["key"].to_numpy())
        result.insert(1, "held_out", rows["held"].to_numpy())
        result.insert(4, "train_tokens", total)
        return result

    return (
        texts.groupBy("chunk").cogroup(model.groupBy("chunk")).applyInPandas(run, schema)
    )
