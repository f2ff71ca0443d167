"""Ranked lexical search without random access (NRA) over impact-sorted lists.

The index has one row for each shard of at most ``SHARD_DOCUMENTS`` documents. A shard keeps, for each
term of the items, the list of its documents by descending impact (what an occurrence adds to a score,
before the term's weight), cut by depth into layers that are columns of their own: a reader that wants the
heads of the lists reads no more. After each layer stands the impact of its last entry, the floor: what
is still unread of a list is no higher. The impact that one occurrence would give a document is kept as
well: where the floor is below it, the document cannot be in the rest of the list.

1. The first layer gives each document of a shard a lower bound. The k-th best bound of an item over all
   shards is a safe cutoff.
2. With the first two layers each document has an interval: what was read of it, and that plus the floors
   of the lists in which it may still be. Documents whose upper end is below the cutoff are out; an item
   is settled in a shard when the interval of every other one is a point.
3. Only shards with unsettled items are read to the end, with cutoffs raised by step 2, and only for those
   items. Then all floors are 0, so membership, ties and scores are settled.

Each shard hands on at most ``k`` documents an item, the best by (score, key), so hot terms stay divided
over their shards. The driver holds a block of items (``BLOCK_BYTES`` of texts), their vocabulary with its
weights, and one cutoff an item; blocks follow one another.

Scores are integers: see ``search``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from layerline.operators.scale import fits_broadcast, materialize

K = 10
SHARD_DOCUMENTS = 8192
SHARD_TOKENS = 4 << 20
#: Ends of all layers of a list but the last.
DEPTHS = (32, 512)
BLOCK_BYTES = 8 << 20

#: Bytes of terms as they count; all others part terms. Bytes beyond ASCII are parts of terms.
TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)

LAYER = "struct<terms:binary,counts:binary,floors:binary,documents:binary,impacts:binary>"
#: Of a row that a shard hands on: settled, or a lower bound of an item that is not.
SETTLED, BOUND = 0, 1


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    """Of a term that so many of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _vocabulary(texts: list[str | None]) -> tuple[dict[bytes, bytes], list[dict[int, int]]]:
    """Terms by number (as 4 bytes), and the terms of each text with their repeats."""
    numbers: dict[bytes, int] = {}
    items = []
    for text in texts:
        found = Counter(terms((text or "").encode("utf-8", "surrogatepass")))
        items.append({numbers.setdefault(t, len(numbers)): n for t, n in found.items()})
    return {t: n.to_bytes(4, "little") for t, n in numbers.items()}, items


def _postings(documents: DataFrame, vocabulary) -> DataFrame:
    """A row for each shard: its documents and the occurrences of the items' terms, by term.

    ``n_documents`` counts those with a term, ``n_terms`` all their terms with repeats.
    """

    def shard(number: int, keys: list, sizes: list[int], bodies: list[bytes]) -> pa.RecordBatch:
        import numpy as np

        found = np.frombuffer(b"".join(bodies), "<u4").astype(np.int64)
        documents_of = np.repeat(np.arange(len(keys)), [len(b) >> 2 for b in bodies])
        codes, times = np.unique(found * len(keys) + documents_of, return_counts=True)
        present, counts = np.unique(codes // len(keys), return_counts=True)
        named = np.array([k is not None for k in keys])
        row = {
            "shard": pa.array([number]),
            "n_documents": pa.array([sum(n > 0 for n in sizes)]),
            "n_terms": pa.array([sum(sizes)]),
            "keys": np.array([k if k is not None else 0 for k in keys], "<i8"),
            "named": named,
            "sizes": np.array(sizes, "<i8"),
            "terms": pa.array([present.astype(np.int32)], pa.list_(pa.int32())),
            "counts": pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
            "documents": (codes % len(keys)).astype("<u2"),
            "times": times.astype("<u4"),
        }
        arrays = [v if isinstance(v, pa.Array) else pa.array([v.tobytes()], pa.binary()) for v in row.values()]
        return pa.RecordBatch.from_arrays(arrays, list(row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value.get
        number = TaskContext.get().partitionId() << 32
        keys, sizes, bodies, tokens = [], [], [], 0
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = body.as_buffer()
                words = terms(text.to_pybytes()) if text is not None else []
                keys.append(name)
                sizes.append(len(words))
                bodies.append(b"".join(filter(None, map(known, words))))
                tokens += len(bodies[-1]) >> 2
                if len(keys) == SHARD_DOCUMENTS or tokens >= SHARD_TOKENS:
                    yield shard(number, keys, sizes, bodies)
                    keys, sizes, bodies, tokens, number = [], [], [], 0, number + 1
        if keys:
            yield shard(number, keys, sizes, bodies)

    return documents.mapInArrow(
        run,
        "shard long, n_documents long, n_terms long, keys binary, named binary, sizes binary, "
        "terms array<int>, counts array<int>, documents binary, times binary",
    )


def _index(postings: DataFrame, n_documents: int, n_terms: int, depths: tuple[int, ...]) -> DataFrame:
    """Lists by descending impact, in layers."""

    def layers(row: dict) -> tuple[list[dict], bytes]:
        import numpy as np

        sizes, place = np.unique(np.frombuffer(row["sizes"], "<i8"), return_inverse=True)
        # Python's integers, as the products may pass 64 bits.
        lengths = np.array([25 + 75 * int(n) * n_documents // n_terms for n in sizes], np.int64)[place]
        counts = np.array(row["counts"], np.int64)
        term_of = np.repeat(np.array(row["terms"], np.int64), counts)
        documents = np.frombuffer(row["documents"], "<u2")
        times = np.frombuffer(row["times"], "<u4").astype(np.int64)
        impacts = 1_000_000_000 * times // (1000 * times + 8 * lengths[documents])
        order = np.lexsort((documents, -impacts, term_of))
        documents, impacts = documents[order], impacts[order].astype("<i4")
        starts = np.cumsum(counts) - counts
        depth = np.arange(len(documents)) - np.repeat(starts, counts)
        found = []
        for low, high in zip((0, *depths), (*depths, None)):
            here = depth >= low if high is None else (depth >= low) & (depth < high)
            there = counts > low
            ends = counts[there] if high is None else np.minimum(counts[there], high)
            floors = np.where(ends < counts[there], impacts[starts[there] + ends - 1], 0)
            found.append(
                {
                    "terms": np.array(row["terms"], "<i4")[there].tobytes(),
                    "counts": (ends - low).astype("<i4").tobytes(),
                    "floors": floors.astype("<i4").tobytes(),
                    "documents": documents[here].tobytes(),
                    "impacts": impacts[here].tobytes(),
                }
            )
        return found, (1_000_000_000 // (1000 + 8 * lengths)).astype("<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.struct([(n, pa.binary()) for n in ("terms", "counts", "floors", "documents", "impacts")])
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                found, least = layers(row)
                arrays = [pa.array([row["shard"]]), *(pa.array([v], pa.binary()) for v in (row["keys"], row["named"], least))]
                arrays += [pa.array([layer], shape) for layer in found]
                names = ["shard", "keys", "named", "least", *(f"layer_{i}" for i in range(len(found)))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    read = postings.select("shard", "keys", "named", "sizes", "terms", "counts", "documents", "times")
    schema = "shard long, keys binary, named binary, least binary, " + ", ".join(
        f"layer_{i} {LAYER}" for i in range(len(depths) + 1)
    )
    return read.mapInArrow(run, schema)


class Shard:
    """Layers of a shard, as far as they were read."""

    def __init__(self, row: dict, layers: list[dict]) -> None:
        import numpy as np

        self.keys = np.frombuffer(row["keys"], "<i8")
        self.named = np.frombuffer(row["named"], bool)
        self.least = np.frombuffer(row["least"], "<i4")
        self._layers = []
        for layer in layers:
            kinds = {"documents": "<u2"}
            own = {n: np.frombuffer(b, kinds.get(n, "<i4")) for n, b in layer.items()}
            own["ends"] = np.cumsum(own["counts"], dtype=np.int64)
            self._layers.append(own)

    def read(self, wanted, weights) -> tuple:
        """(lower bounds of all documents, documents read in each list, floors of the lists)."""
        import numpy as np

        read: list[list] = [[] for _ in wanted]
        floors = np.zeros(len(wanted), np.int64)
        documents, values = [], []
        for layer in self._layers:
            if not len(layer["terms"]):
                continue
            places = np.searchsorted(layer["terms"], wanted)
            places[places == len(layer["terms"])] = 0
            for i in np.flatnonzero(layer["terms"][places] == wanted).tolist():
                at = places[i]
                own = slice(layer["ends"][at] - layer["counts"][at], layer["ends"][at])
                read[i].append(layer["documents"][own])
                documents.append(layer["documents"][own])
                values.append(layer["impacts"][own] * weights[i])
                floors[i] = layer["floors"][at]
        lower = np.zeros(len(self.keys), np.int64)
        if documents:
            documents, values = np.concatenate(documents), np.concatenate(values)
            if int(weights.sum()) * 1_000_000 < 1 << 53:  # every sum is exact as a double
                lower = np.bincount(documents, values, minlength=len(lower)).astype(np.int64)
            else:
                np.add.at(lower, documents, values)
        return lower, read, floors

    def best(self, documents, scores, k: int):
        """Positions in ``documents`` of the k best by score and key."""
        import numpy as np

        if len(documents) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            chosen = np.flatnonzero(scores >= least)
        else:
            chosen = np.arange(len(documents))
        own = documents[chosen]
        return chosen[np.lexsort((self.keys[own], ~self.named[own], -scores[chosen]))[:k]]

    def settle(self, wanted, weights, cutoff: int, k: int) -> tuple:
        """(documents, scores, whether they are settled): the best ones at the cutoff or above."""
        import numpy as np

        lower, read, floors = self.read(wanted, weights)
        gains = weights * floors
        near = np.flatnonzero(lower + gains.sum() >= cutoff)
        upper = lower[near].copy()
        for i in np.flatnonzero(gains):
            unseen = np.ones(len(self.keys), bool)
            for documents in read[i]:
                unseen[documents] = False
            upper += np.where(unseen[near] & (self.least[near] <= floors[i]), gains[i], 0)
        near, upper = near[upper >= cutoff], upper[upper >= cutoff]
        settled = bool((lower[near] == upper).all())
        near = near[lower[near] >= max(1, cutoff if settled else 1)]
        chosen = near[self.best(near, lower[near], k)]
        return chosen, lower[chosen], settled

    def bounds(self, wanted, weights, k: int) -> tuple:
        import numpy as np

        lower, _, _ = self.read(wanted, weights)
        seen = np.flatnonzero(lower > 0)
        chosen = seen[self.best(seen, lower[seen], k)]
        return chosen, lower[chosen]


def _round(index: DataFrame, layers: int, queries, cutoffs, k: int) -> DataFrame:
    """Rows (shard, item, key, score, state) from so many layers; without cutoffs, bounds alone.

    A column ``items`` of the index names the items wanted of a shard, else all are. An item that is
    not settled has a row at least, maybe without a document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        items = queries.value
        limits = None if cutoffs is None else cutoffs.value
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                shard = Shard(row, [row[f"layer_{i}"] for i in range(layers)])
                columns: list[list] = [[], [], [], []]
                for item in row.get("items") or range(len(items)):
                    wanted, weights = items[item]
                    if limits is None:
                        documents, scores = shard.bounds(wanted, weights, k)
                        state = BOUND
                    else:
                        documents, scores, settled = shard.settle(wanted, weights, int(limits[item]), k)
                        state = SETTLED if settled else BOUND
                    names = [int(shard.keys[d]) if shard.named[d] else None for d in documents]
                    scores = scores.tolist()
                    if state == BOUND and limits is not None and not names:
                        names, scores = [None], [0]
                    columns[0] += [item] * len(names)
                    columns[1] += names
                    columns[2] += scores
                    columns[3] += [state] * len(names)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32())
                arrays = [pa.array(v, t) for v, t in zip(columns, kinds)]
                own = pa.array(np.full(len(columns[0]), row["shard"]), pa.int64())
                yield pa.RecordBatch.from_arrays([own, *arrays], ["shard", "item", "key", "score", "state"])

    wanted = [c for c in ("shard", "keys", "named", "least", "items") if c in index.columns]
    read = index.select(*wanted, *(f"layer_{i}" for i in range(layers)))
    return read.mapInArrow(run, "shard long, item int, key long, score long, state int")


def _kth(rows: DataFrame, k: int, items: int):
    """The k-th best score of each item, 1 where there are fewer."""
    import numpy as np

    order = Window.partitionBy("item").orderBy(F.desc("score"))
    ranked = rows.select("item", "score", F.row_number().over(order).alias("r")).where(F.col("r") <= k)
    found = np.ones(items, np.int64)
    for row in ranked.where(F.col("r") == k).collect():  # one an item
        found[row["item"]] = max(1, row["score"])
    return found


def _search(documents: DataFrame, texts: list[str | None], k: int, depths: tuple[int, ...]) -> DataFrame | None:
    """Rows (item, key, score) of the block's items, the best of each shard; written."""
    import numpy as np

    context = documents.sparkSession.sparkContext
    numbers, items = _vocabulary(texts)
    if not numbers:
        return None
    shared = [context.broadcast(numbers)]
    postings = materialize(_postings(documents, shared[0]), "ranked-postings")
    n_documents, n_terms = postings.agg(F.sum("n_documents"), F.sum("n_terms")).first()
    if not n_documents:
        return None
    lists = postings.select(F.explode(F.arrays_zip("terms", "counts")).alias("l"))
    holding = lists.groupBy("l.terms").agg(F.sum("l.counts").alias("n")).collect()  # one a term of the block
    weights = np.zeros(len(numbers), np.int64)
    for row in holding:
        weights[row["terms"]] = weight(n_documents, row["n"])
    queries = []
    for item in items:
        wanted = np.array(sorted(item), np.int32)
        queries.append((wanted, weights[wanted] * np.array([item[t] for t in sorted(item)], np.int64)))
    shared.append(context.broadcast(queries))
    index = materialize(_index(postings, n_documents, n_terms, depths), "ranked-index")

    cutoffs = _kth(_round(index, 1, shared[1], None, k), k, len(items))
    shared.append(context.broadcast(cutoffs))
    narrow = materialize(_round(index, min(2, len(depths) + 1), shared[1], shared[2], k), "ranked-narrow")
    rows = narrow.where(F.col("state") == SETTLED)
    left = narrow.where(F.col("state") == BOUND).groupBy("shard").agg(F.collect_set("item").alias("items"))
    if not left.isEmpty():
        shared.append(context.broadcast(np.maximum(cutoffs, _kth(narrow, k, len(items)))))
        small = fits_broadcast(left)
        rest = index.join(F.broadcast(left) if small else left, "shard")
        rows = rows.union(materialize(_round(rest, len(depths) + 1, shared[1], shared[3], k), "ranked-rest"))
    for one in shared:
        one.destroy()
    return rows.select("item", "key", "score")


def search(
    documents: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = K,
    depths: tuple[int, ...] = DEPTHS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item, rank (from 1), key, score: the k documents of each item with the highest scores above 0.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. N documents have a
    term, L is the number of all terms, df that of the documents holding a term, n a document's length.
    A term weighs floor(1000 * ln((2N + 2) / (2df + 1))), an occurrence count tf has the impact
    10^9 tf div (1000 tf + 8 m) with m = 25 + 75 n N div L, and a score sums weight times impact over the
    item's terms, repeats included. Equal scores go by ascending key, null keys last.

    Null and empty texts have no terms, so such documents and items have no rows. Each row of documents counts
    on its own, also with a key that repeats; of items that repeat an id the least text counts, and a null
    id is an id. Very long texts are read whole. Empty tables give no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    if not isinstance(documents.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} must be an integer column")
    rows = documents.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    asked = items.groupBy(F.col(item).alias("id")).agg(F.min(item_text).alias("text"))
    asked = materialize(asked.where(F.length("text") > 0), "ranked-items")
    kind = asked.schema["id"].dataType
    names = f"`{item}` {kind.simpleString()}, rank int, `{key}` long, score long"
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    found = []
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow()
        best = _search(rows, own.column("text").to_pylist(), k, depths) if own.num_rows else None
        if best is not None:
            ids = pa.table(
                [own.column("id").cast(to_arrow_type(kind)), pa.array(range(own.num_rows), pa.int32())], ["id", "item"]
            )
            # A block of ids.
            found.append(best.join(F.broadcast(spark.createDataFrame(ids)), "item"))
    if not found:
        return spark.createDataFrame([], names)
    order = Window.partitionBy("id").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("rank") <= k) & (F.col("score") > 0)).select(
        F.col("id").alias(item), F.col("rank"), F.col("key").alias(key), "score"
    )
