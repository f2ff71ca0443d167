"""Exact top-k inner products by a three-phase uniform threshold.

A vector's dimensions are dealt into ``parts`` lists; its score is the sum of its partial scores.

1. Each batch of candidates gives, for each query, the best ``k`` of each list by partial score.
   Their full scores are known on the spot, and the k-th best of all is a safe cutoff: the k-th best
   of everything cannot be lower.
2. The cutoff T of each query goes to all tasks. A score of at least T needs a partial score of at
   least T / parts in some list (uniform threshold), so only such entries are collected.
3. Their scores are completed exactly where they lie; those of at least T leave the task, and the
   k best of them are the result.

Queries are written once and read in blocks of at most ``BLOCK_BYTES``; each block is broadcast, meets all
candidates, and its result is written before the next. Scores are integers: matrix products run in float64
while every sum is below 2**53, else in int64. Vectors with components so large that a sum might pass
2**62 are multiplied with Python's integers, a slower path for rare rows; their full scores take the place
of the lists. A score that no long holds is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerline.operators.scale import materialize

K = 5
PARTS = 4
SCALE = 256
BLOCK_BYTES = 16 << 20
#: Candidates multiplied with a block of queries at once.
ROWS_AT_ONCE = 2048
QUERIES_AT_ONCE = 1024


def quantised(vectors: DataFrame, *, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """id, v (array of long): floor(scale * x), x as double.

    Left out: null keys, null or empty vectors, vectors with a null or non-finite component. A component
    that no long holds after scaling is an error.
    """
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(key).alias("id"), doubles.alias("x")).where(
        F.col("id").isNotNull() & (F.size("x") > 0)
    )
    fine = F.forall("x", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    held = F.forall("x", lambda x: F.abs(x * scale) < 2.0**63)
    refused = F.raise_error(F.lit("a component of a vector does not fit a long")).cast("array<bigint>")
    whole = F.transform("x", lambda x: F.floor(x * scale).cast("long"))
    return rows.where(fine).select("id", F.when(held, whole).otherwise(refused).alias("v"))


def _matrix(column: pa.Array, width: int):
    """Rows of equal width; shorter vectors end in zeros."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = at < width
    out[rows[inside], at[inside]] = flat[inside]
    return out


def _partials(queries, rows, parts: int):
    """(parts, queries, rows) exact integer partial scores, all below 2**62."""
    import numpy as np

    width = queries.shape[1]
    edges = np.linspace(0, width, parts + 1).astype(int)
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * width
    kind = np.float64 if most < 2**53 else np.int64
    a, b = queries.astype(kind), rows.astype(kind)
    return np.stack(
        [(a[:, i:j] @ b[:, i:j].T).astype(np.int64) for i, j in zip(edges, edges[1:])]
    )


def _large(vectors):
    """Which vectors have a component whose products might add up to 2**62."""
    import math

    limit = math.isqrt((1 << 62) // max(1, vectors.shape[1]))
    # not by abs(), which has no value for the least long
    return ((vectors >= limit) | (vectors <= -limit)).any(axis=1)


def _entries(ids, queries, names, rows, cuts, k: int, parts: int):
    """(query ids, row ids, scores) of one phase for vectors that are not large; ``cuts`` None in the first."""
    import numpy as np

    partial = _partials(queries, rows, parts)
    total = partial.sum(axis=0)
    other = ids[:, None] != names[None, :]
    if cuts is None:
        wanted = np.zeros_like(other)
        depth = min(k + 1, len(names))  # one more, as the query may be among them
        for one in partial:
            top = np.argpartition(-one, depth - 1, axis=1)[:, :depth]
            np.put_along_axis(wanted, top, True, axis=1)
    else:
        # some list holds at least an equal share of the cutoff
        share = cuts // parts + (cuts % parts != 0)
        wanted = (partial >= share[None, :, None]).any(axis=0)
        wanted &= total >= cuts[:, None]
    q, v = np.nonzero(wanted & other)
    return ids[q], names[v], total[q, v]


def _exact_entries(ids, queries, names, rows, cuts, k: int):
    """The same with Python's integers, by full scores."""
    import heapq

    import numpy as np

    found: list[tuple[int, int, int]] = []
    texts = [v.tolist() for v in rows]
    for i, query in enumerate(queries.tolist()):
        scores = [sum(map(int.__mul__, query, row)) for row in texts]
        entries = [(s, -n) for s, n in zip(scores, names.tolist()) if n != ids[i]]
        if any(not -(1 << 63) <= s < 1 << 63 for s, _ in entries):
            raise OverflowError(f"a score of vector {ids[i]} does not fit a long")
        chosen = heapq.nlargest(k, entries) if cuts is None else [e for e in entries if e[0] >= cuts[i]]
        found += [(int(ids[i]), -n, s) for s, n in chosen]
    return tuple(np.array(c, np.int64) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _over_candidates(candidates: DataFrame, block, cutoffs, k: int, parts: int) -> DataFrame:
    """Entries (query_id, vec_id, score) of one phase; without cutoffs, of the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        ids, queries = block.value
        limits = None if cutoffs is None else cutoffs.value
        large_query = _large(queries)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                names = part.column(0).to_numpy(zero_copy_only=False)
                rows = _matrix(part.column(1), queries.shape[1])
                large_row = _large(rows)
                for low in range(0, len(ids), QUERIES_AT_ONCE):
                    here = np.arange(low, min(low + QUERIES_AT_ONCE, len(ids)))
                    plain, large = here[~large_query[here]], here[large_query[here]]
                    for asked, there, exact in (
                        (plain, ~large_row, False),
                        (plain, large_row, True),
                        (large, np.ones(len(names), bool), True),
                    ):
                        if not len(asked) or not there.any():
                            continue
                        cuts = None if limits is None else limits[asked]
                        own = ids[asked], queries[asked], names[there], rows[there], cuts, k
                        found = _exact_entries(*own) if exact else _entries(*own, parts)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) for c in found], ["query_id", "vec_id", "score"]
                        )

    return candidates.mapInArrow(run, "query_id long, vec_id long, score long")


def _best(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    parts: int = PARTS,
    scale: int = SCALE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best other rows of each query, all if fewer.

    ``is_query`` is a condition on the key column. Ties go to the smaller key. Vectors that
    ``quantised`` leaves out take no part; a shorter vector counts as ending in zeros. Rows of a
    query's own key are no candidates for it; of rows that repeat a key, each is a candidate and
    the query is the largest of them. Without queries or rows the result is empty.
    """
    import numpy as np

    spark = vectors.sparkSession
    rows = quantised(vectors, key=key, vector=vector, scale=scale)
    asked = quantised(vectors.where(is_query), key=key, vector=vector, scale=scale)
    asked = materialize(asked.groupBy("id").agg(F.max("v").alias("v")), "topk-queries")
    shape = asked.agg(F.count(F.lit(1)), F.max(F.size("v")), F.min("id"), F.max("id")).first()
    count, width, least, most = shape
    results = []
    if count:
        parts = min(parts, width)
        blocks = max(1, -(-count * width * 8 // block_bytes))
        hashed = F.pmod(F.xxhash64("id"), F.lit(blocks))
        for number in range(blocks):
            own = asked.where(hashed == number).orderBy("id").toArrow().combine_chunks()
            if not own.num_rows:
                continue
            ids = own.column("id").to_numpy().astype(np.int64)
            queries = _matrix(own.column("v").combine_chunks(), width)
            block = spark.sparkContext.broadcast((ids, queries))
            first = _best(_over_candidates(rows, block, None, k, parts).distinct(), k)
            known = first.where(F.col("rank") == k).select("query_id", "score").toArrow()
            limits = np.full(len(ids), np.iinfo(np.int64).min)
            places = np.searchsorted(ids, known.column("query_id").to_numpy())
            limits[places] = known.column("score").to_numpy()
            cutoffs = spark.sparkContext.broadcast(limits)
            results.append(materialize(_best(_over_candidates(rows, block, cutoffs, k, parts), k), "topk-block"))
            block.destroy()
            cutoffs.destroy()
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, results).select("query_id", "rank", "vec_id", "score")
