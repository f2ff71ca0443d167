"""Measured decisions: what is small enough to broadcast, and which keys are hot.

Both measurements return a few numbers to the driver. They steer the plan only; the result
is the same whichever way they fall.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side may hold this much, measured, at most.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20

# A key is hot when one task would have to sort more rows of it than this. Hot keys are cut into
# chunks of that many rows, whatever the input; at most this many keys are looked for.
HOT_ROWS = 2_000_000
HOT_KEYS = 10_000

# Wide rows are shuffled in slices of about this many rows, and in at most so many slices.
SLICE_ROWS = 18_000_000
SLICES = 12

#: Scratch folders that the innermost ``lean_disk`` drops.
_DROPPED: ContextVar[list[str] | None] = ContextVar("dropped", default=None)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the cluster's shared checkpoint folder.

    Only a local session may lack the setting; it gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="layerline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/layerline/{label}-{uuid.uuid4().hex}"


#: Shuffle files go when the query that wrote them has ended, and files are packed more densely.
_LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[list[str]]:
    """Keep little on disk: what is materialized inside is dropped at the end, shuffle files after each query.

    For steps that end in stored tables or plain values. A frame that leaves may not read what was
    materialized inside; one that came in is not touched. Gives what it will drop: as ``scope`` of
    ``materialize`` in a step inside that one, it keeps a frame until this one ends. Without the first, scratch stays for the life of the
    checkpoint folder, and shuffle files until the driver happens to collect its garbage.
    """
    # What the session's owner has set stays.
    settings = {name: value for name, value in _LEAN.items() if spark.conf.get(name, None) is None}
    mine: list[str] = []
    token = _DROPPED.set(mine)
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield mine
    finally:
        _DROPPED.reset(token)
        for name in settings:
            spark.conf.unset(name)
        for path in mine:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def slices(rows: int, *keys: Column | str) -> list[Column]:
    """Conditions that deal so many rows by a hash of their keys; each row, null keys too, meets exactly one.

    Wide rows that are shuffled slice by slice take a slice's room at a time. The number is bounded, as each
    slice is one more pass over the rows.
    """
    n = min(SLICES, math.ceil(rows / SLICE_ROWS))
    if n <= 1:
        return [F.lit(True)]
    return [F.pmod(F.xxhash64(*keys), F.lit(n)) == i for i in range(n)]


#: Rows that go to a Python worker at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(
    df: DataFrame | Sequence[DataFrame],
    label: str,
    *,
    batch_rows: int | None = None,
    scope: list[str] | None = None,
) -> DataFrame:
    """Write the frame to shared scratch and read it back: cuts lineage, survives executors.

    Several frames of one schema are written one after another, and read back as one.

    ``batch_rows`` is set where rows are large: so many go to Python at once while it is written, as executors
    hold whole batches beside their heap.
    """
    frames = [df] if isinstance(df, DataFrame) else list(df)
    spark = frames[0].sparkSession
    path = scratch_dir(spark, label)
    dropped = _DROPPED.get() if scope is None else scope
    if dropped is not None:
        dropped.append(path)
    usual = spark.conf.get(BATCH_ROWS)
    if batch_rows is not None:
        spark.conf.set(BATCH_ROWS, batch_rows)
    try:
        for i, frame in enumerate(frames):
            frame.write.mode("append" if i else "errorifexists").parquet(path)
    finally:
        if batch_rows is not None:
            spark.conf.set(BATCH_ROWS, usual)
    return spark.read.schema(frames[0].schema).parquet(path)


def _row_bytes(schema: T.StructType):
    size = F.lit(8 * len(schema.fields))
    for field in schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return size


def fits_broadcast(
    df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES
) -> bool:
    """Measure whether the frame is within both bounds.

    ``take`` reads partition after partition until it has ``rows + 1`` row sizes, so a large
    frame is turned down after its first few partitions.
    """
    sizes = df.select(_row_bytes(df.schema).cast("long").alias("b")).take(rows + 1)
    return len(sizes) <= rows and sum(r.b for r in sizes) <= size


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the hot keys, and into how many ordered chunks their rows should be cut."""

    hashes: tuple[int, ...] = ()
    chunks: int = 0

    def __bool__(self) -> bool:
        return bool(self.hashes)


def find_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    *,
    hot_rows: int = HOT_ROWS,
    most: int = HOT_KEYS,
) -> HotKeys:
    """One scan of the key columns into a mergeable top-k sketch. A null key counts as a key.

    A chunk holds ``hot_rows`` rows whatever the input; the number of chunks grows with it.
    """
    row = df.select(F.xxhash64(*keys).alias("h")).agg(
        F.expr(f"approx_top_k(h, {most}, {max(10_000, 10 * most)})").alias("top"),
    ).first()
    hot = [item for item in (row.top or []) if item["count"] > hot_rows]
    chunks = sum(math.ceil(item["count"] / hot_rows) for item in hot)
    return HotKeys(tuple(item["item"] for item in hot), chunks)


def split_hot(df: DataFrame, keys: Sequence[str], hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of hot keys)."""
    spark = df.sparkSession
    listed = spark.createDataFrame([(h,) for h in hot.hashes], "_hot long")
    # At most 10,000 hashes, see find_hot_keys.
    listed = F.broadcast(listed)
    on = F.xxhash64(*keys) == F.col("_hot")
    return df.join(listed, on, "left_anti"), df.join(listed, on, "left_semi")


def ordered_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunks: int
) -> DataFrame:
    """Cut rows into ranges of (keys, order), so that one key can span many tasks.

    Adds ``_chunk``: chunks ascend along each key. The result is written once, which fixes
    the cuts for every later use of the frame.
    """
    ranged = df.repartitionByRange(max(2, chunks), *keys, *order)
    return materialize(ranged.withColumn("_chunk", F.spark_partition_id()), "chunks")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    *,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the same keys up to this one, in order.

    ``order`` tells the rows of a key apart. Rows of hot keys are cut into ordered chunks; what
    the chunks before one add up to is one row per (key, chunk).
    """
    if hot is None:
        hot = find_hot_keys(df, keys)

    def inside(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
        window = Window.partitionBy(*parts).orderBy(*order)
        so_far = F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return rows.withColumn(name, so_far)

    if not hot:
        return inside(df, keys)
    cold, busy = split_hot(df, keys, hot)
    rows = ordered_chunks(busy, keys, order, hot.chunks)
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_total"))
    carried = totals.select(*keys, "_chunk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carried"))
    found = inside(join_edges(rows, carried, keys), [*keys, "_chunk"])
    found = found.withColumn(name, F.col(name) + F.col("_carried")).drop("_chunk", "_carried")
    return inside(cold, keys).unionByName(found)


def next_in_order(
    df: DataFrame, keys: Sequence[str], order: str, name: str, *, hot: HotKeys | None = None
) -> DataFrame:
    """Add the ``order`` value of the next row of the same keys, null for the last one.

    Values are different within a key. Rows of hot keys are cut into ordered chunks; where the next
    chunk of a key begins is one row per (key, chunk).
    """
    if hot is None:
        hot = find_hot_keys(df, keys)

    def inside(rows: DataFrame, parts: Sequence[str]) -> DataFrame:
        return rows.withColumn(name, F.lead(order).over(Window.partitionBy(*parts).orderBy(order)))

    if not hot:
        return inside(df, keys)
    cold, busy = split_hot(df, keys, hot)
    rows = ordered_chunks(busy, keys, [order], hot.chunks)
    along = Window.partitionBy(*keys).orderBy("_chunk")
    firsts = rows.groupBy(*keys, "_chunk").agg(F.min(order).alias("_least"))
    edges = firsts.select(*keys, "_chunk", F.lead("_least").over(along).alias("_after"))
    found = inside(join_edges(rows, edges, keys), [*keys, "_chunk"])
    found = found.withColumn(name, F.coalesce(name, "_after")).drop("_chunk", "_after")
    return inside(cold, keys).unionByName(found)


def join_edges(rows: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with what belongs to their (key, chunk); edges are broadcast where they are measured as small."""
    same = F.lit(True)
    for key in [*keys, "_chunk"]:
        same = same & F.col(f"r.{key}").eqNullSafe(F.col(f"e.{key}"))
    added = [c for c in edges.columns if c not in (*keys, "_chunk")]
    edges = F.broadcast(edges) if fits_broadcast(edges) else edges
    return rows.alias("r").join(edges.alias("e"), same, "left").select("r.*", *(f"e.{c}" for c in added))
