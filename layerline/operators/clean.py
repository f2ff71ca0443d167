"""Latest-row deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerline.functions.hashing import row_hash
from layerline.operators.scale import fits_broadcast, materialize, slices


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep one row per key: the highest by ``order_by``, nulls last.

    Spark plans the rank filter as a group limit on both sides of the shuffle, so a task
    sends at most one row per key however many copies of a key it reads. Rows that tie on
    ``order_by`` are told apart by a hash of the whole row, so that the pick is the same on
    every run; select the columns you need first, or the hash makes the scan read them all.
    """
    if not keys:
        raise ValueError("latest_per_key needs at least one key")
    order = [F.col(c).desc_nulls_last() for c in order_by]
    window = Window.partitionBy(*keys).orderBy(*order, row_hash(df).desc())
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes of keys, ``_h``, that more than one row has: all that are held twice, and chance meetings."""
    counts = df.groupBy(F.xxhash64(*keys).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where("_n > 1").select("_h")


def latest_frames(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> list[DataFrame]:
    """``latest_per_key`` of stored rows, in frames that together hold its rows and share no key.

    Rows are wide and most keys are held once, so the keys' hashes are shuffled first. Where those met again
    are measured as few, only their rows are shuffled. Otherwise all are, in slices by key: one frame
    each, to be written one after another. Reads ``df`` several times.
    """
    again = materialize(_repeated(df, keys), "repeated")
    on = F.xxhash64(*keys) == F.col("_h")
    if again.isEmpty():
        return [df]
    if fits_broadcast(again):
        met = F.broadcast(again)
        copies = latest_per_key(df.join(met, on, "left_semi"), keys, order_by)
        return [df.join(met, on, "left_anti").unionByName(copies)]
    return [latest_per_key(df.where(part), keys, order_by) for part in slices(df.count(), *keys)]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], what: str = "grain") -> None:
    # Hashes are shuffled first, and keys only where a hash was met again.
    again = _repeated(df, keys)
    if again.isEmpty():
        return
    met = df.join(again, F.xxhash64(*keys) == F.col("_h"), "left_semi")
    if not duplicate_keys(met, keys).isEmpty():
        raise ValueError(f"Duplicate {what} ({', '.join(keys)}).")
