"""Differences of two large tables by a tree of digests, exact where they differ.

Rows fall into buckets by the first bits of their keys' hash. A bucket's digest is its number of rows and
two sums of 64-bit row hashes: it does not depend on order, counts copies, and can be added up. A level
takes the digests of both sides in one aggregate, one row a bucket and task; the next level looks with
more bits, and only at the rows of buckets that differ. The rows of the last differing buckets, some
``LEAF_ROWS`` each, are compared for what they are. So tables are scanned once a level, and what is shuffled
grows with the difference. Different buckets with equal digests have a chance of 2^-128.

Where so many buckets differ that their list may not be broadcast, the levels end and the rows so far
left are compared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerline.operators.diff import keyed_diff, multiset_diff
from layerline.operators.scale import fits_broadcast, materialize

#: Bits of a level, and rows that a bucket of the last level has in the mean.
LEVEL_BITS = 10
LEAF_ROWS = 64
_BUCKET = "_bucket"


def _hash(df: DataFrame, columns: Sequence[str], salt: int) -> Column:
    """Of values and of which are null, so that a null may not change places with its neighbour."""
    values, nulls = [], []
    for name in columns:
        kind = df.schema[name].dataType
        nested = isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType))
        values.append(F.to_json(F.struct(name), {"ignoreNullFields": "false"}) if nested else F.col(name))
        nulls.append(F.when(F.col(name).isNull(), "0").otherwise("1"))
    return F.xxhash64(F.lit(salt), *values, F.concat(*nulls) if nulls else F.lit(""))


def digest(df: DataFrame, keys: Sequence[str], bits: int, columns: Sequence[str] | None = None) -> DataFrame:
    """(bucket, rows, first, second) of each bucket that has rows; digests of parts of a table add up."""
    return _digest(_hashed(df, keys, columns or df.columns), bits, F.lit(1).cast("long")).drop("_seen")


def _hashed(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {"_key": _hash(df, keys, 0), "_first": _hash(df, sorted(columns), 1), "_second": _hash(df, sorted(columns), 2)}
    )


def _digest(hashed: DataFrame, bits: int, sign: Column) -> DataFrame:
    # Decimals hold the sums of any number of 64-bit hashes.
    def added(name: str) -> Column:
        return F.sum(F.col(name).cast("decimal(20,0)") * sign.cast("decimal(2,0)")).cast("decimal(38,0)")

    bucket = F.shiftrightunsigned("_key", 64 - bits).alias("bucket")
    return hashed.groupBy(bucket).agg(
        F.sum(sign).alias("rows"),
        added("_first").alias("first"),
        added("_second").alias("second"),
        F.count(F.lit(1)).alias("_seen"),
    )


def differing_rows(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    level_bits: int = LEVEL_BITS,
    leaf_rows: int = LEAF_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides in buckets that differ: all differing rows, and some beside them.

    Columns are compared by name, and must be the same with the same types. Null keys are keys; copies count.
    """
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError("both sides must have the same columns and types")
    columns = left.columns
    sides = [_hashed(side.select(*columns), keys, columns) for side in (left, right)]
    both = sides[0].withColumn("_sign", F.lit(1).cast("long")).unionAll(sides[1].withColumn("_sign", F.lit(-1).cast("long")))
    inside, rows, bits = both, None, 0
    while rows is None or (bits < 60 and rows > leaf_rows << bits):
        bits += level_bits
        found = _digest(inside, bits, F.col("_sign"))
        found = found.withColumn("differs", (F.col("rows") != 0) | (F.col("first") != 0) | (F.col("second") != 0))
        # At most 2^bits rows of the first level, and as many for each differing bucket of the one before.
        found = materialize(found, "digest")
        if rows is None:
            rows = found.agg(F.sum("_seen")).first()[0] or 0
        differing = found.where("differs").select("bucket")
        if not fits_broadcast(differing):
            break
        listed = F.broadcast(differing)
        inside = both.join(listed, F.shiftrightunsigned("_key", 64 - bits) == F.col("bucket"), "left_semi")
        if differing.isEmpty():
            break
    return tuple(inside.where(F.col("_sign") == sign).select(*columns) for sign in (1, -1))


def tree_multiset_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], **levels: int) -> DataFrame:
    """``multiset_diff`` of what differs: distinct rows with ``_copies`` (after minus before)."""
    return multiset_diff(*differing_rows(before, after, keys, **levels))


def tree_keyed_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], **levels: int) -> DataFrame:
    """``keyed_diff`` of what differs: key and ``_change``; keys are unique."""
    return keyed_diff(*differing_rows(before, after, keys, **levels), keys)


def reconcile_rows(entities: Mapping[str, tuple[DataFrame, DataFrame, Sequence[str]]]) -> DataFrame:
    """(entity, natural_key, change) of every key that two layers hold differently."""
    found = [
        tree_keyed_diff(first, second, keys).select(
            F.lit(entity).alias("entity"),
            F.concat_ws(":", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)).alias("natural_key"),
            F.col("_change").alias("change"),
        )
        for entity, (first, second, keys) in entities.items()
    ]
    return reduce(DataFrame.unionAll, found)
