"""Change hashes, surrogate keys and row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Stored hashes depend on them.
NULL_MARK = "∅"
SEPARATOR = "␟"

_LONG_MAX = 2**63 - 1


def change_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns as text. A null and a literal null mark hash alike."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def surrogate_key(columns: Sequence[str]) -> Column:
    """Non-negative 64-bit key; clamped first, because abs(Long.MIN) raises under ANSI."""
    return F.abs(F.greatest(F.xxhash64(*columns), F.lit(-_LONG_MAX)))


def row_hash(df: DataFrame) -> Column:
    """A stable tie-break over all hashable columns, so that a retried task picks the same row."""
    return F.xxhash64(*[f.name for f in df.schema.fields if _hashable(f.dataType)])


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))
