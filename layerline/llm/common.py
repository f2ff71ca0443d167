"""What several operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word, as every contract here has it.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(column: Column) -> Column:
    """A to Z only, unlike ``lower``."""
    return F.translate(column, UPPER, LOWER)


def remainder(key: Column, divisor: int) -> Column:
    """crc32 of the key as text, modulo the divisor; null for a null key."""
    return F.crc32(key.cast("string")) % divisor


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: itself if it can be seen, else the next free."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(seen))
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TwoAges:
    """A bounded cache: when the young half is full it becomes the old one, which is forgotten.

    What is in use moves back to the young half. Read ``young`` first, then ``older``.
    """

    def __init__(self, limit: int) -> None:
        self._limit = limit
        self.young: dict = {}
        self._old: dict = {}

    def older(self, key: object) -> object:
        return self._old.get(key)

    def shrink(self, size: int) -> None:
        """Keep the ``size`` oldest entries of the young half, which are the ones met first: the common ones."""
        if len(self.young) > size:
            kept = list(islice(self.young.items(), size))
            self.young.clear()
            self.young.update(kept)
        self._old = {}

    def add(self, key: object, value: object) -> None:
        if len(self.young) >= self._limit:
            self._old = dict(self.young)
            self.young.clear()  # the same dict, so that bound methods stay good
        self.young[key] = value


def per_worker(key: Hashable, build: Callable[[], object]) -> object:
    """What ``build`` gives, made once for each Python worker process.

    Spark reuses its workers, so tables that are costly to fill serve one task after another. What is
    built must not carry results from one task to the next, and must be bounded: a worker that waits takes
    memory from whatever its executor does meanwhile, so caches shrink at the end of a task.
    """
    name = "_layerline_worker"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]
