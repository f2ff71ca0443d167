"""Histories in two times: when something held, and when that was known.

A row is a rectangle: a key had its values in ``[valid_from, valid_to)``, as known in ``[known_from, known_to)``.
A change says from when on its values hold (its start); what is later in the history stays. Another
change with the same start corrects it, and a withdrawal (``op`` W) takes it out, so that the version before
it holds on. Nothing is overwritten: a change ends what was known of the rectangles it touches and
writes those that are known from then on. Changes of one batch become known at one time.

``record`` folds one batch into the stored rectangles; ``as_known`` reads the history as it was known at a
time. The rows of a key that a batch touches are put in order; keys it does not touch pass through, and
rectangles that are no longer known are never read again. Rows of hot keys are cut into ordered
chunks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.operators.scale import HotKeys, find_hot_keys, fits_broadcast, materialize, next_in_order

WITHDRAWN = "W"
SPAN = ("valid_from", "valid_to", "known_from", "known_to")


@dataclass(frozen=True)
class Bitemporal:
    keys: Sequence[str]
    values: Sequence[str]
    #: When a change starts to hold, and what tells changes of one start and batch apart (the last one counts).
    starts: str
    tie_break: str
    op: str = "op"
    open_end: str = "9999-12-31 23:59:59"


def empty_history(changes: DataFrame, cfg: Bitemporal) -> DataFrame:
    """A history without rows, for changes of this schema."""
    when = changes.schema[cfg.starts].dataType.simpleString()
    spans = [F.lit(None).cast(when).alias(name) for name in SPAN]
    return changes.select(*cfg.keys, *cfg.values, *spans).limit(0)


def _same(keys: Sequence[str], left: str, right: str) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return on


def as_known(history: DataFrame, known_at: Column, holds_at: Column | None = None) -> DataFrame:
    """The versions known at a time; with ``holds_at``, those of them that held then."""
    rows = history.where((F.col("known_from") <= known_at) & (known_at < F.col("known_to")))
    if holds_at is not None:
        rows = rows.where((F.col("valid_from") <= holds_at) & (holds_at < F.col("valid_to")))
    return rows


def record(
    history: DataFrame, changes: DataFrame, cfg: Bitemporal, known_at: Column, hot: HotKeys | None = None
) -> DataFrame:
    """The rectangles after a batch that becomes known at ``known_at``, later than all before it.

    A change that says what is known already, and a withdrawal of a start that is not there, change nothing:
    the batch may be repeated. Changes without a start are left out. Null keys are keys.
    """
    keys, values = list(cfg.keys), list(cfg.values)
    when = history.schema["valid_from"].dataType
    never, now = F.lit(cfg.open_end).cast(when), known_at.cast(when)
    dated = changes.where(F.col(cfg.starts).isNotNull())
    # Folded map-side: the last change of each key and start.
    picked = F.max_by(F.struct(*values, (F.coalesce(F.col(cfg.op) == WITHDRAWN, F.lit(False))).alias("_out")), cfg.tie_break)
    batch = dated.groupBy(*keys, F.col(cfg.starts).cast(when).alias("valid_from")).agg(picked.alias("_new"))
    batch = materialize(batch, "bitemporal-batch")
    touched = batch.select(*keys).distinct()
    touched = F.broadcast(touched) if fits_broadcast(touched) else touched

    current = history.where(F.col("known_to") == never)
    past = history.where(F.col("known_to") != never)
    mine = current.alias("h").join(touched.alias("t"), _same(keys, "h", "t"), "left_semi")
    others = current.alias("h").join(touched.alias("t"), _same(keys, "h", "t"), "left_anti")
    mine = materialize(mine, "bitemporal-current")

    # The starts that are known after the batch, in order: each version ends where the next one starts.
    both = mine.alias("h").join(batch.alias("b"), _same([*keys, "valid_from"], "h", "b"), "full_outer")
    old_there, new_there = F.col("h.known_from").isNotNull(), F.col("b._new").isNotNull()
    # A withdrawal is no correction: it ends a version, or nothing.
    points = both.where(~F.coalesce(F.col("b._new._out"), F.lit(False))).select(
        *(F.when(old_there, F.col(f"h.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in [*keys, "valid_from"]),
        *(F.when(new_there, F.col(f"b._new.{v}")).otherwise(F.col(f"h.{v}")).alias(v) for v in values),
    )
    points = materialize(points, "bitemporal-points")
    if hot is None:
        hot = find_hot_keys(points, keys)
    chain = next_in_order(points, keys, "valid_from", "_next", hot=hot)
    fresh = chain.withColumn("valid_to", F.coalesce("_next", never)).drop("_next")

    # Versions that are as they were stay as they were known; the others end, and what is new starts now.
    equal = _same([*keys, "valid_from", "valid_to", *values], "h", "f")
    matched = mine.withColumn("_old", F.lit(True)).alias("h").join(
        fresh.withColumn("_fresh", F.lit(True)).alias("f"), equal, "full_outer"
    )
    kept, opened = F.col("h._old").isNotNull(), F.col("h._old").isNull()
    columns = [*keys, *values, "valid_from", "valid_to"]
    held = matched.where(kept).select(
        *(F.col(f"h.{c}").alias(c) for c in [*columns, "known_from"]),
        F.when(F.col("f._fresh").isNull(), now).otherwise(never).alias("known_to"),
    )
    started = matched.where(opened).select(
        *(F.col(f"f.{c}").alias(c) for c in columns), now.alias("known_from"), never.alias("known_to")
    )
    return past.unionByName(others).unionByName(held).unionByName(started)
