"""Rule metrics that merge over batches without reading rows again.

A row that fails two rules, or comes again in a later batch, is one row: what is kept of a batch is a theta
sketch of the natural keys it held, and one of those that failed each rule. Unions of sketches give the
number of different keys over any batches. Counts are exact up to ``2 ** lg_size`` keys; beyond that the
standard error is ``1 / sqrt(2 ** lg_size)``, 0.4 % at 16.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerline.operators.quality import RuleSet

LG_SIZE = 16
#: The name under which a batch keeps all its keys, and those that fail any drop rule.
ALL_ROWS, DROPPED = "*", "* drop"


def rule_sketches(df: DataFrame, rules: RuleSet, key: Column, batch: str, *, lg_size: int = LG_SIZE) -> DataFrame:
    """(batch_id, name, severity, rows_evaluated, rows_failed, keys) for each rule, by one aggregate over one scan.

    ``keys`` is a sketch of the keys that fail. Two rows more: ``*`` for all rows and ``* drop`` for those that
    fail any drop rule. Rows without a key are counted as rows and not as keys.
    """
    ordered = list(rules)
    whole = [(ALL_ROWS, None, F.lit(True)), (DROPPED, "drop", rules.any_failed("drop"))]
    marked = df.select(
        key.cast("string").alias("_key"), *(c.alias(f"_f{i}") for i, (_, _, c) in enumerate(whole)),
        *(r.failed.alias(f"_f{i + len(whole)}") for i, r in enumerate(ordered)),
    )
    names = [(n, s) for n, s, _ in whole] + [(r.name, r.severity) for r in ordered]
    counts = marked.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(f"_f{i}").alias(f"n{i}") for i in range(len(names))),
        *(F.theta_sketch_agg(F.when(F.col(f"_f{i}"), F.col("_key")), lg_size).alias(f"k{i}") for i in range(len(names))),
    )
    rows = F.array(
        *(
            F.struct(
                F.lit(batch).alias("batch_id"),
                F.lit(name).alias("name"),
                F.lit(severity).cast("string").alias("severity"),
                F.col("n").alias("rows_evaluated"),
                F.col(f"n{i}").alias("rows_failed"),
                F.col(f"k{i}").alias("keys"),
            )
            for i, (name, severity) in enumerate(names)
        )
    )
    return counts.select(F.inline(rows))


def merged_metrics(kept: DataFrame, *, lg_size: int = LG_SIZE) -> DataFrame:
    """(name, severity, rows_evaluated, rows_failed, keys_failed, keys_evaluated, key_pass_rate) over kept batches.

    A batch that was kept twice under its name counts once. Without keys the rate is 1.
    """
    once = kept.groupBy("batch_id", "name", "severity").agg(
        F.max("rows_evaluated").alias("rows_evaluated"),
        F.max("rows_failed").alias("rows_failed"),
        F.theta_union_agg("keys", lg_size).alias("keys"),
    )
    union = once.groupBy("name", "severity").agg(
        F.sum("rows_evaluated").alias("rows_evaluated"),
        F.sum("rows_failed").alias("rows_failed"),
        F.theta_sketch_estimate(F.theta_union_agg("keys", lg_size)).alias("keys_failed"),
    )
    # One row.
    total = union.where(F.col("name") == ALL_ROWS).select(F.col("keys_failed").alias("keys_evaluated"))
    rate = 1 - F.coalesce(F.try_divide(F.col("keys_failed").cast("double"), F.col("keys_evaluated")), F.lit(0.0))
    rules = union.where(F.col("name") != ALL_ROWS).crossJoin(F.broadcast(total))
    return rules.withColumn("key_pass_rate", F.greatest(rate, F.lit(0.0)))
