"""Reconciliation and invariant checks over the published layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerline.functions.text import digits_only
from layerline.operators.scd2 import broken_chains, not_one_current
from layerline.plans.contracts import ISSUER_KEY, ITEM_KEY, PRODUCT_KEY
from layerline.sources.tables import TableStore


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def reconcile(entities: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(entity, bronze_count, silver_count) for each entity whose layers differ in size."""
    counted = [
        bronze.select(F.lit(entity).alias("entity"), F.lit(1).alias("b"), F.lit(0).alias("s"))
        .unionAll(silver.select(F.lit(entity), F.lit(0), F.lit(1)))
        for entity, (bronze, silver) in entities.items()
    ]
    # Partial counts are taken where the rows lie; one row per task and entity is shuffled.
    return (
        reduce(DataFrame.unionAll, counted)
        .groupBy("entity")
        .agg(F.sum("b").alias("bronze_count"), F.sum("s").alias("silver_count"))
        .filter("bronze_count <> silver_count")
    )


def current_version_violations(dims: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(dimension, natural_key) of every key without exactly one current version."""
    found = [
        not_one_current(dim, keys).select(
            F.lit(name).alias("dimension"), F.concat_ws(":", *keys).alias("natural_key")
        )
        for name, (dim, keys) in dims.items()
    ]
    return reduce(DataFrame.unionAll, found)


def invariants(dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(invariant, violations) for one dimension."""
    one_current = not_one_current(dim, keys).agg(F.count(F.lit(1)).alias("violations"))
    chains = broken_chains(dim, keys).agg(F.count(F.lit(1)).alias("violations"))
    return one_current.select(F.lit("one_current").alias("invariant"), "violations").unionAll(
        chains.select(F.lit("no_gap_no_overlap"), "violations")
    )


def verification(store: TableStore) -> DataFrame:
    """(check, passed), one row each."""

    def table(layer: str, name: str) -> DataFrame:
        return store.table(layer, name).read()

    def filled(label: str, df: DataFrame) -> DataFrame:
        return row_count(df, "n").select(F.lit(label).alias("check"), (F.col("n") > 0).alias("passed"))

    # A bronze item is either in silver or in quarantine.
    held = table("silver", "nfe_item").select(F.concat_ws(":", *ITEM_KEY).alias("natural_key"))
    quarantine = store.table("silver", "quarantine_nfe")
    if quarantine.exists():
        rejected = quarantine.read().filter("source_table = 'bronze.nfe_item_raw'")
        held = held.unionAll(rejected.select("natural_key"))
    raw = digits_only(table("bronze", "nfe_item_raw").select(*ITEM_KEY), "chave_acesso")
    arrived = raw.select(F.concat_ws(":", *ITEM_KEY).alias("natural_key"))
    lost = row_count(arrived.join(held, "natural_key", "left_anti"), "n")
    currents = not_one_current(table("gold", "dim_emitente"), ISSUER_KEY)
    products = not_one_current(table("gold", "dim_produto"), PRODUCT_KEY)

    def none(label: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(label), F.col("n") == 0)

    return reduce(
        DataFrame.unionAll,
        [
            filled("bronze headers exist", table("bronze", "nfe_cab_raw")),
            filled("silver headers exist", table("silver", "nfe_header")),
            none("silver items reconcile", lost),
            filled("gold fact exists", table("gold", "fct_nfe_item")),
            none("one current issuer version", row_count(currents, "n")),
            none("one current product version", row_count(products, "n")),
        ],
    )


def verify(store: TableStore) -> list[str]:
    """Raise if a check fails; returns the names of the checks that passed."""
    rows = verification(store).collect()
    failed = [r.check for r in rows if not r.passed]
    if failed:
        raise RuntimeError(f"Verification failed: {', '.join(failed)}.")
    return [r.check for r in rows]
