"""What is kept on disk: scratch and shuffle files of wide rows go when they have been used."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerline.operators import clean, scale
from layerline.operators.asof import Take, as_of_join
from layerline.operators.clean import latest_frames, latest_per_key, require_unique
from layerline.operators.incremental import MaintainedAggregate, Measures
from layerline.operators.quality import Expectation, apply_expectations
from layerline.operators.scale import HotKeys, lean_disk, materialize, slices
from layerline.plans.medallion import run_medallion
from layerline.plans.silver import clean_items
from layerline.plans.stand_in import raw_sources, tables
from layerline.sources.tables import TableStore

CODEC = "spark.sql.parquet.compression.codec"
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def scratch(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir")) / "layerline"
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_what_is_materialized_inside_is_dropped(spark):
    outside = materialize(spark.range(3), "outside")
    before = scratch(spark)
    with lean_disk(spark):
        outer = materialize(spark.range(5), "outer")
        with lean_disk(spark):
            inner = materialize([spark.range(2), spark.range(2, 4)], "inner")
            assert rows(inner) == [(0,), (1,), (2,), (3,)]
            assert (spark.conf.get(CODEC), spark.conf.get(CLEAN)) == ("zstd", "true")
        # The inner one's folder is gone, the outer one's settings and rows are there.
        assert len(scratch(spark) - before) == 1
        assert spark.conf.get(CODEC) == "zstd"
        assert outer.count() == 5
    assert scratch(spark) == before
    assert (spark.conf.get(CODEC), spark.conf.get(CLEAN)) == ("snappy", "false")
    assert outside.count() == 3


def test_a_setting_of_the_session_stays_and_a_failure_cleans_up(spark):
    before = scratch(spark)
    spark.conf.set(CODEC, "gzip")
    try:
        with pytest.raises(RuntimeError), lean_disk(spark):
            materialize(spark.range(3), "lost")
            assert spark.conf.get(CODEC) == "gzip"
            raise RuntimeError("lost")
        assert spark.conf.get(CODEC) == "gzip"
    finally:
        spark.conf.unset(CODEC)
    assert scratch(spark) == before


def test_a_medallion_run_leaves_its_tables_alone(spark, folder, tmp_path):
    raw = raw_sources(tables(spark, folder))
    before = scratch(spark)
    run_medallion(TableStore(spark, str(tmp_path)), raw, "b1")
    assert scratch(spark) == before


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100])
def test_slices_deal_each_row_once(spark, monkeypatch, n):
    monkeypatch.setattr(scale, "SLICE_ROWS", 1)
    df = spark.range(200).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("k"), F.lit("x").alias("v"))
    parts = slices(n, "k", "v")
    assert len(parts) == max(1, min(n, scale.SLICES))
    dealt = [r for part in parts for r in rows(df.where(part))]
    assert sorted(dealt, key=repr) == rows(df)


COPIES = [(1, "a", 1), (1, "a", 2), (2, None, 1), (2, None, 3), (None, None, 5), (None, None, 4), (1, None, 1), (3, "c", 0)]


@pytest.mark.parametrize("few", [True, False])
def test_latest_frames_are_the_latest_rows(spark, monkeypatch, few):
    df = spark.createDataFrame(COPIES, "k int, l string, o int")
    expected = rows(latest_per_key(df, ["k", "l"], ["o"]))
    if not few:
        monkeypatch.setattr(clean, "fits_broadcast", lambda *_: False)
        monkeypatch.setattr(scale, "SLICE_ROWS", 3)
    frames = latest_frames(df, ["k", "l"], ["o"])
    assert len(frames) == (1 if few else 3)
    assert sorted((r for f in frames for r in rows(f)), key=repr) == expected


def test_rows_of_keys_held_once_are_not_shuffled(spark):
    df = materialize(spark.range(100).withColumn("v", F.lit("x")), "once")
    (frame,) = latest_frames(df, ["id"], ["v"])
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    assert frame.count() == 100


def test_require_unique_sees_null_keys_twice(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, "a")], "k int, l string")
    require_unique(df, ["k", "l"])
    with pytest.raises(ValueError):
        require_unique(df.unionAll(df.limit(1)), ["k", "l"])


def test_items_that_are_one_when_spelt_alike_are_copies(spark):
    raw = spark.createDataFrame(
        [("12-3", 1, 5), ("123", 1, 7), ("1.23", 2, 1), ("9", 1, 1)], "chave_acesso string, num_item int, _ingest_ts int"
    ).withColumns({"cnpj_emitente": F.lit("1/2"), "ncm": F.lit("8471.30"), "cest": F.lit(None).cast("string")})
    found = [r for f in clean_items(raw) for r in rows(f.select("chave_acesso", "num_item", "_ingest_ts", "cnpj_emitente"))]
    assert sorted(found) == [("123", 1, 7, "12"), ("123", 2, 1, "12"), ("9", 1, 1, "12")]


def test_facts_read_once_resolve_as_facts_written_do(spark):
    facts = spark.createDataFrame(
        [(n, None if n % 3 == 0 else n % 5, n) for n in range(60)], "n int, k int, ts int"
    )
    dim = spark.createDataFrame([(k, a, a + 9, f"{k}{a}") for k in range(4) for a in (0, 20, 29)], "k int, valid_from int, valid_to int, v string")
    names = {"on": {"k": "k"}, "event_ts": "ts", "take": {"v": Take("v", "none")}, "grain": ["n"], "allow_broadcast": False}
    before = scratch(spark)
    once = as_of_join(facts, dim, **names, write_once=True, hot=HotKeys())
    assert not {p for p in scratch(spark) - before if p.startswith("facts")}
    assert rows(once) == rows(as_of_join(facts, dim, **names))
    assert rows(once) == rows(as_of_join(facts, dim, **names, write_once=True))


def test_an_aggregate_in_slices_is_the_same_and_leaves_no_scratch(spark, monkeypatch, tmp_path):
    facts = spark.range(300).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 5).cast("string").alias("month"),
        (F.col("id") % 3).alias("kind"),
        F.when(F.col("id") % 13 > 0, F.col("id") % 40).alias("invoice"),
        F.col("id").cast("decimal(18,2)").alias("value"),
    )
    measures = Measures(("month", "kind"), "month", sums={"net": F.col("value")}, distinct={"n": F.col("invoice")})
    found = []
    before = scratch(spark)
    for limit in (10_000, 20):
        monkeypatch.setattr(scale, "SLICE_ROWS", limit)
        state = MaintainedAggregate(spark, str(tmp_path / str(limit)), measures, facts)
        state.create(facts.where("value < 200"))
        touched = state.apply(facts.where("value < 50"), facts.where("value >= 200"), "b2")
        found.append((touched, rows(state.read())))
    assert scratch(spark) == before
    assert found[0] == found[1]
    whole = facts.where("value >= 50").groupBy("month", "kind").agg(F.sum("value"), F.countDistinct("invoice"))
    assert found[0][1] == rows(whole)


def test_frames_are_merged_as_one(spark, tmp_path):
    df = spark.createDataFrame([(k, k % 4, "new") for k in range(20)] + [(3, 9, "last")], "k int, o int, v string")
    old = spark.createDataFrame([(k, 0, "old") for k in range(5)], "k int, o int, v string")
    names = {"keys": ["k"], "order_by": ["o"], "batch_id": "b", "stage": "s"}
    found = []
    for i, source in enumerate((df, [df.where("k % 2 = 0"), df.where("k % 2 = 1")])):
        for target in (None, old):
            for stored in (False, True):
                table = TableStore(spark, str(tmp_path / f"{i}{target is old}{stored}")).table("silver", "t")
                if target is not None:
                    table.append(target, batch_id="a", stage="s")
                merged = table.merge(source, **names, stored=stored)
                found.append((target is old, merged.rows_inserted, merged.rows_updated, rows(table.read())))
    assert all(f == found[0] for f in found if not f[0]) and found[0][1:3] == (20, 0)
    assert all(f == found[2] for f in found if f[0]) and found[2][1:3] == (15, 5)


def test_frames_are_checked_as_one(spark):
    rule = Expectation("small", F.col("id") < 4, "drop")
    passing, rejected, results = apply_expectations([spark.range(3), spark.range(3, 6)], [rule], write_once=True)
    assert (passing.count(), rejected.count(), results[0].rows_evaluated, results[0].rows_failed) == (4, 2, 6, 2)
    with pytest.raises(ValueError):
        apply_expectations([spark.range(3), spark.range(3, 6)], [rule])
