"""Tree differences against the plain ones, and payloads that do not parse."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerline.operators.diff import keyed_diff, multiset_diff
from layerline.operators.digest import differing_rows, digest, reconcile_rows, tree_keyed_diff, tree_multiset_diff
from layerline.plans.bronze import RawSources, ingest_batch
from layerline.plans.control import BatchControl
from layerline.plans.stand_in import raw_sources, tables
from layerline.sources.readers import PAYLOAD, PROBLEM, checked_payload, split_payload
from layerline.sources.tables import TableStore

DDL = "k int, a string, b string, xs array<int>"


def table(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


def content(df):
    return sorted(map(str, df.collect()))


def test_finds_what_the_plain_differences_find(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice("xyz"), rng.choice(["p", None]), rng.choice([[1, None], [None, 1], None])) for k in range(3_000)]
    other = list(rows)
    for k in (7, 70, 700):
        other[k] = (k, "changed", other[k][2], other[k][3])
    other[9] = (9, other[9][2], other[9][1], other[9][3])  # a null that changes places
    other[11] = (11, *other[11][1:3], [None, 1] if other[11][3] == [1, None] else [1, None])
    other = other[:2_990] + [(5_000, "new", None, None), (None, "null key", None, None)]
    left, right = table(spark, rows), table(spark, other)
    for levels in ({}, {"level_bits": 3, "leaf_rows": 4}):
        assert content(tree_keyed_diff(left, right, ["k"], **levels)) == content(keyed_diff(left, right, ["k"]))
        twice = left.unionAll(left.where("k < 3"))
        assert content(tree_multiset_diff(twice, right, ["k"], **levels)) == content(multiset_diff(twice, right))
    same = reconcile_rows({"t": (left, left.orderBy(F.desc("a")), ["k"])})
    assert same.columns == ["entity", "natural_key", "change"] and same.isEmpty()


def test_few_rows_meet_where_few_differ(spark):
    left = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    changed = F.when(F.col("k").isin(5, 77_777, 123_456), F.col("v") + 1).otherwise(F.col("v"))
    a, b = differing_rows(left, left.withColumn("v", changed), ["k"])
    assert a.count() == b.count() <= 3 * 4
    assert tree_keyed_diff(left, left.withColumn("v", changed), ["k"]).count() == 3


def test_when_most_differs_and_when_nothing_is_there(spark):
    left, none = table(spark, [(k, "a", None, None) for k in range(500)]), table(spark, [])
    assert tree_keyed_diff(left, left.withColumn("a", F.lit("b")), ["k"]).count() == 500
    assert {r._change for r in tree_keyed_diff(left, none, ["k"]).collect()} == {"removed"}
    assert tree_keyed_diff(none, none, ["k"]).isEmpty()
    with pytest.raises(ValueError):
        tree_keyed_diff(left, left.drop("a"), ["k"])


def test_digests_of_parts_add_up(spark):
    df = table(spark, [(k % 50, str(k), None, None) for k in range(300)])
    parts = digest(df.where("k < 20"), ["k"], 4).unionAll(digest(df.where("k >= 20"), ["k"], 4))
    added = parts.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.sum("first").alias("first"), F.sum("second").alias("second"))
    assert content(added) == content(digest(df.repartition(7), ["k"], 4))


PAYLOADS = [
    ('{"k": 1, "d": "2.50", "t": "2024-01-01 00:00:00"}', None),
    ('{"k": null}', None),
    ("{}", None),
    ('{"k": 1, "more": {"x": []}}', None),
    (None, "missing"),
    ("", "missing"),
    (" \n", "missing"),
    ('{"k": 1', "not json"),
    ("k=1", "not json"),
    ("[1]", "not an object"),
    ('[{"k": 1}]', "not an object"),
    ('"text"', "not an object"),
    ("null", "not an object"),
    ('{"k": "x"}', "wrong type"),
    ('{"k": 1.5}', "wrong type"),
    ('{"k": 1, "d": "much"}', "wrong type"),
]


def test_payloads_are_told_apart(spark):
    schema = T.StructType.fromDDL("k int, d decimal(18,2), t timestamp")
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(PAYLOADS)], "i int, p string")
    checked = checked_payload(df, "p", schema, carry=["i"])
    assert {r.i: r[PROBLEM] for r in checked.collect()} == {i: why for i, (_, why) in enumerate(PAYLOADS)}
    good, bad = split_payload(checked, carry=["i"])
    assert good.count() + bad.count() == len(PAYLOADS)
    assert good.columns == ["i", "k", "d", "t", PAYLOAD]
    assert checked_payload(df.limit(0), "p", schema).isEmpty()


def test_bronze_holds_what_does_not_parse(spark, folder, tmp_path):
    raw = raw_sources(tables(spark, folder))
    broken = spark.createDataFrame([('{"chave_acesso": ',), (None,)], "payload string")
    events = raw.change_log.limit(1).withColumn("payload_json", F.lit("oops"))
    dirty = RawSources(raw.headers, raw.items.unionByName(broken), raw.change_log.unionByName(events), raw.issuers, raw.issuer_change_ts)
    store = TableStore(spark, str(tmp_path))
    result = ingest_batch(store, BatchControl(store), dirty, "b1")
    assert result.items.rows_inserted == raw.items.count()
    table = store.table("silver", "quarantine_nfe")
    assert sorted((r.source_table, r.failed_expectations) for r in table.read().collect()) == [
        ("source.nfe_evento", '["payload: not json"]'),
        ("source.nfe_item", '["payload: missing"]'),
        ("source.nfe_item", '["payload: not json"]'),
    ]
    version = table.version
    assert ingest_batch(store, BatchControl(store), dirty, "b2").rows_written == 0
    assert table.version == version
