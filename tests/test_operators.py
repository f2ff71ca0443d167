from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerline.operators.clean import duplicate_keys, latest_per_key, require_unique
from layerline.operators.contracts import conform, drift_kind, schema_findings
from layerline.operators.diff import diff_counts, keyed_diff
from layerline.operators.merge import ACTION, merge_changes, merge_counts, merge_frames
from layerline.operators.quality import (
    DataQualityGateError,
    DuplicateExpectationError,
    Expectation,
    RuleSet,
    apply_expectations,
    mark_reprocessed,
    quarantine_rows,
    rule_metrics,
    summarize,
    summary,
)
from layerline.operators.scale import find_hot_keys, fits_broadcast, split_hot


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, None, "b"), (1, 7, "c"), (None, 1, "d"), (None, 2, "e"), (2, None, "f")],
        "k int, o int, v string",
    )
    assert rows(latest_per_key(df, ["k"], ["o"])) == [(1, 7, "c"), (2, None, "f"), (None, 2, "e")]


def test_ties_are_broken_the_same_way_whatever_the_layout(spark):
    df = spark.createDataFrame([(1, 1, c) for c in "abcdefgh"], "k int, o int, v string")
    picks = {
        latest_per_key(df.repartition(n, "v"), ["k"], ["o"]).first().v for n in (1, 2, 3, 7)
    }
    assert len(picks) == 1


def test_latest_per_key_prunes_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    latest_per_key(df, ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]
    with pytest.raises(ValueError, match="Duplicate fact grain"):
        require_unique(df, ["a", "b"], "fact grain")
    require_unique(df.distinct(), ["a", "b"])


# -- quality --------------------------------------------------------------------------------


@pytest.mark.parametrize("write_once", [False, True])
def test_quality_split(spark, write_once):
    df = spark.createDataFrame([(1, 10), (2, -1), (3, 0), (4, None)], "id int, amount int")
    passing, rejected, results = apply_expectations(
        df,
        [
            Expectation("positive", F.col("amount") > 0, "drop"),
            Expectation("large", F.col("amount") >= 10, "warn"),
            Expectation("not_negative", F.col("amount") >= 0, "drop"),
        ],
        write_once=write_once,
    )
    assert rows(passing) == [(1, 10, "PASS")]
    failed = {r.id: r._failed_expectations for r in rejected.collect()}
    # A rule that is null has failed.
    assert failed == {2: ["positive", "not_negative"], 3: ["positive"], 4: ["positive", "not_negative"]}
    assert [(r.name, r.rows_failed) for r in results] == [("positive", 3), ("large", 3), ("not_negative", 2)]
    # Rows that fail two drop rules count twice; the rate stays at zero or above.
    assert summarize(results).rows_failed == 5 and summarize(results).pass_rate == 0.0


def test_quality_summary_rate(spark):
    df = spark.createDataFrame([(1, 10), (2, -1), (3, 0)], "id int, amount int")
    rules = RuleSet(
        Expectation("positive", F.col("amount") > 0, "drop"),
        Expectation("large", F.col("amount") >= 10, "warn"),
    )
    _, _, results = apply_expectations(df, rules)
    assert summarize(results).pass_rate == pytest.approx(1 / 3)
    assert summary(rule_metrics(df, rules)).first().pass_rate == pytest.approx(1 / 3)


def test_quality_empty_input(spark):
    empty = spark.createDataFrame([], "id int")
    passing, rejected, results = apply_expectations(empty, [Expectation("any", F.lit(True), "warn")])
    assert passing.isEmpty() and rejected.isEmpty()
    assert results[0].pass_rate == 1.0


def test_quality_gate(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    with pytest.raises(DataQualityGateError, match="'present' of 't' .* 1 row"):
        apply_expectations(df, [Expectation("present", F.col("id") > 0, "fail")], source="t")


def test_duplicate_rule_names(spark):
    rule = Expectation("same", F.lit(True), "warn")
    with pytest.raises(DuplicateExpectationError):
        RuleSet(rule, rule)
    rules = RuleSet(rule)
    assert rules.names("warn") == {"same"} and rules.names("drop") == frozenset()


def test_quarantine_and_reprocess(spark):
    df = spark.createDataFrame([(1, 10), (2, -1), (3, 0)], "id int, amount int")
    _, rejected, _ = apply_expectations(df, [Expectation("positive", F.col("amount") > 0, "drop")])
    held = quarantine_rows(rejected, source_table="s", natural_key=F.col("id"), batch_id="b1")
    stored = {r.natural_key: r for r in held.collect()}
    assert set(stored) == {"2", "3"}
    assert stored["2"].failed_expectations == '["positive"]'
    assert stored["2"].row_payload_json == '{"id":2,"amount":-1,"_failed_expectations":["positive"]}'
    again = {r.natural_key: r.quarantine_id for r in held.collect()}
    assert again == {k: r.quarantine_id for k, r in stored.items()}
    keys = spark.createDataFrame([("2",), ("2",), ("9",)], "natural_key string")
    marked = {r.natural_key: r.is_reprocessed for r in mark_reprocessed(held, keys, "b1").collect()}
    assert marked == {"2": True, "3": False}
    assert mark_reprocessed(held, keys, "b2").filter("is_reprocessed").isEmpty()


# -- merge and diff -------------------------------------------------------------------------


@pytest.fixture
def sides(spark):
    target = spark.createDataFrame(
        [(1, "a", 10, "b0"), (2, "b", 20, "b0"), (None, "n", 30, "b0"), (4, None, 40, "b0")],
        "k int, v string, only_target int, _batch_id string",
    )
    source = spark.createDataFrame(
        [(2, "b", 1, "b1"), (1, "A", 1, "b1"), (1, "old", 0, "b1"), (None, "N", 1, "b1"), (5, "e", 1, "b1"), (4, None, 1, "b1")],
        "k int, v string, op_seq int, _batch_id string",
    )
    return target, source


def test_merge(sides):
    target, source = sides
    merged = merge_frames(target, source, ["k"], order_by=["op_seq"])
    assert rows(merged) == sorted(
        [
            (1, "A", 10, "b1", 1, "update"),
            (2, "b", 20, "b0", None, "keep"),
            (None, "N", 30, "b1", 1, "update"),
            (4, None, 40, "b0", None, "keep"),
            (5, "e", None, "b1", 1, "insert"),
        ],
        key=repr,
    )
    assert merge_counts(merged).first() == (1, 2, 2)
    again = merge_frames(merged.drop(ACTION), source, ["k"], order_by=["op_seq"])
    assert merge_counts(again).first() == (0, 0, 5)


def test_merge_changes_are_the_changed_rows(sides):
    target, source = sides
    merged = merge_frames(target, source, ["k"], order_by=["op_seq"]).filter("_action <> 'keep'")
    assert rows(merge_changes(target, source, ["k"], order_by=["op_seq"])) == rows(merged)


def test_merge_changes_with_a_large_source(sides, monkeypatch):
    target, source = sides
    small = rows(merge_changes(target, source, ["k"], order_by=["op_seq"]))
    monkeypatch.setattr("layerline.operators.merge.fits_broadcast", lambda df: False)
    assert rows(merge_changes(target, source, ["k"], order_by=["op_seq"])) == small


def test_a_new_source_column_is_a_change(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, w string")
    assert rows(merge_frames(target, source, ["k"])) == [(1, "a", "x", "update"), (2, "b", None, "keep")]


def test_merge_needs_keys(sides):
    with pytest.raises(ValueError):
        merge_frames(*sides, [])


def test_diffs(spark):
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (None, None), (3, "d")], "k int, v string")
    assert diff_counts(before, after).first() == (2, 2)
    assert diff_counts(before, before).first() == (0, 0)
    unique = before.distinct()
    assert rows(keyed_diff(unique, after, ["k"])) == [(2, "changed"), (3, "added")]
    assert rows(keyed_diff(after, unique, ["k"])) == [(2, "changed"), (3, "removed")]


# -- contracts ------------------------------------------------------------------------------


def _schema(**fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def test_drift():
    want = _schema(id=T.IntegerType(), label=T.StringType())

    def findings(**fields):
        return {f.column: f.finding for f in schema_findings(_schema(**fields), want, ["id"])}

    assert findings(id=T.IntegerType(), label=T.StringType()) == {"id": "same", "label": "same"}
    assert findings(id=T.LongType(), extra=T.DateType()) == {"id": "same", "label": "absent", "extra": "new"}
    assert findings(id=T.ShortType(), label=T.StringType())["id"] == "narrowed"
    assert findings(label=T.StringType())["id"] == "key lost"

    def kind(observed, expected, keys=()):
        return drift_kind(schema_findings(observed, expected, keys))

    assert kind(want, want, ["id"]) == "none"
    # A lost column that is no key does no harm, a new one is an addition.
    assert kind(_schema(id=T.IntegerType()), want, ["id"]) == "none"
    assert kind(_schema(id=T.IntegerType(), extra=T.DateType()), want, ["id"]) == "additive"
    assert kind(_schema(label=T.StringType()), want, ["id"]) == "breaking"
    money = _schema(m=T.DecimalType(18, 2))
    assert kind(_schema(m=T.DecimalType(20, 2)), money) == "none"
    assert kind(_schema(m=T.DecimalType(20, 4)), money) == "breaking"
    assert kind(_schema(m=T.DecimalType(16, 2)), money) == "breaking"


def test_conform(spark):
    df = spark.createDataFrame([("7", 1.255, "x"), ("q", 2.0, "y")], "id string, m double, extra string")
    contract = _schema(m=T.DecimalType(18, 2), id=T.IntegerType(), gone=T.DateType())
    out = conform(df, contract)
    assert [f.dataType for f in out.schema] == [f.dataType for f in contract]
    assert [r.id for r in out.collect()] == [7, None]
    assert conform(df, contract, keep_extra=True).columns == ["m", "id", "gone", "extra"]


# -- scale ----------------------------------------------------------------------------------


def test_fits_broadcast_measures_rows_and_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert fits_broadcast(df, rows=100, size=1 << 20)
    assert not fits_broadcast(df, rows=99, size=1 << 20)
    assert not fits_broadcast(df, rows=100, size=50_000)


def test_hot_keys(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    assert not find_hot_keys(df, ["k"])
    hot = find_hot_keys(df, ["k"], hot_rows=100)
    assert len(hot.hashes) == 1 and hot.chunks >= 10
    cold, busy = split_hot(df, ["k"], hot)
    assert (cold.count(), busy.count(), busy.distinct().count()) == (2000, 1000, 1)
