"""Histories in two times against replaying what was known."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from layerline.operators.bitemporal import Bitemporal, as_known, empty_history, record
from layerline.operators.scale import find_hot_keys, materialize

CFG = Bitemporal(["k"], ["v", "w"], "ts", "seq")
DDL = "k string, v string, w int, ts timestamp_ntz, seq int, op string"


def at(hour: float) -> datetime:
    return datetime(2024, 1, 1) + timedelta(hours=hour)


def known(day: int) -> datetime:
    return datetime(2024, 3, 1) + timedelta(days=day)


def ts(value: datetime):
    return F.lit(value).cast("timestamp_ntz")


def replay(batches: list[list[tuple]]) -> list[tuple]:
    """(key, values, valid_from, valid_to) known after these batches."""
    starts: dict = {}
    for batch in batches:
        last: dict = {}
        for k, v, w, start, seq, op in batch:
            if start is not None and (k, start) not in last or start is not None and last[k, start][0] < seq:
                last[k, start] = (seq, v, w, op)
        for (k, start), (_, v, w, op) in last.items():
            if op == "W":
                starts.pop((k, start), None)
            else:
                starts[k, start] = (v, w)
    found = []
    for (k, start), (v, w) in starts.items():
        later = [s for key, s in starts if key == k and s > start]
        found.append((k, v, w, start, min(later, default=None)))
    return sorted(found, key=repr)


def shown(history, when):
    end = F.when(F.col("valid_to") < ts(datetime(9000, 1, 1)), F.col("valid_to"))
    rows = as_known(history, ts(when)).select("k", "v", "w", "valid_from", end.alias("valid_to"))
    return sorted(map(tuple, rows.collect()), key=repr)


def change(rng, seq):
    key = rng.choice(["hot", "hot", "a", "b", None])
    start = None if rng.random() < 0.03 else at(rng.randrange(40))
    return key, rng.choice(["x", "y", None]), rng.choice([1, 2, None]), start, seq, rng.choice(["U", "U", "I", "W", None])


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_each_batch_is_still_known_later(spark, hot_rows):
    rng = random.Random(8)
    batches = [[change(rng, 100 * b + i) for i in range(30)] for b in range(4)]
    frames = [spark.createDataFrame(b, DDL).repartition(2) for b in batches]
    history = empty_history(frames[0], CFG)
    for number, frame in enumerate(frames):
        hot = hot_rows and find_hot_keys(history.unionByName(frame, allowMissingColumns=True), ["k"], hot_rows=hot_rows)
        history = materialize(record(history, frame, CFG, ts(known(number)), hot), "history")
        again = record(history, frame, CFG, ts(known(number)), hot)
        assert sorted(map(str, again.collect())) == sorted(map(str, history.collect()))
    for number in range(len(batches)):
        assert shown(history, known(number)) == replay(batches[: number + 1])
        assert shown(history, known(number + 0.5)) == replay(batches[: number + 1])
    assert shown(history, known(-1)) == []
    # Rectangles of a key do not overlap, and none is empty.
    cells = history.alias("a").join(history.alias("b"), F.col("a.k").eqNullSafe(F.col("b.k")))
    meets = (F.col("a.valid_from") < F.col("b.valid_to")) & (F.col("b.valid_from") < F.col("a.valid_to"))
    meets &= (F.col("a.known_from") < F.col("b.known_to")) & (F.col("b.known_from") < F.col("a.known_to"))
    assert cells.where(meets).count() == history.count()


def test_a_late_a_corrected_and_a_withdrawn_change(spark):
    first = [("a", "x", 1, at(0), 1, "I"), ("a", "y", 1, at(10), 2, "U")]
    late = [("a", "z", 1, at(5), 3, "U")]
    corrected = [("a", "q", 1, at(10), 4, "U")]
    withdrawn = [("a", None, None, at(5), 5, "W"), ("a", None, None, at(7), 6, "W")]
    history = empty_history(spark.createDataFrame(first, DDL), CFG)
    for day, batch in enumerate((first, late, corrected, withdrawn)):
        history = materialize(record(history, spark.createDataFrame(batch, DDL), CFG, ts(known(day))), "history")

    def value(day, hour):
        return [r.v for r in as_known(history, ts(known(day)), ts(at(hour))).collect()]

    assert [value(d, 6) for d in range(4)] == [["x"], ["z"], ["z"], ["x"]]
    assert [value(d, 12) for d in range(4)] == [["y"], ["y"], ["q"], ["q"]]
    assert [value(d, -1) for d in range(4)] == [[]] * 4
    # x to 10 o'clock, to 5, and to 10 again; z; y; q
    assert history.count() == 6


def test_untouched_keys_pass_through(spark):
    first = spark.createDataFrame([("a", "x", 1, at(0), 1, "I"), ("b", "x", 1, at(0), 2, "I")], DDL)
    history = materialize(record(empty_history(first, CFG), first, CFG, ts(known(0))), "history")
    after = record(history, spark.createDataFrame([("a", "y", 1, at(3), 3, "U")], DDL), CFG, ts(known(1)))
    same = after.where("k = 'b'").collect()
    assert same == history.where("k = 'b'").collect()
    assert record(history, first.limit(0), CFG, ts(known(2))).count() == history.count()
