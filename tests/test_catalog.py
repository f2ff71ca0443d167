"""Every query against its SQL equivalent, on the smallest tables."""

from __future__ import annotations

from functools import partial
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from layerline.operators.scale import find_hot_keys
from tools.check_oracle import canonical


@pytest.fixture(scope="module")
def db(folder):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, folder, db, name):
    frame = contract.queries()[name](spark, folder)
    mine = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(contract.oracle_sql()[name])
    assert mine == canonical([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["q14_late_changes", "q15_full_history", "q16_as_of_join", "q27_item_fact"])
def test_query_with_every_key_hot(spark, folder, db, monkeypatch, name):
    """The same results where each key is cut into time-ordered chunks."""
    touchy = partial(find_hot_keys, hot_rows=10)
    monkeypatch.setattr("layerline.operators.scd2.find_hot_keys", touchy)
    monkeypatch.setattr("layerline.operators.asof.find_hot_keys", touchy)
    test_query(spark, folder, db, name)


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
