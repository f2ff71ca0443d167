from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from layerline.llm import topk
from layerline.llm.queries import QUERIES


def brute_force(rows, is_query, k):
    vectors = []
    for name, vector in rows:
        fine = name is not None and vector and all(x is not None and math.isfinite(x) for x in vector)
        if fine:
            vectors.append((name, [math.floor(256 * x) for x in vector]))
    asked: dict[int, list[int]] = {}
    for name, v in vectors:
        if is_query(name):
            asked[name] = max(asked.get(name, v), v)
    out = []
    for query, q in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v)), n) for n, v in vectors if n != query)
        out += [(query, rank, n, -s) for rank, (s, n) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(n, v, "x") for n, v in rows], "vec_id long, embedding array<double>, score string")
    found = topk.top_k(frame.repartition(3), F.col("vec_id") % 5 == 0, **options)
    return sorted(map(tuple, found.collect()))


def test_random_vectors(spark):
    random.seed(4)
    rows = [(i, [random.gauss(0, 1) for _ in range(10)]) for i in range(300)]
    assert run(spark, rows) == brute_force(rows, lambda n: n % 5 == 0, 5)
    # several blocks of queries, other parts and depth
    assert run(spark, rows, k=3, parts=3, block_bytes=800) == brute_force(rows, lambda n: n % 5 == 0, 3)


def test_ties_copies_and_bad_vectors(spark):
    rows = [(i, [0.5, -0.25]) for i in range(20)] + [(3, [0.5, -0.25]), (5, [1.0, 1.0])]
    rows += [(21, None), (25, []), (30, [1.0, None]), (35, [math.nan, 1.0]), (40, [math.inf, 0.0]), (None, [1.0, 1.0])]
    rows += [(22, [1.0])]  # counts as (1, 0)
    assert run(spark, rows) == brute_force(rows, lambda n: n % 5 == 0, 5)


def test_large_components(spark):
    """Nothing is left out and nothing wraps, up to scores that a long holds."""
    rows = [(0, [8e6, 0.0, 0.0, 0.0]), (1, [8e6, 0.0, 0.0, 0.0])] + [(i, [float(i), 1.0, -2.0, 0.5]) for i in range(2, 9)]
    found = run(spark, rows)
    assert found == brute_force(rows, lambda n: n % 5 == 0, 5)
    assert (0, 1, 1, 4_194_304_000_000_000_000) in found
    rows = [(50, [9e6, 1.0]), (51, [9e6, 2.0]), (52, [1.0, 1.0]), (53, [-3.0, 7.5]), (55, [0.0, 2.0])]
    rows = [(n, [x / 2 for x in v]) for n, v in rows]
    assert run(spark, rows) == brute_force(rows, lambda n: n % 5 == 0, 5)
    random.seed(9)
    rows = [(i, [random.choice((1e15, 3e9, 1.0)) * random.choice((-1, 1)), 0.0, random.gauss(0, 1)]) for i in range(20, 60)]
    rows = [(n, v if n % 5 else [random.gauss(0, 1) / 64, 0.0, 1.0]) for n, v in rows]
    assert run(spark, rows) == brute_force(rows, lambda n: n % 5 == 0, 5)
    assert run(spark, rows, k=50, block_bytes=64) == brute_force(rows, lambda n: n % 5 == 0, 50)


def test_scores_and_components_beyond_a_long_are_refused(spark):
    with pytest.raises(Exception, match="does not fit a long"):
        run(spark, [(0, [1e15, 1.0]), (1, [1e15, 1.0])])
    with pytest.raises(Exception, match="does not fit a long"):
        run(spark, [(0, [1e300, 1.0]), (1, [1.0, 1.0])])


def test_fewer_rows_than_k_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-3.0])]
    assert run(spark, rows) == brute_force(rows, lambda n: n % 5 == 0, 5)
    assert run(spark, [(1, [1.0])]) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []


def test_query_on_whole_table(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = sorted(map(tuple, QUERIES["op10_top_k"](spark, folder).collect()))
    assert found == brute_force(rows, lambda n: n % 50 == 0, 5)
