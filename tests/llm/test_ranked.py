"""Ranked search against a plain scorer, with shards and layers small enough that every path runs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from layerline.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, k=10):
    counted = [(key, Counter(terms(text))) for key, text in documents]
    n_documents = sum(bool(c) for _, c in counted)
    total = sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    found = []
    for item, text in items:
        scores = []
        for key, counts in counted:
            score = 0
            for term, times in Counter(terms(text)).items():
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * holding[term] + 1)))
                    m = 25 + 75 * sum(counts.values()) * n_documents // total
                    score += times * w * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0))
        for rank, (score, nameless, key) in enumerate(sorted(scores)[:k], 1):
            found.append((item, rank, None if nameless else key, -score))
    return found


def by_item(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def corpus(seed, count, vocabulary=60):
    random.seed(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Été", "漢字", "O'Neil"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(random.choices(words, weights, k=random.choice((3, 10, 40, 200)))) for _ in range(count)]
    texts += texts[:40] * 3  # ties
    return [(i, t) for i, t in enumerate(texts)], words


@pytest.mark.parametrize("shard,depths", [(16, (1, 3)), (64, (2, 8)), (8192, (32, 512)), (50, (4,))])
def test_equals_a_plain_scorer(spark, monkeypatch, shard, depths):
    monkeypatch.setattr(ranked, "SHARD_DOCUMENTS", shard)
    documents, words = corpus(shard, 300)
    items = [(i, " ".join(random.choices(words, k=random.choice((1, 2, 5, 20))))) for i in range(40)]
    items += [(50, "nothing known here"), (51, ""), (52, "w0 w0 w0 W0 w1")]
    left = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    found = ranked.search(left, right, depths=depths)
    assert by_item(found.collect()) == brute(documents, items)
    # more documents wanted than there are, in several blocks of items
    found = ranked.search(left.where("doc_id < 25"), right, depths=depths, block_bytes=200, k=30)
    assert by_item(found.collect()) == brute([d for d in documents if d[0] < 25], items, 30)


def test_shards_end_early(spark, monkeypatch):
    """With a cutoff, few pairs of shards and items need the ends of the lists."""
    monkeypatch.setattr(ranked, "SHARD_DOCUMENTS", 200)
    random.seed(3)
    words = [f"w{i}" for i in range(2_000)]
    documents = [(i, " ".join(random.choices(words, k=60))) for i in range(4_000)]
    items = [(i, documents[100 * i][1]) for i in range(20)]
    rounds = []
    plain = ranked._round

    def counted(index, layers, queries, cutoffs, k):
        rounds.append(index.select("items").collect() if "items" in index.columns else None)
        return plain(index, layers, queries, cutoffs, k)

    monkeypatch.setattr(ranked, "_round", counted)
    left = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    found = ranked.search(left, spark.createDataFrame(items, "item_id long, text string"), k=1, depths=(8, 64))
    assert by_item(found.collect()) == brute(documents, items, 1)
    rest = sum(len(r["items"]) for r in rounds[2]) if len(rounds) > 2 else 0
    assert rest < 0.5 * 20 * 20


def test_nulls_copies_long_texts_and_other_columns(spark):
    documents = [(None, "alpha beta"), (1, None), (2, ""), (3, "alpha"), (3, "alpha"), (4, "beta " * 50_000), (-5, "ALPHA")]
    items = [(1, "alpha"), (None, "beta"), (7, None), (8, "gamma")]
    left = spark.createDataFrame([(*d, "x", 1) for d in documents], "doc_id long, text string, item_id string, rank int")
    right = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")
    assert by_item(ranked.search(left, right).collect()) == by_item(brute(documents, items))
    twice = right.union(spark.createDataFrame([(1, "beta", 2)], right.schema))
    assert by_item(ranked.search(left, twice).collect()) == by_item(brute(documents, items))


def test_empty_tables_and_other_keys(spark):
    left = spark.createDataFrame([(1, "alpha")], "doc_id int, text string")
    right = spark.createDataFrame([("a", "alpha")], "item_id string, text string")
    one = ranked.search(left, right)
    assert one.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert [r.rank for r in one.collect()] == [1]
    for documents, items in ((left.limit(0), right), (left, right.limit(0))):
        assert ranked.search(documents, items).isEmpty()
    with pytest.raises(TypeError):
        ranked.search(left.withColumn("doc_id", left.doc_id.cast("string")), right)
