from __future__ import annotations

import re
from collections import Counter

import pytest

from layerline.llm import quality
from layerline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if times[window] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def fails(counts: tuple[int, ...]) -> bool:
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


TEXTS = [
    None,
    "",
    " \t\n\r\x0b\x0c ",
    "one two three four five",
    "a b c d e a b c d e",
    "a a a a a a a a a a a a",
    "x y z\nx y z\n\nx y z \n \n",
    "# * $ % & | < > ## plain words stay one",
    "éè \U0001f389 " * 7,
    " ".join(f"w{i}" for i in range(40)) + " w3 w4 w5 w6 w7 end",
    "word " * 30_000,
    " ".join(str(i % 977) for i in range(20_000)),
]


def test_counts_like_brute_force(spark):
    rows = [(i, t, "h", 5) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "h", 5), (None, TEXTS[8], None, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long")
    found = quality.judge(frame).collect()
    assert len(found) == len(rows)
    expected = Counter((k, counted(t), fails(counted(t))) for k, t, _, _ in rows)
    assert Counter((r.doc_id, tuple(r[1:6]), r.base_failed) for r in found) == expected


GOOD = " ".join(f"good{i}" for i in range(12))


def test_hosts_that_mostly_fail_go(spark):
    rows = [(f"h{h}", GOOD if i else "bad") for h in range(20) for i in range(50)]
    rows += [("spam", GOOD if i < 5 else "bad") for i in range(60)]
    rows += [("small", "bad"), ("small", GOOD), (None, "bad"), (None, "bad"), (None, GOOD)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, text string")
    for row in quality.judge(frame).collect():
        assert row.kept == (not row.base_failed and row.source != "spam")


def test_shrinkage(spark):
    frame = spark.createDataFrame(
        [(h, f < bad) for h, n, bad in [("a", 200, 2), ("b", 200, 4), ("c", 1, 1), ("d", 100, 95)] for f in range(n)],
        "host string, failed boolean",
    )
    rates = {r["host"]: r for r in quality.host_verdicts(frame, "host", "failed").collect()}
    assert rates["d"]["rejected"] and not rates["a"]["rejected"] and not rates["b"]["rejected"]
    assert rates["c"]["shrunk_rate"] < 1 and rates["a"]["failures"] == 2
    assert 0.01 < rates["a"]["shrunk_rate"] < rates["b"]["shrunk_rate"] < 0.05


@pytest.mark.parametrize("share", [0, 1])
def test_all_alike(spark, share):
    frame = spark.createDataFrame([("a", bool(share))] * 4, "host string, failed boolean")
    assert [r["rejected"] for r in quality.host_verdicts(frame, "host", "failed").collect()] == [bool(share)]


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality.judge(frame).count() == 0


def test_query_on_whole_table(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op1_quality_rules"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        counts = counted(texts[row.doc_id])
        assert (tuple(row[1:6]), row.base_failed) == (counts, fails(counts))
        assert not (row.kept and row.base_failed)
