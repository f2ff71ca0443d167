from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from layerline.llm import lines
from layerline.llm.queries import QUERIES


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute_force(rows: list[tuple], least: int, edits: int, hashes: dict) -> list[tuple]:
    """Rows (key, text) to (key, new text, lines, dropped)."""
    first: dict[str, tuple] = {}
    for key, text in rows:
        for at, line in enumerate([] if text is None else text.split("\n")):
            if len(line) >= least:
                place = (key is not None, key or 0, hashes[text], at)
                first[line] = min(first.get(line, place), place)
    near = {
        y
        for x in first
        for y in first
        if x != y and first[x] < first[y] and abs(len(x) - len(y)) <= edits and distance(x, y) <= edits
    }
    out = []
    for key, text in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        kept = [
            line
            for at, line in enumerate(text.split("\n"))
            if len(line) < least
            or line not in near
            and first[line] == (key is not None, key or 0, hashes[text], at)
        ]
        n = text.count("\n") + 1
        out.append((key, "\n".join(kept), n, n - len(kept)))
    return sorted(out, key=repr)


def compare(spark, rows, least=12, edits=2):
    frame = spark.createDataFrame([(k, t, 7, 0) for k, t in rows], "doc_id long, text string, n_chars int, n_lines int")
    hashes = {r.text: r.h for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    found = lines.deduplicate(frame.drop("n_lines").repartition(3), least_chars=least, edits=edits)
    assert found.columns == ["doc_id", "text", "n_chars", "n_lines", "n_dropped"]
    mine = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=repr)
    assert mine == brute_force(rows, least, edits, hashes)


def mutated(line: str, times: int, random: random.Random) -> str:
    for _ in range(times):
        at = random.randrange(len(line) + 1)
        kind = random.randrange(3)
        line = line[:at] + random.choice("abé") * (kind != 1) + line[at + (kind != 0) :]
    return line


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_random_edits(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(12, 40))) for _ in range(25)]
    rows = []
    for key in range(60):
        picked = [mutated(rng.choice(base), rng.randint(0, edits + 1), rng) for _ in range(rng.randint(1, 5))]
        rows.append((key, "\n".join(picked)))
    compare(spark, rows, edits=edits)


def test_one_letter_lines_and_shifts(spark):
    rows = [(i, "a" * n) for i, n in enumerate([12, 13, 14, 15, 16, 20, 21, 30])]
    rows += [(20, "xy" * 10), (21, "yx" * 10), (22, "y" + "xy" * 10)]
    compare(spark, rows)


def test_odd_rows(spark):
    long = "the same long enough line"
    rows = [
        (1, f"{long}\nshort\n{long}\nshort"),
        (2, ""),
        (3, None),
        (None, f"head of nothing else\n{long}"),
        (4, long),
        (4, f"{long}\nand another line of four"),
        (5, "\n\n"),
        (6, "\n".join([long] * 500)),
    ]
    compare(spark, rows)


def test_short_lines_go_too(spark):
    """Without a minimum: equal lines at any length with a word, near ones from six characters on."""
    boilerplate = "Licensed under CC BY-NC 4.0."
    rows = [
        (1, f"{boilerplate}\n}}\n\nabcdef\nabcde\nof"),
        (2, f"{boilerplate}\n}}\n\n  \nabxdyf\nabcdx\nof\n語"),
        (3, "Licensed under CC BY-SA 4.0.\n  \nabcde\nxbcdefg\nx語\n語"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.deduplicate(frame).collect()}
    assert found == {
        1: (rows[0][1], 6, 0),
        2: ("\n  \nabcdx\n語", 8, 4),
        3: ("  \nx語", 6, 4),
    }


def test_short_lines_by_brute_force(spark):
    """At the least length that segments allow, all pairs."""
    rng = random.Random(8)
    rows = [(i, "\n".join("".join(rng.choices("abcdef ", k=rng.randint(0, 11))) for _ in range(4))) for i in range(80)]
    compare(spark, rows, least=6)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in lines.deduplicate(frame).collect()}
    fixed = {r.doc_id: r.text for r in lines.deduplicate(frame, least_chars=6).collect()}
    seen = set()
    for key, text in sorted(fixed.items()):
        # of what a minimum of six leaves, equal shorter lines go, and only they
        left = []
        for line in text.split("\n"):
            if len(line) >= 6 or not line.strip(" ") or line not in seen:
                left.append(line)
        seen.update(rows[key][1].split("\n"))
        assert [x for x in found[key].split("\n") if x.strip(" ")] == list(dict.fromkeys(x for x in left if x.strip(" ")))


def test_equal_rows_keep_the_same_lines(spark):
    frame = spark.createDataFrame([(1, "a line that is long enough to count")] * 2, "doc_id long, text string")
    assert [r.n_dropped for r in lines.deduplicate(frame).collect()] == [0, 0]


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(lines, "fits_broadcast", lambda *a, **k: False)
    test_random_edits(spark, 2)


def test_empty_and_too_short(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert lines.deduplicate(frame).count() == 0
    with pytest.raises(ValueError):
        lines.deduplicate(frame, least_chars=4)


def test_query_on_whole_table(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    hashes = {r.text: r.h for r in documents.select("text", F.xxhash64("text").alias("h")).collect()}
    found = {r.doc_id: r for r in QUERIES["op6_line_dedup"](spark, folder).collect()}
    assert len(found) == len(rows)
    # equal lines are compared in full; near ones by brute force where lengths allow
    seen = set()
    for key, text in sorted(rows, key=lambda r: (r[0], hashes[r[1]])):
        kept = (found[key].text or "").split("\n")
        n = 0 if text is None else text.count("\n") + 1
        assert found[key].n_lines == n
        expected = [line for line in (text or "").split("\n") if len(line) < 30 or line not in seen]
        seen.update(line for line in (text or "").split("\n") if len(line) >= 30)
        assert set(kept) <= {*expected, ""}


def test_sketches_never_part_near_lines(spark):
    rnd = random.Random(5)
    alphabet = "etaoin shr dz9-ÄÖ語"
    pairs = []
    for _ in range(400):
        one = "".join(rnd.choices(alphabet, k=rnd.randint(30, 90)))
        other = list(one)
        for _ in range(2):
            at, kind = rnd.randrange(len(other)), rnd.randrange(3)
            other[at : at + (kind != 1)] = [] if kind == 0 else [rnd.choice(alphabet)]
        pairs.append((one, "".join(other)))
    frame = spark.createDataFrame(pairs, "x string, y string")
    sketched = frame.select(lines.sketch(F.col("x")).alias("a"), lines.sketch(F.col("y")).alias("b"))
    assert sketched.where(~lines.may_be_near("a", "b", 2)).isEmpty()
    far = spark.createDataFrame([("e" * 40, "t" * 40)], "x string, y string")
    assert far.select(lines.sketch(F.col("x")).alias("a"), lines.sketch(F.col("y")).alias("b")).where(
        lines.may_be_near("a", "b", 2)
    ).isEmpty()


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a first line of words\nsame line of words", "d", 7, "x", 5, True), (2, "same line of words", None, 8, "y", 6, False)]
    names = "doc_id long, text string, _doc string, _th long, _text string, n_lines int, `a.b` boolean"
    frame = spark.createDataFrame(rows, names)
    plain = lines.deduplicate(frame, counts=False)
    assert plain.columns == frame.columns
    assert sorted(map(tuple, plain.collect())) == [rows[0], (2, "", *rows[1][2:])]
    counted = lines.deduplicate(frame)
    assert counted.columns == ["doc_id", "text", "_doc", "_th", "_text", "a.b", "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["_doc"], r["a.b"], r["n_lines"], r["n_dropped"]) for r in counted.collect()) == [
        (1, "d", True, 2, 0),
        (2, None, False, 1, 1),
    ]
