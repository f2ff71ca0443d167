from __future__ import annotations

import random
import re

import pytest

from layerline.llm import neardup
from layerline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, width: int) -> frozenset:
    words = WORD.findall((text or "").translate(FOLD))
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_force(rows: list[tuple], width: int, percent: int = 80) -> list[tuple]:
    sets = [shingles(t, width) for _, t in rows]
    above = list(range(len(rows)))

    def root(i: int) -> int:
        while above[i] != i:
            i = above[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                above[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    out = []
    for i, (key, _) in enumerate(rows):
        own = least.get(root(i))
        out.append((key, len(sets[i]), own, own == key))
    return sorted(out, key=repr)


def compare(spark, rows, width=2):
    frame = spark.createDataFrame([(k, t, 1, "c") for k, t in rows], "doc_id long, text string, n long, rid string")
    found = neardup.near_duplicates(frame.repartition(3), words=width).collect()
    mine = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=repr)
    assert mine == brute_force(rows, width)


def edited(words: list[str], times: int, rng: random.Random) -> list[str]:
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"n{rng.randrange(10_000)}"
    return words


@pytest.mark.parametrize("width", [2, 5])
def test_edited_copies(spark, width):
    rng = random.Random(width)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randint(8, 120))]
        for _ in range(8):
            words = edited(base, rng.randint(0, max(1, len(base) // 15)), rng)
            rows.append((len(rows), " ".join(words).title()))
    rng.shuffle(rows)
    compare(spark, rows, width)


def test_one_group_whose_members_are_far_apart(spark):
    """Copies of one text, each edited: close to the text, often not to one another."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(edited(base, rng.randint(2, 6), rng))) for i in range(120)]
    rows += [(500, " ".join(base)), (501, "quite another text " * 3)]
    compare(spark, rows)


def test_chain(spark):
    """Neighbours are linked, ends are not."""
    rows = [(30 - i, " ".join(f"w{j}" for j in range(4 * i, 4 * i + 60))) for i in range(30)]
    compare(spark, rows)


def test_thresholds_are_exact(spark):
    # 8 of 10, 79 of 100, and short texts
    rows = [
        (1, " ".join(f"a{i}" for i in range(10))),
        (2, " ".join(f"a{i}" for i in range(9)) + " b c"[:0]),
        (3, "a b"), (4, "A  B"), (5, "a"), (6, "a"), (7, "b"),
    ]
    compare(spark, rows)


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, text), (4, text), (None, text), (9, text.upper())]
    rows += [(None, "some words of no key"), (7, "w " * 3_000), (8, "w w w")]
    compare(spark, rows)


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert neardup.near_duplicates(frame).count() == 0


def test_last_round_leaves_pairs_that_cannot_be_links(spark):
    """A family whose sets share some seven tenths: all meet at their rarest shingles, only links and few others are tried."""
    import numpy as np

    rng = random.Random(5)
    hashes = np.random.default_rng(5).integers(0, 1 << 63, 210, dtype=np.uint64).tolist()
    core, pool = hashes[:100], hashes[100:]
    sets = [{*core, *rng.sample(pool, 60)} for _ in range(40)]
    sets += [{*s} - {*list(s)[:4]} for s in sets[:6]]
    rows = [(i, 0, 0, i, np.array(sorted(s), "<u8").tobytes()) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "rid long, d1 long, d2 long, label long, shingles binary")
    found = {(r.a, r.b) for r in neardup._rare_pairs(frame, 80).collect()}
    linked = {
        (i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if 100 * len(a & b) >= 80 * len(a | b)
    }
    assert len(linked) >= 6 and linked <= found
    assert len(found) < len(linked) + 40


def test_parities_never_differ_more_than_sets():
    import numpy as np

    rng = np.random.default_rng(9)
    for size in (1, 30, 700):
        x, y = (rng.integers(0, 1 << 63, size, dtype=np.uint64) for _ in range(2))
        x[: size // 2] = y[: size // 2]
        cells = np.unpackbits((neardup._parities(x) ^ neardup._parities(y)).view(np.uint8)).sum()
        assert cells <= len(np.setxor1d(x, y))
        assert not (neardup._parities(x) ^ neardup._parities(x[::-1])).any()


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    found = {r.rid: r.label for r in neardup.components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 90, 90: 90}


def test_pigeonhole():
    edges = neardup.chunk_edges(neardup.SYMBOLS, neardup.CHUNKS)
    assert edges[0] == 0 and edges[-1] == neardup.SYMBOLS and len(edges) == neardup.CHUNKS + 1
    assert neardup.RADIUS // neardup.CHUNKS == 1


def test_query_on_whole_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op8_minhash_near_dedup"](spark, folder).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute_force(rows, 2)
