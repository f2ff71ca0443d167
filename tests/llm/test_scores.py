"""Toxicity and language-model scores."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from layerline.llm import ctw, toxicity
from layerline.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# -- context-tree weighting ------------------------------------------------------------------


def kt(zeros: int, ones: int) -> float:
    value = 0.0
    for i in range(zeros):
        value += math.log((i + 0.5) / (i + 1))
    for i in range(ones):
        value += math.log((i + 0.5) / (zeros + i + 1))
    return value


class Tree:
    """The definition, one byte context at a time."""

    def __init__(self, texts: list[bytes], depth: int) -> None:
        self.depth, self.counts, self.known = depth, Counter(), {}
        self.children: dict = {}
        for text in texts:
            padded = bytes([255] * depth) + text + b"\xff"
            for at in range(depth, len(padded)):
                for length in range(depth + 1):
                    context = padded[at - length : at]
                    for bit in range(8):
                        node = (1 << bit) | (padded[at] >> (8 - bit))
                        self.counts[context, node, padded[at] >> (7 - bit) & 1] += 1
                    if length < depth:
                        self.children.setdefault(context, set()).add(padded[at - length - 1 : at])

    def own(self, context: bytes, node: int) -> float:
        return kt(self.counts[context, node, 0], self.counts[context, node, 1])

    def weighted(self, context: bytes, node: int) -> float:
        if (context, node) not in self.known:
            value = self.own(context, node)
            if len(context) < self.depth:
                below = sum(self.weighted(c, node) for c in self.children.get(context, ()))
                value = math.log(0.5) + np.logaddexp(value, below)
            self.known[context, node] = value
        return self.known[context, node]

    def chance(self, history: bytes, node: int, bit: int, length: int = 0) -> float:
        context = history[len(history) - length :]
        zeros, ones = (self.counts[context, node, b] for b in (0, 1))
        local = ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
        if length == self.depth:
            return local
        deeper = history[len(history) - length - 1 :]
        if not self.counts[deeper, node, 0] + self.counts[deeper, node, 1]:
            return local
        share = math.exp(min(0.0, math.log(0.5) + self.own(context, node) - self.weighted(context, node)))
        return share * local + (1 - share) * self.chance(history, node, bit, length + 1)

    def score(self, text: bytes) -> float:
        padded, total = bytes([255] * self.depth) + text + b"\xff", 0.0
        for at in range(self.depth, len(padded)):
            for bit in range(8):
                node = (1 << bit) | (padded[at] >> (8 - bit))
                total += math.log10(self.chance(padded[:at], node, padded[at] >> (7 - bit) & 1))
        return total


def expected(rows: list[tuple], depth: int) -> list[tuple]:
    held = [k is not None and zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in rows]
    bodies = [ctw.normal_text(t) for _, t in rows]
    tree = Tree([b for b, out in zip(bodies, held) if not out], depth)
    tokens = [[*WORD.findall(b.decode()), ""] for b in bodies]
    counts = Counter(w for ws, out in zip(tokens, held) if not out for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (key, _), body, words, is_held in zip(rows, bodies, tokens, held):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        known = sum(counts[w] > 0 for w in words)
        out.append((key, is_held, len(words), known, n, base, tree.score(body)))
    return out


def close(found, wanted) -> None:
    found, wanted = sorted(found, key=repr), sorted(wanted, key=repr)
    assert len(found) == len(wanted)
    order = lambda row: (str(row[0]), row[2], row[5])
    for mine, theirs in zip(sorted(found, key=order), sorted(wanted, key=order)):
        assert mine[:5] == theirs[:5]
        assert mine[5] == pytest.approx(theirs[5], rel=1e-9, abs=1e-9)
        assert mine[6] == pytest.approx(theirs[6], rel=1e-6)


@pytest.mark.parametrize("depth", [2, 3])
def test_scores_like_the_definition(spark, depth):
    rng = random.Random(depth)
    words = ["the", "cat", "sat", "ON", "a", "mät", "big"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(3, None), (None, "the cat"), (100, ""), (101, " \t\n"), (102, "zzz unseen 中"), (7, "the the the")]
    rows += [(7, "the the the")]
    frame = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    close([tuple(r)[:7] for r in ctw.score(frame.repartition(3), depth=depth).collect()], expected(rows, depth))


def test_small_chunks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 40)
    monkeypatch.setattr(ctw, "COUNT_AT_ONCE", 30)
    monkeypatch.setattr(ctw, "HELD", 20)
    rows = [(i, f"some text of row {i % 7} " * (i % 4)) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    close([tuple(r)[:7] for r in ctw.score(frame, depth=2).collect()], expected(rows, 2))


def test_groups_do_not_grow_with_the_chunks(spark, monkeypatch):
    """Large parts are divided and folded: no group gathers more than a few chunks."""
    monkeypatch.setattr(ctw, "CHUNK_BYTES", 40)
    for name, value in (("GROUP_ENTRIES", 12), ("FOLD_CHUNKS", 3), ("JOINED", 4)):
        monkeypatch.setattr(ctw, name, value)
    most, folds = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    gathered = ctw._gathered

    def watched(frame, depth, counted="<u4"):
        keys = gathered(frame, depth, counted)
        small = sum(len(b) for b in frame["counts"]) <= 4 * 12
        if counted == "<u4" and not small or len(frame) > 12:
            most.add(1)
        folds.add(counted == "<i8")
        return keys

    monkeypatch.setattr(ctw, "_gathered", watched)
    rows = [(i, f"some text of row {i % 7} " * (i % 4)) for i in range(40)] + [(None, "unseen Zq"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    close([tuple(r)[:7] for r in ctw.score(frame.repartition(2), depth=3).collect()], expected(rows, 3))
    assert most.value == 0 and folds.value > 0


def test_lm_empty(spark):
    assert ctw.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bits_of_a_byte_sum_to_one():
    tree = Tree([b"abracadabra"], 2)
    total = 0.0
    for byte in range(256):
        total += math.prod(
            tree.chance(b"\xff\xffra", (1 << b) | (byte >> (8 - b)), byte >> (7 - b) & 1) for b in range(8)
        )
    assert total == pytest.approx(1.0)


def test_lm_query_on_whole_table(spark, folder):
    rows = QUERIES["op7_lm_scoring"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    tokens = {k: [*(w for w in WORD.findall((t or "").translate(ctw.FOLD))), ""] for k, t in texts.items()}
    counts = Counter(w for k, ws in tokens.items() if zlib.crc32(str(k).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for row in rows:
        own = tokens[row.doc_id]
        assert (row.n_tokens, row.train_tokens) == (len(own), n)
        assert row.n_known == sum(counts[w] > 0 for w in own)
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 10 == 0)
        assert row.score < 0


def test_lists_are_merged_and_texts_counted_together():
    rng = np.random.default_rng(3)
    for size in (1, 5, 300):
        one, two = ({int(k): int(n) for k, n in zip(rng.integers(0, 400, size), rng.integers(0, 9, size))} for _ in range(2))
        arrays = [tuple(np.array(x, np.int64) for x in zip(*sorted(d.items()))) for d in (one, two)]
        keys, counts = ctw.merged(*arrays)
        assert dict(zip(keys.tolist(), counts.tolist())) == Counter(one) + Counter(two) | {k: 0 for k in {**one, **two} if one.get(k, 0) + two.get(k, 0) == 0}
        assert (np.diff(keys) > 0).all()
    bodies = [b"", b"abcabc", "mät".encode(), b"x"]
    together, sizes = ctw.grams(bodies, 3)
    assert sizes.tolist() == [len(b) + 1 for b in bodies]
    assert together.tolist() == [k for b in bodies for k in ctw.grams([b], 3)[0].tolist()]
    hashed, sizes = ctw.word_hashes()([b"a b a", b"", b"b"])
    assert sizes.tolist() == [4, 1, 2] and hashed[0] == hashed[2] and hashed[1] == hashed[5] and hashed[3] == hashed[4]


@pytest.mark.parametrize("size", [0, 1, 2, 1000, 50_000])
def test_values_of_known_keys(size):
    keys = np.unique(np.random.default_rng(size).integers(0, 1 << 48, size))
    values = np.arange(len(keys), dtype=np.int32)
    asked = np.concatenate([values[::-1], values[::3]])
    assert (ctw.lookup(keys, values, -1)(keys[asked]) == asked).all()


def test_only_ascii_blanks_part_words():
    text = " A\x0bB\x1cC\u00a0D\t\u2003E\x85\r\n"
    assert ctw.normal_text(text) == "a b\x1cc\u00a0d \u2003e\x85".encode()


# -- toxicity --------------------------------------------------------------------------------

BAD = ["nasty", "vile", "rotten"]


def corpus(n: int, seed: int) -> list[tuple[int, str, int]]:
    rng = random.Random(seed)
    rows = []
    for key in range(n):
        sentences = [" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(rng.randint(1, 12))]
        toxic = key % 5 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] = sentences[at].replace(" ", f" {rng.choice(BAD)} ", 2)
        rows.append((key, ". ".join(sentences) + ".", int(toxic)))
    return rows


def test_learns_from_documents_and_finds_sentences(spark):
    rows = corpus(900, 1)
    documents = spark.createDataFrame([(k, t, "s") for k, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in rows], "doc_id long, quality int, toxic int")
    found = toxicity.toxic_documents(documents, labels, located=True).collect()
    truth, texts = {k: y for k, _, y in rows}, {k: t for k, t, _ in rows}
    held = [r for r in found if r.held_out]
    assert len(found) == 900 and 200 < len(held) < 400
    for row in held:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    for row in found:
        for span in row.offending:
            if truth[row.doc_id]:
                assert any(b in texts[row.doc_id][span.start : span.stop] for b in BAD)


def test_held_out_labels_are_not_read(spark):
    rows = corpus(300, 2)
    documents = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = [(k, y) for k, _, y in rows]
    flipped = [(k, 1 - y if zlib.crc32(str(k).encode()) % 3 == 1 else y) for k, y in labels]
    scores = [
        sorted(tuple(r) for r in toxicity.toxic_documents(documents, spark.createDataFrame(own, "doc_id long, toxic int")).collect())
        for own in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_odd_texts_and_labels(spark):
    rows = [(k, t) for k, t, _ in corpus(200, 3)] + [(None, "nasty words"), (900, None), (901, ""), (902, "fine. " * 20_000), (1, "w1 w2")]
    labels = [(k, y) for k, _, y in corpus(200, 3)] + [(None, 1), (5, None), (6, 7), (0, 0), (999, 1)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    own = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.toxic_documents(documents, own).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    assert {r.doc_id: r.predicted for r in found if r.doc_id in (900, 901, 902)} == {900: 0, 901: 0, 902: 0}
    assert not [r for r in found if r.doc_id is None and r.held_out]
    assert toxicity.toxic_documents(documents.limit(0), own).count() == 0


@pytest.mark.parametrize(("labels", "score"), [([], 0.0), ([(k, 1) for k in range(30)], 1.0)])
def test_one_label_or_none(spark, labels, score):
    documents = spark.createDataFrame([(k, "some words") for k in range(30)], "doc_id long, text string")
    own = spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = [r.score for r in toxicity.toxic_documents(documents, own).collect()]
    assert scores == pytest.approx([score] * 30, abs=1e-9)


def test_filter_keeps_clean_rows_as_they_are(spark):
    rows = corpus(400, 4)
    documents = spark.createDataFrame([(k, t, None) for k, t, _ in rows] + [(1000, None, "x")], "doc_id long, text string, source string")
    model = toxicity.fit([(t, y) for _, t, y in rows])
    kept = {r.doc_id: r for r in toxicity.keep_clean(documents, model).collect()}
    assert set(kept) == {k for k, _, y in rows if not y} | {1000}


def test_toxicity_query_on_whole_table(spark, folder):
    rows = QUERIES["op5_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    learnt = [r for r in rows if not r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in learnt) >= 0.95 * len(learnt)
