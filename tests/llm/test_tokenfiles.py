"""Token files against the tokenizers library, exact round trips, and broken files."""

from __future__ import annotations

import json
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerline.llm import tokenfiles
from layerline.llm.queries import QUERIES, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
SMALL = tokenfiles.Settings(sample=50, shard_bytes=4_000, shard_documents=40)
#: Blanks, line ends, marks, contractions, digits, other scripts, controls and a special token's name.
BITS = [" ", "  ", "\n", "\n\n", "\t", " \n", "\x1c", "\xa0", " ", ",", ".", "'s", "don't", "Foo", "bar", "été",
        "д", "漢字", "12", "½", "-", "<|endoftext|>", "\x00", "🙂", "é", "!!", ":x", "'", "$$$", "re,***", "_"]


@pytest.fixture(scope="module")
def encoder():
    return tokenfiles.ByteLevelEncoder(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=12).map("".join))
def test_encoder_equals_the_library(encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder_ids(text)


LIBRARY: dict = {}


def encoder_ids(text: str) -> list[int]:
    from tokenizers import Tokenizer

    if not LIBRARY:
        LIBRARY["own"] = Tokenizer.from_file(PATH)
        LIBRARY["own"].encode_special_tokens = True
    return LIBRARY["own"].encode(text, add_special_tokens=False).ids


def brute(rows: list[tuple]) -> list[tuple]:
    """(doc_id, start, n_tokens, crc) of rows with distinct ids, nulls last."""
    found, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(encoder_ids(text or "") + [2], "<u4").tobytes()
        found.append((key, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return found


def test_query_equals_the_library(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(map(tuple, QUERIES["op11_token_files"](spark, folder).collect()))
    assert found == brute([tuple(r) for r in rows])


def test_round_trip_over_many_shards(spark, tmp_path):
    rows = [(k * 7 % 501, f"word{k} " * (k % 9)) for k in range(501)] + [(None, "nameless"), (1_000, None), (1_001, "")]
    rows.append((2_000, "long text, " * 20_000))
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, start string").repartition(5)
    path = tokenfiles.write(frame, str(tmp_path / "files"), PATH, settings=SMALL)
    back = tokenfiles.read(spark, path).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.start, r.n_tokens, r.ids_crc32) for r in back) == [
        (k is None, k or 0, *rest) for k, *rest in brute(rows)
    ]
    texts = dict(rows)
    assert all(r.ids == [*encoder_ids(texts[r.doc_id] or ""), 2] for r in back)
    assert spark.read.parquet(f"{path}/manifest").count() > 5


def test_short_access_opens_only_what_is_wanted(spark, tmp_path):
    rows = [(k, f"document number {k}") for k in range(300)] + [(None, "nameless")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    path = tokenfiles.write(frame, str(tmp_path / "files"), PATH, settings=SMALL)
    found = tokenfiles.read(spark, path, keys=[7, 299, None, 5_000]).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found) == [(False, 7), (False, 299), (True, 0)]
    assert next(r.ids for r in found if r.doc_id == 7) == [*encoder_ids("document number 7"), 2]
    assert tokenfiles.read(spark, path, keys=[5_000]).isEmpty()


def test_equal_keys_and_rows_stay(spark, tmp_path):
    rows = [(5, "same")] * 40 + [(5, "other")] * 3 + [(4, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    back = tokenfiles.digests(frame, str(tmp_path / "files"), PATH).orderBy("start").collect()
    assert [r.doc_id for r in back] == [4] + [5] * 43
    ends = np.cumsum([r.n_tokens for r in back])
    assert [r.start for r in back] == [0, *ends[:-1]]


def test_strings_as_keys_and_no_rows(spark, tmp_path):
    frame = spark.createDataFrame([("b", "one"), ("a", "two")], "k string, body string")
    back = tokenfiles.digests(frame, str(tmp_path / "a"), PATH, key="k", text="body").orderBy("start").collect()
    assert [r.k for r in back] == ["a", "b"]
    empty = tokenfiles.digests(frame.limit(0), str(tmp_path / "b"), PATH, key="k", text="body")
    assert empty.columns == ["k", "start", "n_tokens", "ids_crc32"] and empty.isEmpty()


def test_broken_files_are_refused(spark, tmp_path):
    frame = spark.createDataFrame([(k, f"text {k} of some") for k in range(50)], "doc_id long, text string").coalesce(1)
    path = tokenfiles.write(frame, str(tmp_path / "files"), PATH)
    (row,) = spark.read.parquet(f"{path}/manifest").collect()
    whole = (tmp_path / "files" / row.file).read_bytes()
    (tmp_path / "files" / "cut.tokens").write_bytes(whole[:-1])
    with pytest.raises(ValueError, match="not a whole shard"):
        list(tokenfiles._documents(path, "cut.tokens", 0, None))
    (tmp_path / "files" / "dictionary.zdict").write_bytes(b"another")
    with pytest.raises(ValueError, match="another dictionary"):
        list(tokenfiles._documents(path, row.file, 0, None))


def test_a_file_of_another_kind_encodes_whole_texts():
    path = tokenizer_path("word_bpe_49k.json")
    own = tokenfiles.ByteLevelEncoder(path)
    assert not own._cuts and json.load(open(path))["pre_tokenizer"]["type"] != "ByteLevel"
    assert own.encode("Some words, some more") == own.whole("Some words, some more")
