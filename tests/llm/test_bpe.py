from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from layerline.llm import bpe
from layerline.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
STREAM = bpe.Utf8Stream({rank: token for token, rank in RANKS.items()})


def ids_of(text: str) -> list[int]:
    return np.frombuffer(ENCODER.encode(text), "<u4").tolist()


@given(st.text(max_size=60))
@settings(max_examples=400, deadline=None)
def test_any_text_like_the_library(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


@given(st.text(alphabet="abeht ing's\n\té中!-", max_size=80))
@settings(max_examples=400, deadline=None)
def test_dense_merges_like_the_library(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 5_000, " " * 2_000 + "x", "thandre" * 900, "-=" * 800])
def test_long_matches_leave_in_parts(text):
    assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_small_tables_give_the_same(monkeypatch):
    monkeypatch.setattr(bpe, "STATE_LIMIT", 20)
    monkeypatch.setattr(bpe, "PAIR_LIMIT", 20)
    monkeypatch.setattr(bpe, "WORD_LIMIT", 5)
    tight = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ["the there then thence", "straightforwardness" * 40, "über größere Straßen"]:
        assert np.frombuffer(tight.encode(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)


@given(st.binary(max_size=30))
@settings(max_examples=300, deadline=None)
def test_stream_decodes_any_bytes(data):
    ids = [RANKS[data[i : i + 1]] for i in range(len(data))]
    text = STREAM.feed(ids) + STREAM.close()
    try:
        assert text == data.decode("utf-8")
    except UnicodeDecodeError:
        assert "�" in text


def test_frames(spark):
    texts = [(1, "Ein Satz, two words."), (2, ""), (3, None), (None, "key"), (1, "Ein Satz, two words."), (4, "x" * 50_000)]
    frame = spark.createDataFrame([(k, t, "z") for k, t in texts], "doc_id long, text string, ids string")
    encoded = bpe.encode(frame, PATH, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == sorted(
        (str(k), LIBRARY.encode_ordinary(t or "")) for k, t in texts
    )
    decoded = bpe.decode(encoded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in decoded) == sorted((str(k), t or "") for k, t in texts)
    assert all(r.text_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for r in decoded)
    assert bpe.encode(frame.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    assert bpe.decode(encoded.limit(0), PATH).count() == 0


def test_query_on_whole_table(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op4_byte_bpe"](spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = LIBRARY.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
