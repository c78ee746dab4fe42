from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from punctua.llm.byte_bpe import ByteBPE, encode_and_decode

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(FILE, "rb") as f:
    CONTENT = f.read()
RANKS = {base64.b64decode(t): int(i) for t, i in map(bytes.split, CONTENT.splitlines())}
TRUE = tiktoken.Encoding(
    "true", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
OURS = ByteBPE.from_rank_file(CONTENT, public_tokenizers.PATTERN)


def ids(text):
    return np.frombuffer(OURS.encode(text), "<u4").tolist()


def test_every_token_as_a_piece():
    """Merging the bytes of a token gives the token; the search agrees without the shortcut."""
    for token, i in list(RANKS.items())[::7]:
        assert OURS.encode_piece(token) == [i]
        longer = token + token
        assert OURS.encode_piece(longer) == TRUE._encode_single_piece(longer)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    assert ids(text) == TRUE.encode_ordinary(text)
    assert OURS.decode(OURS.encode(text)) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(sorted(RANKS)), max_size=12).map(b"".join))
def test_any_bytes(piece):
    if piece:
        assert OURS.encode_piece(piece) == TRUE._encode_single_piece(piece)


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9000, "é" * 9000, " " * 9000, "<|endoftext|>"])
def test_long_runs(text):
    assert ids(text) == TRUE.encode_ordinary(text)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = encode_and_decode(docs, FILE, public_tokenizers.PATTERN).collect()
    assert len(out) == docs.count()
    for r in out:
        want = TRUE.encode_ordinary(r.text)
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert bytes(r.decoded) == r.text.encode()


def test_nulls_and_clashing_columns(rows):
    df = rows("doc_id int, text string, ids int", [(1, None, 5), (None, "", 6), (2, "hé", None), (2, "hé", None)])
    df = df.withColumns({"row": df.doc_id, "body": df.text})
    out = encode_and_decode(df, FILE, public_tokenizers.PATTERN).collect()
    assert sorted(r.n_tokens for r in out) == [0, 0, len(ids("hé")), len(ids("hé"))]
    assert set(out[0].asDict()) == {"doc_id", "text", "row", "body", "n_tokens", "ids", "decoded"}
    empty = rows("doc_id int, text string", [])
    assert encode_and_decode(empty, FILE, public_tokenizers.PATTERN).collect() == []


def test_tokens_that_no_merge_reaches_stand_for_whole_pieces_only():
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"xy": 257, b"xyzw": 258}
    theirs = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ours = ByteBPE(ranks, public_tokenizers.PATTERN)
    for text in ("abc", "abcd", "dabc", "xyzw", "xyzwx", "axyzw", "abcabc"):
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == theirs.encode_ordinary(text)
