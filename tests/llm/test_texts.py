from __future__ import annotations

import re

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from punctua.llm import texts

some = st.lists(st.text(alphabet="aAzZ09é ßſ\t\n.\x00|", max_size=40), max_size=6)


def by_text(w):
    out = [[] for _ in w.per_doc]
    for i, d in enumerate(w.doc):
        out[d].append(w.data[w.start[i] : w.end[i]].decode())
    return out


@given(some)
def test_words_match_patterns(bodies):
    low = [texts.lower_bytes(b) for b in bodies]
    for table, pattern in (
        (texts.NOT_SPACE, r"[^\x20\x09-\x0D]+"),
        (texts.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    ):
        got = by_text(texts.words(low, table)) if low else []
        assert got == [re.findall(pattern, b.decode()) for b in low]


@given(some)
def test_codes_depend_on_the_words_alone(bodies):
    low = [texts.lower_bytes(b) for b in bodies]
    together = texts.words(low, texts.NOT_SPACE) if low else None
    seen = {}
    for i in range(len(together.code) if low else 0):
        word = together.data[together.start[i] : together.end[i]]
        alone = texts.words([word], texts.NOT_SPACE).code[0]
        assert together.code[i] == alone
        assert seen.setdefault(int(alone), word) == word


def test_codes_over_several_pieces(monkeypatch):
    body = b" ".join(b"w%d" % (i % 97) for i in range(3000)) + b" " + b"x" * 700
    want = texts.words([body], texts.NOT_SPACE).code
    monkeypatch.setattr(texts, "BLOCK", 256)
    texts._tables.cache_clear()
    try:
        assert np.array_equal(texts.words([body], texts.NOT_SPACE).code, want)
    finally:
        texts._tables.cache_clear()


def test_blocks_keep_every_text():
    bodies = [b"", b"a" * 10, b"", b"b" * 30, b"c"]
    got = [(first, len(block)) for first, block in texts.blocks(bodies, 12)]
    assert sum(n for _, n in got) == 5 and [f for f, _ in got] == sorted(f for f, _ in got)
    assert [t for _, block in texts.blocks(bodies, 12) for t in block] == bodies
    assert list(texts.blocks([])) == []
