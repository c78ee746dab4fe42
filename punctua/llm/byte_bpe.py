"""Byte-level BPE: exact encoding in linear time, and decoding.

The bytes of a piece, mapped to Latin-1, run backwards through an Aho-Corasick automaton
of the reversed tokens; that gives the longest token at every position at once. Encoding
takes the longest token and goes back to a shorter one, or to the token before, whenever
two neighbours could not stand side by side in a true merge result. That compatibility of
two tokens is computed from their merges and kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.rows import column, extended, prepare_workers, unpacked

KEPT = 1 << 18  # pieces and pairs kept in mind by a worker before it starts anew
LONGEST_KEPT = 64  # bytes of a piece worth keeping


class Kept(dict):
    """Computes a missing value and keeps it; emptied when full."""

    def __init__(self, compute):
        super().__init__()
        self.compute = compute

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= KEPT:
            self.clear()
        self[key] = value
        return value


class ByteBPE:
    """Encoder and decoder of a rank file's vocabulary; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pieces = regex.compile(pattern)
        self.halves = {i: self._last_merge(t) for t, i in ranks.items()}
        self.merges = {h: i for i, h in self.halves.items() if h is not None}
        # a token that no merge reaches only stands for a whole piece
        self.reached = {t for t, i in ranks.items() if len(t) == 1 or self.halves[i] is not None}
        self.shorter = {i: self._shorter(t) for t, i in ranks.items()}
        self.longest = ahocorasick.Automaton()
        for token, i in ((t, i) for t, i in ranks.items() if t in self.reached):
            self.longest.add_word(token[::-1].decode("latin-1"), (len(token), i))
        self.longest.make_automaton()
        self.pairs = Kept(self._compatible)
        self.packed = Kept(self._pack)

    @classmethod
    def from_rank_file(cls, content: bytes, pattern: str) -> ByteBPE:
        lines = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte.

        Merges of lower rank are applied, lowest first, until two parts are left.
        """
        parts = [token[i : i + 1] for i in range(len(token))]
        own = self.ranks[token]
        while len(parts) > 2:
            best, at = own, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], own)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                return None  # no merge reaches it
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def _shorter(self, token: bytes) -> int | None:
        """The longest token that merges reach and that is a proper beginning of this one."""
        for n in range(len(token) - 1, 0, -1):
            if token[:n] in self.reached:
                return self.ranks[token[:n]]
        return None

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merging leaves these neighbours apart.

        Undo the merges on both sides of the border, latest first. If the two parts that
        met at the border at that time merge into a token of lower rank than the merge
        just undone, true merging would have joined them across the border.
        """
        left, right = pair
        limit = len(self.tokens) + 256
        while True:
            if self.merges.get((left, right), limit) < limit:
                return False
            l_half, r_half = self.halves[left], self.halves[right]
            # the right one was made first on equal ranks: merging goes from left to right
            if l_half is not None and (r_half is None or left > right):
                limit, left = left, l_half[1]
            elif r_half is not None:
                limit, right = right + 1, r_half[0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        best = [0] * n
        size = [0] * n
        for end, (length, i) in self.longest.iter(piece[::-1].decode("latin-1")):
            start = n - 1 - end
            if length > size[start]:
                size[start], best[start] = length, i
        open_ = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, best[0]
        while True:
            end = at + len(self.tokens[token])
            if open_[end] and (not out or self.pairs[out[-1], token]):
                out.append(token)
                if end == n:
                    return out
                at, token = end, best[end]
            elif (less := self.shorter[token]) is not None:
                token = less
            else:
                open_[at] = 0  # no token goes on from here
                token = out.pop()
                at -= len(self.tokens[token])

    def _pack(self, piece: str) -> bytes:
        return np.array(self.encode_piece(piece.encode()), "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        packed, pack = self.packed, self._pack
        found = self.pieces.findall(text)
        return b"".join([packed[p] if len(p) <= LONGEST_KEPT else pack(p) for p in found])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@cache
def _bpe(content: bytes, pattern: str) -> ByteBPE:
    return ByteBPE.from_rank_file(content, pattern)


def encode_and_decode(
    df: DataFrame,
    rank_file: str,
    pattern: str,
    text: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` (all columns or those of ``keep``) with ``n_tokens``, ``ids``, ``decoded``.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers, as in token
    files; ``decoded`` the bytes they stand for. Texts of any length are encoded whole, in time
    linear in it; an empty table stays empty. Matches of ``pattern`` are encoded each on
    its own, without special tokens. A null text counts as empty and has no ids; rows are
    independent of each other, so repeated ones are alike. Columns with the new names are
    replaced. The rank file is read on the driver and sent along (its size is that of the
    vocabulary, not of the table).
    """
    prepare_workers(df.sparkSession)
    with open(rank_file, "rb") as f:
        vocabulary = df.sparkSession.sparkContext.broadcast(f.read())
    kept = df.columns if keep is None else list(keep)
    whole = F.struct(*(column(c) for c in kept)).alias("row")
    rows = df.select(whole, F.coalesce(column(text), F.lit("")).alias("body"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary.value, pattern)
        for batch in batches:
            ids = [bpe.encode(t) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([bpe.decode(i) for i in ids], pa.binary()),
                ],
                names=["row", "n_tokens", "ids", "decoded"],
            )

    schema = extended(rows.select("row"), "n_tokens bigint, ids binary, decoded binary")
    coded = rows.mapInArrow(code, schema)
    return unpacked(coded, "n_tokens", "ids", "decoded")
