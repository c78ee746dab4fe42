"""Words of whole texts as numpy arrays: bounds, 64-bit codes and codes of word runs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np

BLOCK = 1 << 20  # bytes of text worked on at once
_WORD = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_table(members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# Bytes of words, after A-Z became a-z. Bytes from 0x80 belong to letters beyond ASCII.
NOT_SPACE = ~byte_table([*range(0x09, 0x0E), 0x20])
ALPHANUMERIC = byte_table([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


class Words(NamedTuple):
    """Words of several texts, in order; ``doc`` counts the texts from 0."""

    data: bytes
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    per_doc: np.ndarray

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (exclusive), one space between each two."""
        spans = zip(self.start[first:last], self.end[first:last], strict=True)
        return b" ".join([self.data[a:b] for a, b in spans])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    powers = np.cumprod(np.full(BLOCK + 1, _BASE, np.uint64)) * np.uint64(_INVERSE)
    inverses = np.cumprod(np.full(BLOCK + 1, _INVERSE, np.uint64)) * np.uint64(_BASE)
    return values, powers, inverses


def _codes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial code of each span, from differences of running sums, piece by piece."""
    values, powers, inverses = _tables()
    at_start = np.empty(len(start), np.uint64)
    at_end = np.empty(len(end), np.uint64)
    shift = np.empty(len(start), np.uint64)
    carry = np.uint64(0)
    for a in range(0, max(len(buffer), 1), BLOCK):
        piece = buffer[a : a + BLOCK]
        sums = np.zeros(len(piece) + 1, np.uint64)
        scale = np.uint64(pow(_BASE, a, 1 << 64))
        np.cumsum(values[piece] * powers[: len(piece)] * scale, out=sums[1:])
        sums += carry
        carry = sums[-1]
        i, j = np.searchsorted(start, [a, a + len(piece)])
        at_start[i:j] = sums[start[i:j] - a]
        back = np.uint64(pow(_INVERSE, a, 1 << 64))
        shift[i:j] = inverses[start[i:j] - a] * back
        i, j = np.searchsorted(end, [a, a + len(piece)], side="right")
        at_end[i:j] = sums[end[i:j] - a]
    lengths = (end - start).astype(np.uint64)
    return mixed((at_end - at_start) * shift + lengths * np.uint64(_BASE))


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 with A-Z as a-z, nothing else changed; empty for None."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def blocks(texts: list[bytes], size: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about ``size`` bytes, with the index of their first."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield first, texts[first:i]
            first, total = i, 0
        total += len(text) + 1
    if first < len(texts):
        yield first, texts[first:]


def words(texts: list[bytes], inside: np.ndarray) -> Words:
    """Maximal runs of bytes for which ``inside`` holds; a line feed must not be one."""
    data = b"\n".join(texts)
    buffer = np.frombuffer(data, np.uint8)
    edge = np.zeros(len(buffer) + 2, np.int8)
    edge[1:-1] = inside[buffer]
    step = np.diff(edge)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    doc = np.searchsorted(begins, start, side="right") - 1
    code = _codes(buffer, start, end)
    return Words(data, doc, start, end, code, np.bincount(doc, minlength=len(texts)))


def _combined(parts: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(parts[0]), len(parts), np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for i, part in enumerate(parts):
        total = mixed(total + part * np.uint64((_BASE * (2 * i + 3)) & _WORD))
    return total


def runs(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and code of every run of ``width`` words inside one text."""
    n = len(w.code) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.flatnonzero(w.doc[:n] == w.doc[width - 1 :])
    return first, _combined([w.code[first + i] for i in range(width)])


def whole_short(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and code of the whole word sequence of texts with 1 to ``width`` - 1 words."""
    begin = np.concatenate(([0], np.cumsum(w.per_doc)[:-1]))
    docs, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for n in range(1, width):
        d = np.flatnonzero(w.per_doc == n)
        docs.append(d)
        codes.append(_combined([w.code[begin[d] + i] for i in range(n)]))
    return np.concatenate(docs), np.concatenate(codes)
