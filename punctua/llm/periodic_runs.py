"""Runs of repeating words, found over a difference cover and a harmonic grid.

Words of several texts become numbers, one after the other, between separators that occur
once. Whether two places go on alike, and how far, is a longest common extension (LCE): a
difference cover of COVER residues holds, for any two places, one small step that takes both
to sampled places. So only the suffixes at sampled places are sorted (by their first COVER
words, then by doubling from sample to sample); an extension compares the few words up to the
samples and takes the rest as the least common prefix between the two in sorted order, from a
sparse table.

A run of period q and at least ``times`` times its length has (times - 1) * q places in a row
that equal the place q further on. Looking at every (times - 1) * q-th place for each q
therefore meets every run; these places are n / (times - 1) * (1 + 1/2 + 1/3 ...) in all.
Where both words are equal, the extensions to either side give the run's ends. A stretch that
is met with several periods has all multiples of its smallest one, which is kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua.llm import texts
from punctua.llm.rows import column, extended, prepare_workers, unpacked

COVER = 21
RESIDUES = (3, 6, 7, 12, 14)  # their differences modulo COVER are all residues
CANDIDATES = 1 << 18  # pairs of places extended at once
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _steps() -> np.ndarray:
    """Smallest step that takes places of two residues to sampled ones."""
    inside = np.isin(np.arange(3 * COVER) % COVER, RESIDUES)
    a, b = np.indices((COVER, COVER))
    both = np.array([inside[a + s] & inside[b + s] for s in range(COVER)])
    return both.argmax(axis=0)


STEPS = _steps()


class Extensions:
    """Longest common extensions to the right of a sequence whose last number occurs once."""

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        self.numbers = np.concatenate((numbers, np.full(COVER, -1, numbers.dtype)))
        self.sample = np.flatnonzero(np.isin(np.arange(n) % COVER, RESIDUES))
        self.index = np.full(n + COVER, -1, np.int64)
        self.index[self.sample] = np.arange(len(self.sample))
        order, levels = self._sorted()
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.table = self._minima(self._neighbours(order, levels))

    def _sorted(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Order of the sampled suffixes; ranks by their first COVER, 2 COVER, 4 COVER ... words."""
        bits = max(1, int(self.numbers.max()).bit_length())
        at_once = 62 // bits
        keys = []
        for first in range(0, COVER, at_once):
            key = np.zeros(len(self.sample), np.int64)
            for i in range(first, min(first + at_once, COVER)):
                key = (key << bits) | np.maximum(self.numbers[self.sample + i], 0)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        changed = np.zeros(len(order), bool)
        changed[:1] = True
        for key in keys:
            changed[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.maximum.accumulate(np.where(changed, np.arange(len(order)), 0))
        levels, length = [rank], COVER
        while True:
            first = rank[order]
            same = first[1:] == first[:-1]
            slots = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
            if not len(slots):
                return order, levels
            tied = order[slots]
            then = self._after(rank, self.sample[tied], length)
            by = np.lexsort((then, rank[tied]))
            order[slots] = tied = tied[by]
            head, then = rank[tied], then[by]
            new = np.ones(len(slots), bool)
            new[1:] = (head[1:] != head[:-1]) | (then[1:] != then[:-1])
            rank = rank.copy()
            rank[tied] = np.maximum.accumulate(np.where(new, slots, 0))
            levels.append(rank)
            length *= 2

    def _after(self, rank: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
        """Rank of the suffix ``length`` words further on, -1 beyond the end."""
        on = np.minimum(at + length, len(self.index) - 1)
        index = self.index[on]
        return np.where(index < 0, -1, rank[index])

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that each sorted suffix has in common with the one before."""
        a, b = self.sample[order[:-1]], self.sample[order[1:]]
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            length = COVER << k
            one, two = (self._after(levels[k], x + common, 0) for x in (a, b))
            common += np.where((one == two) & (one >= 0), length, 0)
        open_ = np.arange(len(a))
        for _ in range(COVER):
            at, to = a[open_] + common[open_], b[open_] + common[open_]
            open_ = open_[self.numbers[at] == self.numbers[to]]
            common[open_] += 1
        return common

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table = [values]
        while 2 << len(table) <= 2 * len(values):
            half, last = 1 << (len(table) - 1), table[-1]
            table.append(np.minimum(last[:-half], last[half:]))
        return table

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from places ``i`` and ``j`` on, i <> j."""
        steps = STEPS[i % COVER, j % COVER]
        common = np.zeros(len(i), np.int64)
        open_ = np.arange(len(i))
        for s in range(COVER):
            short = open_[steps[open_] > s]
            differ = self.numbers[i[short] + s] != self.numbers[j[short] + s]
            common[short] = s + 1 - differ
            if differ.any():
                open_ = np.setdiff1d(open_, short[differ], assume_unique=True)
            if len(short) == differ.sum():
                break
        one, two = (self.place[self.index[x[open_] + steps[open_]]] for x in (i, j))
        low, high = np.minimum(one, two), np.maximum(one, two)
        width = high - low
        level = np.frexp(width.astype(np.float64))[1] - 1
        least = np.empty(len(open_), np.int64)
        for k in np.unique(level):
            here = level == k
            row = self.table[k]
            least[here] = np.minimum(row[low[here]], row[high[here] - (1 << int(k))])
        common[open_] = steps[open_] + least
        return common


def find_runs(numbers: np.ndarray, doc: np.ndarray, longest: int, least: int, times: int) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and end.

    ``numbers`` begins and ends with a number that occurs once, and has one between any two
    documents; ``doc`` tells the document of each place, ``longest`` the words of the longest.
    """
    n = len(numbers)
    last = np.int64(n - 1)
    right = left = None
    found = np.zeros((0, 3), np.int64)
    waiting, held = [], 0

    def extend() -> np.ndarray:
        nonlocal right, left
        i, q = (np.concatenate(x) for x in zip(*waiting, strict=True))
        if right is None:
            right, left = Extensions(numbers), Extensions(numbers[::-1].copy())
        on, back = right(i, i + q), left(last - i, last - i - q)
        start, end = i - back + 1, i + q + on
        runs = np.column_stack((start, end, q))[end - start >= np.maximum(least, times * q)]
        runs = np.concatenate((found, runs))
        runs = runs[np.lexsort(runs.T[::-1])]
        new = np.ones(len(runs), bool)
        new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
        return runs[new]

    for q in range(1, longest // times + 1):
        step = (times - 1) * q
        a, b = numbers[: n - q : step], numbers[q::step]
        k = np.flatnonzero(a == b)
        if len(k):
            i = k * step
            i = i[doc[i] == doc[i + q]]
            waiting.append((i, np.full(len(i), q)))
            held += len(i)
            if held >= CANDIDATES:
                found = extend()
                waiting, held = [], 0
    return extend() if held else found


def runs_of_texts(bodies: list[bytes], least: int, times: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """Number of words, runs (start, length, period) and collapsed text of each text."""
    for _, block in texts.blocks(bodies):
        words = [body.split() for body in block]  # at the six ASCII blanks
        known: dict[bytes, int] = {}
        sizes = np.array([len(w) for w in words])
        total = int(sizes.sum()) + len(words) + 1
        numbers = np.empty(total, np.int64)
        doc = np.empty(total, np.int64)
        begins = np.cumsum(sizes + 1) - sizes  # after a separator each
        for d, (own, at) in enumerate(zip(words, begins.tolist(), strict=True)):
            numbers[at : at + len(own)] = [known.setdefault(w, len(known)) for w in own]
            doc[at - 1 : at + len(own)] = d
        doc[-1] = -1
        edges = np.append(begins - 1, total - 1)
        numbers[edges] = len(known) + np.arange(len(edges))
        runs = find_runs(numbers, doc, int(sizes.max(initial=0)), least, times)
        of = doc[runs[:, 0]]
        bounds = np.searchsorted(of, np.arange(len(words) + 1))
        for d, own in enumerate(words):
            mine = runs[bounds[d] : bounds[d + 1]] - np.array([begins[d], begins[d], 0])
            if not len(mine):
                yield len(own), mine, b" ".join(own)
                continue
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, mine[:, 0] + mine[:, 2], 1)
            np.add.at(edge, mine[:, 1], -1)
            kept = np.cumsum(edge[:-1]) == 0
            mine = np.column_stack((mine[:, 0], mine[:, 1] - mine[:, 0], mine[:, 2]))
            yield len(own), mine[np.lexsort((mine[:, 2], mine[:, 0]))], b" ".join(compress(own, kept))


def periodic_runs(
    df: DataFrame, text: str = "text", keep: Sequence[str] | None = None, least: int = 6, times: int = 4
) -> DataFrame:
    """Rows of ``df`` (all columns or those of ``keep``) with ``n_words``, ``runs``, ``collapsed``.

    Words are split at ASCII blanks and counted from 0. A run is a stretch of at least ``least``
    words and ``times`` (2 or more) times its smallest period, that cannot be extended. ``runs``
    lists (start, length, period) by start and period; ``collapsed`` joins by one space the words
    that no run contains after its first period. Null and empty texts have no words, no run and
    an empty collapsed text. A text of any length is worked on whole, in memory linear in its
    words; rows are independent, so repeated ones are alike, and an empty table gives an empty
    one. Columns with the new names are replaced.
    """
    if times < 2:
        raise ValueError("a run repeats its period at least twice")
    prepare_workers(df.sparkSession)
    kept = df.columns if keep is None else list(keep)
    whole = F.struct(*(column(c) for c in kept)).alias("row")
    rows = df.select(whole, F.coalesce(column(text), F.lit("")).alias("body"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [t.encode() for t in batch.column("body").to_pylist()]
            counts, tables, collapsed = [], [np.zeros((0, 3), np.int64)], []
            for n, runs, rest in runs_of_texts(bodies, least, times):
                counts.append(n)
                tables.append(runs)
                collapsed.append(rest.decode())
            offsets = np.cumsum([0, *(len(t) for t in tables[1:])]).astype(np.int32)
            fields = np.concatenate(tables).T
            structs = pa.StructArray.from_arrays([pa.array(f) for f in fields], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), structs),
                    pa.array(collapsed, pa.string()),
                ],
                names=["row", "n_words", "runs", "collapsed"],
            )

    schema = extended(rows.select("row"), f"n_words bigint, runs array<{RUN}>, collapsed string")
    return unpacked(rows.mapInArrow(search, schema), "n_words", "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equals."""
    none = F.lit(None).cast(RUN)
    return F.reduce(
        runs, none,
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )


def planted(text: Column, id: Column) -> Column:
    """The text, its words joined by one space and made periodic from a place on, for a tenth of all ids.

    With h the CRC-32 of the id as text and g = h div 10, if h % 10 = 0 each of the n words from
    a = g % n on becomes word a + (i - a) % p, where p = 1 + (n - a) div (3 + g % 8).
    """
    h = F.crc32(id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    # whole arrays: a lambda per word would compute the words anew for each
    times = F.ceil((n - a) / p).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, p), times))
    changed = F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(changed, " ")).otherwise(text)
