"""Runs of words that repeat with a period, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, of max(24, 3 q)
words or more, that no neighbouring word extends keeping period q.

The words of many documents lie in one array, each document followed by a mark of its
own. Prefix doubling gives the suffix array and, on the way, a name for the substring
of 2^k words at every place: equal names, equal words. All occurrences of a block of
2^k words are one range of the suffix array; a wavelet tree over it answers "the
first occurrence behind place x" (range successor).

A run of period q holds an aligned block of 2^k words, with 2^k <= max(8, q), together
with its copy q words on, because the run is at least 3 q words long. So for every dyadic
block the occurrences in the next 2^(k+1) words are asked for. A block whose own
period is half its length or less occurs in progressions; each is jumped over as a
whole, and the distances between the first and between the last occurrences of two
progressions are candidates, as are those of single occurrences. Every candidate is
extended both ways by comparing names (exact, no hashing), which gives its run; of equal
stretches the smallest period stays.

Words hold no ASCII white space and are compared as they are. A null text has no words
and an empty collapsed text; texts of any length are processed whole, in memory of
some 100 bytes a word. Documents never mix: no stretch crosses a mark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from postrank.llm.bpe import text_blocks

#: Least words in a run, and least periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The smallest blocks have 2^3 words.
FIRST_LEVEL = 3
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"
RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Names:
    """Prefix doubling over an array that ends with a value found nowhere else.

    ``levels[k][i]`` names the substring of 2^k from i: the first place of its class in
    the order of suffixes. Above the last level every name is different.
    """

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        sizes = np.bincount(codes)
        start = np.cumsum(sizes) - sizes
        now = start[codes].astype(np.int32)
        self.levels = [now]
        active = np.flatnonzero(sizes[codes] > 1)
        width = 1
        while len(active):
            beside = active + width  # within the array: what reaches its end is no longer active
            key = now[active].astype(np.int64) * n + now[beside]
            order = np.argsort(key, kind="stable")
            active, key = active[order], key[order]
            old = now[active]
            at = np.arange(len(active))
            first_of_old = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
            begins = np.concatenate([[True], key[1:] != key[:-1]])
            first = np.maximum.accumulate(np.where(begins, at, 0))
            now = now.copy()
            now[active] = old + (first - first_of_old).astype(np.int32)
            self.levels.append(now)
            class_sizes = np.diff(np.concatenate([np.flatnonzero(begins), [len(active)]]))
            active = np.sort(active[np.repeat(class_sizes, class_sizes) > 1])
            width *= 2
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[now] = np.arange(n)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values from i on equal those from j on."""
        i, j, length = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step = (self.levels[k][i] == self.levels[k][j]).astype(np.int64) << k
            i += step
            j += step
            length += step
        return length

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values before i equal those before j; i < j."""
        i, j, length = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            width = 1 << k
            a, b = np.maximum(i - width, 0), np.maximum(j - width, 0)
            step = ((i >= width) & (self.levels[k][a] == self.levels[k][b])).astype(np.int64) << k
            i -= step
            j -= step
            length += step
        return length


class WaveletTree:
    """The values 0 to n - 1 in some order, level by level as bits (a wavelet matrix)."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros_before, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros_before.append(before)
            self.zeros.append(int(before[-1]))
            values = np.concatenate([values[zero], values[~zero]])

    def _down(self, level: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        before, zeros = self.zeros_before[level], self.zeros[level]
        low0, high0 = before[low].astype(np.int64), before[high].astype(np.int64)
        return np.where(ones, zeros + low - low0, low0), np.where(ones, zeros + high - high0, high0), high0 - low0

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of places low to high - 1 that is ``least`` or more, else -1."""
        smaller = np.zeros(len(low), np.int64)
        a, b = low, high
        for level in range(self.bits):
            ones = (least >> (self.bits - 1 - level) & 1) == 1
            a, b, zeros = self._down(level, a, b, ones)
            smaller += np.where(ones, zeros, 0)
        over = least >> self.bits > 0
        found = ~over & (smaller < high - low)
        value, left = np.zeros(len(low), np.int64), smaller
        a, b = low, high
        for level in range(self.bits):
            before = self.zeros_before[level]
            zeros = (before[b] - before[a]).astype(np.int64)
            ones = left >= zeros
            left = np.where(ones, left - zeros, left)
            value = value << 1 | ones
            a, b, _ = self._down(level, a, b, ones & found)
        return np.where(found, value, -1)


def candidates(names: Names, tree: WaveletTree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance): distances at which runs may repeat the aligned blocks of a level."""
    width, held = 1 << level, names.levels[level]
    sizes = np.bincount(held, minlength=len(held) + 1)
    start = np.arange(0, len(held), width)
    start = start[sizes[held[start]] > 1]
    low = held[start].astype(np.int64)
    high = low + sizes[low]
    period, last = np.zeros(len(start), np.int64), start.copy()
    asked, now = np.arange(len(start)), start.copy()
    seen_block, seen_at = [], []
    while len(asked):
        found = tree.successor(low[asked], high[asked], now + 1)
        near = (found >= 0) & (found < start[asked] + 2 * width)
        asked, now, found = asked[near], now[near], found[near]
        seen_block.append(asked)
        seen_at.append(found)
        gap = found - now
        row = np.flatnonzero(gap <= width // 2)  # a progression: to its last occurrence at once
        if len(row):
            step = gap[row]
            end = found[row] + names.forward(now[row], found[row])
            jump = now[row] + (end - width - now[row]) // step * step
            block = asked[row]
            period[block] = step
            own = now[row] == start[block]
            last[block[own]] = jump[own]
            found = found.copy()
            found[row] = jump
            seen_block.append(block)
            seen_at.append(jump)
        now = found
    if not seen_block:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    block, at = np.concatenate(seen_block), np.concatenate(seen_at)
    first = start.copy()
    periodic = np.flatnonzero(period)
    back = names.backward(start[periodic], start[periodic] + period[periodic])
    first[periodic] -= back // period[periodic] * period[periodic]
    place = np.concatenate([start[block]] * 3)
    distance = np.concatenate([at - start[block], at - first[block], at - last[block]])
    fits = (distance > 0) & (distance < 2 * width) & (place + distance < len(held))
    return place[fits], distance[fits]


def runs_of(codes: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period.

    ``codes`` is one array of words as small numbers, with values found nowhere else
    at both ends and wherever a run must not cross.
    """
    names = Names(codes)
    if len(names.levels) <= FIRST_LEVEL:
        return np.empty((0, 3), np.int64)
    tree = WaveletTree(names.suffixes)
    found = [candidates(names, tree, k) for k in range(FIRST_LEVEL, len(names.levels))]
    place, distance = (np.concatenate(x) for x in zip(*found))
    pair = np.unique(place * len(codes) + distance)
    place, distance = pair // len(codes), pair % len(codes)
    ahead, behind = names.forward(place, place + distance), names.backward(place, place + distance)
    rows = np.stack([place - behind, behind + distance + ahead, distance], axis=1)
    rows = rows[rows[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * distance)]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # Of one stretch the smallest period.
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _block(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each text of a block; no text is null."""
    split = pc.ascii_split_whitespace(texts)
    words, offsets = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    some = pc.not_equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    words = words.filter(pa.array(some))
    ends = np.concatenate([[0], np.cumsum(some)])[offsets]  # words before each text
    sizes = np.diff(ends)
    coded = words.dictionary_encode()
    code, kinds = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    # Too few words hold no run; the others lie one after another, with marks between.
    long = np.flatnonzero(sizes >= LEAST_WORDS)
    places = np.repeat(sizes >= LEAST_WORDS, sizes)
    begin = np.cumsum(sizes[long] + 1) - sizes[long]  # behind the first mark
    line = np.empty(int(sizes[long].sum()) + len(long) + 1, np.int64)
    marks = np.concatenate([[0], begin + sizes[long]]) if len(long) else np.zeros(1, np.int64)
    line[marks] = kinds + np.arange(len(marks))
    inside = np.ones(len(line), bool)
    inside[marks] = False
    line[inside] = code[places]
    rows = runs_of(line) if len(long) else np.empty((0, 3), np.int64)
    of = np.searchsorted(begin, rows[:, 0], side="right") - 1
    first = rows[:, 0] - begin[of] if len(rows) else rows[:, 0]
    text = long[of] if len(rows) else np.empty(0, np.int64)
    # What lies behind the first period of a run goes.
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, ends[text] + first + rows[:, 2], 1)
    np.add.at(edge, ends[text] + first + rows[:, 1], -1)
    kept = np.cumsum(edge[:-1]) == 0
    left = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(kept)])[ends].astype(np.int32)), words.filter(pa.array(kept)).cast("string"))
    struct = pa.StructArray.from_arrays([pa.array(x) for x in (first, rows[:, 1].copy(), rows[:, 2].copy())], ["start", "length", "period"])
    counts = np.bincount(text, minlength=len(texts))
    runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), struct)
    return runs.cast(RUN_TYPE), pc.binary_join(left, " ")


def periodic(texts: pa.Array) -> pa.StructArray:
    """(runs, collapsed) of each text; null counts as empty."""
    blocks = [_block(b) for b in text_blocks(texts.cast(pa.large_string()).fill_null(""))]
    if blocks:
        runs, collapsed = (pa.concat_arrays(x) for x in zip(*blocks))
    else:
        runs, collapsed = pa.array([], RUN_TYPE), pa.array([], pa.string())
    return pa.StructArray.from_arrays([runs, collapsed], ["runs", "collapsed"])


def periodic_column(text: Column) -> Column:
    """A struct of a text column: ``runs`` (start and length in words, period; by start,
    then period) and ``collapsed``, the words joined by one space without those that any
    run holds behind its first period.

    The column is null nowhere; null and empty texts have no run and an empty collapsed
    text. Repeated rows have equal results, whatever lies beside them.
    """

    def found(texts: pa.Array) -> pa.Array:
        return periodic(texts)

    return F.arrow_udf(found, f"runs {RUN}, collapsed string")(text)
