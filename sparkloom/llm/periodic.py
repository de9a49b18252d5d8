"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends.  Every run of at least four periods holds
an aligned block of 2^k words, 2^k <= q < 2^(k+1), among its first 2q words,
and that block occurs again q words later.  So for each k the aligned blocks of
2^k words ask for their occurrences that start 2^k to 2^(k+1) - 1 words
further on: a block is an interval of the suffix array, and a wavelet tree
over that array gives the first occurrence in a window of positions (range
successor).  Occurrences in so short a window form an arithmetic progression, so its
first two members and their number give all of them; their distances
are the candidate periods.  Longest common extensions, from the ranks of the
blocks of 2^k words that sorting the suffixes by doubling leaves behind, turn
a candidate into its whole run.

Scale.  A text is worked on where it is read: nothing is shuffled.  The texts
of a task are joined to about ``BATCH_WORDS`` words at a time, each with word
numbers and an end mark of its own, so that no match crosses texts and the
array work is shared; memory follows that number or the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import free_name

BATCH_WORDS = 1 << 17
MIN_LENGTH, MIN_EXPONENT = 6, 4
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RUNS_DDL = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _firsts(new: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For sorted entries at ``places``, the place of the first entry of each one's group."""
    return np.maximum.accumulate(np.where(new, places, 0))


def sorted_suffixes(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``codes`` (whose last is unique), and for k = 0, 1, ... the ranks of the 2^k codes from each place.

    A rank is the first place of the block's interval in the suffix array.  The
    list ends before the k for which all blocks differ.
    """
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    ordered = codes[sa]
    act = np.arange(n)
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = _firsts(new, act)
    ranks, width = [], 1
    while True:
        more = np.concatenate([~new[1:], [False]]) | ~new  # in a group of several
        act = act[more]
        if not len(act):
            return sa, ranks
        ranks.append(rank)
        at = sa[act]
        after = at + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sa[act], key = at[order], key[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[sa[act]] = _firsts(new, act)
        width *= 2


class WaveletTree:
    """Range queries on the places of numbers by value: a wavelet matrix, one bit vector a level."""

    def __init__(self, values: np.ndarray):
        self.bits = int(len(values)).bit_length()
        self.ones, self.zeros = [], []
        for b in reversed(range(self.bits)):
            bit = (values >> b & 1).astype(bool)
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[~bit], values[bit]])

    def below(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many of the entries left <= place < right are under ``value`` (at most the number of entries)."""
        count = np.zeros(len(left), np.int64)
        for level, b in enumerate(reversed(range(self.bits))):
            one_l, one_r = self.ones[level][left], self.ones[level][right]
            up = (value >> b & 1).astype(bool)
            count += np.where(up, (right - one_r) - (left - one_l), 0)
            left = np.where(up, self.zeros[level] + one_l, left - one_l)
            right = np.where(up, self.zeros[level] + one_r, right - one_r)
        return count

    def smallest(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The entry with ``k`` smaller ones among those of left <= place < right."""
        value = np.zeros(len(left), np.int64)
        for level, b in enumerate(reversed(range(self.bits))):
            one_l, one_r = self.ones[level][left], self.ones[level][right]
            none = (right - one_r) - (left - one_l)
            up = k >= none
            value |= up.astype(np.int64) << b
            k = np.where(up, k - none, k)
            left = np.where(up, self.zeros[level] + one_l, left - one_l)
            right = np.where(up, self.zeros[level] + one_r, right - one_r)
        return value


def _ahead(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes from places a and b on are equal."""
    start = a
    for k in reversed(range(len(ranks))):
        step = np.where(ranks[k][a] == ranks[k][b], 1 << k, 0)
        a, b = a + step, b + step
    return a - start


def _behind(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes before places a < b are equal."""
    start = a
    for k in reversed(range(len(ranks))):
        w = 1 << k
        far = a >= w
        equal = far & (ranks[k][np.where(far, a - w, 0)] == ranks[k][np.where(far, b - w, 0)])
        step = np.where(equal, w, 0)
        a, b = a - step, b - step
    return start - a


def _candidates(codes: np.ndarray, sa: np.ndarray, ranks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances at which an aligned block occurs again."""
    n = len(codes)
    # a block of one word has a window of one place, the next word
    near = np.flatnonzero(codes[1:] == codes[:-1])
    places, distances = [near], [np.ones(len(near), np.int64)]
    tree = None
    for k in range(1, len(ranks)):
        w = 1 << k
        at = np.arange(0, n, w)
        left = ranks[k][at]
        many = np.bincount(ranks[k], minlength=n)[left]
        at, left, many = (x[many > 1] for x in (at, left, many))
        if not len(at):
            continue
        tree = tree or WaveletTree(sa)
        right = left + many
        low = tree.below(left, right, np.minimum(at + w, n))
        number = tree.below(left, right, np.minimum(at + 2 * w, n)) - low
        at, left, right, low, number = (x[number > 0] for x in (at, left, right, low, number))
        first = tree.smallest(left, right, low)
        step = np.zeros(len(at), np.int64)
        row = np.flatnonzero(number > 1)
        step[row] = tree.smallest(left[row], right[row], low[row] + 1) - first[row]
        # how far the step itself is a period from the block on
        reach = np.zeros(len(at), np.int64)
        reach[row] = step[row] + _ahead(ranks, at[row], at[row] + step[row])
        which = np.repeat(np.arange(len(at)), number)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        d = (first - at)[which] + nth * step[which]
        # a distance that is a multiple of a period of its whole stretch isn't the smallest one
        s = step[which]
        multiple = (s > 0) & (d > s) & (d % np.maximum(s, 1) == 0) & (reach[which] >= d + w)
        places.append(at[which][~multiple])
        distances.append(d[~multiple])
    return np.concatenate(places), np.concatenate(distances)


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``codes``, by start, then period; the last code must be unique."""
    if min_exponent < 4:
        raise ValueError("blocks of half a period are promised to runs of four periods or more")
    sa, ranks = sorted_suffixes(codes)
    if not ranks:
        return np.empty((0, 3), np.int64)
    at, period = _candidates(codes, sa, ranks)
    start = at - _behind(ranks, at, at + period)
    length = at + period + _ahead(ranks, at, at + period) - start
    long = length >= np.maximum(min_length, min_exponent * period)
    found = np.stack([start, length, period], axis=1)[long]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    # a stretch that shows with several periods has the smallest, which divides the others
    same = (found[1:, :2] == found[:-1, :2]).all(axis=1)
    found = found[np.concatenate([[True], ~same])] if len(found) else found
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _batch_runs(texts: list[list[bytes]], min_length: int, min_exponent: int) -> list[tuple[list[dict], bytes]]:
    """Runs and collapsed text of each list of words."""
    base, codes, starts, at = 0, [], [], 0
    for words in texts:
        number = dict(zip(dict.fromkeys(words), range(base, base + len(words))))
        codes.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        base += len(number)
        codes.append(np.array([base]))
        base += 1
        starts.append(at)
        at += len(words) + 1
    found = runs_of(np.concatenate(codes), min_length, min_exponent)
    first = np.searchsorted(found[:, 0], np.array([*starts, at]))
    out = []
    for words, begin, lo, hi in zip(texts, starts, first, first[1:]):
        own = found[lo:hi] - [begin, 0, 0]
        if len(own):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 0] + own[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
        out.append(([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()], b" ".join(words)))
    return out


def _described(schema: pa.Schema, runs_name: str, collapsed_name: str, text_name: str, min_length: int, min_exponent: int):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_name))
            rest = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != text_name]
            at = 0
            while at < batch.num_rows:
                first, words, total = at, [], 0
                while at < batch.num_rows and total < BATCH_WORDS:
                    # on bytes, split() cuts at U+0020 and U+0009 to U+000D alone
                    words.append((texts[at].as_py() or b"").split())
                    total += len(words[-1]) + 1
                    at += 1
                found = _batch_runs(words, min_length, min_exponent)
                new = [pa.array([r for r, _ in found], RUNS), pa.array([c for _, c in found], pa.binary())]
                yield pa.RecordBatch.from_arrays([*(c.slice(first, at - first) for c in rest), *new], schema=schema)

    return run


def periodic_runs(
    docs: DataFrame, text_col: str = "text", *, runs_col: str = "runs", collapsed_col: str = "collapsed",
    min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``docs`` with the runs of each whole text and the text without their repeats.

    Words are maximal stretches without U+0020 and U+0009 to U+000D, numbered
    from 0.  ``runs_col`` holds every run of at least ``min_length`` words and
    ``min_exponent`` (at least 4) periods as (start, length, period), by
    start, then period; ``collapsed_col`` the words, joined by one space, that no run contains
    after its first ``period`` words.  Null, empty and blank texts have no
    runs and an empty collapsed text; rows are treated one by one, so ids, null or
    repeated, don't matter; columns of these two names are replaced, all others stay.
    """
    from sparkloom.llm.common import arrow_schema

    rest = docs.drop(runs_col, collapsed_col)
    text = free_name(rest, "text_bytes")
    source = docs.select(*rest.columns, F.col(text_col).cast("string").cast("binary").alias(text))
    ddl = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rest.schema.fields), f"`{runs_col}` {RUNS_DDL}", f"`{collapsed_col}` binary"])
    out = source.mapInArrow(_described(arrow_schema(ddl), runs_col, collapsed_col, text, min_length, min_exponent), ddl)
    return out.withColumn(collapsed_col, F.col(collapsed_col).cast("string"))
