"""Periodic runs of words, by internal pattern matching.

A run is a longest stretch with smallest period q that holds it at least twice.
Words of a text, q apart, agree along all of a run but its last q words, and
that stretch holds a block of b words at a multiple of b, where b is the power
of two with 2b - 1 <= q <= 4b - 2.  So for every b and every such block the
occurrences of the block between 2b - 1 and 4b - 2 words further on give all
candidate periods.  The block's occurrences are one range of the suffix array;
a wavelet tree over that array finds the next one of them behind a place.
Occurrences at most half a block apart form a progression, which is taken at
once: inside one run of its step it says nothing new, elsewhere each of its
terms is a candidate.  A candidate is extended both ways as far as it holds.

Everything is done with arrays over many texts at a time.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts are handled together until they have this many words; one longer text is handled alone.
TOGETHER = 200_000


class Factors:
    """The suffix array of a sequence of numbers, and names of all its factors of 1, 2, 4, ... numbers.

    ``names[k][i]`` is where the suffixes that begin with the ``2**k`` numbers
    from ``i`` on begin in the suffix array; equal names are equal factors.
    Names end at the length at which all factors differ.
    """

    def __init__(self, codes: np.ndarray):
        count = self.count = len(codes)
        self.order = np.argsort(codes, kind="stable")
        name, active = np.empty(count, np.int64), np.arange(count)
        keys, slots, length = codes[self.order], active, 1
        self.names: list[np.ndarray] = []
        while True:
            starts = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1)) if len(keys) else np.empty(0, np.int64)
            sizes = np.diff(starts, append=len(keys))
            name[self.order[slots]] = np.repeat(slots[starts], sizes)
            shared = np.repeat(sizes > 1, sizes)
            slots = slots[shared]
            if not len(slots):
                break
            self.names.append(name.astype(np.int32))
            active = self.order[slots]
            follower = active + length
            inside = follower < count
            keys = name[active] * (count + 1)
            keys[inside] += name[follower[inside]] + 1
            by = np.argsort(keys, kind="stable")
            self.order[slots], keys, length = active[by], keys[by], 2 * length

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers agree from ``i`` and from ``j`` (larger) on."""
        far = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            at = j + far
            inside = np.flatnonzero(at < self.count)
            same = self.names[k][i[inside] + far[inside]] == self.names[k][at[inside]]
            far[inside[same]] += 1 << k
        return far

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers agree that end just before ``i`` and before ``j``."""
        far = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            at = i - far - (1 << k)
            inside = np.flatnonzero(at >= 0)
            same = self.names[k][at[inside]] == self.names[k][j[inside] - far[inside] - (1 << k)]
            far[inside[same]] += 1 << k
        return far


class WaveletTree:
    """Range queries on an array of whole numbers from 0 on, many at a time.

    The nodes of a level lie side by side; ``zeros`` counts the numbers before
    a place of a level that go to the left child.
    """

    def __init__(self, values: np.ndarray, most: int):
        self.bits = range(max(1, int(most).bit_length()) - 1, -1, -1)
        self.zeros, self.lefts = [], []
        for bit in self.bits:
            left = (values >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
            self.lefts.append(int(self.zeros[-1][-1]))
            values = np.concatenate([values[left], values[~left]])

    def below(self, low, high, bound) -> np.ndarray:
        """How many numbers of places ``low`` to ``high`` are less than ``bound``."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros, lefts in zip(self.bits, self.zeros, self.lefts):
            low_left, high_left = zeros[low], zeros[high]
            right = (bound >> bit) & 1 == 1
            found += np.where(right, high_left - low_left, 0)
            low = np.where(right, lefts + low - low_left, low_left)
            high = np.where(right, lefts + high - high_left, high_left)
        return found

    def ranked(self, low, high, rank) -> np.ndarray:
        """The number with ``rank`` smaller ones among places ``low`` to ``high``."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros, lefts in zip(self.bits, self.zeros, self.lefts):
            low_left, high_left = zeros[low], zeros[high]
            right = rank >= high_left - low_left
            rank = np.where(right, rank - (high_left - low_left), rank)
            found |= np.where(right, 1 << bit, 0)
            low = np.where(right, lefts + low - low_left, low_left)
            high = np.where(right, lefts + high - high_left, high_left)
        return found

    def successor(self, low, high, bound, none: int) -> np.ndarray:
        """The least number of places ``low`` to ``high`` from ``bound`` on, else ``none``."""
        smaller = self.below(low, high, bound)
        some = np.flatnonzero(smaller < high - low)
        found = np.full(len(low), none, np.int64)
        found[some] = self.ranked(low[some], high[some], smaller[some])
        return found


def _candidates(factors: Factors, tree: WaveletTree, places: np.ndarray, level: int):
    """Pairs of places of equal blocks that lie a candidate period apart."""
    name, size = factors.names[level], 1 << level
    block = np.arange(0, factors.count, size)
    members = np.bincount(name, minlength=factors.count)
    low = name[block].astype(np.int64)
    block, low = block[members[low] > 1], low[members[low] > 1]
    high = places[low + members[low]]
    low, none = places[low], factors.count
    place = block + (1 if level == 1 else 2 * size - 1)
    end = block + 4 * size - 2
    while len(block):
        first = tree.successor(low, high, place, none)
        met = np.flatnonzero((first <= end) & (first < none))
        block, low, high, end, first = block[met], low[met], high[met], end[met], first[met]
        second = tree.successor(low, high, first + 1, none)
        step = second - first
        dense = np.flatnonzero((second < none) & (step <= size // 2))
        last = first.copy()
        terms = np.ones(len(block), np.int64)
        if len(dense):
            by, at, own = step[dense], first[dense], block[dense]
            last[dense] = at + (by + factors.ahead(at, at + by) - size) // by * by
            terms[dense] = (np.minimum(last[dense], end[dense]) - at) // by + 1
            inside = factors.ahead(own, own + by) >= at - own + size - by
            terms[dense[inside]] = (at == own + by)[inside]
        number = np.arange(terms.sum()) - np.repeat(np.cumsum(terms) - terms, terms)
        yield np.repeat(block, terms), np.repeat(first, terms) + number * np.repeat(step, terms)
        place = last + 1


def find_runs(codes: np.ndarray, least: int) -> np.ndarray:
    """(runs, 3): start, length and period of all runs of at least ``least`` numbers, by start and period."""
    factors, found = Factors(codes), [np.empty((0, 3), np.int64)]
    if len(factors.names) > 1:
        pairs = np.bincount(factors.names[1], minlength=len(codes))
        shared = np.repeat(pairs > 1, pairs)
        places = np.concatenate([[0], np.cumsum(shared)])
        tree = WaveletTree(factors.order[shared], len(codes))
        for level in range(1, len(factors.names)):
            for own, other in _candidates(factors, tree, places, level):
                start = own - factors.behind(own, other)
                end, period = other + factors.ahead(own, other), other - own
                good = end - start >= np.maximum(least, 2 * period)
                found.append(np.stack([start, end - start, period], 1)[good])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # A stretch whose smallest period is q also has the period 2q, with the same two ends.
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def _handle(ids, texts, least):
    numbers = _Numbers()
    codes = np.fromiter((numbers[w] for words in texts for w in words), np.int64, sum(map(len, texts)))
    ends = np.cumsum([len(words) for words in texts])
    starts = ends - [len(words) for words in texts]
    # No factor of one text equals one of another.
    text_of = np.repeat(np.arange(len(texts)), ends - starts)
    runs = find_runs(codes + text_of * len(numbers), least)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(change)[:-1] > 0
    cuts = np.searchsorted(runs[:, 0], ends)
    rows = []
    for key, words, start, end, first, last in zip(ids, texts, starts, ends, np.r_[0, cuts[:-1]], cuts):
        own = runs[first:last] - [start, 0, 0]
        kept = words
        if len(own):
            gone = dropped[start:end]
            kept = [w for w, g in zip(words, gone.tolist()) if not g]
        rows.append((key, len(words), *own.T, b" ".join(kept).decode()))
    return pd.DataFrame(rows, columns=["row", "n_words", "starts", "lengths", "periods", "collapsed"])


def _each(least):
    def run(frames):
        ids, texts, words = [], [], 0
        for frame in frames:
            for key, text in zip(frame["row"], frame["text"]):
                ids.append(key)
                texts.append(text.encode().split())
                words += len(texts[-1])
                if words >= TOGETHER:
                    yield _handle(ids, texts, least)
                    ids, texts, words = [], [], 0
        if ids:
            yield _handle(ids, texts, least)

    return run


def periodic_runs(docs: DataFrame, id_col="doc_id", text_col="text", least=12) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row of ``docs``.

    Words stand between ASCII white space and are numbered from 0.  ``runs``
    holds the start, length and period of every run of at least ``least`` words
    (at least 5), by start and then period.  ``collapsed`` is the text without
    the words that any run contains after its first period, joined by a space.

    A null text is an empty one; an empty text has no words, no runs and an
    empty ``collapsed``.  Rows without an id, and rows that repeat one, are
    handled like any other, one result each; an empty table gives an empty
    result.  Other columns are not read.  A text is handled in one task whatever
    its length, in memory that grows with its words times the logarithm of its
    longest repeat.
    """
    if least < 5:
        raise ValueError("runs are found from 5 words on")
    # The id travels as text inside Python, so that no type of it changes there.
    kind = docs.schema[id_col].dataType
    given = docs.select(
        F.to_json(F.struct(F.col(id_col).alias("id"))).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    numbers = T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("row", T.StringType()), T.StructField("n_words", T.LongType()),
            T.StructField("starts", numbers), T.StructField("lengths", numbers), T.StructField("periods", numbers),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    found = given.mapInPandas(_each(least), schema)
    zipped = F.transform(
        F.arrays_zip("starts", "lengths", "periods"),
        lambda r: F.struct(r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")),
    )
    key = F.from_json("row", T.StructType([T.StructField("id", kind)]))["id"]
    return found.select(key.alias(id_col), "n_words", zipped.alias("runs"), "collapsed")
