"""Perplexity of texts under a class-based bigram model.

Words belong to classes; P(word | before) is the probability of its class after
the class before, times the share of the word in its class.  All learned words
are clustered by exchange: a word moves to the class that raises the likelihood
of the class bigrams most.  The start comes from the most frequent words, moved
one after another until none moves; every other word takes the class that suits
its neighbours best.  Then sweeps over the corpus move all words, each judged
against the class bigrams before the sweep, as long as the likelihood rises.
Words that occur once stand for unseen words: an
unseen word has the chance of one of them after the class before, shared out
among as many kinds as there are of those and one more.
The class model is mixed with the smoothed word frequencies.
"""

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.text_blocks import Numbers, packed, unpacked, write_blocks
from millrace.llm.words import mixed
from millrace.session import materialise

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Settings(NamedTuple):
    """The ``frequent`` commonest words make the start of the ``classes``.  Sweeps
    over all words end when one raises the likelihood by less than ``least_gain``
    of a nat per token.  Beyond ``word_blocks`` blocks, neighbours of words are
    summed up in parts before they meet in one task."""

    classes: int = 24
    frequent: int = 300
    sweeps: int = 12
    mixture: float = 0.9
    added: float = 0.1
    block_chars: int = 8_000_000
    word_blocks: int = 20_000
    least_gain: float = 0.002


def words_of(text: str) -> list[str]:
    """Words between ASCII white space, with A-Z in lower case."""
    return _WORD.findall(text.encode().lower().decode())


def all_words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of many texts as ``words_of`` has them: how many in each, and all in a row."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, lengths = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    # White space at an end leaves an empty string there, a text without words too.
    real = pc.binary_length(words).to_numpy() > 0
    if not real.all():
        lengths = np.add.reduceat(real.astype(np.int64), np.cumsum(lengths) - lengths)
        words = words.filter(pa.array(real))
    return lengths, words


def _line(lengths, flags, codes, edge: int) -> np.ndarray:
    """Codes of the flagged texts of a block, with ``edge`` around each."""
    lengths, flags = np.asarray(lengths, np.int64), np.asarray(flags, bool)
    codes = codes if flags.all() else codes[np.repeat(flags, lengths)]
    return np.insert(codes, np.concatenate([[0], np.cumsum(lengths[flags])]), edge) if flags.any() else np.array([edge])


def _sequence(lengths, flags, codes, symbols, edge) -> np.ndarray:
    """Symbols of the flagged texts of a block, with ``edge`` around each."""
    return np.append(symbols, edge)[_line(lengths, flags, codes, len(symbols))]


def _frequent_bigrams(words: list[str]):
    rest, edge = len(words), len(words) + 1

    def run(batches):
        total = np.zeros((edge + 1) ** 2, np.int64)
        for batch in batches:
            known = pa.array(words, batch.schema.field("words").type.value_type)
            for row in range(batch.num_rows):
                lengths, flags, names = (batch[c][row].values for c in ("lengths", "flags", "words"))
                symbols = pc.fill_null(pc.index_in(names, known), rest).to_numpy().astype(np.int64)
                codes = unpacked(batch["codes"][row].as_buffer())
                found = _sequence(lengths.to_numpy(), flags.to_numpy(zero_copy_only=False), codes, symbols, edge)
                total += np.bincount(found[:-1] * (edge + 1) + found[1:], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    return run


def _likelihood(pairs: np.ndarray) -> float:
    xlogx = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    return xlogx(pairs) - xlogx(pairs.sum(0)) - xlogx(pairs.sum(1))


def exchange(bigrams: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """A class per word from the bigram counts of words, in frequency order.

    The last two symbols, other words and the edge of a text, are classes of
    their own, numbered after the others.
    """
    count = len(bigrams) - 2
    belongs = np.concatenate([np.arange(count) % classes, [classes, classes + 1]])
    member = np.eye(classes + 2)[belongs]
    pairs = member.T @ bigrams @ member
    for _ in range(sweeps if count > 1 else 0):
        moved = False
        for word in range(count):
            after, before = bigrams[word] @ member, bigrams[:, word] @ member
            own, self_pairs = belongs[word], float(bigrams[word, word])
            after[own] -= self_pairs
            before[own] -= self_pairs
            bare = pairs.copy()
            bare[own, :] -= after
            bare[:, own] -= before
            bare[own, own] -= self_pairs
            best, choice = -np.inf, own
            for target in range(classes):
                trial = bare.copy()
                trial[target, :] += after
                trial[:, target] += before
                trial[target, target] += self_pairs
                value = _likelihood(trial) + (1e-9 if target == own else 0.0)
                if value > best:
                    best, choice, pairs = value, target, trial
            if choice != own:
                belongs[word], moved = choice, True
                member[word] = 0
                member[word, choice] = 1
        if not moved:
            break
    return belongs[:count]


def _suited(around: np.ndarray, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class of each word: its own, or the one that suits all its neighbours best.

    ``around`` has a row per word: how often each class, other words and the
    edge come before it, then the same after it.  Words of the class after the
    last have none yet.
    """
    width, classes = len(pairs), len(pairs) - 2
    smooth = pairs + 0.5
    follows = np.log(smooth / smooth.sum(1, keepdims=True))
    score = around[:, :width] @ follows[:, :classes] + around[:, width : 2 * width] @ follows[:classes].T
    # Rounded, so that the order of the sums in a product decides nothing.
    best = np.round(score, 6).argmax(1)
    return np.where(own < classes, own, best)


def _exchanged(around: np.ndarray, own: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood most, all others staying.

    ``around`` as for ``_suited``, then how often the word follows itself.
    """
    width, classes = len(pairs), len(pairs) - 2
    xlogx = lambda x: x * np.log(np.maximum(x, 1))
    rows, twice = np.arange(len(own)), around[:, -1]
    before, after = around[:, :width].astype(float), around[:, width : 2 * width].astype(float)
    n = after.sum(1)
    before[rows, own] -= twice
    after[rows, own] -= twice
    gain = np.zeros((len(own), classes))
    # The bigrams of a class with itself, without the word; they stay where the word does not meet the class.
    more = before[:, :classes] + after[:, :classes] + twice[:, None]
    word, cell = np.nonzero(more)
    mine = cell == own[word]
    inside = np.diag(pairs)[cell].astype(float)
    inside[mine] -= (before[rows, own] + after[rows, own] + twice)[word[mine]]
    gain[word, cell] = xlogx(inside + more[word, cell]) - xlogx(inside)
    # The tokens of a class, without the word: the same for all words as frequent, but for their own classes.
    tokens = pairs.sum(1)[:classes].astype(float)
    kinds, kind = np.unique(n, return_inverse=True)
    change = (xlogx(tokens + kinds[:, None]) - xlogx(tokens))[kind]
    bare = tokens[own] - n
    change[rows, own] = xlogx(bare + n) - xlogx(bare)
    gain -= 2 * change
    for table, counts, others in ((pairs, after, before), (pairs.T, before, after)):
        word, cell = np.nonzero(counts)
        if not len(word):
            continue
        d, mine, table = counts[word, cell], own[word], table[:classes].astype(float)
        # The same for all words that meet a class as often, but for their own classes.
        span = int(d.max()) + 1
        kinds, kind = np.unique(cell * span + d.astype(np.int64), return_inverse=True)
        bare, times = table[:, kinds // span].T, (kinds % span)[:, None]
        change = (xlogx(bare + times) - xlogx(bare))[kind]
        bare = table[mine, cell] - d
        change[np.arange(len(word)), mine] = xlogx(bare + d) - xlogx(bare)
        same = np.flatnonzero(cell == mine)
        bare = table[:, cell[same]].T - others[word[same], :classes]
        bare[np.arange(len(same)), mine[same]] -= d[same] + twice[word[same]]
        change[same] = xlogx(bare + d[same, None]) - xlogx(bare)
        inner = np.flatnonzero(cell < classes)
        change[inner, cell[inner]] = 0
        first = np.flatnonzero(np.diff(word, prepend=-1))
        gain[word[first]] += np.add.reduceat(change, first, axis=0)
    gain = np.round(gain, 6)
    gain[rows, own] += 5e-7
    return gain.argmax(1)


#: Cells with their counts, as count * number of cells + cell; a cell may come again.
CELLS = "<u4"


def _cells_of(cells: np.ndarray, counts: np.ndarray, size: int, limit: int | None = None):
    """Codes of cells with their counts, and how many codes each of them takes."""
    limit = limit or (2**32 - 1) // size - 1
    if counts.max(initial=0) <= limit:
        return (counts * size + cells).astype(CELLS), np.ones(len(cells), np.int64)
    times = -(-counts // limit)
    last = np.cumsum(times) - 1
    n = np.full(int(times.sum()), limit, np.int64)
    n[last] = counts - (times - 1) * limit
    return (n * size + np.repeat(cells, times)).astype(CELLS), times


def _summed_cells(packs, which: np.ndarray, words: int, size: int, lengths=None) -> np.ndarray:
    """Counts by word and cell; ``which``: the word of each pack of codes.

    With ``lengths``, packs hold many words, each with so many codes in a row.
    """
    if lengths is None:
        lengths = np.fromiter(map(len, packs), np.int64, len(packs)) // np.dtype(CELLS).itemsize
    cells, counts = _uncelled(np.frombuffer(b"".join(packs), CELLS), size)
    at = np.repeat(which, lengths) * size + cells
    return np.bincount(at, weights=counts, minlength=words * size).reshape(words, size)


def _uncelled(codes: np.ndarray, size: int):
    """Cells and counts of codes."""
    counts = codes // codes.dtype.type(size)
    return codes - counts * codes.dtype.type(size), counts


#: A word may occur more than 2**32 times.
COUNTS = "<u8"
_NUMBERED = "bucket int, block long, positions binary, members binary, totals binary, top array<struct<n: long, word: string, member: int>>"
_CLASSES = "bucket int, classes binary, moved long"
_LOOKUP = "bucket int, block long, positions binary, members binary, classes binary, counts binary"
_NEAR = "bucket int, block long, members binary, lengths binary, around binary"


def _steps(values: np.ndarray) -> bytes:
    """Rising numbers."""
    return packed(np.diff(values, prepend=0))


def _unsteps(data) -> np.ndarray:
    return np.cumsum(unpacked(data).astype(np.int64))


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of the bytes of each word."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    letters = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    place = np.arange(len(letters)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(letters + (place.astype(np.uint64) << np.uint64(8))))])
    return mixed(np.diff(sums[offsets - offsets[0]]))


def _dealt(buckets: int):
    """The words of a block by the bucket of their hash: one row per block and bucket."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                names, counts = batch["words"][row].values, batch["counts"][row].values.to_numpy()
                if not len(names):
                    continue
                bucket = (_hashes(names) % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                there, starts = np.unique(bucket[order], return_index=True)
                ends = pa.array(np.append(starts, len(names)).astype(np.int32))
                lists = lambda values: pa.ListArray.from_arrays(ends, values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(there),
                        pa.array(np.full(len(there), batch["block"][row].as_py(), np.int64)),
                        lists(names.take(pa.array(order))),
                        lists(pa.array(order.astype(np.int32))),
                        lists(pa.array(counts[order])),
                    ],
                    ["bucket", "block", "words", "positions", "counts"],
                )

    return run


def _numbers(frequent: int):
    """Rows in bucket order -> words by number in their bucket, then a row with its totals and commonest words."""

    names = [field.split()[0] for field in _NUMBERED.split(", ", 5)]

    def whole(bucket, number, totals):
        totals = totals[: len(number)]
        least = max(1, np.partition(totals, -frequent)[-frequent]) if len(totals) > frequent > 0 else 1
        words = list(number)
        top = sorted((-int(totals[at]), words[at], int(at)) for at in np.flatnonzero(totals >= least))[:frequent]
        top = [{"n": -n, "word": word, "member": at} for n, word, at in top]
        return bucket, None, None, None, packed(totals, COUNTS), top

    def run(frames):
        bucket, number, totals = None, Numbers(), np.zeros(0, np.int64)
        for frame in frames:
            out = []
            for row in frame.itertuples():
                if row.bucket != bucket:
                    if bucket is not None:
                        out.append(whole(bucket, number, totals))
                    bucket, number, totals = row.bucket, Numbers(), np.zeros(0, np.int64)
                members = np.fromiter(map(number.__getitem__, row.words), np.int64, len(row.words))
                if len(number) > len(totals):
                    totals = np.concatenate([totals, np.zeros(len(number), np.int64)])
                totals[members] += row.counts
                order = np.argsort(members)
                out.append((row.bucket, row.block, packed(row.positions[order]), _steps(members[order]), None, None))
            yield pd.DataFrame(out, columns=names).astype({"block": "Int64"})
        if bucket is not None:
            yield pd.DataFrame([whole(bucket, number, totals)], columns=names).astype({"block": "Int64"})

    return run


def _start(classes: int, chosen: dict):
    """The classes of the clustered words, (number, class) by bucket; all others have none yet."""

    def run(frames):
        for frame in frames:
            out = []
            for bucket, totals in zip(frame["bucket"], frame["totals"]):
                own = np.full(len(unpacked(totals, COUNTS)), classes, np.int64)
                for member, cluster in chosen.get(bucket, []):
                    own[member] = cluster
                out.append((bucket, packed(own), 0))
            yield pd.DataFrame(out, columns=["bucket", "classes", "moved"])

    return run


def _looked_up(frames):
    """Rows in bucket order, that of its classes first -> classes of the words of each block.

    Where the classes come with totals, with these in place of the numbers.
    """
    own, totals = None, None
    for frame in frames:
        out = []
        for row in frame.itertuples():
            if row.classes is not None:
                own = unpacked(row.classes)
                totals = None if row.totals is None else unpacked(row.totals, COUNTS)
                continue
            at = _unsteps(row.members)
            last = (row.members, packed(own[at]), None) if totals is None else (None, packed(own[at]), packed(totals[at], COUNTS))
            out.append((row.bucket, int(row.block), row.positions, *last))
        yield pd.DataFrame(out, columns=["bucket", "block", "positions", "members", "classes", "counts"])


def _lookups(numbered: DataFrame, state: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    if totals is None:
        state = state.select("bucket", "classes", F.lit(None).cast("binary").alias("totals"))
    else:
        state = state.join(totals, "bucket").select("bucket", "classes", "totals")
    rows = numbered.filter("block is not null").select("bucket", "block", "positions", "members")
    rows = rows.unionByName(state, allowMissingColumns=True)
    # Nulls come first, so that the classes of a bucket stand before its words.
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "block")
    return rows.mapInPandas(_looked_up, _LOOKUP)


def _neighbours(classes: int):
    """The neighbours by class of the learned words of a block, one row per bucket of words."""
    edge, width = classes + 1, classes + 2
    size = 2 * width + 1

    def run(blocks, found):
        row = blocks.iloc[0]
        found = found.sort_values("bucket")
        positions = [unpacked(p) for p in found["positions"]]
        starts = np.cumsum([0, *map(len, positions)])
        words = int(starts[-1])
        kind = np.uint32 if (words + 1) * size < 2**32 else np.uint64
        # Where the cells of each word begin; the edge comes after the last word.
        spot, belongs = np.full(words + 1, words * size, kind), np.full(words + 1, edge, kind)
        if words:
            order = np.concatenate(positions)
            spot[order] = np.arange(words, dtype=kind) * kind(size)
            belongs[order] = np.concatenate([unpacked(c) for c in found["classes"]])
        line = _line(row["lengths"], row["flags"], unpacked(row["codes"]), words)
        spots, around = spot[line], belongs[line]
        twice = spots[:-1][line[:-1] == line[1:]] + kind(2 * width)
        cells = np.concatenate([spots[1:] + around[:-1], spots[:-1] + (around[1:] + kind(width)), twice])
        # Sorted, as few of all cells of a block's many words have a count.
        cells.sort()
        cells = cells[: np.searchsorted(cells, kind(words * size))]
        first = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
        there, total = cells[first], np.diff(np.append(first, len(cells)))
        word = there // kind(size)
        values, times = _cells_of((there - word * kind(size)).astype(np.int64), total, size)
        each = np.bincount(word.astype(np.int64), weights=times, minlength=words).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(each)])
        out = [
            (bucket, row["block"], members, packed(each[a:b]), packed(values[ends[a] : ends[b]]))
            for bucket, members, a, b in zip(found["bucket"], found["members"], starts[:-1], starts[1:])
            if ends[b] > ends[a]
        ]
        return pd.DataFrame(out, columns=["bucket", "block", "members", "lengths", "around"])

    return run


def _unlisted(rows):
    """Members, lengths and codes of cells of rows of neighbours."""
    members = np.concatenate([_unsteps(m) for m in rows["members"]])
    lengths = np.concatenate([unpacked(n) for n in rows["lengths"]]).astype(np.int64)
    return members, lengths, [unpacked(a) for a in rows["around"]]


def _table(rows, size: int) -> np.ndarray:
    """Counts by word of a bucket and cell, of some of its rows."""
    members, lengths, packs = _unlisted(rows)
    return _summed_cells(packs, members, int(members.max()) + 1, size, lengths).astype(np.int64)


def _added_up(size: int):
    """Rows in order of bucket and block -> one row of their sum for each."""

    def whole(key, table):
        there = np.flatnonzero(table)
        values, times = _cells_of(there % size, table.ravel()[there], size)
        each = np.bincount(there // size, weights=times, minlength=len(table)).astype(np.int64)
        members = np.flatnonzero(each)
        return *key, _steps(members), packed(each[members]), packed(values)

    def run(frames):
        last, total = None, None
        for frame in frames:
            out = []
            for key, rows in frame.groupby(["bucket", "block"]):
                table = _table(rows, size)
                if key == last:
                    less, total = sorted((total, table), key=len)
                    total[: len(less)] += less
                    continue
                if last is not None:
                    out.append(whole(last, total))
                last, total = key, table
            yield pd.DataFrame(out, columns=["bucket", "block", "members", "lengths", "around"])
        if last is not None:
            yield pd.DataFrame([whole(last, total)], columns=["bucket", "block", "members", "lengths", "around"])

    return run


def _all_around(blocks: DataFrame, lookups: DataFrame, classes: int, n_blocks: int, word_blocks: int) -> DataFrame:
    """The neighbours by class of all learned words, one row per bucket."""
    grouped = blocks.select("block", "flags", "lengths", "codes").groupBy("block").cogroup(lookups.groupBy("block"))
    near = grouped.applyInPandas(_neighbours(classes), _NEAR)
    parts = -(-n_blocks // max(word_blocks, 1)) if n_blocks > word_blocks else 1
    for n in (parts, 1) if parts > 1 else (1,):
        near = near.withColumn("block", F.pmod(F.hash("block"), F.lit(n)).cast("long"))
        near = near.repartition("bucket", "block").sortWithinPartitions("bucket", "block")
        near = near.mapInPandas(_added_up(2 * classes + 5), _NEAR)
    return near.drop("block")


def _bigrams_of(classes: int):
    """Class bigrams of the words of each bucket, and of the edge before them."""
    edge, width = classes + 1, classes + 2

    def run(frames):
        for frame in frames:
            pairs = np.zeros((width, width), np.int64)
            for at in np.flatnonzero(frame["members"].notna()):
                members, lengths, packs = _unlisted(frame.iloc[at : at + 1])
                own = unpacked(frame["classes"].iloc[at])[members].astype(np.int64)
                mine = _summed_cells(packs, own, width, 2 * width + 1, lengths).astype(np.int64)[:classes]
                pairs[:classes] += mine[:, width : 2 * width]
                pairs[edge, :classes] += mine[:, edge]
            cells = np.flatnonzero(pairs)
            yield pd.DataFrame({"cell": cells, "n": pairs.ravel()[cells]})

    return run


#: Words that are moved at once in a task.
_MOVED = 4096


def _reclassed(pairs: np.ndarray, rule):
    """New classes of the words of each bucket by a rule, and how many words moved."""

    def run(frames):
        for frame in frames:
            out = []
            for at, bucket in enumerate(frame["bucket"]):
                rows = frame.iloc[at : at + 1]
                own = unpacked(rows["classes"].iloc[0]).astype(np.int64)
                new = own.copy()
                if rows["members"].notna().iloc[0]:
                    table = _table(rows, 2 * len(pairs) + 1)
                    learned = np.flatnonzero(table.any(1))
                    for some in np.split(learned, range(_MOVED, len(learned), _MOVED)):
                        new[some] = rule(table[some], own[some], pairs)
                out.append((bucket, packed(new), int((new != own).sum())))
            yield pd.DataFrame(out, columns=["bucket", "classes", "moved"])

    return run


def _clustered(blocks, numbered, state, coarse, n_blocks, settings) -> DataFrame:
    """Classes of all words by bucket: from those of the start, moved until the likelihood stays."""
    classes = settings.classes
    width = classes + 2

    def beside(state):
        lookups = _lookups(numbered, state)
        near, _ = materialise(_all_around(blocks, lookups, classes, n_blocks, settings.word_blocks), "neighbours")
        return state.drop("moved").join(near, "bucket", "left")

    def moved(near, pairs, rule):
        new, _ = materialise(near.mapInPandas(_reclassed(pairs, rule), _CLASSES), "word_classes")
        return new, new.agg(F.sum("moved")).first()[0]

    state, any_moved = moved(beside(state), coarse, _suited)
    kept, value = state, -np.inf
    for _ in range(settings.sweeps):
        near = beside(state)
        pairs = _summed(near.mapInPandas(_bigrams_of(classes), "cell long, n long"), width * width).reshape(width, width)
        now = _likelihood(pairs)
        if now <= value:
            break
        gain, kept, value = now - value, state, now
        if gain < settings.least_gain * pairs.sum():
            break
        state, any_moved = moved(near, pairs, _exchanged)
        if not any_moved:
            break
    return kept


def _totals_of(classes: int):
    """Tokens of each class, then learned words, of the words of each bucket."""

    def run(frames):
        for frame in frames:
            n = np.zeros(classes + 1, np.int64)
            for own, totals in zip(frame["classes"], frame["totals"]):
                own, totals = unpacked(own), unpacked(totals, COUNTS).astype(np.int64)
                known = totals > 0
                np.add.at(n, own[known], totals[known])
                n[classes] += known.sum()
            yield pd.DataFrame({"cell": np.arange(classes + 1), "n": n})

    return run


def _filled(row, found, classes):
    """Class (``classes`` for unseen words) and training count of each word of a block."""
    belongs = np.full(row["n_words"] + 1, classes, np.int64)
    counts = np.zeros(row["n_words"] + 1, np.int64)
    for positions, own, n in zip(found["positions"], found["classes"], found["counts"]):
        at = unpacked(positions)
        counts[at] = unpacked(n, COUNTS)
        belongs[at] = np.where(counts[at] > 0, unpacked(own), classes)
    return belongs, counts


def _class_pairs(classes: int):
    """Class bigrams of the training texts of a block; classes, once-seen, edge.

    Cells: (before, after) with every word in its class, then the same with
    words that occur once in the class of unseen words.
    """
    edge, width = classes + 1, classes + 2

    def run(blocks, found):
        row = blocks.iloc[0]
        belongs, counts = _filled(row, found, classes)
        belongs[-1] = edge  # a position past the words
        line = _line(row["lengths"], row["flags"], unpacked(row["codes"]), row["n_words"])
        parts = []
        for symbols in (belongs, np.where((counts <= 1) & (belongs != edge), classes, belongs)):
            seen = symbols[line]
            parts.append(np.bincount(seen[:-1] * width + seen[1:], minlength=width * width))
        cells = np.concatenate(parts)
        at = np.flatnonzero(cells)
        return pd.DataFrame({"cell": at, "n": cells[at]})

    return run


class Model(NamedTuple):
    """Class probabilities and totals; rows and columns: classes, unseen, edge."""

    classes: int
    follows: np.ndarray
    tokens: np.ndarray
    texts: int
    train_tokens: int
    kinds: int
    once: int
    settings: Settings


def class_model(pairs, marked, tokens, texts, kinds, settings) -> Model:
    """``pairs`` and ``marked``: the two tables of ``_class_pairs``."""
    classes = len(tokens)
    # After an unseen word, what follows words that occur once.
    before = pairs.copy().astype(float)
    before[classes] = marked[classes]
    before[:, classes] = 0
    known = (before + 0.05) * (np.arange(classes + 2) != classes)
    # A class without words cannot follow.
    known[:, :classes] *= tokens > 0
    known /= np.maximum(known.sum(1, keepdims=True), 1e-300)
    unseen = (marked[:, classes] + 0.5) / (marked.sum(1) + 1.0)
    follows = known * (1 - unseen[:, None])
    follows[:, classes] = unseen
    # Of a word that occurs once, one token comes after something: as many as kinds.
    once = int(marked[:, classes].sum())
    return Model(classes, follows, np.maximum(tokens, 1), texts, int(tokens.sum()) + texts, kinds, once, settings)


def _scores(model: Model):
    classes, s = model.classes, model.settings
    edge, whole = classes + 1, model.train_tokens + s.added * (model.kinds + 1)

    def run(blocks, found):
        row = blocks.iloc[0]
        belongs, counts = _filled(row, found, classes)
        lengths = np.asarray(row["lengths"], np.int64)
        everything = np.ones(len(lengths), bool)
        end = len(counts) - 1  # a position past the words, for the end of a text
        counts[end], belongs[end] = model.texts, edge
        place = _line(lengths, everything, unpacked(row["codes"]), end)[1:]
        own = belongs[place]
        before = np.concatenate([[edge], own[:-1]])
        base = (counts + s.added) / whole
        share = np.where(belongs == classes, 1 / (model.once + 1), 1.0)
        inside = belongs < classes
        share[inside] = counts[inside] / model.tokens[belongs[inside]]
        chance = (s.mixture * model.follows)[before, own] * share[place] + ((1 - s.mixture) * base)[place]
        starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        total = lambda values: np.add.reduceat(values, starts)
        return pd.DataFrame(
            {
                "id": row["ids"],
                "learned": row["flags"],
                "n_tokens": lengths + 1,
                "n_known": total((counts > 0).astype(np.int64)[place]),
                "train_tokens": model.train_tokens,
                "base_score": total(np.log10(base)[place]),
                "score": total(np.log10(chance)),
            }
        )

    return run


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for row in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row["cell"]] = row["n"]
    return out


def score_texts(docs: DataFrame, learned, id_col="doc_id", text_col="text", settings=Settings()) -> DataFrame:
    """(id, learned, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``learned`` is a boolean column: the rows whose text the model learns from.
    Tokens are the words of a text and one end.  ``n_known`` counts tokens that
    occur in learned texts, ``train_tokens`` all tokens of those, ``base_score``
    the log10 probability of the text by smoothed word frequencies, ``score``
    that of the model.  A null or empty text is its end alone.  Rows without an
    id and repeated rows count like any other.  Without learned texts every
    token has the same small probability.  Other columns are not read.
    """
    classes = settings.classes
    blocks = write_blocks(docs, id_col, text_col, learned, words_of, settings.block_chars, all_words_of)
    texts = blocks.select(F.aggregate(F.filter("flags", lambda f: f), F.lit(0).cast("long"), lambda a, b: a + 1).alias("n"))
    n_texts, n_blocks = texts.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_texts = int(n_texts or 0)
    # As many buckets as keep the words of a bucket few, whatever the number of blocks.
    dealt = blocks.select("block", "words", "counts").mapInArrow(
        _dealt(max(64, n_blocks // 4)),
        "bucket int, block long, words array<string>, positions array<int>, counts array<long>",
    )
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "block")
    numbered, _ = materialise(dealt.mapInPandas(_numbers(settings.frequent), _NUMBERED), "numbered_words")
    totals = numbered.filter("block is null").select("bucket", "totals")
    often = numbered.filter("block is null").select("bucket", F.explode("top").alias("w")).select("bucket", "w.*")
    often = often.orderBy(F.desc("n"), "word").limit(settings.frequent).collect()
    frequent = [r["word"] for r in often]
    side = len(frequent) + 2
    cells = blocks.select("lengths", "flags", "codes", "words").mapInArrow(_frequent_bigrams(frequent), "cell long, n long")
    bigrams = _summed(cells, side * side).reshape(side, side).astype(float)
    belongs = exchange(bigrams, classes, settings.sweeps)
    member = np.eye(classes + 2)[np.concatenate([belongs, [classes, classes + 1]]).astype(int)]
    coarse = member.T @ bigrams @ member
    chosen = {}
    for row, own in zip(often, belongs):
        chosen.setdefault(row["bucket"], []).append((row["member"], int(own)))
    state, _ = materialise(totals.mapInPandas(_start(classes, chosen), _CLASSES), "word_classes")
    if frequent:
        state = _clustered(blocks, numbered, state, coarse, n_blocks, settings)
    of_words = state.join(totals, "bucket").select("classes", "totals")
    *tokens, kinds = _summed(of_words.mapInPandas(_totals_of(classes), "cell long, n long"), classes + 1)
    tokens, kinds = np.array(tokens, np.int64), int(kinds) + (n_texts > 0)
    found, _ = materialise(_lookups(numbered, state, totals).drop("bucket", "members"), "lookups")
    found = found.groupBy("block")
    grouped = blocks.select("block", "ids", "flags", "lengths", "codes", F.size("words").alias("n_words"))
    grouped = grouped.groupBy("block").cogroup(found)
    width = classes + 2
    both = _summed(grouped.applyInPandas(_class_pairs(classes), "cell long, n long"), 2 * width * width)
    pairs, marked = both.reshape(2, width, width)
    model = class_model(pairs, marked, tokens, n_texts, int(kinds), settings)
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("learned", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return grouped.applyInPandas(_scores(model), schema).withColumnRenamed("id", id_col)
