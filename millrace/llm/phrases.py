"""Collocations: phrases whose words occur together far more often than apart.

Words are counted first.  A phrase can be frequent only if all its parts are
(Apriori): of adjacent words only frequent ones are counted as pairs, and of
three in a row only those whose pairs both lie in buckets of frequent pairs.

Texts are read once, into blocks of numbered words with a mark between pieces,
one language a block.  The different words of a block go to groups by hash,
which count them and give the frequent ones a number for the whole corpus; the
numbers go back to the blocks.  A phrase is then two or three numbers.  Tasks
count those of many blocks at a time, and the counts meet in groups by hash, as
sorted arrays.  So the blocks are read once for pairs and once for triples,
however many phrases there are.  No list that grows with the corpus is
broadcast: buckets are a fixed number of bits.
"""

from itertools import count
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from millrace.llm.text_blocks import packed, unpacked
from millrace.llm.words import mixed
from millrace.session import materialise

#: All separators of pieces become the comma, which no word can hold then.
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", b",,,,,,,,,,")
MARK = b","
SLICE_BITS = 18
OUT_ROWS = 50_000
#: The block of rows that hold words.
NO_BLOCK = -1
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.int64((1 << 32) - 1)


class Settings(NamedTuple):
    """``least`` occurrences make a phrase frequent; of a lang the first ``top``
    phrases by score are given, all without it.  A pair that makes up
    ``percent`` of a longer phrase's count or less is dropped with it.

    ``block_words`` bounds a block of text and ``open_words`` all blocks that a
    task fills at a time, ``bits`` the buckets of pairs.  A group that counts
    words has about four times ``shard_phrases`` words of blocks, one that counts
    phrases the occurrences of four times ``pass_phrases``, and a task hands its
    counts on after four times ``held`` occurrences."""

    least: int = 10
    percent: int = 50
    top: int | None = 2_000
    block_words: int = 500_000
    open_words: int = 1_200_000
    bits: int = 28
    shard_phrases: int = 250_000
    pass_phrases: int = 600_000
    held: int = 500_000


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


class _Block:
    def __init__(self):
        self.numbers, self.parts, self.size = _Numbers({MARK: 0}), [], 0

    def add(self, text):
        words = text.encode().lower().translate(PIECES).replace(MARK, b" , ").split()
        words.append(MARK)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.size += len(words)
        return len(words)

    def row(self, block, lang):
        codes = np.concatenate(self.parts)
        between = codes == 0
        codes = codes[~between | ~np.r_[False, between[:-1]]]
        return (block, lang, int((codes > 0).sum()), len(self.numbers), _joined(self.numbers), packed(codes))


BLOCK = "block long, lang string, n long, different long, words binary, codes binary"


def _blocks(block_words, open_words):
    def run(frames):
        blocks, size = {}, 0
        numbers = count(TaskContext.get().partitionId() << 32)

        def closed(lang):
            row = blocks.pop(lang).row(next(numbers), lang)
            return pd.DataFrame([row], columns=["block", "lang", "n", "different", "words", "codes"])

        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                block = blocks.get(lang)
                if block is None:
                    block = blocks[lang] = _Block()
                size += block.add(text)
                if block.size >= block_words or size >= open_words:
                    full = max(blocks, key=lambda k: blocks[k].size)
                    size -= blocks[full].size
                    yield closed(full)
        for lang in list(blocks):
            yield closed(lang)

    return run


def _joined(words) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def _words(data) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(bytes(data)).split(b"\n")


def _hashes(lang, words) -> np.ndarray:
    """A hash of each word of a language."""
    start = xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxh3_64_intdigest(w, start) for w in words), np.uint64, len(words))


def _slices(parts, groups):
    """The rows of each part that occurs, in their order: (part, places)."""
    parts = parts.astype(np.uint16 if groups <= 1 << 16 else np.int64)
    order = np.argsort(parts, kind="stable")
    here = parts[order]
    starts = np.flatnonzero(np.r_[len(here) > 0, here[1:] != here[:-1]])
    return [(int(here[at]), order[at:to]) for at, to in zip(starts, [*starts[1:], len(here)])]


# --- words ----------------------------------------------------------------------

ENTRIES = "part long, lang string, block long, words binary, places binary"
NUMBERED = "lang string, block long, words binary, numbers binary"


def _entries(groups):
    """The words of each block by hash group, with their places in its list and their counts."""

    def run(frames):
        for frame in frames:
            for block, lang, data, codes in zip(frame["block"], frame["lang"], frame["words"], frame["codes"]):
                words = _words(data)
                counts = np.bincount(unpacked(codes).astype(np.int64), minlength=len(words))[1:]
                rows = []
                for part, at in _slices(_hashes(lang, words[1:]) % np.uint64(groups), groups):
                    own = _joined([words[place + 1] for place in at.tolist()])
                    rows.append((part, lang, block, own, packed(np.r_[at + 1, counts[at]], "<u8")))
                yield pd.DataFrame(rows, columns=["part", "lang", "block", "words", "places"])

    return run


def _numbered(least, groups):
    """Counts the words of a group, and numbers those that occur often enough from 1 on.

    Gives the words of a lang in a row, with counts and numbers, and for every
    block the places of such words in its list with their numbers.
    """

    def run(frame):
        rows, used, part = [], 0, int(frame["part"].iloc[0])
        for lang, own in frame.groupby("lang", sort=False):
            known, each, places, counts = _Numbers(), [], [], []
            for words, data in zip(own["words"], own["places"]):
                words = _words(words)
                each.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
                at, n = unpacked(data, "<u8").astype(np.int64).reshape(2, -1)
                places.append(at)
                counts.append(n)
            total = np.zeros(len(known), np.int64)
            np.add.at(total, np.concatenate(each), np.concatenate(counts))
            met = np.flatnonzero(total >= least)
            numbers = np.zeros(len(known), np.int64)
            numbers[met] = (np.arange(len(met)) + used) * groups + part + 1
            used += len(met)
            if len(met):
                spelled = list(known)
                row = packed(np.r_[total[met], numbers[met]], "<u8")
                rows.append((lang, NO_BLOCK, _joined([spelled[at] for at in met.tolist()]), row))
            for block, mine, at in zip(own["block"], each, places):
                mine = numbers[mine]
                if mine.any():
                    rows.append((lang, block, None, packed(np.r_[at[mine > 0], mine[mine > 0]])))
        return pd.DataFrame(rows, columns=["lang", "block", "words", "numbers"])

    return run


def _spelled(frames):
    """(lang, phrase, f, number) of the words, in small frames."""
    for frame in frames:
        for lang, words, data in zip(frame["lang"], frame["words"], frame["numbers"]):
            words = [w.decode() for w in _words(words)]
            f, number = unpacked(data, "<u8").astype(np.int64).reshape(2, -1)
            for at in range(0, len(words), OUT_ROWS):
                here = slice(at, at + OUT_ROWS)
                yield pd.DataFrame({"lang": lang, "phrase": words[here], "f": f[here], "number": number[here]})


def _with_numbers(block, found):
    """A block with the number of each word of its list, 0 for those that are not frequent."""
    numbers = np.zeros(int(block["different"].iloc[0]), np.uint32)
    for data in found["numbers"]:
        at, own = unpacked(data).reshape(2, -1)
        numbers[at] = own
    return pd.DataFrame({"codes": [block["codes"].iloc[0]], "numbers": [packed(numbers)]})


def _frequent_words(blocks, settings):
    """(lang, phrase, f, number) of the frequent words, and the blocks with these numbers."""
    groups = -(-(blocks.agg(F.sum("different")).first()[0] or 0) // (4 * settings.shard_phrases)) or 1
    entries = blocks.mapInPandas(_entries(groups), ENTRIES).groupBy("part")
    found, _ = materialise(entries.applyInPandas(_numbered(settings.least, groups), NUMBERED), "numbers")
    spelled = found.filter(F.col("block") == NO_BLOCK)
    words, _ = materialise(spelled.mapInPandas(_spelled, "lang string, phrase string, f long, number long"), "frequent")
    placed = found.filter(F.col("block") != NO_BLOCK).select("block", "numbers").groupBy("block")
    given = blocks.select("block", "different", "codes").groupBy("block")
    placed = given.cogroup(placed).applyInPandas(_with_numbers, "codes binary, numbers binary")
    return words, materialise(placed, "numbered_blocks")[0]


# --- phrases --------------------------------------------------------------------


def _tallied(columns, weights=None):
    """The different rows of two or more columns of numbers below 2 ** 31, sorted, and their summed weights.

    Two numbers make a key of 64 bits; with a third, keys are numbered anew.
    """
    key, heads = columns[0].astype(np.int64) << 32 | columns[1], []
    for column in columns[2:]:
        head, number = np.unique(key, return_inverse=True)
        heads.append(head)
        key = number << 32 | column
    if weights is None:
        key, total = np.unique(key, return_counts=True)
    else:
        order = np.argsort(key)
        key = key[order]
        starts = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]])
        key, total = key[starts], np.add.reduceat(weights[order], starts) if len(starts) else weights
    out = []
    for head in reversed(heads):
        out.append(key & _LOW)
        key = head[key >> 32]
    return [key >> 32, key & _LOW, *reversed(out)], total


def _mixed_all(columns) -> np.ndarray:
    """A hash of each row of numbers."""
    out = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        out = mixed(out * _STEP + column.astype(np.uint64))
    return out


def _buckets(columns, bits) -> np.ndarray:
    return (_mixed_all(columns) >> np.uint64(64 - bits)).astype(np.int32)


def _runs_of(length, bits, marked, words) -> np.ndarray:
    """Where runs of ``length`` frequent words inside a piece begin of which all pairs lie in marked buckets."""
    hot = np.zeros(len(words), bool)
    at = np.flatnonzero((words[:-1] > 0) & (words[1:] > 0))
    hot[at] = True if marked is None else _is_marked(marked, _buckets([words[at], words[at + 1]], bits))
    here = hot.copy()
    for step in range(1, length - 1):
        here[:-step] &= hot[step:]
        here[-step:] = False
    return np.flatnonzero(here)


def _is_marked(marked, buckets) -> np.ndarray:
    return (marked[buckets >> 3] >> (7 - (buckets & 7))) & 1 == 1


def _as_bits(frame):
    """A slice of the buckets as bits."""
    mask = np.zeros(1 << SLICE_BITS, bool)
    mask[frame["bucket"].to_numpy() & ((1 << SLICE_BITS) - 1)] = True
    return pd.DataFrame({"slice": [int(frame["bucket"].iloc[0]) >> SLICE_BITS], "bits": [np.packbits(mask).tobytes()]})


def _bit_list(buckets: DataFrame, bits: int):
    """The buckets as a broadcast list of ``2**bits`` bits, of fixed size."""
    spark = buckets.sparkSession
    slices = (
        buckets.select("bucket").distinct().withColumn("slice", F.shiftright("bucket", SLICE_BITS))
        .groupBy("slice").applyInPandas(_as_bits, "slice long, bits binary")
    )
    found = np.zeros(max(1 << bits, 1 << SLICE_BITS) >> 3, np.uint8)
    wide = 1 << (SLICE_BITS - 3)
    for row in slices.toLocalIterator():
        found[row["slice"] * wide : (row["slice"] + 1) * wide] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(found.tobytes())


def _buckets_of(bits):
    """The buckets of a table of pairs."""

    def run(frames):
        for frame in frames:
            yield pd.DataFrame({"bucket": _buckets([frame["w0"].to_numpy(), frame["w1"].to_numpy()], bits)})

    return run


def _counts(length, bits, pairs, groups, held):
    """How often runs of ``length`` frequent words occur in some blocks, by hash group.

    A row has the runs of a group in order, word by word, and their counts; of
    the first word the steps, which compress well.
    """

    def run(frames):
        waiting, size, marked = [], 0, None if pairs is None else np.frombuffer(pairs.value, np.uint8)

        def rows():
            columns, total = _tallied([np.concatenate(c) for c in zip(*waiting)])
            out = []
            for part, at in _slices(_mixed_all(columns) % np.uint64(groups), groups):
                first, *others = (c[at] for c in columns)
                out.append((part, packed(np.concatenate([np.diff(first, prepend=0), *others, total[at]]))))
            return pd.DataFrame(out, columns=["part", "counts"])

        for frame in frames:
            for codes, numbers in zip(frame["codes"], frame["numbers"]):
                words = unpacked(numbers)[unpacked(codes)]
                at = _runs_of(length, bits, marked, words)
                waiting.append([words[at + step] for step in range(length)])
                size += len(at)
                if size >= 4 * held:
                    yield rows()
                    waiting, size = [], 0
        if size:
            yield rows()

    return run


def _frequent(length, least):
    """The runs of a group that occur often enough."""

    def run(frame):
        parts = [unpacked(c).astype(np.int64).reshape(length + 1, -1) for c in frame["counts"]]
        first = np.concatenate([np.cumsum(p[0]) for p in parts])
        *others, counts = (np.concatenate([p[i] for p in parts]) for i in range(1, length + 1))
        columns, total = _tallied([first, *others], counts)
        met = total >= least
        return pd.DataFrame({f"w{i}": c[met] for i, c in enumerate(columns)} | {"f": total[met]})

    return run


def _counted(blocks, length, pairs, n, settings) -> DataFrame:
    """(w0, w1 and so on, f): the runs of ``length`` words with at least ``least`` occurrences, by their numbers."""
    groups = -(-n // (4 * settings.pass_phrases)) or 1
    each = blocks.mapInPandas(_counts(length, settings.bits, pairs, groups, settings.held), "part long, counts binary")
    schema = ", ".join([*(f"w{i} long" for i in range(length)), "f long"])
    return each.groupBy("part").applyInPandas(_frequent(length, settings.least), schema)


def _followed(phrases, heads, words, place):
    """Phrases with the lang and the text of ``heads``, by their numbers, and of the word at ``place``."""
    last = words.select(F.col("number").alias(f"w{place}"), F.col("phrase").alias("last"))
    text = F.concat_ws(" ", "phrase", "last").alias("phrase")
    numbers = [f"w{i}" for i in range(place + 1)]
    return phrases.join(heads, numbers[:-1]).join(last, numbers[-1]).select("lang", text, "f", *numbers)


def _part(start, words, phrase="phrase"):
    """Some words of a phrase of up to three."""
    pieces = F.split(phrase, " ")
    return F.array_join(F.slice(pieces, start, words), " ")


def frequent_phrases(docs: DataFrame, text_col="text", lang_col="lang", settings=Settings()):
    """(lang, phrase, f) of the frequent words, pairs and triples, each a table, and (lang, n)."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = texts.mapInPandas(_blocks(settings.block_words, settings.open_words), BLOCK)
    blocks, _ = materialise(made, "phrase_blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    n = blocks.agg(F.sum("n")).first()[0] or 0
    words, blocks = _frequent_words(blocks, settings)
    single = words.select("lang", "phrase", F.col("number").alias("w0"))
    # A run of three occurs no more often than its pairs, so that a count of its own is enough.
    pairs = _followed(_counted(blocks, 2, None, n, settings), single, words, 1)
    pairs, _ = materialise(pairs, "frequent")
    of_pairs = _bit_list(pairs.mapInPandas(_buckets_of(settings.bits), "bucket int"), settings.bits)
    heads = pairs.select("lang", "phrase", "w0", "w1")
    triples = _followed(_counted(blocks, 3, of_pairs, n, settings), heads, words, 2)
    triples, _ = materialise(triples, "frequent")
    of_pairs.destroy()
    words, pairs, triples = (found.select("lang", "phrase", "f") for found in (words, pairs, triples))
    return words, pairs, triples, totals


def _scored(phrases: DataFrame, left: DataFrame, right: DataFrame, cut: int) -> DataFrame:
    """(lang, phrase, cut, l, r, score) for the cut after ``cut`` words."""
    first = left.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rest = right.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    parts = phrases.select("lang", "phrase", "f", _part(1, cut).alias("head"), _part(cut + 1, 3).alias("tail"))
    joined = parts.join(first, ["lang", "head"]).join(rest, ["lang", "tail"])
    # Decimals of no fraction hold these products exactly up to counts of 10 ** 15.
    exact = "cast({} as decimal(15, 0))".format
    score = F.expr(
        f"(cast(1000000 as decimal(7, 0)) * {exact('f')} * {exact('f')}) div ({exact('l')} * {exact('r')})"
    )
    return joined.select("lang", "phrase", F.lit(cut).alias("cut"), "f", "l", "r", score.cast("long").alias("score"))


def collocations(docs: DataFrame, text_col="text", lang_col="lang", settings=Settings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each lang.

    A phrase is two or three words in a row inside a piece between punctuation
    marks or line ends, with ``a`` occurrences, at least ``least``.  Cut in two,
    its parts occur ``l`` and ``r`` times, and its score is the millionths of
    a * a / (l * r), rounded down, of the cut that scores lowest (the first of
    them).  A phrase is dropped if its words lie inside a longer one that has at
    least ``percent`` of its occurrences.  ``n`` counts the words of the lang.

    A null text is an empty one; texts without a lang count as lang ``und``.
    Rows that repeat count as often as they occur.  A table without words, or
    without frequent phrases, gives an empty result.  A very long text is one
    block.  Other columns, ids included, are not read.
    """
    words, pairs, triples, totals = frequent_phrases(docs, text_col, lang_col, settings)
    of_pairs = _scored(pairs, words, words, 1)
    of_triples = _scored(triples, words, pairs, 1).unionByName(_scored(triples, pairs, words, 2))
    weakest = F.min_by(F.struct("f", "l", "r", "score"), F.struct("score", "cut")).alias("best")
    of_triples = of_triples.groupBy("lang", "phrase").agg(weakest).select("lang", "phrase", "best.*")
    inner = F.explode(F.array(_part(1, 2), _part(2, 2))).alias("phrase")
    longer = triples.select("lang", inner, "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = of_pairs.drop("cut").join(longer, ["lang", "phrase"], "left")
    kept = kept.filter(F.coalesce(F.col("longer") * 100 < F.col("f") * settings.percent, F.lit(True))).drop("longer")
    found = kept.unionByName(of_triples)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long"))
    if settings.top is not None:
        ranked = ranked.filter(F.col("rank") <= settings.top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score"
    )
