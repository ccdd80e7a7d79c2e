"""Packing of tokenised documents into sequences of a fixed length.

Large items (above a third of the capacity) share a sequence with at most one
other: the largest is matched with the largest that still fits beside it.
Smaller items then go, largest first, to the tightest gap that holds them.

Items of one length are interchangeable, so the matching needs only how many
items there are of each length: a table of at most ``capacity`` rows, whatever
the number of documents.  It is worked out on the driver as runs (so many items
of this length, so many sequences, at this offset); each item finds its place
in the runs by its rank among the items of its length.
"""

import bisect
import math
import zlib
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tokenizing import word_ids
from millrace.session import materialise

SHARD_ROWS = 200_000


class Run(NamedTuple):
    """Items ``first`` .. ``first + count - 1`` of a length, ``each`` of them per
    sequence one after the other, in the sequences from ``sequence`` on."""

    first: int
    count: int
    sequence: int
    offset: int
    each: int


class _Plan:
    def __init__(self, counts, capacity):
        self.capacity = capacity
        self.left = {length: n for length, n in counts.items() if n}
        self.used = dict.fromkeys(self.left, 0)
        self.runs = {length: [] for length in self.left}
        self.gaps: list[int] = []
        self.bins: dict[int, list[tuple[int, int]]] = {}
        self.sequences = 0

    def opened(self, count):
        first = self.sequences
        self.sequences += count
        return first

    def put(self, length, count, sequence, offset, each=1):
        self.runs[length].append(Run(self.used[length], count, sequence, offset, each))
        self.used[length] += count
        self.left[length] -= count

    def leave(self, gap, sequence, count):
        if gap and count:
            if gap not in self.bins:
                bisect.insort(self.gaps, gap)
                self.bins[gap] = []
            self.bins[gap].append((sequence, count))

    def match_large(self):
        sizes = sorted((n for n in self.left if 3 * n > self.capacity), reverse=True)
        for size in sizes:
            while self.left[size]:
                partner = next((p for p in sizes if p <= self.capacity - size and self.left[p] > (p == size)), None)
                if partner is None:
                    count = self.left[size]
                    first = self.opened(count)
                    self.put(size, count, first, 0)
                    self.leave(self.capacity - size, first, count)
                    continue
                count = self.left[size] // 2 if partner == size else min(self.left[size], self.left[partner])
                first = self.opened(count)
                self.put(size, count, first, 0)
                self.put(partner, count, first, size)
                self.leave(self.capacity - size - partner, first, count)

    def fill_small(self):
        for size in sorted((n for n in self.left if 3 * n <= self.capacity), reverse=True):
            while self.left[size]:
                at = bisect.bisect_left(self.gaps, size)
                if at == len(self.gaps):
                    gap, sequence = self.capacity, None
                    free = -(-self.left[size] // (gap // size))
                    sequence = self.opened(free)
                else:
                    gap = self.gaps[at]
                    sequence, free = self.bins[gap].pop()
                    if not self.bins[gap]:
                        del self.bins[gap], self.gaps[at]
                each = gap // size
                full = min(free, self.left[size] // each)
                if full:
                    self.put(size, full * each, sequence, self.capacity - gap, each)
                    self.leave(gap - each * size, sequence, full)
                rest = min(self.left[size], each - 1) if full < free else 0
                if rest:
                    self.put(size, rest, sequence + full, self.capacity - gap, each)
                    self.leave(gap - rest * size, sequence + full, 1)
                self.leave(gap, sequence + full + bool(rest), free - full - bool(rest))


def plan_sequences(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[Run]], int]:
    """Runs per length, and the number of sequences, for counts of items per length."""
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("every item must have between one token and the capacity")
    plan = _Plan(counts, capacity)
    plan.match_large()
    plan.fill_small()
    return plan.runs, plan.sequences


def _pieces(path, capacity, separator, with_ids):
    end = np.array([separator], "<u4").tobytes()

    def run(frames):
        words = word_ids(path)
        for frame in frames:
            for at in range(0, len(frame), 1000):
                rows = []
                for key, text in zip(frame["id"].iloc[at : at + 1000], frame["text"].iloc[at : at + 1000]):
                    ids = words.of_text(text or "") + end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        row = (key, piece, start // 4, len(part) // 4, zlib.crc32(part))
                        rows.append(row + ((np.frombuffer(part, "<u4").astype(np.int64),) if with_ids else ()))
                yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids])

    return run


def pieces(docs, path, capacity=2048, separator=0, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): documents as items to pack.

    A document is its token ids and then ``separator``; a null text is empty.
    Only longer ones than ``capacity`` are cut.  ``ids_crc32`` is the CRC-32 of
    the ids as little-endian unsigned 32-bit numbers.
    """
    fields = [
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInPandas(_pieces(path, capacity, separator, with_ids), T.StructType(fields))


def _places(runs):
    starts = {length: np.array([r.first for r in found]) for length, found in runs.items()}
    table = {length: np.array(found, np.int64) for length, found in runs.items()}

    def run(frames):
        for frame in frames:
            sequence = np.empty(len(frame), np.int64)
            offset = np.empty(len(frame), np.int64)
            lengths, ranks = frame["length"].to_numpy(), frame["rank"].to_numpy()
            for length in np.unique(lengths):
                own = lengths == length
                rank = ranks[own]
                first, _, base, start, each = table[length][np.searchsorted(starts[length], rank, "right") - 1].T
                sequence[own] = base + (rank - first) // each
                offset[own] = start + (rank - first) % each * length
            yield frame.drop(columns=["rank"]).assign(sequence_id=sequence, offset=offset)

    return run


def pack(items: DataFrame, capacity=2048) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``, in as few sequences as it can.

    ``items`` needs ``id``, ``piece`` and ``length`` (1 to ``capacity``); its
    other columns stay.  Places have no gaps between them.  Items that agree in
    id, piece and length may swap their places.  No items give no sequences.
    """
    written, rows = materialise(items, "items")
    shards = max(1, math.ceil(rows / SHARD_ROWS))
    sharded = written.withColumn("shard", F.pmod(F.xxhash64("id", "piece"), F.lit(shards)).cast("int"))
    sizes = sharded.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("items"))
    counts = {r["length"]: r["items"] for r in sizes.groupBy("length").agg(F.sum("items").alias("items")).collect()}
    runs, _ = plan_sequences(counts, capacity)
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "shard", F.coalesce(F.sum("items").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "shard").orderBy("id", "piece")
    ranked = (
        sharded.withColumn("number", F.row_number().over(order) - 1)
        .join(before, ["length", "shard"])
        .withColumn("rank", F.col("number") + F.col("before"))
        .select(*written.columns, "rank")
    )
    schema = T.StructType(
        [*written.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInPandas(_places(runs), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from packed items with ids."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def pack_documents(docs, path, capacity=2048, separator=0, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """Every document of ``docs`` in packed pieces; see ``pieces`` and ``pack``.

    A null or empty text is its separator alone.  Rows without an id and
    repeated rows are packed like any other.  Other columns are not read.
    """
    items = pieces(docs, path, capacity, separator, id_col, text_col, with_ids)
    return pack(items, capacity).withColumnRenamed("id", id_col)
