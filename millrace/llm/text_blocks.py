"""Texts as numbered words: blocks of documents, each with its own word list.

A block holds some megabytes of whole texts: its distinct words, and per text
the positions of its words in that list.  Facts about words can then be worked
out once per distinct word and joined back through the blocks, which moves one
row per block and distinct word instead of one per running word.  The blocks
are a table bucketed by block, so joins on the block do not move them again.
"""

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fresh_path

BLOCK_CHARS = 8_000_000


class Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def packed(codes: np.ndarray, kind="<u4") -> bytes:
    """Whole numbers that ``kind`` can hold, compressed byte plane by byte plane."""
    width = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(codes.astype(kind).view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpacked(data, kind="<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(data)), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class _Block:
    """Texts whose words are numbered as the texts come."""

    def __init__(self, split):
        self.split, self.words, self.ids, self.flags, self.parts, self.chars = split, Numbers(), [], [], [], 0

    def add(self, key, flag, text):
        self.ids.append(key)
        self.flags.append(flag)
        self.parts.append(self.part(text))
        self.chars += len(text)

    def part(self, text):
        words = self.split(text)
        return np.fromiter(map(self.words.__getitem__, words), np.uint32, len(words))

    def numbered(self):
        codes = np.concatenate(self.parts) if self.parts else np.empty(0, np.uint32)
        return np.array([len(p) for p in self.parts], np.int64), codes, np.array(list(self.words), object)

    def row(self, number):
        lengths, codes, words = self.numbered()
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        codes = rank[codes]
        words = words[order] if len(order) else []
        learned = np.repeat(np.array(self.flags, bool), lengths)
        counts = np.bincount(codes[learned], minlength=len(words))
        return pd.DataFrame(
            {
                "block": [number],
                "ids": [self.ids],
                "flags": [self.flags],
                "lengths": [lengths],
                "codes": [packed(codes)],
                "words": [words],
                "counts": [counts],
                "learned": [int(counts.sum())],
            }
        )


class _WholeBlock(_Block):
    """Texts whose words are split and numbered together; numbers as in ``_Block``."""

    def part(self, text):
        return text

    def numbered(self):
        lengths, words = self.split(pa.array(self.parts, pa.large_string()))
        coded = words.dictionary_encode()
        return lengths, coded.indices.to_numpy().astype(np.uint32), coded.dictionary.to_numpy(zero_copy_only=False)


def _blocks(split, block_chars, split_all=None):
    fresh = lambda: _WholeBlock(split_all) if split_all else _Block(split)

    def run(frames):
        first = TaskContext.get().partitionId() << 32
        block, made = fresh(), 0
        for frame in frames:
            for key, flag, text in zip(frame["id"], frame["flag"], frame["text"]):
                text = text or ""
                block.add(key, bool(flag), text)
                if block.chars >= block_chars:
                    yield block.row(first + made)
                    block, made = fresh(), made + 1
        if block.ids:
            yield block.row(first + made)

    return run


def write_blocks(docs: DataFrame, id_col, text_col, flag, split, block_chars=BLOCK_CHARS, split_all=None) -> DataFrame:
    """(block, ids, flags, lengths, codes, words, counts, learned), one row per block.

    ``split`` turns a text into a list of strings; a null text is empty.
    ``split_all``, which goes first, does so for an Arrow array of texts at once:
    how many words each has, and all words one after another.
    ``flag`` is a boolean column, kept per text; ``counts`` has how often each
    word of the block occurs in texts with the flag, ``learned`` their sum.
    """
    spark = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(docs.schema[id_col].dataType)),
            T.StructField("flags", T.ArrayType(T.BooleanType())),
            T.StructField("lengths", T.ArrayType(T.IntegerType())),
            T.StructField("codes", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.StringType())),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("learned", T.LongType()),
        ]
    )
    texts = docs.select(F.col(id_col).alias("id"), flag.alias("flag"), F.col(text_col).cast("string").alias("text"))
    name = f"text_blocks_{uuid.uuid4().hex}"
    (
        texts.mapInPandas(_blocks(split, block_chars, split_all), schema)
        .write.option("compression", "zstd")
        .option("parquet.block.size", 16 << 20)
        .option("path", fresh_path(spark, "blocks"))
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
        .saveAsTable(name)
    )
    return spark.table(name)


def texts_of(row) -> list[np.ndarray]:
    """The word positions of each text of a block."""
    lengths = np.asarray(row["lengths"], np.int64)
    return np.split(unpacked(row["codes"]), np.cumsum(lengths)[:-1]) if len(lengths) else []
