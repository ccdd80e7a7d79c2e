"""Byte-pair encoding and decoding through a table of distinct words.

Texts are split in Spark into units that the tokenizer encodes on their own.
Equal units of all blocks of texts meet by their hash; each distinct unit is
encoded once, and decoded again by looking its ids up in the table of pieces.
Ids and pieces go back to the texts by the position of each unit.
"""

import functools
from zlib import crc32

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.text_blocks import packed, texts_of, unpacked, write_blocks
from millrace.llm.tokenizing import REMEMBERED, byte_level_split, byte_pieces, encode_word

#: Groups of units by hash; a group's distinct units are held in memory by its task.
MOST_GROUPS = 4096


def _dealt(groups: int):
    """The words of each block by the group of their hash, as compressed lists."""

    def run(frames):
        for frame in frames:
            for block, words in zip(frame["block"], frame["words"]):
                words = np.array(words, object)
                group = np.fromiter((crc32(w.encode()) % groups for w in words), np.int32, len(words))
                order = np.lexsort((words, group))
                out = []
                for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if len(order) else []:
                    own = words[rows]
                    letters = zstandard.ZstdCompressor().compress("".join(own).encode())
                    sizes = np.fromiter(map(len, own), np.uint32, len(own))
                    out.append((int(group[rows[0]]), block, packed(rows), packed(sizes), letters))
                yield pd.DataFrame(out, columns=["group", "block", "positions", "lengths", "letters"])

    return run


class _Words(dict):
    """word -> (ids, the text they decode to); emptied when it holds too many."""

    def __init__(self, path):
        self.path, self.pieces = path, byte_pieces(path)

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        ids = encode_word(word, self.path)
        back = b"".join(self.pieces[i] for i in ids).decode("utf-8", "replace")
        found = self[word] = (np.array(ids, np.uint32), word if back == word else back)
        return found


def _encode(path):
    """Lists of words, group after group -> the ids of each word for each block."""

    def run(frames):
        known, group = _Words(path), None
        for frame in frames:
            out = []
            for row in frame.itertuples():
                if row.group != group:
                    known.clear()
                    group = row.group
                ends = np.cumsum(unpacked(row.lengths)).tolist()
                letters = zstandard.ZstdDecompressor().decompress(bytes(row.letters)).decode()
                words = [letters[a:b] for a, b in zip([0, *ends], ends)]
                ids, back = zip(*map(known.__getitem__, words))
                texts = None if all(b is w or b == w for b, w in zip(back, words)) else list(back)
                sizes = np.fromiter(map(len, ids), np.uint32, len(ids))
                out.append((row.block, row.positions, packed(sizes), packed(np.concatenate(ids)), texts))
            yield pd.DataFrame(out, columns=["block", "positions", "sizes", "ids", "texts"])

    return run


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each span, one span after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _finish(blocks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """Ids and decoded texts of the documents of one block."""
    row = blocks.iloc[0]
    words = np.array(row["words"], object)
    decoded = words.copy()
    sizes = np.zeros(len(words), np.int64)
    at = [unpacked(b) for b in found["positions"]]
    for positions, own, texts in zip(at, found["sizes"], found["texts"]):
        sizes[positions] = unpacked(own)
        if texts is not None:
            decoded[positions] = texts
    starts = np.cumsum(sizes) - sizes
    table = np.empty(int(sizes.sum()), np.int32)
    for positions, ids in zip(at, found["ids"]):
        table[_spans(starts[positions], sizes[positions])] = unpacked(ids)
    ids, texts = [], []
    for codes in texts_of(row):
        ids.append(table[_spans(starts[codes], sizes[codes])])
        texts.append("".join(decoded[codes]))
    return pd.DataFrame({"id": row["ids"], "ids": ids, "decoded": texts})


def encode_and_decode(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, ids, decoded) of every row: its token ids, and the text they decode to.

    Equal to the tokenizers library with the file ``path``, without special
    tokens added, truncation or padding; special tokens spelled out in a text
    become their ids and are spelled out again.  A null or empty text has no
    ids and decodes to an empty text.  Rows without an id, repeated rows and
    repeated ids are encoded like any other.  Other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    split = functools.partial(byte_level_split, path=path)
    blocks = write_blocks(docs, id_col, text_col, F.lit(False), split)
    groups = min(MOST_GROUPS, max(16, blocks.count()))
    lists = "group int, block long, positions binary, lengths binary, letters binary"
    words = blocks.select("block", "words").mapInPandas(_dealt(groups), lists)
    words = words.repartition("group").sortWithinPartitions("group")
    found = words.mapInPandas(_encode(path), "block long, positions binary, sizes binary, ids binary, texts array<string>")
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )
    texts = blocks.select("block", "ids", "lengths", "codes", "words").groupBy("block")
    return texts.cogroup(found.groupBy("block")).applyInPandas(_finish, schema).withColumnRenamed("id", id_col)
