"""Steps of the class bigrams that work on whole blocks at once."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import class_bigrams as bigrams

SCHEMA = "doc_id long, text string"
ODD = ["", " a\x0b\x0cB\x1c  c\u0085 É ", "  ", "\tA", "  İ K \x00 z", "A b\n\nA B", "퟿\U0001f600 \U0001f600"]


def odd_texts(n):
    draw = random.Random(3)
    return ODD + ["".join(draw.choice(" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0aAbBcÉ　") for _ in range(draw.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("texts", [odd_texts(500), ["", " "], ["a b"], []])
def test_words_of_many_texts_are_those_of_each(texts):
    lengths, words = bigrams.all_words_of(pa.array(texts, pa.large_string()))
    assert words.to_pylist() == [w for t in texts for w in bigrams.words_of(t)]
    assert lengths.tolist() == [len(bigrams.words_of(t)) for t in texts]


def test_blocks_split_at_once_are_the_same(spark):
    rows = [*enumerate(odd_texts(60)), (None, "a b a b"), (3, None), (3, " ")]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    learned = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))
    one, whole = (
        sorted(map(repr, bigrams.write_blocks(df, "doc_id", "text", learned, bigrams.words_of, 60, split).collect()))
        for split in (None, bigrams.all_words_of)
    )
    assert len(one) > 5 and one == whole


def test_no_text_is_split_by_itself(spark, monkeypatch):
    rows = [*enumerate(odd_texts(60)), (None, "a b a b"), (3, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    learned = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))
    few = bigrams.Settings(classes=3, frequent=10)

    def alone(text):
        raise AssertionError(text)

    monkeypatch.setattr(bigrams, "words_of", alone)
    assert bigrams.score_texts(df, learned, settings=few).count() == len(rows)


def test_logarithms_of_equal_counts_are_taken_once(monkeypatch):
    draw, classes, words = np.random.default_rng(1), 24, 4000
    width = classes + 2
    around = np.zeros((words, 2 * width + 1), np.int64)
    for at in range(words):
        np.add.at(around[at], draw.integers(0, classes, 3), 1)
        np.add.at(around[at], width + draw.integers(0, classes, 3), 1)
    own, pairs = draw.integers(0, classes, words), draw.integers(1000, 9000, (width, width))
    want = [bigrams._exchanged(around[[at]], own[[at]], pairs)[0] for at in range(0, words, 100)]
    taken, log = [], np.log
    monkeypatch.setattr(np, "log", lambda x: taken.append(np.size(x)) or log(x))
    got = bigrams._exchanged(around, own, pairs)
    # Far fewer than one for each word, class and class beside the word.
    assert sum(taken) < 2 * words * classes
    assert got[::100].tolist() == want


def test_a_word_has_one_bucket():
    words = ["a", "ab", "ba", "É", "\x00", "\x00\x00", "x" * 300, "a"]
    whole = pa.array(words)
    hashes = bigrams._hashes(whole)
    assert hashes[0] == hashes[-1] and len(set(hashes.tolist())) == len(set(words))
    assert bigrams._hashes(whole.slice(2, 5)).tolist() == hashes[2:7].tolist()
    assert bigrams._hashes(whole.cast(pa.large_string()).slice(1)).tolist() == hashes[1:].tolist()
