"""Exchange of all learned words among the classes of the class bigrams."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import class_bigrams as bigrams

SCHEMA = "doc_id long, text string"


def plain_pairs(texts, belongs, classes):
    """Class bigrams of texts of words, with the edge around each."""
    pairs = np.zeros((classes + 2, classes + 2), np.int64)
    for words in texts:
        line = [classes + 1, *(belongs[w] for w in words), classes + 1]
        for one, two in zip(line, line[1:]):
            pairs[one, two] += 1
    return pairs


def plain_around(texts, belongs, classes):
    """Per word: classes before it, classes after it, how often it follows itself."""
    width, out = classes + 2, {}
    for words in texts:
        line = [None, *words, None]
        own = [classes + 1, *(belongs[w] for w in words), classes + 1]
        for at, word in enumerate(words, 1):
            cells = out.setdefault(word, np.zeros(2 * width + 1, np.int64))
            cells[own[at - 1]] += 1
            cells[width + own[at + 1]] += 1
            cells[-1] += line[at + 1] == word
    return out


def test_exchange_takes_the_class_of_the_highest_likelihood():
    draw, classes = random.Random(5), 4
    texts = [[draw.choice("aabbcdefghijkl") for _ in range(draw.randrange(1, 30))] for _ in range(12)]
    texts += [["m", "m", "m", "a"], ["n"], ["a", "a"]]
    words = sorted({w for t in texts for w in t})
    belongs = {w: draw.randrange(classes) for w in words}
    around = plain_around(texts, belongs, classes)
    table, own = np.array([around[w] for w in words]), np.array([belongs[w] for w in words])
    got = bigrams._exchanged(table, own, plain_pairs(texts, belongs, classes))
    for word, choice in zip(words, got):
        value = [bigrams._likelihood(plain_pairs(texts, belongs | {word: c}, classes)) for c in range(classes)]
        assert value[choice] == pytest.approx(max(value), abs=1e-5)


def test_words_beyond_the_frequent_ones_move_too(spark, monkeypatch):
    draw = random.Random(4)
    # Words of three kinds in turn; the frequent one tells nothing about the others.
    kinds = [[f"{k}{n}" for n in range(40)] for k in "xyz"]
    texts = [["the"] * 3 + [draw.choice(kinds[(at + first) % 3]) for at in range(40)] for first in (0, 1, 2) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(map(" ".join, texts))), SCHEMA).repartition(3)
    found = []
    summed = bigrams._summed
    monkeypatch.setattr(bigrams, "_summed", lambda cells, size: found.append(summed(cells, size)) or found[-1])
    few = bigrams.Settings(classes=4, frequent=10, block_chars=4000)
    scored = bigrams.score_texts(df, F.lit(True), settings=few)
    kept = [bigrams._likelihood(p.reshape(6, 6)) for p in found if p.size == 36]
    # The start, then what sweeps over all words made of it.
    assert len(kept) > 1 and max(kept) > kept[0]
    # No word stays in the class of unclustered words.
    assert all(not p.reshape(6, 6)[4].any() for p in found if p.size == 36)
    rows = scored.collect()
    assert len(rows) == len(texts)
    n = sum(r["n_tokens"] for r in rows)
    # Three kinds of 40 words in turn: less than 2 bits over the choice among 40.
    assert -sum(r["score"] for r in rows) / n < np.log10(40) + 0.2


@pytest.mark.parametrize("word_blocks", [20_000, 7])
def test_neighbours_are_counted_whole(spark, word_blocks):
    draw = random.Random(9)
    texts = [[draw.choice("aabbcdefghijkl") for _ in range(draw.randrange(0, 30))] for _ in range(40)]
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)] + [(None, "a b a b"), (3, None), (3, " ")]
    learned = F.coalesce(F.col("doc_id") % 4 != 0, F.lit(False))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    classes = 3
    blocks = bigrams.write_blocks(df, "doc_id", "text", learned, bigrams.words_of, 60)
    n_blocks = blocks.count()
    assert n_blocks > 7
    dealt = blocks.select("block", "words", "counts").mapInArrow(
        bigrams._dealt(5), "bucket int, block long, words array<string>, positions array<int>, counts array<long>"
    )
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "block")
    numbered, _ = bigrams.materialise(dealt.mapInPandas(bigrams._numbers(100), bigrams._NUMBERED), "numbered")
    names = {}
    count = Counter(w for n, t in enumerate(texts) if n % 4 for w in t)
    for row in numbered.filter("block is null").collect():
        total = bigrams.unpacked(row["totals"], bigrams.COUNTS)
        for word in row["top"]:
            names[word["word"]] = row["bucket"], word["member"]
            assert word["n"] == count[word["word"]] == total[word["member"]]
    assert set(names) == set(count)
    belongs = {w: n % classes for n, w in enumerate(sorted(names))}
    chosen = {}
    for word, (bucket, member) in names.items():
        chosen.setdefault(bucket, []).append((member, belongs[word]))
    totals = numbered.filter("block is null").select("bucket", "totals")
    state = totals.mapInPandas(bigrams._start(classes, chosen), bigrams._CLASSES)
    lookups = bigrams._lookups(numbered, state)
    near = bigrams._all_around(blocks, lookups, classes, n_blocks, word_blocks)
    got = {row["bucket"]: bigrams._table(near.sparkSession.createDataFrame([row], near.schema).toPandas(), 11) for row in near.collect()}
    want = plain_around([t for n, t in enumerate(texts) if n % 4], belongs, classes)
    for word, (bucket, member) in names.items():
        assert got[bucket][member].tolist() == want[word].tolist()
    both = state.drop("moved").join(near, "bucket", "left")
    pairs = bigrams._summed(both.mapInPandas(bigrams._bigrams_of(classes), "cell long, n long"), 25).reshape(5, 5)
    whole = plain_pairs([t for n, t in enumerate(texts) if n % 4 and t], belongs, classes)
    assert pairs.tolist() == whole.tolist()
