"""Collocations against plain counting, tries against plain search, and awkward rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import phrases
from millrace.llm.phrase_trie import build, counts
from millrace.llm.phrases import Settings, collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, f long, n long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=10, percent=50, top=2_000):
    found, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                found[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in found.items():
        kept = []
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in frequent.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= percent * a for q, b in frequent.items()):
                continue
            score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        kept.sort()
        out += [
            (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
            for rank, (score, a, phrase, left, right) in enumerate(kept[:top], 1)
        ]
    return sorted(out)


def corpus():
    draw = random.Random(8)
    words = [draw.choice("abcdeÉfgh") + draw.choice(["", "x", "YZ", "ﬁ", "😀"]) for _ in range(30)] + ["the"] * 12
    fixed = ["New York City", "hot dog", "at the end of the day", "one-two"]
    rows = []
    for n in range(300):
        text = " ".join(draw.choice(words) if draw.random() < 0.85 else draw.choice(fixed) for _ in range(draw.randrange(60)))
        text = "".join(c if c != " " or draw.random() < 0.9 else draw.choice([".", ", ", "\n", "\t", "  ", " \t ", "!?", "\r\n", "\x0b"]) for c in text)
        rows.append((draw.choice(["en", "en", "de", None, "und", ""]), text))
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("fr", "only one text here"), ("en", "a b " * 3_000), ("en", "z" * 20_000)]
    rows += [("de", "a\x00b c\x00 " * 12), ("de", "x y z w " * 15), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize(
    "settings",
    [Settings(), Settings(block_words=40, open_words=90, shard_phrases=7, pass_phrases=15, bits=18, held=11), Settings(top=3, least=4, percent=90)],
)
def test_against_plain_counting(spark, settings):
    rows = corpus()
    docs = spark.createDataFrame([(n, t, lang, "x", 1, 2) for n, (lang, t) in enumerate(rows)], SCHEMA).repartition(3)
    got = sorted(map(tuple, collocations(docs, settings=settings).collect()))
    assert got == plain(rows, settings.least, settings.percent, settings.top)
    assert got


def test_empty_tables(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    few = spark.createDataFrame([(1, "hardly any words", "en", "", 0, 0), (2, None, None, "", 0, 0)], SCHEMA)
    assert collocations(few).collect() == []


def test_products_beyond_64_bits(spark):
    docs = spark.range(0, 40, 1, 4).selectExpr(
        "id AS doc_id", "trim(repeat('a b ', 50000)) AS text", "'en' AS lang", "'' AS phrase", "0L AS f", "0L AS n"
    )
    got = sorted(map(tuple, collocations(docs).collect()))
    a, rest = 40 * 50_000, 40 * 49_999
    # "a b" lies inside both triples; "b a" inside them too.
    assert [r[2] for r in got] == ["a b a", "b a b"]
    assert 1_000_000 * a * a > 1 << 61
    for _, _, phrase, f, left, right, n, score in got:
        assert (f, n) == (rest, 2 * a) and score == 1_000_000 * f * f // (left * right)


@pytest.mark.parametrize("seed", range(5))
def test_tries_count_like_plain_search(seed):
    draw = random.Random(seed)
    size, words = draw.choice([2, 3]), draw.choice([1, 2, 7, 40, 900])
    phrases = sorted({tuple(draw.randrange(words) for _ in range(size)) for _ in range(draw.choice([1, 5, 400, 3_000]))})
    draw.shuffle(phrases)
    trie = build(np.array(phrases, np.int64), words)
    text = [draw.randrange(-1, words) for _ in range(4_000)]
    for _ in range(200):
        at = draw.randrange(3_990)
        text[at : at + size] = draw.choice(phrases)
    want = Counter(tuple(text[i : i + size]) for i in range(len(text) - size + 1))
    assert counts(trie, np.array(text, np.int64), len(phrases)).tolist() == [want[p] for p in phrases]
    taken = trie.check[trie.check >= 0]
    assert len(taken) <= len(trie.check) and trie.words == size


def test_blocks_are_not_read_again_for_more_phrases(spark, monkeypatch):
    """What is written, and so what is read, is the same for one group of phrases and for many."""
    names, write = [], phrases.materialise

    def written(df, name):
        names.append(name)
        return write(df, name)

    monkeypatch.setattr(phrases, "materialise", written)
    docs = spark.createDataFrame([(n, t, lang, "x", 1, 2) for n, (lang, t) in enumerate(corpus())], SCHEMA)
    found = []
    for settings in (Settings(), Settings(shard_phrases=7, pass_phrases=15)):
        found.append((sorted(map(tuple, collocations(docs, settings=settings).collect())), names[:]))
        names.clear()
    assert found[0] == found[1] and found[0][0]


@pytest.mark.parametrize("size", [2, 3])
def test_runs_of_numbers_are_tallied(size):
    draw = random.Random(size)
    numbers = [1, 2, 3, 1 << 21, (1 << 31) - 2, (1 << 31) - 1]
    rows = [tuple(draw.choice(numbers) for _ in range(size)) for _ in range(2_000)]
    columns = [np.array(c, np.uint32) for c in zip(*rows)]
    different, total = phrases._tallied(columns)
    want = Counter(rows)
    assert list(zip(*(c.tolist() for c in different))) == sorted(want)
    assert total.tolist() == [want[r] for r in sorted(want)]
    again, total = phrases._tallied([np.r_[c, c[:5]] for c in different], np.r_[total, total[:5]])
    assert total.tolist() == [want[r] * (1 + (i < 5)) for i, r in enumerate(sorted(want))]
    assert list(zip(*(c.tolist() for c in again))) == sorted(want)
