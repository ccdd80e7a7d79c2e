"""Periodic runs against all periods tried one by one, and on awkward rows."""

import random

import numpy as np
import pytest

from millrace.llm import periodic_runs as module
from millrace.llm.periodic_runs import Factors, WaveletTree, find_runs, periodic_runs


def plain(codes, least):
    """Runs by trying every period; of the periods of one stretch the smallest counts."""
    found = {}
    for period in range(1, len(codes) // 2 + 1):
        place = 0
        while place + period < len(codes):
            start = place
            while place + period < len(codes) and codes[place] == codes[place + period]:
                place += 1
            if place - start + period >= max(least, 2 * period):
                found.setdefault((start, place - start + period), period)
            place = max(place, start + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic(draw, most):
    n, kinds = draw.randrange(0, most), draw.choice([1, 2, 2, 3, 5])
    codes = [draw.randrange(kinds) for _ in range(n)]
    for _ in range(draw.randrange(3)):
        if n:
            period, a = draw.randrange(1, 30), draw.randrange(n)
            for i in range(a + period, draw.randrange(a, n + 1)):
                codes[i] = codes[i - period]
    return codes


@pytest.mark.parametrize("seed", range(6))
def test_against_all_periods(seed):
    draw = random.Random(seed)
    for _ in range(150):
        codes, least = periodic(draw, 110), draw.choice([5, 6, 12])
        assert [tuple(r) for r in find_runs(np.array(codes, np.int64), least).tolist()] == plain(codes, least)


def test_long_repetitive_sequences():
    assert find_runs(np.zeros(50_000, np.int64), 12).tolist() == [[0, 50_000, 1]]
    word = np.r_[np.zeros(30, np.int64), 1]
    assert [tuple(r) for r in find_runs(np.tile(word, 60), 12).tolist()] == plain(np.tile(word, 60).tolist(), 12)
    a, b = [0], [0, 1]
    while len(b) < 1_500:
        a, b = b, b + a
    assert [tuple(r) for r in find_runs(np.array(b, np.int64), 12).tolist()] == plain(b, 12)


def test_factors_and_wavelet_tree():
    draw = random.Random(4)
    codes = [draw.randrange(3) for _ in range(200)]
    factors = Factors(np.array(codes, np.int64))
    assert factors.order.tolist() == sorted(range(200), key=lambda i: codes[i:])
    tree = WaveletTree(factors.order, 200)
    low = np.array([draw.randrange(200) for _ in range(500)])
    high = np.array([draw.randrange(a, 201) for a in low])
    bound = np.array([draw.randrange(201) for _ in low])
    want = [min([v for v in factors.order[a:b] if v >= x], default=999) for a, b, x in zip(low, high, bound)]
    assert tree.successor(low, high, bound, 999).tolist() == want


SCHEMA = "doc_id long, text string, row string, runs int, starts int, n_words int"


def test_rows(spark, monkeypatch):
    draw = random.Random(9)
    texts = [None, "", " \t\n", "one", "a " * 12, "a\tb\n" * 7, "É é " * 30 + "ﬁ 日本 x", "no repeat in this text at all", "z" * 9000]
    texts += [" ".join(f"w{c}" for c in periodic(draw, 300)) for _ in range(120)]
    texts += ["same block of words again " * 4_000, texts[20], texts[20]]
    rows = [((1 << 60) + n, t, "x", 1, 2, 3) for n, t in enumerate(texts)]
    rows += [(None, texts[5], "x", 1, 2, 3), rows[6], rows[6]]

    def want(text, least=12):
        words = (text or "").encode().split()
        runs = plain(words, least) if len(words) < 2_000 else [(0, len(words), 5)]
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        return len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()

    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = sorted(((r[0], *want(r[1])) for r in rows), key=repr)
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs(docs).collect()]
    assert sorted(got, key=repr) == expected
    # How texts are put together makes no difference.
    handed = [(t or "").encode().split() for t in texts]
    alone = [module._handle([n], [words], 12).iloc[0] for n, words in enumerate(handed)]
    together = module._handle(list(range(len(handed))), handed, 12)
    for n, row in enumerate(alone):
        assert row["periods"].tolist() == together["periods"][n].tolist()
        assert row["starts"].tolist() == together["starts"][n].tolist() and row["collapsed"] == together["collapsed"][n]
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(docs, least=4)
