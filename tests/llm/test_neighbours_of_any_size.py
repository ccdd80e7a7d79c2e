"""Nearest neighbours where components have very different sizes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.neighbours import Settings, nearest


def search(spark, vectors, **settings):
    rows = [(n, [float(x) for x in v]) for n, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = nearest(df, F.col("vec_id") % 20 == 0, k=5, settings=Settings(**settings))
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def plain(vectors, k=5):
    out = {}
    for q in range(0, len(vectors), 20):
        scores = []
        for n, v in enumerate(vectors):
            total = 0.0
            for a, b in zip(vectors[q], v):
                total += float(a) * float(b)
            if n != q:
                scores.append((-total, n))
        out[q] = [(n, -s) for s, n in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("odd", [1e200, 1e-200, 1e30, -1e250])
def test_one_vector_of_another_size(spark, odd):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(200, 8))
    vectors[37] = odd * np.abs(vectors[37])
    # Lists are few here, so that all are read.
    got, want = search(spark, vectors, list_rows=1_000), plain(vectors)
    assert set(got) == set(want)
    for q in want:
        assert [n for n, _ in got[q]] == [n for n, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])


@pytest.mark.parametrize("size", [1e150, 1e-120, 1e-150])
def test_all_vectors_of_an_odd_size(spark, size):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(120, 6)) * size
    got, want = search(spark, vectors, list_rows=1_000), plain(draw_again(5))
    assert {q: [n for n, _ in found] for q, found in got.items()} == {q: [n for n, _ in found] for q, found in want.items()}


def draw_again(seed):
    return np.random.default_rng(seed).normal(size=(120, 6))


def test_a_long_query_finds_its_neighbours_too(spark):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(200, 8))
    vectors[40] *= 1e180
    got, want = search(spark, vectors, list_rows=1_000), plain(vectors)
    assert [n for n, _ in got[40]] == [n for n, _ in want[40]] and len(got) == 10
