"""Near-duplicate embeddings against all pairs, and on awkward rows."""

import numpy as np
import pytest

from millrace.llm.embedding_duplicates import Settings, buckets, hadamard, make_plan, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id string, digest string, component string"
BIG = 1 << 60


def plain(rows):
    """n_links and component of each row by comparing all pairs."""
    units = {}
    for place, (key, vector) in enumerate(rows):
        if key is None or not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        v = np.array(vector, float)
        v /= np.abs(v).max()
        units[place] = v / np.sqrt((v * v).sum())
    links = {p: set() for p in range(len(rows))}
    for a in units:
        for b in units:
            if a != b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.9:
                links[a].add(b)
    component = {key: key for key, _ in rows if key is not None}
    changed = True
    while changed:
        changed = False
        for a, others in links.items():
            for b in others:
                least = min(component[rows[a][0]], component[rows[b][0]])
                for key in (rows[a][0], rows[b][0]):
                    if component[key] != least:
                        component[key], changed = least, True
    return [(key, len(links[p]), component.get(key), key is None or component[key] == key) for p, (key, _) in enumerate(rows)]


def rows_of_vectors():
    draw = np.random.default_rng(5)
    rows = [(BIG + n, draw.normal(size=20).tolist()) for n in range(60)]
    for group in range(6):
        centre = draw.normal(size=20)
        for n in range(12):
            noisy = centre + draw.normal(size=20) * 0.16 * np.linalg.norm(centre) / np.sqrt(20) * (1 + n % 3)
            rows.append((group * 100 + n, noisy.tolist()))
    # A chain whose ends are far apart, each step just above the threshold.
    for n in range(12):
        angle = n * 0.44
        rows.append((2_000 + n, [float(np.cos(angle)), float(np.sin(angle))] + [0.0] * 18))
    rows += [(3_000, rows[0][1]), (3_001, rows[0][1]), (3_002, (np.array(rows[0][1]) * 7).tolist())]
    rows += [(7, rows[5][1]), (7, rows[5][1]), (8, rows[6][1]), (8, rows[7][1])]
    rows += [(None, rows[1][1]), (4_000, None), (4_001, []), (4_002, [0.0] * 20), (4_003, [float("nan")] * 20)]
    rows += [(4_004, [None] + [1.0] * 19), (4_005, [float("inf")] + [1.0] * 19), (4_006, [1.0, 2.0]), (4_007, [2.0, 4.1])]
    rows += [(4_008, [1e30] * 20), (4_009, [1e-30] * 20), (4_010, [3.0]), (4_011, [-3.0])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x", "y", "z") for k, v in rows], SCHEMA).repartition(3)


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("settings", [Settings(), Settings(unit_rows=9), Settings(bucket_rows=2, miss=1e-6)])
def test_against_all_pairs(spark, settings):
    rows = rows_of_vectors()
    got = collected(near_vectors(frame(spark, rows), settings=settings))
    assert got == sorted(plain([(k, v and [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]), key=repr)


def test_a_hot_group_of_copies_and_one_of_near_copies(spark):
    draw = np.random.default_rng(2)
    same = draw.normal(size=16).tolist()
    centre = draw.normal(size=16)
    rows = [(n, same) for n in range(400)] + [(1_000 + n, (centre + draw.normal(size=16) * 0.04).tolist()) for n in range(400)]
    rows += [(2_000 + n, draw.normal(size=16).tolist()) for n in range(400)]
    got = collected(near_vectors(frame(spark, rows), settings=Settings(unit_rows=50)))
    assert got == sorted(plain([(k, [float(np.float32(x)) for x in v]) for k, v in rows]), key=repr)


def test_empty_table_and_doubles(spark):
    assert near_vectors(frame(spark, [])).collect() == []
    doubles = spark.createDataFrame(
        [("b", [1e200, 2e200]), ("a", [1.0, 2.0]), ("c", [-1.0, 2.0]), ("d", [1e-300, 2e-300])],
        "vec_id string, embedding array<double>",
    )
    assert collected(near_vectors(doubles)) == [("a", 2, "a", True), ("b", 2, "a", False), ("c", 0, "c", True), ("d", 2, "a", False)]


def test_the_transform_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.allclose(hadamard(hadamard(x)), x)
    assert np.allclose((hadamard(x) ** 2).sum(1), (x**2).sum(1))


@pytest.mark.parametrize("rows", [1_000, 10**7, 10**10])
def test_pairs_at_the_threshold_meet_at_any_size(rows):
    settings = Settings(miss=1e-2)
    plan = make_plan(rows, 48, settings)
    assert (2 * plan.size) ** plan.width * settings.bucket_rows >= rows
    draw = np.random.default_rng(3)
    a, b = draw.normal(size=(2, 1_500, 48))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= a * (a * b).sum(1)[:, None]
    b = 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1)[:, None]
    mine, theirs = buckets(a, plan), buckets(b, plan)
    met = (mine == theirs[:, :, :1]).any((1, 2)) | (theirs == mine[:, :, :1]).any((1, 2))
    assert met.mean() > 0.975
