"""Approximate nearest neighbours by inner product, from balanced posting lists.

Vectors get one more component that makes them equally long; the largest inner
product is then the smallest distance.  Centres are fitted on a bounded sample
by splitting it again and again into equal halves.  Every vector is written to
the list of its nearest centre and, near a boundary, to further lists.  Centres
are searched through a graph of their neighbours, which every task holds in
memory.  A query reads the lists whose centre is at most ``ratio`` times as far
as the nearest one; the ratio is measured on sample queries against a search of
all vectors, so that the wanted recall is met.

Vectors far longer than nearly all others would leave no digits for the rest;
they stay out of the index and are compared with every query.
"""

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import materialise


class Settings(NamedTuple):
    """``fit_rows`` bounds the sample that the centres are fitted on, ``probes``
    the queries that the ratio is measured on.  A list has about ``list_rows``
    vectors while the sample allows that many centres, and ``copies`` bounds in
    how many lists a vector stands.  ``shard_rows`` bounds the vectors that one
    task compares at a time."""

    fit_rows: int = 16_000
    list_rows: int = 192
    copies: int = 4
    boundary: float = 1.08
    degree: int = 24
    probes: int = 200
    recall: float = 0.97
    shard_rows: int = 40_000


class Index(NamedTuple):
    """Centres in the order of the splits, the nearest others of each, the centres
    that walks start from, and the length that all vectors are brought to."""

    centres: np.ndarray
    near: np.ndarray
    starts: np.ndarray
    longest: float


def split_centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """Centres of ``lists`` equal parts of the sample, in the order of the splits."""
    parts = [(np.arange(len(sample)), lists)]
    out = []
    while parts:
        rows, wanted = parts.pop()
        own = sample[rows]
        if wanted <= 1 or len(rows) < 2:
            out.append(own.mean(0))
            continue
        first = own[np.argmax(((own - own.mean(0)) ** 2).sum(1))]
        second = own[np.argmax(((own - first) ** 2).sum(1))]
        left = wanted // 2
        cut = round(len(rows) * left / wanted)
        for _ in range(6):
            order = np.argsort(own @ (second - first), kind="stable")
            first, second = own[order[:cut]].mean(0), own[order[cut:]].mean(0)
        parts.append((rows[order[cut:]], wanted - left))
        parts.append((rows[order[:cut]], left))
    return np.array(out)


def build_index(sample: np.ndarray, lists: int, longest: float, degree: int) -> Index:
    centres = split_centres(sample, lists)
    count = len(centres)
    near = np.empty((count, min(degree, max(1, count - 1))), np.int64)
    for at in range(0, count, 1000):
        part = _distances(centres[at : at + 1000], centres)
        part[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf if count > 1 else 0.0
        near[at : at + 1000] = np.argsort(part, axis=1, kind="stable")[:, : near.shape[1]]
    starts = np.unique(np.linspace(0, count - 1, min(count, 32)).astype(int))
    return Index(centres, near, starts, longest)


def _distances(points, centres) -> np.ndarray:
    squares = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None, :]
    return np.sqrt(np.maximum(squares, 0))


def near_centres(index: Index, points: np.ndarray, ratio: float, at_a_time=128):
    """(point, list, distance) of lists within ``ratio`` of the nearest centre, by graph search.

    Each point's lists come nearest first.
    """
    out = [np.empty((0, 3))]
    for start in range(0, len(points), at_a_time):
        found = _walk(index, points[start : start + at_a_time], ratio)
        row, centre = np.nonzero(found <= found.min(1, keepdims=True) * ratio)
        away = found[row, centre]
        order = np.lexsort((centre, away, row))
        out.append(np.column_stack([row[order] + start, centre[order], away[order]]))
    row, centre, away = np.concatenate(out).T
    return row.astype(int), centre.astype(int), away


def _walk(index: Index, points: np.ndarray, ratio: float) -> np.ndarray:
    """Distances to the centres that a walk of the graph reaches, else infinite.

    From the start centres, every reached centre within the ratio of the
    nearest so far is expanded to its neighbours, until nothing new is reached.
    """
    centres, count = index.centres, len(index.centres)
    found = np.full((len(points), count), np.inf)
    found[:, index.starts] = _distances(points, centres[index.starts])
    expanded = np.zeros((len(points), count), bool)
    norms, own = (centres**2).sum(1), (points**2).sum(1)
    fourth = min(3, count - 1)
    while True:
        # At least the four nearest, so that a walk can leave a hollow.
        edge = np.maximum(found.min(1) * ratio, np.partition(found, fourth, axis=1)[:, fourth])
        row, centre = np.nonzero((found <= edge[:, None]) & ~expanded)
        if not len(row):
            return found
        expanded[row, centre] = True
        seen = np.zeros((len(points), count), bool)
        seen[np.repeat(row, index.near.shape[1]), index.near[centre].ravel()] = True
        row, centre = np.nonzero(seen & np.isinf(found))
        squares = own[row] - 2 * np.einsum("ij,ij->i", points[row], centres[centre]) + norms[centre]
        found[row, centre] = np.sqrt(np.maximum(squares, 0))


def _first(row: np.ndarray, count: int) -> np.ndarray:
    """Which of sorted rows are among the first ``count`` of their value."""
    return np.arange(len(row)) - np.searchsorted(row, row) < count


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with the component that makes all of them ``longest`` long."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(1), 0))
    return np.hstack([vectors, rest[:, None]])


def directions(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; no size of components is too large or too small."""
    vectors = vectors / np.abs(vectors).max(1)[:, None]
    return vectors / np.sqrt((vectors**2).sum(1))[:, None]


def _products(queries, which_query, vectors, which_vector, at_a_time=20_000) -> np.ndarray:
    """Inner products of chosen pairs, summed component by component, so that
    equal vectors tie."""
    out = np.zeros(len(which_query))
    for start in range(0, len(out), at_a_time):
        part = slice(start, start + at_a_time)
        left, right = queries[which_query[part]], vectors[which_vector[part]]
        for d in range(vectors.shape[1]):
            out[part] += left[:, d] * right[:, d]
    return out


def _promising(queries: np.ndarray, vectors: np.ndarray, k: int, left_out: np.ndarray):
    """(query, vector) positions that hold every one of the k best and all ties.

    A matrix product finds them; its rounding is allowed for by a margin.
    """
    scores = queries @ vectors.T
    scores[left_out] = -np.inf
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k]
        margin = 1e-12 * np.sqrt((queries**2).sum(1) * max((vectors**2).sum(1).max(), 1e-300))
        return np.nonzero((scores >= (least - margin)[:, None]) & np.isfinite(scores))
    return np.nonzero(np.isfinite(scores))


def _best(rows, ids, scores, k):
    """The k best of each row without repeats, ties to the smaller id, in order."""
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    # A vector that stands in several lists scores the same in each.
    new = np.r_[True, (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])][: len(rows)]
    rows, ids, scores = rows[new], ids[new], scores[new]
    keep = _first(rows, k)
    return rows[keep], ids[keep], scores[keep]


def _stack(frame, column="vector") -> np.ndarray:
    return np.array(frame[column].tolist(), np.float64).reshape(len(frame), -1)


def _posted(index: Index, settings: Settings):
    """Each vector with the lists it stands in, nearest first."""

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), 1000):
                part = frame.iloc[at : at + 1000]
                points = lengthened(_stack(part), index.longest)
                row, centre, _ = near_centres(index, points, settings.boundary)
                keep = _first(row, settings.copies)
                yield part.iloc[row[keep]].assign(list=centre[keep].astype(np.int32))

    return run


def _probed(index: Index, ratio: float, shard_of: np.ndarray):
    """Each query with the lists it reads, by shard."""

    def run(frames):
        for frame in frames:
            for at in range(0, len(frame), 256):
                part = frame.iloc[at : at + 256]
                vectors = _stack(part)
                points = np.hstack([directions(vectors) * index.longest, np.zeros((len(part), 1))])
                row, centre, _ = near_centres(index, points, ratio)
                shards = shard_of[centre]
                order = np.lexsort((centre, shards, row))
                row, centre, shards = row[order], centre[order], shards[order]
                cuts = np.flatnonzero(np.diff(row) | np.diff(shards)) + 1
                groups = np.split(np.arange(len(row)), cuts)
                yield part.iloc[[row[g[0]] for g in groups]].assign(
                    shard=[int(shards[g[0]]) for g in groups], lists=[centre[g].astype(np.int32) for g in groups]
                )

    return run


def _by_shard(k: int):
    """The best of a shard for each query that reads it."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if vectors.empty or queries.empty:
            return pd.DataFrame({c: [] for c in columns})
        vectors = vectors.sort_values(["list", "vec_id"], kind="stable")
        lists, ids, points = vectors["list"].to_numpy(), vectors["vec_id"].to_numpy(), _stack(vectors)
        asked = _stack(queries)
        # A power of two taken out of a query, and given back to its scores, changes no digit.
        _, power = np.frexp(np.abs(asked).max(1))
        asked = np.ldexp(asked, -power[:, None])
        sizes = queries["lists"].map(len).to_numpy()
        who, which = np.repeat(np.arange(len(queries)), sizes), np.concatenate(queries["lists"].to_list())
        order = np.argsort(which, kind="stable")
        who, which = who[order], which[order]
        names = queries["vec_id"].to_numpy()
        parts = []
        for own in np.unique(which):
            first, last = np.searchsorted(lists, [own, own + 1])
            if first == last:
                continue
            rows = who[slice(*np.searchsorted(which, [own, own + 1]))]
            same = names[rows][:, None] == ids[None, first:last]
            query, vector = _promising(asked[rows], points[first:last], k, same)
            parts.append((rows[query], vector + first))
        if not parts:
            return pd.DataFrame({c: [] for c in columns})
        rows, found = (np.concatenate(p) for p in zip(*parts))
        power = power + queries["exponent"].to_numpy()
        scores = np.ldexp(_products(asked, rows, points, found), power[rows] + vectors["exponent"].to_numpy()[found])
        rows, vec_ids, scores = _best(rows, ids[found], scores, k)
        return pd.DataFrame({"query_id": names[rows], "vec_id": vec_ids, "score": scores})

    return run


def _nearest_of_all(ids: np.ndarray, points: np.ndarray, k: int):
    """Each task's best for some queries, over all of its vectors."""

    def run(frames):
        best = (np.empty(0, int), np.empty(0, np.int64), np.empty(0))
        for frame in frames:
            for at in range(0, len(frame), 5000):
                part = frame.iloc[at : at + 5000]
                own, vectors = part["vec_id"].to_numpy(), _stack(part)
                query, vector = _promising(points, vectors, k, ids[:, None] == own[None, :])
                more = (query, own[vector], _products(points, query, vectors, vector))
                best = _best(*(np.concatenate(pair) for pair in zip(best, more)), k)
        yield pd.DataFrame({"query_id": ids[best[0]], "vec_id": best[1], "score": best[2]})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector): the rows that can take part.

    Left out are rows without an id, and vectors that are null, empty, zero, of
    another than the commonest length, or hold null or non-finite components.
    """
    doubles = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), doubles.alias("vector")).dropna()
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    return rows.filter(F.size("vector") == (common["size"] if common else 0))


def fit(written: DataFrame, rows: int, settings: Settings, k: int) -> tuple[Index, float]:
    """The index of a written table of vectors, and the ratio that gives the recall."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    longest = float(written.agg(F.max(norm)).first()[0]) * (1 + 1e-12)
    picked = written.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.fit_rows).toPandas()
    sample = _stack(picked)
    lists = max(1, min(rows // settings.list_rows, len(sample) // 12))
    index = build_index(lengthened(sample, longest), lists, longest, settings.degree)
    # Sample queries: the rows that come last in the order of the sample.
    probes = picked.tail(min(settings.probes, len(picked)))
    ids, points = probes["vec_id"].to_numpy(), _stack(probes)
    best = written.mapInPandas(_nearest_of_all(ids, points, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    truth = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    truth = truth.select("query_id", F.col("vec_id").alias("wanted"))
    near = written.join(F.broadcast(truth), F.col("vec_id") == F.col("wanted")).select("query_id", "vec_id", "vector").toPandas()
    if near.empty:
        return index, 1.0
    near = near.drop_duplicates(["query_id", "vec_id"])
    row, centre, _ = near_centres(index, lengthened(_stack(near), longest), settings.boundary)
    keep = _first(row, settings.copies)
    asked = directions(points) * longest
    away = _distances(np.hstack([asked, np.zeros((len(asked), 1))]), index.centres)
    away /= np.maximum(away.min(1, keepdims=True), 1e-300)
    at = {name: position for position, name in enumerate(ids)}
    query = np.array([at[q] for q in near["query_id"]])
    needed = np.full(len(near), np.inf)
    np.minimum.at(needed, row[keep], away[query[row[keep]], centre[keep]])
    return index, float(np.quantile(needed, settings.recall, method="higher")) * (1 + 1e-9)


FAR = 2.0**20


def _scaled(written: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The vectors that an index can hold, and those far longer, if there are any.

    ``exponent`` is the power of two that was taken out of a vector, one for
    all of either frame.  At most one vector in a hundred is far longer: than
    ``FAR`` times the largest component of the 99th percentile.
    """
    size = F.array_max(F.transform("vector", F.abs))
    facts = written.agg(F.percentile_approx(size, 0.99, 1_000).alias("typical"), F.max(size).alias("most")).first()
    typical, most = facts["typical"], facts["most"]
    usual = 2.0**-100 < typical < 2.0**100

    def shifted(df, by):
        # In two steps, as a power of two may itself be too large.
        halves = [2.0 ** -(by // 2), 2.0 ** -(by - by // 2)]
        vector = F.transform("vector", lambda x: x * F.lit(halves[0]) * F.lit(halves[1])) if by else F.col("vector")
        return df.select("vec_id", vector.alias("vector"), F.lit(by).alias("exponent"))

    taken = 0 if usual else math.frexp(typical)[1]
    if most / FAR <= typical:
        return shifted(written, taken), None
    far = size / F.lit(FAR) > typical
    return shifted(written.filter(~far), taken), shifted(written.filter(far), math.frexp(most)[1])


def nearest(vectors: DataFrame, is_query, k=20, id_col="vec_id", vector_col="embedding", settings=Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each query.

    ``is_query`` is a condition on the column ``vec_id``; candidates are all
    rows but those with the id of the query.  The score is the inner product in
    double precision, the same for equal vectors; ties go to the smaller id.
    With fewer candidates than ``k`` a query has that many rows.  ``usable``
    says which rows take part; rows that repeat an id are one candidate.
    Components may have any finite size; a score that passes the range of
    doubles is infinite.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    written, rows = materialise(usable(vectors, id_col, vector_col), "vectors")
    if not rows:
        return written.sparkSession.createDataFrame([], schema)
    written, far = _scaled(written)
    if far is not None:
        (written, rows), (far, far_rows) = materialise(written, "vectors"), materialise(far, "far")
    index, ratio = fit(written, rows, settings, k)
    columns = "vec_id long, vector array<double>, exponent int"
    posted, entries = materialise(written.mapInPandas(_posted(index, settings), f"{columns}, list int"), "postings")
    # Shards: runs of lists in the order of the splits, and parts of lists that are too long.
    count = len(index.centres)
    shards = max(1, math.ceil(entries / settings.shard_rows))
    shard_of = (np.arange(count) * shards // count).astype(np.int32)
    table = F.array(*(F.lit(int(s)) for s in np.searchsorted(shard_of, np.arange(1, shards))))
    own = F.aggregate(table, F.lit(0), lambda n, first: n + (F.col("list") >= first).cast("int")) if shards > 1 else F.lit(0)
    sharded = posted.withColumn("shard", own.cast("int"))
    parts = sharded.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / settings.shard_rows / 1.5).cast("int").alias("parts"))
    parts, _ = materialise(parts, "parts")
    sharded = sharded.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    sharded = sharded.drop("parts")
    queries = written if far is None else written.unionByName(far)
    queries = queries.filter(is_query).dropDuplicates(["vec_id"])
    asked = queries.mapInPandas(_probed(index, ratio, shard_of), f"{columns}, shard int, lists array<int>")
    asked = asked.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    if far is not None:
        # Shards of their own, which every query reads.
        more = max(1, math.ceil(far_rows / settings.shard_rows))
        place = (shards + F.pmod(F.xxhash64("vec_id"), F.lit(more))).cast("int")
        sharded = sharded.unionByName(far.withColumns({"list": F.lit(-1), "shard": place, "part": F.lit(0)}))
        every = F.explode(F.sequence(F.lit(shards), F.lit(shards + more - 1)))
        asked = asked.unionByName(queries.withColumns({"lists": F.array(F.lit(-1)), "shard": every, "part": F.lit(0)}))
    found = (
        sharded
        .groupBy("shard", "part")
        .cogroup(asked.groupBy("shard", "part"))
        .applyInPandas(_by_shard(k), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
