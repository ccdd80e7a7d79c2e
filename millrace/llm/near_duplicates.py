"""Near-duplicate texts: banded MinHash, sequential Bayesian pruning, exact check.

Texts with one and the same shingle set are one class, held by its smallest id.
Classes that agree in a band of their signature are candidates.  Candidates
that hang together form a cluster, which one task compares; a cluster too large
for that is compared bucket by bucket, and a bucket too large for one task
block against block, so no task holds an unbounded group and no pair is left
out.  Inside a task, pairs drop out as soon as the posterior probability that
they reach the threshold falls below ``miss``; what survives is confirmed on
the full sets.  Only links that join two groups not yet joined are written, at
most one per class and task.
"""

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from millrace.llm.frames import listed
from millrace.llm.graph import components
from millrace.llm.words import WordHashes, mixed, shingle_hashes, words_of
from millrace.session import materialise


class Settings(NamedTuple):
    """``miss``: the chance, for a pair just at the threshold, to share no band,
    and likewise to be pruned.  ``unit_shingles`` and ``unit_classes`` bound
    what one task compares at a time."""

    width: int = 5
    percent: int = 85
    rows: int = 6
    miss: float = 1e-6
    step: int = 30
    unit_shingles: int = 1_500_000
    unit_classes: int = 3_000

    @property
    def bands(self) -> int:
        shared = (self.percent / 100) ** self.rows
        return max(1, math.ceil(math.log(self.miss) / math.log1p(-shared)))


BATCH_SHINGLES = 1 << 16


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_240_229)
    return (
        draw.integers(1, 1 << 32, count, np.uint64).astype(np.uint32) | np.uint32(1),
        draw.integers(0, 1 << 32, count, np.uint64).astype(np.uint32),
    )


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash signatures (sets x count) of non-empty sets of 64-bit hashes."""
    out = np.empty((len(sets), count), np.uint32)
    by, flip = _factors(count)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= BATCH_SHINGLES):
            size += len(sets[end])
            end += 1
        values = np.concatenate(sets[at:end])
        values = (values ^ (values >> np.uint64(32))).astype(np.uint32)
        starts = np.cumsum([0] + [len(s) for s in sets[at : end - 1]])
        for k in range(count):
            out[at:end, k] = np.minimum.reduceat((values * by[k]) ^ flip[k], starts)
        at = end
    return out


def band_keys(signs: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature values (sets x bands)."""
    bands = signs.shape[1] // rows
    parts = signs.reshape(len(signs), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for row in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, row])
    return keys


def shingle_set(text, hashes: WordHashes, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(hashes.of(words_of(text)), width))


def _sketch(settings: Settings):
    def run(frames):
        hashes = WordHashes()
        for frame in frames:
            for at in range(0, len(frame), 500):
                part = frame.iloc[at : at + 500]
                sets = [shingle_set(t, hashes, settings.width) for t in part["text"]]
                keys: list = [None] * len(sets)
                full = [i for i, s in enumerate(sets) if len(s)]
                if full:
                    signs = signatures([sets[i] for i in full], settings.bands * settings.rows)
                    for i, row in zip(full, band_keys(signs, settings.rows).view(np.int64)):
                        keys[i] = row
                yield pd.DataFrame(
                    {
                        "id": part["id"].to_numpy(),
                        "n_shingles": [len(s) for s in sets],
                        "digest": [xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                        "bands": keys,
                    }
                )

    return run


def _sets(settings: Settings):
    def run(frames):
        hashes = WordHashes()
        for frame in frames:
            for at in range(0, len(frame), 500):
                part = frame.iloc[at : at + 500]
                sets = [shingle_set(t, hashes, settings.width) for t in part["text"]]
                found = [xxh3_128_digest(s.tobytes()) for s in sets]
                same = [f == bytes(d) for f, d in zip(found, part["digest"])]
                out = part[["id"]].assign(shingles=[s.tobytes() for s in sets])
                yield out[same]

    return run


class _Groups:
    """Union-find over positions."""

    def __init__(self, count):
        self.up = list(range(count))

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x, y) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on) after each batch.

    With a uniform prior the posterior of the similarity after m matches in n
    is Beta(1 + m, 1 + n - m); its tail above t equals P(Bin(n + 1, t) <= m).
    """
    t, total, out = settings.percent / 100, settings.bands * settings.rows, []
    for n in range(settings.step, total + 1, settings.step):
        tail, m = 0.0, -1
        while tail < settings.miss:
            m += 1
            tail += math.exp(
                math.lgamma(n + 2)
                - math.lgamma(m + 1)
                - math.lgamma(n + 2 - m)
                + m * math.log(t)
                + (n + 1 - m) * math.log1p(-t)
            )
        out.append((n, m))
    return out


def _candidates(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that share a band, a block of rows at a time."""
    count = len(keys)
    for start in range(0, count, blocks):
        mine = keys[start : start + blocks]
        shared = np.zeros((len(mine), count), bool)
        for band in range(keys.shape[1]):
            shared |= mine[:, band, None] == keys[None, :, band]
        left, right = np.nonzero(shared)
        left = left + start
        keep = left < right
        yield left[keep], right[keep]


def similar_links(sets: list[np.ndarray], settings: Settings) -> list[tuple[int, int]]:
    """Links that join all positions whose sets are similar enough, directly or not."""
    total = settings.bands * settings.rows
    signs = signatures(sets, total)
    keys = band_keys(signs, settings.rows)
    sizes = np.array([len(s) for s in sets])
    bounds = least_matches(settings)
    groups, links = _Groups(len(sets)), []
    for left, right in _candidates(keys, max(1, 4_000_000 // len(sets))):
        small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
        keep = 100 * small >= settings.percent * large
        left, right = left[keep], right[keep]
        matches, done = np.zeros(len(left), np.int32), 0
        for compared, least in bounds:
            matches += (signs[left, done:compared] == signs[right, done:compared]).sum(1, dtype=np.int32)
            keep = matches >= least
            left, right, matches, done = left[keep], right[keep], matches[keep], compared
        for at in np.argsort(-matches, kind="stable"):
            i, j = int(left[at]), int(right[at])
            if groups.root(i) == groups.root(j):
                continue
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= settings.percent * (len(sets[i]) + len(sets[j]) - both):
                groups.join(i, j)
                links.append((i, j))
    return links


def _link_unit(settings: Settings):
    def run(frame):
        frame = frame.drop_duplicates("id").sort_values("id")
        ids = frame["id"].to_numpy()
        sets = [np.frombuffer(b, np.uint64) for b in frame["shingles"]]
        links = similar_links(sets, settings)
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]})

    return run


def _units(members: DataFrame, clusters: DataFrame, settings: Settings) -> DataFrame:
    """(id, digest, unit): the tasks that a class takes part in.

    members: (key, id, n_shingles, digest), the buckets of at least two classes;
    clusters: (node, component).
    """
    nodes = members.select("id", "n_shingles", "digest").distinct()
    nodes = nodes.join(clusters, nodes["id"] == clusters["node"]).drop("node")
    total = nodes.groupBy("component").agg(
        F.sum("n_shingles").alias("weight"), F.count(F.lit(1)).alias("classes")
    )
    fits = (F.col("weight") <= settings.unit_shingles) & (F.col("classes") <= settings.unit_classes)
    nodes, _ = materialise(nodes.join(total.select("component", fits.alias("fits")), "component"), "nodes")
    small = nodes.filter("fits").select("id", "digest", F.xxhash64("component").alias("unit"))
    unfit = nodes.filter("not fits").select(F.col("id").alias("node"))
    large = members.join(unfit, F.col("id") == F.col("node"), "left_semi")
    # Buckets of the same members are compared once.
    marks = large.groupBy("key").agg(
        F.sum("n_shingles").alias("weight"),
        F.count(F.lit(1)).alias("classes"),
        F.expr("bit_xor(xxhash64(id, digest))").alias("members"),
    )
    marks = marks.groupBy("members", "classes", "weight").agg(F.min("key").alias("key"))
    over = F.greatest(F.col("weight") / settings.unit_shingles, F.col("classes") / settings.unit_classes)
    blocks = F.when(over > 1, F.ceil(2 * over)).otherwise(1).cast("int")
    marks = marks.select("key", blocks.alias("blocks"))
    dealt = large.join(marks, "key").withColumn("block", F.pmod(F.xxhash64("id", "digest"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("key", "id", "digest", "block", other.alias("other"))
    split = dealt.select(
        "id", "digest", F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("unit")
    )
    return small.unionByName(split)


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", settings=Settings()) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``docs``.

    Linked are texts whose word-shingle sets have at least ``percent`` of their
    union in common; ``component_id`` is the smallest id that can be reached.
    Rows with an empty or null text are linked with nothing.  A row without an
    id has no component and is kept.  Rows that repeat an id share its
    component.  Other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )
    sketches, _ = materialise(texts.mapInPandas(_sketch(settings), schema), "sketches")
    classes = (
        sketches.filter("n_shingles > 0 and id is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    owners, _ = materialise(classes, "classes")
    in_bands = owners.select("id", "n_shingles", "digest", F.explode("bands").alias("key"))
    buckets = in_bands.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last"))
    members, found = materialise(in_bands.join(buckets.filter("centre < last").drop("last"), "key"), "members")
    if found:
        clusters = components(members.select(F.col("centre").alias("a"), F.col("id").alias("b")))
        units, _ = materialise(_units(members, clusters, settings), "units")
        wanted = listed(units.select(F.col("id").alias("node"), "digest").distinct(), "wanted")
        needed = texts.join(wanted, F.col("id") == F.col("node")).select("id", "digest", "text")
        binary = T.StructType([T.StructField("id", kind), T.StructField("shingles", T.BinaryType())])
        sets = needed.mapInPandas(_sets(settings), binary)
        sets = sets.join(units.select(F.col("id").alias("node"), "unit"), F.col("id") == F.col("node"))
        link = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
        links = sets.select("unit", "id", "shingles").groupBy("unit").applyInPandas(_link_unit(settings), link)
        groups = components(links)
        reached = owners.select("digest", "id").join(groups, F.col("id") == F.col("node"), "left")
        reached = reached.select("digest", F.coalesce("component", "id").alias("component"))
    else:
        reached = owners.select("digest", F.col("id").alias("component"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return (
        sketches.drop("bands")
        .join(reached, "digest", "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        )
    )
