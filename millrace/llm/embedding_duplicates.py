"""Near-duplicate embeddings: cross-polytope hashing with verified candidate pairs.

A vector is turned by three rounds of sign flips and a fast Hadamard transform;
its hash is the axis it then lies closest to.  ``width`` such hashes make the
bucket of a table.  A vector lives in its own bucket of every table and visits
the buckets that come next by distance, so a pair is a candidate where one of
the two lives in a bucket that the other lives in or visits.  Candidates are
verified by their cosine in double precision.

A pair may meet in many buckets.  It counts in the first one alone, which a
task can tell from the two vectors, so that counts per vector are written in
place of pairs, and only the links that join two groups.  Equal vectors are one
class.  A bucket too large for one task is compared block against block.
"""

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.frames import listed
from millrace.llm.graph import components
from millrace.session import materialise

ROUNDS = 3
STRIP = 512


class Settings(NamedTuple):
    """``miss``: the chance that a pair just at ``least`` shares no bucket.
    ``bucket_rows`` is how many vectors a bucket holds on average, at most;
    ``unit_rows`` bounds the vectors of a block that a task compares."""

    least: float = 0.9
    miss: float = 1e-4
    bucket_rows: int = 1_000
    unit_rows: int = 4_000
    most_probes: int = 24


class Plan(NamedTuple):
    """``tables`` tables of buckets of ``width`` hashes over ``size`` axes, of
    which a vector enters ``probes`` each."""

    size: int
    width: int
    tables: int
    probes: int


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of every row; the length is a power of two."""
    rows, size = x.shape
    half = 1
    while half < size:
        pairs = x.reshape(rows, -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, size)
        half *= 2
    return x / math.sqrt(size)


def _axes(x: np.ndarray, signs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` nearest signed axes of each turned row, and how much farther each is."""
    for flips in signs:
        x = hadamard(x * flips)
    size = np.abs(x)
    order = np.argsort(-size, axis=1, kind="stable")[:, :most]
    near = np.take_along_axis(size, order, 1)
    negative = np.take_along_axis(x, order, 1) < 0
    return 2 * order + negative, (near[:, :1] - near) ** 2


def buckets(units: np.ndarray, plan: Plan) -> np.ndarray:
    """(rows, tables, probes) bucket keys; the first of a table is the vector's own."""
    padded = np.zeros((len(units), plan.size))
    padded[:, : units.shape[1]] = units
    draw = np.random.default_rng(20_260_101)
    signs = draw.choice(np.array([-1.0, 1.0]), (plan.tables, plan.width, ROUNDS, plan.size))
    out = np.empty((len(units), plan.tables, plan.probes), np.int64)
    for table in range(plan.tables):
        keys, far = np.zeros((len(units), 1), np.int64), np.zeros((len(units), 1))
        for step in range(plan.width):
            axes, more = _axes(padded, signs[table, step], plan.probes)
            keys = (keys[:, :, None] * (2 * plan.size) + axes[:, None, :]).reshape(len(units), -1)
            far = (far[:, :, None] + more[:, None, :]).reshape(len(units), -1)
            best = np.argsort(far, axis=1, kind="stable")[:, : plan.probes]
            keys, far = np.take_along_axis(keys, best, 1), np.take_along_axis(far, best, 1)
        out[:, table] = np.pad(keys, ((0, 0), (0, plan.probes - keys.shape[1])), mode="edge")
    return out


def make_plan(rows: int, dimension: int, settings: Settings) -> Plan:
    """Hashes per bucket by the number of vectors, tables and probes by the chance to miss.

    The chance that a pair at ``least`` meets in a table is measured on random
    pairs with exactly that cosine; the choice with the fewest rows to move is taken.
    """
    size = max(2, 1 << (dimension - 1).bit_length())
    wanted = math.log(max(rows / settings.bucket_rows, 1)) / math.log(2 * size)
    width = max(1, min(math.ceil(wanted), int(62 / math.log2(2 * size))))
    draw = np.random.default_rng(7)
    first, second = draw.normal(size=(2, 4_000, size))
    first /= np.linalg.norm(first, axis=1)[:, None]
    second -= first * (first * second).sum(1)[:, None]
    second /= np.linalg.norm(second, axis=1)[:, None]
    second = settings.least * first + math.sqrt(1 - settings.least**2) * second
    probes = min(settings.most_probes, 2 * size)
    one = Plan(size, width, 1, probes)
    mine, theirs = buckets(first, one)[:, 0], buckets(second, one)[:, 0]
    visits = np.maximum.accumulate(mine == theirs[:, :1], 1) | np.maximum.accumulate(theirs == mine[:, :1], 1)
    best = None
    for count, met in enumerate(visits.mean(0), 1):
        met = min(max(float(met), 1e-3), 1 - settings.miss / 10)
        tables = max(1, math.ceil(math.log(settings.miss) / math.log1p(-met)))
        if best is None or tables * count < best.tables * best.probes:
            best = Plan(size, width, tables, count)
    return best


def _prepared(kind):
    """Vectors that take part as bytes, with a digest; others have none."""

    def run(frames):
        for frame in frames:
            data, digests, sizes = [], [], []
            for vector in frame["vector"]:
                values = None if vector is None else np.asarray(vector, kind)
                if values is None or not len(values) or not np.isfinite(values).all() or not values.any():
                    data.append(None), digests.append(None), sizes.append(None)
                    continue
                data.append(values.tobytes())
                digests.append(hashlib.md5(values.tobytes(), usedforsecurity=False).digest())
                sizes.append(len(values))
            yield pd.DataFrame(
                {"id": frame["id"], "dimension": pd.array(sizes, "Int32"), "digest": digests, "data": data}
            )

    return run


def unit_vectors(data, kind) -> np.ndarray:
    """Rows of length one in double precision; any finite length is handled."""
    rows = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    rows /= np.abs(rows).max(1)[:, None]
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def _posted(kind, plans, with_data):
    def run(frames):
        for frame in frames:
            for dimension, part in frame.groupby("dimension"):
                plan = plans[dimension]
                for at in range(0, len(part), 2_000):
                    rows = part.iloc[at : at + 2_000]
                    keys = buckets(unit_vectors(rows["data"], kind), plan)
                    table, probe = np.divmod(np.arange(plan.tables * plan.probes), plan.probes)
                    each = len(table)
                    out = pd.DataFrame(
                        {
                            "dimension": np.int32(dimension),
                            "table": np.tile(table.astype(np.int32), len(rows)),
                            "bucket": keys.reshape(-1),
                            "visits": np.tile(probe > 0, len(rows)),
                        }
                    )
                    if with_data:
                        for name in ("id", "digest", "weight", "data"):
                            out[name] = np.repeat(rows[name].to_numpy(), each)
                    # Where a vector has fewer buckets than probes, its last one repeats.
                    again = np.zeros(keys.shape, bool)
                    again[:, :, 1:] = keys[:, :, 1:] == keys[:, :, :-1]
                    yield out[~again.reshape(-1)]

    return run


def first_meeting(mine: np.ndarray, theirs: np.ndarray, table: int, bucket: int) -> np.ndarray:
    """Whether pairs (rows of both arrays of ``buckets``) meet in this bucket and in none before it."""
    first = np.ones(len(mine), bool)
    for before in range(table + 1):
        own, other = mine[:, before, 0], theirs[:, before, 0]
        comes = (theirs[:, before] == own[:, None]).any(1)
        goes = (mine[:, before] == other[:, None]).any(1)
        if before < table:
            first &= ~(comes | goes)
        else:
            least = np.where(comes & goes, np.minimum(own, other), np.where(comes, own, other))
            first &= (comes | goes) & (least == bucket)
    return first


class _Joined:
    """Groups of positions, as a label for each."""

    def __init__(self, count):
        self.label = np.arange(count)

    def join(self, place, others) -> list[int]:
        """Positions among ``others`` whose groups the one of ``place`` swallows."""
        labels, at = np.unique(self.label[others], return_index=True)
        new = labels != self.label[place]
        if not new.any():
            return []
        self.label[np.isin(self.label, labels)] = self.label[place]
        return others[at[new]].tolist()


def _compare(kind, plans, settings):
    """Counts of links and joining links of one unit: a bucket, or two blocks of one."""

    def run(frame):
        frame = frame.sort_values(["id", "digest"], kind="stable", ignore_index=True)
        plan = plans[int(frame["dimension"].iloc[0])]
        table, bucket = int(frame["table"].iloc[0]), int(frame["bucket"].iloc[0])
        units = unit_vectors(frame["data"], kind)
        visits, weight = frame["visits"].to_numpy(), frame["weight"].to_numpy(np.int64)
        block = frame["block"].to_numpy()
        across = block.min() != block.max()
        ids = frame["id"].to_numpy()
        links, joined, edges = np.zeros(len(frame), np.int64), _Joined(len(frame)), []
        keys, known = np.zeros((len(frame), plan.tables, plan.probes), np.int64), np.zeros(len(frame), bool)
        for at in range(0, len(frame), STRIP):
            rows = slice(at, at + STRIP)
            close = units[rows] @ units.T >= settings.least
            close &= ~(visits[rows, None] & visits[None, :])
            if across:
                close &= block[rows, None] != block[None, :]
            left, right = np.nonzero(close)
            left = left + at
            keep = left < right
            left, right = left[keep], right[keep]
            if not len(left):
                continue
            needed = np.zeros(len(frame), bool)
            needed[left] = needed[right] = True
            needed &= ~known
            if needed.any():
                keys[needed], known = buckets(units[needed], plan), known | needed
            for part in range(0, len(left), 1 << 18):
                a, b = left[part : part + (1 << 18)], right[part : part + (1 << 18)]
                first = first_meeting(keys[a], keys[b], table, bucket)
                links += np.bincount(a[first], weight[b[first]], len(frame)).astype(np.int64)
                links += np.bincount(b[first], weight[a[first]], len(frame)).astype(np.int64)
            starts = np.flatnonzero(np.diff(left, prepend=-1))
            for begin, end in zip(starts, [*starts[1:], len(left)]):
                place = int(left[begin])
                edges += [(ids[place], ids[other]) for other in joined.join(place, right[begin:end])]
        some = np.flatnonzero(links)
        more = len(edges)
        # Ids keep their own type: as objects they are never turned into floats.
        return pd.DataFrame(
            {
                "digest": [*frame["digest"].to_numpy()[some], *[None] * more],
                "links": pd.array([*links[some].tolist(), *[None] * more], "Int64"),
                "a": pd.Series([*[None] * len(some), *[a for a, _ in edges]], dtype=object),
                "b": pd.Series([*[None] * len(some), *[b for _, b in edges]], dtype=object),
            }
        )

    return run


def near_vectors(vectors: DataFrame, id_col="vec_id", vector_col="embedding", settings=Settings()) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Linked are rows whose vectors have a cosine of at least ``least``;
    ``n_links`` counts the other rows linked to one, ``component_id`` is the
    smallest id that links reach, and the row that bears it is kept.  A pair
    just at the threshold is missed with the chance ``miss``, a closer one with
    less; no pair below it is linked.

    A vector that is null, empty, zero, or has null or non-finite components is
    linked with nothing, and neither are vectors of different lengths.  Any
    finite size of components is handled.  Equal vectors are linked whatever
    their number.  A row without an id is linked with nothing, has no component
    and is kept.  Rows that repeat an id share its component and count as rows.
    An empty table gives an empty result.  Other columns are not read.
    """
    id_type = vectors.schema[id_col].dataType
    element = vectors.schema[vector_col].dataType.elementType
    kind = np.dtype(np.float32 if isinstance(element, T.FloatType) else np.float64)
    given = vectors.select(
        F.col(id_col).alias("id"),
        F.col(vector_col).cast(T.ArrayType(T.FloatType() if kind.itemsize == 4 else T.DoubleType())).alias("vector"),
    )
    node = T.StructField("id", id_type)
    digest, data = T.StructField("digest", T.BinaryType()), T.StructField("data", T.BinaryType())
    dimension = T.StructField("dimension", T.IntegerType())
    # Python sees no missing id, so whole numbers stay whole numbers there.
    prepared = given.filter("id is not null").mapInPandas(
        _prepared(kind), T.StructType([node, dimension, digest, data])
    )
    prepared, _ = materialise(prepared, "vectors")
    usable = prepared.filter("digest is not null")
    # The dimension follows from the data, so equal digests have it in common.
    classes = usable.groupBy("digest").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"),
        F.first("dimension").alias("dimension"), F.first("data").alias("data"),
    )
    classes, _ = materialise(classes, "vector_classes")
    lengths = classes.groupBy("dimension").count().collect()
    plans = {r["dimension"]: make_plan(r["count"], r["dimension"], settings) for r in lengths}
    found = _links(classes, kind, plans, settings, id_type)
    links = found.filter("digest is not null").groupBy("digest").agg(F.sum("links").alias("links"))
    groups = components(found.filter("a is not null").select("a", "b"))
    reached = (
        classes.select("digest", "id", "weight")
        .join(links, "digest", "left")
        .join(groups, F.col("id") == F.col("node"), "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    nameless = given.filter("id is null").select("id", F.lit(0).alias("links"), F.col("id").alias("component"))
    found = prepared.join(reached, "digest", "left").select(
        "id", "links", F.coalesce("component", "id").alias("component")
    )
    return found.unionByName(nameless).select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _links(classes, kind, plans, settings, id_type) -> DataFrame:
    """Rows with (digest, links), and rows with a joining link (a, b)."""
    place = [
        T.StructField("dimension", T.IntegerType()), T.StructField("table", T.IntegerType()),
        T.StructField("bucket", T.LongType()), T.StructField("visits", T.BooleanType()),
    ]
    carried = [
        T.StructField("id", id_type), T.StructField("digest", T.BinaryType()),
        T.StructField("weight", T.LongType()), T.StructField("data", T.BinaryType()),
    ]
    where = ["dimension", "table", "bucket"]
    # Places are worked out twice, which is cheaper than to write vectors so often.
    sizes = classes.mapInPandas(_posted(kind, plans, False), T.StructType(place)).groupBy(*where)
    large = sizes.agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > settings.unit_rows)
    large = listed(large.select(*where, F.ceil(F.col("rows") / settings.unit_rows).cast("int").alias("blocks")), "large")
    posted = classes.mapInPandas(_posted(kind, plans, True), T.StructType([*place, *carried])).join(large, where, "left")
    blocks = F.coalesce("blocks", F.lit(1))
    dealt = posted.withColumn("block", F.pmod(F.xxhash64("digest"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    units = dealt.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("blocks", "other")
    out = T.StructType(
        [
            T.StructField("digest", T.BinaryType()), T.StructField("links", T.LongType()),
            T.StructField("a", id_type), T.StructField("b", id_type),
        ]
    )
    compared = units.groupBy(*where, "low", "high").applyInPandas(_compare(kind, plans, settings), out)
    return materialise(compared, "vector_links")[0]
