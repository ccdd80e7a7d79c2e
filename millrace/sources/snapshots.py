"""Tables with numbered snapshots, several writers and changes by predicate.

A table is a folder.  Rows lie below ``data``, one folder for each write.  A
write counts from the moment its commit exists: a small numbered file below
``commits`` that lists the folders it adds and the files it removes.  Numbers
have no gaps, and a number belongs to the first writer that creates its file,
so every number names one state of the table.  A writer that comes second looks
at what was committed since it began and takes the next number, or gives up if
the same rows were changed.

Nothing is overwritten.  What a write leaves behind that never was committed
belongs to no snapshot.
"""

import json
import uuid
from collections import defaultdict
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import EmptySource, SchemaChanged, TableMoved
from millrace.operators.tables import delete, update
from millrace.session import write_counted
from millrace.sources import objects

COMMIT = (
    "version long, base long, kind string, batch string, rows long, schema string, "
    "added array<string>, removed array<string>"
)


@dataclass(frozen=True)
class Change:
    """A write that is not committed yet: made from snapshot ``base``.

    ``added`` are folders, ``removed`` files, both below the table's own folder.
    """

    root: str
    base: int
    kind: str
    batch: str | None
    rows: int
    schema: str
    added: tuple = ()
    removed: tuple = ()


def _commit_path(root, number):
    return f"{root}/commits/{number:012d}.json"


# --- reading ---------------------------------------------------------------------------


def latest(spark: SparkSession, root) -> int:
    """The number of the newest snapshot, 0 before the first."""

    def exists(number):
        return objects.exists(spark, _commit_path(root, number))

    if not exists(1):
        return 0
    low, high = 1, 2
    while exists(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if exists(middle) else (low, middle)
    return low


def history(spark: SparkSession, root, version=None) -> DataFrame:
    """The commits up to a snapshot, the newest by default."""
    upto = latest(spark, root) if version is None else version
    if not upto:
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(f"{root}/commits").filter(F.col("version") <= upto)


def _one(spark, root, number):
    return spark.read.schema(COMMIT).json(_commit_path(root, number)).first()


def _live(spark, root, version) -> list:
    """(folder, names of its removed files) of a snapshot, oldest first."""
    past = history(spark, root, version)
    folders = past.select("version", F.posexplode("added").alias("at", "folder")).collect()
    gone = defaultdict(set)
    for row in past.select(F.explode("removed").alias("file")).collect():
        folder, name = row["file"].rsplit("/", 1)
        gone[folder].add(name)
    ordered = sorted(folders, key=lambda r: (r["version"], r["at"]))
    return [(r["folder"], gone[r["folder"]]) for r in ordered]


def _names(spark, path, schema):
    """Names of the data files of a folder."""
    return [uri.rsplit("/", 1)[1] for uri in spark.read.schema(schema).parquet(path).inputFiles()]


def _paths(spark, root, version, schema) -> list:
    """What to read for a snapshot: whole folders, and single files of those that lost some."""
    out = []
    for folder, gone in _live(spark, root, version):
        path = f"{root}/{folder}"
        kept = [f"{path}/{n}" for n in _names(spark, path, schema) if n not in gone] if gone else [path]
        out += kept
    return out


def schema_of(spark: SparkSession, root, version) -> T.StructType:
    """The columns of a snapshot."""
    return T.StructType.fromJson(json.loads(_one(spark, root, version)["schema"]))


def read(spark: SparkSession, root, version=None) -> DataFrame:
    """The rows of a snapshot, the newest by default.

    Columns that were added after a file was written are null for its rows.
    """
    newest = latest(spark, root)
    number = newest if version is None else version
    if not 1 <= number <= newest:
        raise EmptySource(f"{root} has no snapshot {number}")
    schema = schema_of(spark, root, number)
    paths = _paths(spark, root, number, schema)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


# --- writing ---------------------------------------------------------------------------


def merged(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both; one that changes its type is refused."""
    kinds = {f.name: f.dataType for f in old}
    for field in new:
        if kinds.get(field.name, field.dataType) != field.dataType:
            raise SchemaChanged(f"{field.name}: {kinds[field.name].simpleString()} to {field.dataType.simpleString()}")
    fields = [*old, *(f for f in new if f.name not in kinds)]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def _new_folder(prefix="") -> str:
    return f"data/{prefix}{uuid.uuid4().hex}"


def stage_append(df: DataFrame, root, batch=None, base=None, prefix="") -> Change:
    """Write rows that a commit will add."""
    spark = df.sparkSession
    folder = _new_folder(prefix)
    rows = write_counted(df, f"{root}/{folder}")
    base = latest(spark, root) if base is None else base
    return Change(root, base, "append", batch, rows, df.schema.json(), (folder,))


def _stage_rewrite(spark, root, kind, predicate, rewrite, batch):
    base = latest(spark, root)
    if not base:
        raise EmptySource(f"{root} has no snapshot")
    schema = schema_of(spark, root, base)
    table = read(spark, root, base)
    hit = table.filter(F.coalesce(predicate, F.lit(False)))
    touched = [] if not hit.inputFiles() else hit.select("_metadata.file_path").distinct().collect()
    removed = sorted("/".join(r["file_path"].split("/")[-3:]) for r in touched)
    nothing = Change(root, base, kind, batch, 0, schema.json())
    if not removed:
        return nothing
    rows_in = spark.read.schema(schema).parquet(*[f"{root}/{name}" for name in removed])
    folder = _new_folder()
    rows = write_counted(rewrite(rows_in).select(*schema.names), f"{root}/{folder}")
    return replace(nothing, rows=rows, added=(folder,) if rows else (), removed=tuple(removed))


def stage_update(spark: SparkSession, root, predicate, changes, batch=None) -> Change:
    """Write anew the files that hold rows of the predicate, with those rows changed."""
    return _stage_rewrite(spark, root, "update", predicate, lambda df: update(df, predicate, changes), batch)


def stage_delete(spark: SparkSession, root, predicate=None, batch=None) -> Change:
    """Write anew the files that hold rows of the predicate, without those rows.

    Without a predicate all files go, and none is read.
    """
    if predicate is not None:
        return _stage_rewrite(spark, root, "delete", predicate, lambda df: delete(df, predicate), batch)
    base = latest(spark, root)
    if not base:
        raise EmptySource(f"{root} has no snapshot")
    schema = schema_of(spark, root, base)
    gone = [
        f"{folder}/{name}"
        for folder, before in _live(spark, root, base)
        for name in _names(spark, f"{root}/{folder}", schema) if name not in before
    ]
    return Change(root, base, "delete", batch, 0, schema.json(), (), tuple(gone))


def commit(spark: SparkSession, change: Change, exact=False) -> int:
    """Make a staged change count; the number of its snapshot.

    If others committed since, their snapshots come first: rows appended
    meanwhile stay, unchanged.  ``TableMoved`` is raised, and nothing changed,
    if one of them removed a file that this change removes too, or, when
    ``exact``, if there was any.  A batch that another writer committed
    meanwhile is not committed twice.
    """
    number = change.base + 1
    schema = T.StructType.fromJson(json.loads(change.schema))
    before = _one(spark, change.root, change.base) if change.base else None
    while True:
        if before is not None:
            schema = merged(T.StructType.fromJson(json.loads(before["schema"])), schema)
        record = {
            "version": number, "base": change.base, "kind": change.kind, "batch": change.batch, "rows": change.rows,
            "schema": schema.json(), "added": list(change.added), "removed": list(change.removed),
        }
        if objects.create_once(spark, _commit_path(change.root, number), json.dumps(record)):
            return number
        before = _one(spark, change.root, number)
        if change.batch is not None and before["batch"] == change.batch:
            return number
        both = set(before["removed"]) & set(change.removed)
        if exact or both:
            raise TableMoved(f"{change.root}: snapshot {number} was committed since {change.base}")
        number += 1


def append(df: DataFrame, root, batch=None) -> int:
    """Append rows; the number of the snapshot that has them.

    A batch that is there already is not written again, so that a failed run
    can be repeated; its first snapshot is returned.
    """
    spark = df.sparkSession
    before = batch_version(spark, root, batch)
    return before or commit(spark, stage_append(df, root, batch))


def batch_version(spark: SparkSession, root, batch) -> int | None:
    """The snapshot that a batch came with."""
    if batch is None:
        return None
    return history(spark, root).filter(F.col("batch") == batch).agg(F.min("version")).first()[0]


def update_rows(spark: SparkSession, root, predicate, changes) -> int:
    """Change the rows of a predicate; the number of the new snapshot."""
    return commit(spark, stage_update(spark, root, predicate, changes))


def delete_rows(spark: SparkSession, root, predicate=None) -> int:
    """Remove the rows of a predicate, or all; the number of the new snapshot."""
    return commit(spark, stage_delete(spark, root, predicate))


# --- tables of the session catalog -------------------------------------------------------


def show(spark: SparkSession, identifier, root):
    """Let a table of the session catalog hold what is committed.

    The table has a partition for each folder, named after the commit's own id,
    so readers of the catalog never see an uncommitted one.  Only tables whose
    commits are all appends can be shown like this.
    """
    newest = latest(spark, root)
    schema = schema_of(spark, root, newest)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {identifier} ({columns}, commit string) USING parquet "
        f"PARTITIONED BY (commit) LOCATION '{root}/data'"
    )
    known = set(spark.table(identifier).columns)
    later = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in known)
    if later:
        spark.sql(f"ALTER TABLE {identifier} ADD COLUMNS ({later})")
    there = {row[0] for row in spark.sql(f"SHOW PARTITIONS {identifier}").collect()}
    folders = [folder.removeprefix("data/") for folder, _ in _live(spark, root, newest)]
    missing = [folder for folder in folders if folder not in there]
    if missing:
        wanted = " ".join(
            f"PARTITION (commit='{f.removeprefix('commit=')}') LOCATION '{root}/data/{f}'" for f in missing
        )
        spark.sql(f"ALTER TABLE {identifier} ADD IF NOT EXISTS {wanted}")
    spark.catalog.refreshTable(identifier)


def rows_of_snapshots(spark: SparkSession, root, versions) -> DataFrame:
    """The rows of several snapshots, with the number of theirs as ``snapshot``."""
    frames = [read(spark, root, v).withColumn("snapshot", F.lit(v).cast("long")) for v in versions]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
