"""State of a stream in files, of which a micro-batch touches only its own buckets.

Rows are dealt to buckets by the hash of their key.  A micro-batch reads the
buckets of its keys, and writes them anew below a folder of its own number.  A
small index says for each bucket which micro-batch wrote it last; the index of
a number is the state before the micro-batch of that number, so one that is
repeated reads what it read before and replaces what it wrote.
"""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import observed
from millrace.sources import objects


@dataclass(frozen=True)
class Index:
    """The number that wrote each bucket last, and facts about the whole state."""

    buckets: dict
    facts: dict


@dataclass(frozen=True)
class BucketState:
    """Rows of ``schema`` below ``root``, in ``count`` buckets by ``key``.

    The folder belongs to one checkpoint, whose micro-batches number the states.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    key: str
    count: int = 256

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.count)).cast("int")

    def buckets_of(self, df: DataFrame) -> list:
        """The buckets that a frame has keys of."""
        return sorted(r[0] for r in df.select(self.bucket().alias("b")).distinct().collect())

    def _index_path(self, number):
        return f"{self.root}/index/{number:012d}.json"

    def index(self, number) -> Index | None:
        """The state before a micro-batch, None if nothing was saved for it."""
        if not objects.exists(self.spark, self._index_path(number)):
            return None
        read = json.loads(objects.get(self.spark, self._index_path(number)))
        return Index({int(b): n for b, n in read["buckets"].items()}, read["facts"])

    def rows(self, index: Index, wanted) -> DataFrame:
        """The rows of some buckets."""
        paths = [f"{self.root}/rows/{index.buckets[b]}/bucket={b}" for b in wanted if b in index.buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _write(self, df, folder) -> list:
        """Write rows below a folder; the buckets that got any.

        Files of a bucket are cut by size, so one that holds a hot key is
        written by several tasks.
        """
        seen = Observation()
        rows = df.select(*self.schema.names).withColumn("bucket", self.bucket())
        rows = rows.hint("rebalance", "bucket").observe(seen, F.collect_set("bucket").alias("filled"))
        rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/rows/{folder}")
        return sorted((observed(seen) or {}).get("filled") or [])

    def _put(self, number, index: Index) -> Index:
        text = json.dumps({"buckets": index.buckets, "facts": index.facts})
        objects.put(self.spark, self._index_path(number), text)
        return index

    def start(self, df: DataFrame, number, facts) -> Index:
        """Begin with the rows of ``df`` as the state before a micro-batch."""
        folder = f"start-{number}"
        return self._put(number, Index(dict.fromkeys(self._write(df, folder), folder), facts))

    def save(self, df: DataFrame, number, index: Index, wanted, facts) -> Index:
        """Let the rows of ``df`` be those of the buckets ``wanted`` after a micro-batch; others stay."""
        kept = {b: n for b, n in index.buckets.items() if b not in set(wanted)}
        filled = dict.fromkeys(self._write(df, str(number)), str(number))
        return self._put(number + 1, Index(kept | filled, facts))
