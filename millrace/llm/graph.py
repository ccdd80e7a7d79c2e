"""Connected components of a graph held in a table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise


def _starred(edges: DataFrame, to_larger: bool) -> DataFrame:
    """One star step: neighbours of a node are linked to the smallest of them."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not to_larger:
        both = both.filter("b < a")
    centres = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    linked = both.join(centres, F.col("a") == F.col("node")).select("a", "b", F.least("a", "least").alias("centre"))
    if to_larger:
        pairs = linked.filter("b > a").select(F.col("centre").alias("a"), "b")
    else:
        pairs = linked.select(F.col("centre").alias("a"), "b").unionByName(
            linked.select(F.col("centre").alias("a"), F.col("a").alias("b"))
        )
    return pairs.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b).

    The component is the smallest node that can be reached.  Large-star and
    small-star steps alternate until every node hangs directly on its smallest;
    each round is written to the shared folder.  The smallest neighbour is
    aggregated before it is joined back, so a node with very many neighbours is
    one row on one side and can be split on the other.
    """
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current, rows = materialise(edges.filter("a <> b").distinct(), "edges")
    mark = None
    while rows:
        stepped, rows = materialise(_starred(_starred(current, True), False), "edges")
        facts = stepped.agg(
            F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.hash("a", "b").cast("long"))
        ).first()
        current = stepped
        if tuple(facts) == mark:
            break
        mark = tuple(facts)
    nodes = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return nodes.unionByName(roots)
