"""Connected components of a graph of links, by contraction.

Each round every node is merged into the least of itself and its neighbours, and the links are renamed; links within
one node vanish. Names should be hashes: then the least neighbour is a random one, every round leaves a constant share
of the nodes, and long chains need a logarithmic number of rounds. A hub is a group of a partial aggregation, never a
list, and rows that look up a hub's name are spread by salt over several tasks. Every round is written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Tasks over which the rows of one key are spread when they look it up.
SALTS = 8


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """left with the columns of its key's row in right (null if it has none); right has one row for each key.

    Left rows are spread by a salt made of column `by`, right rows are sent to each salt: a key that a third of all
    left rows hold does not meet in one task.
    """
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    every = right.withColumn("_salt", F.explode(F.array(*(F.lit(k) for k in range(SALTS)))))
    return salted.join(every, [key, "_salt"], "left").drop("_salt")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of all nodes that a link touches; two nodes have one label when links connect them.

    The label is one of the nodes of the component. Self-links, repeated links and links with a null end are allowed
    and count for nothing. No links give an empty result.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    edges = materialize(pairs.filter("a <> b").distinct(), "links")
    names = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        least = materialize(least, "least")
        if names is None:
            names = least.select(F.col("n").alias("node"), F.col("m").alias("label"))
        else:
            named = spread_join(names, least.withColumnRenamed("n", "label"), "label", "node")
            names = materialize(named.select("node", F.coalesce("m", "label").alias("label")), "names")
        half = spread_join(edges, least.withColumnRenamed("n", "a"), "a", "b").select(F.col("m").alias("a"), "b")
        moved = spread_join(half, least.withColumnRenamed("n", "b"), "b", "a").select("a", F.col("m").alias("b"))
        edges = materialize(moved.filter("a <> b").distinct(), "links")
        if edges.isEmpty():
            return names
