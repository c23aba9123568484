"""Connected components of an edge table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import stash


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable from every node that has an edge.

    Alternates the large-star and small-star steps until the edges are stars. A node's
    minimum is a partial aggregate and is joined back to its edges with a sort-merge
    join, whose hot nodes adaptive execution splits; no neighbour list is ever gathered.
    Loops and null ends are ignored; no edges give no rows.
    """
    e = stash(edges.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    last = None
    while True:
        n, mark = e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                      F.lit(0))).first()
        if (n, mark) == last:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        last = (n, mark)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = stash(small.distinct(), "edges")
