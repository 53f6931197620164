"""Connected components of a graph given by its edges, as Spark joins and aggregations.

Alternating large-star and small-star steps: every node points its larger neighbours to its smallest one, then its smaller
neighbours and itself, until nothing changes; what remains are stars whose centre is the smallest node of each component.  Stars
that grow hot are never gathered: a step is a partially aggregated minimum and an equi-join that adaptive execution can split.
Each step is written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("o"))
    both = both.unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("o")))
    if not large:
        both = both.filter("o < n")
    low = both.groupBy("n").agg(F.min("o").alias("m")).select("n", F.least("n", "m").alias("m"), F.xxhash64("n").alias("h"))
    # The second key makes the join deal both sides anew, as plain exchanges: only those are split where a hub is skewed.
    both = both.withColumn("h", F.xxhash64("n"))
    if large:
        out = both.filter("o > n").join(low, ["n", "h"]).select(F.col("o").alias("u"), F.col("m").alias("v"))
    else:
        out = both.join(low, ["n", "h"]).select(F.col("o").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, component`` of every node with an edge; ``component`` is the smallest node that can be reached.

    Nulls and self loops are ignored; an empty table of edges gives an empty result.
    """
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).filter(F.col(u).isNotNull() & F.col(v).isNotNull())
    pairs = materialize(pairs.filter("u <> v").distinct(), "edges")
    last = None
    while True:
        state = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == last:
            break
        last = (state["n"], state["h"])
        pairs = materialize(_star(_star(pairs, True), False), "edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
