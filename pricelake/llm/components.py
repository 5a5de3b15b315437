"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in links (a, b); nodes are long.

    Each turn points a node to its smallest neighbour, follows the pointers to their ends, and
    goes on with the links between different ends, at most half as many nodes. Every step is joins
    and grouped minima over tables in the shared folder; only whether a table is empty is asked.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct(), "links")
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        ends = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("end")), "ends")
        while True:
            up = ends.select(F.col("node").alias("_node"), F.col("end").alias("_end"))
            jumped = ends.join(up, F.col("end") == F.col("_node"))
            ends = written(jumped.select("node", F.col("_end").alias("end"), (F.col("_end") < F.col("end")).alias("moved")), "ends")
            if ends.where("moved").isEmpty():
                break
        ends = ends.drop("moved")
        if found is None:
            found = ends
        else:
            up = ends.withColumnsRenamed({"node": "_node", "end": "_end"})
            joined = found.join(up, F.col("end") == F.col("_node"), "left")
            found = written(joined.select("node", F.coalesce("_end", "end").alias("end")), "ends")
        a, b = ends.withColumnsRenamed({"node": "a", "end": "ea"}), ends.withColumnsRenamed({"node": "b", "end": "eb"})
        rest = edges.join(a, "a").join(b, "b").where("ea <> eb")
        edges = written(rest.select(F.least("ea", "eb").alias("a"), F.greatest("ea", "eb").alias("b")).distinct(), "links")
    if found is None:
        found = edges.select(F.col("a").alias("node"), F.col("b").alias("end"))
    return found.withColumnRenamed("end", "component")
