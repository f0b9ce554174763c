"""Connected components of an edge table, by contraction in Spark.

Each round maps every node two steps along "smallest neighbour" pointers and
relabels the edges; the edges left over shrink by at least half. A hub's edges
meet in a ``min`` aggregate (combined map-side) and in equi-joins that AQE can
split, never in one task's memory. Rounds are cut through the shared folder;
their maps are composed from the last, smallest one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges(a, b)``; root is the component's smallest node.

    Self loops and repeated edges are allowed; nodes without an edge to
    another node are not returned.
    """
    live = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(), "edges")
    maps = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("up"))
        near = cut(near, "pointers")
        step = cut(near.join(near.select(F.col("node").alias("up"), F.col("up").alias("root")), "up")
                   .select("node", "root"), "steps")
        maps.append(step)
        live = cut(live
                   .join(step.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
                   .join(step.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
                   .where("ra <> rb")
                   .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
                   .distinct(), "edges")
    if not maps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # from the last round to the first: each join is of a round's nodes with the fewer ones of the rounds after it
    out = maps[-1]
    for step in reversed(maps[:-1]):
        out = (step.join(out.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
               .select("node", F.coalesce("next", "root").alias("root")))
    return cut(out, "components") if len(maps) > 1 else out
