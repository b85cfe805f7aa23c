"""Connected components of a table of links, without a driver-side graph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of links (x, y); root is the least node of the component, as its own row too.

    Every node hooks to its least neighbour, paths are halved until all point at roots, and links between different
    roots go on. Each step is written, so that the plan does not grow.
    """
    links = links.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    nodes = written(links.select("x").union(links.select("y")).distinct().select(F.col("x").alias("node"), F.col("x").alias("root")), "nodes")
    while True:
        links = written(links.distinct(), "links")
        if links.isEmpty():
            return nodes
        hook = written(links.groupBy("x").agg(F.min("y").alias("up")), "hooks")
        while True:
            over = hook.select(F.col("x").alias("up"), F.col("up").alias("far"))
            longer = written(hook.join(over, "up", "left").select("x", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moved")), "hooks")
            hook = longer.select("x", "up")
            if longer.where("moved").isEmpty():
                break
        to = hook.select(F.col("x").alias("root"), F.col("up").alias("to"))
        nodes = written(nodes.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "nodes")
        x, y = (to.select(F.col("root").alias(c), F.col("to").alias(f"{c}_to")) for c in ("x", "y"))
        links = links.join(x, "x", "left").join(y, "y", "left").select(
            F.coalesce("x_to", "x").alias("x"), F.coalesce("y_to", "y").alias("y")).where("x <> y").select(
            F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
