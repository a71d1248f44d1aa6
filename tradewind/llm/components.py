"""Connected components of a graph of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b: long); roots are smallest nodes.

    Every round points each node at its smallest neighbour, follows the pointers twice more and
    contracts the links to the ends so found; a star or a short chain is done after one round.
    Self-links and repeated links do no harm.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    found = None
    while True:
        ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = ends.groupBy("a").agg(F.min("b").alias("b"))
        up = stored(up.select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "up")
        over = up.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        for _ in range(2):
            up = up.join(over, "up").select("node", F.col("upper").alias("up"))
        up = stored(up, "up")
        if found is None:
            found = up.select("node", F.col("up").alias("root"))
        else:
            step = up.select(F.col("node").alias("root"), "up")
            found = found.join(step, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")
            )
            found = stored(found, "components")
        for end in ("a", "b"):
            step = up.select(F.col("node").alias(end), F.col("up").alias(f"{end}_up"))
            links = links.join(step, end).drop(end).withColumnRenamed(f"{end}_up", end)
        links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
        if links.isEmpty():
            return found
