"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b), for
    every node that has a link.

    Each round gives every node the smallest root among its own and its
    neighbours', then replaces that root by its own root (pointer jumping),
    so the number of rounds is logarithmic in the longest path for the usual
    shapes.  A round is two joins and a combining aggregation; its result is
    stored, which cuts the lineage.  Nothing is collected but a count.
    """
    links = links.filter(F.col("a") != F.col("b")).select("a", "b")
    both = stored(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-links")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "cc-0")
    while True:
        seen = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("near"))
        lower = roots.join(seen, "node").select("node", "root", F.least("root", "near").alias("low"))
        up = roots.select(F.col("node").alias("low"), F.col("root").alias("jump"))
        after = stored(lower.join(up, "low").select("node", F.col("root").alias("was"), F.least("low", "jump").alias("root")), "cc")
        moved = after.filter("root < was").limit(1).count()
        roots = after.select("node", "root")
        if not moved:
            return roots
