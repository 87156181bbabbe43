"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.session import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node reachable.

    Labels spread along links, roots hook onto smaller neighbours and paths are halved, so the
    number of rounds grows with the logarithm of the longest chain. A round is a few joins; what
    it found is checkpointed, and only the number of changes comes to the driver.
    """
    ensure_checkpoint_dir(links.sparkSession)
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.distinct().checkpoint()
    labels = both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("component")).checkpoint()
    while True:
        ends = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        near = both.join(ends, "b").groupBy(F.col("a").alias("node")).agg(
            F.min("near").alias("near"))
        spread = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        hooks = spread.select(F.col("old").alias("node"), F.lit(None).alias("old"), "new")
        hooked = spread.union(hooks).groupBy("node").agg(
            F.max("old").alias("old"), F.min("new").alias("new"))
        parents = hooked.select(F.col("node").alias("new"), F.col("new").alias("further"))
        step = hooked.join(parents, "new").select(
            "node", "old", F.least("new", "further").alias("component")).checkpoint()
        labels = step.select("node", "component")
        if step.filter(F.col("component") != F.col("old")).isEmpty():
            return labels
