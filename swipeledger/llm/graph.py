"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeledger.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b), where a component is named by its least node. Every node
    takes the least name among itself, its neighbours and, following names, theirs, until no name changes; a star is
    done after two rounds, a chain after about the logarithm of its length. Only minima are shuffled,
    combined in each task first, so a node with very many links is no hot group."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    names = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        of = names.select(F.col("node").alias("b"), F.col("component").alias("theirs"))
        around = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        lower = names.join(around, "node").select("node", F.col("component").alias("was"), F.least("component", "theirs").alias("component"))
        further = names.select(F.col("node").alias("component"), F.col("component").alias("next"))
        now = stored(lower.join(further, "component", "left").select("node", "was", F.least("component", F.coalesce("next", "component")).alias("component")))
        if now.where("was <> component").isEmpty():
            return now.select("node", "component")
        names = now.select("node", "component")
