"""Connected components of a link table by label propagation with pointer jumping, all in joins."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b: longs); comp is the smallest node of the component.

    Each round gives every node the smallest label among its neighbours' and its own, combined on the map
    side so that a node with very many links is no burden, then follows labels one step. Rounds are
    stored, so a lost executor never costs more than the round at hand; the driver sees one count a round.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("comp")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        closer = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("comp").alias("beyond"))
        after = stored(closer.join(jump, "new").select("node", "comp", F.least("new", "beyond").alias("new")))
        changed = after.where("comp <> new").limit(1).count()
        labels = after.select("node", F.col("new").alias("comp"))
        if not changed:
            return labels
