"""Connected components of a table of links."""

from pyspark.sql import functions as F

from pagelens.session import ensure_checkpoint_dir


def components(links, a="a", b="b"):
    """Every linked node with the smallest node of its component: node, label.

    Each round sends a node to its smallest neighbour, follows eight such steps at once, and contracts
    the links, whose number falls at least by half; both tables are checkpointed, so a lost executor
    repeats one round at most.
    """
    ensure_checkpoint_dir(links.sparkSession)
    pair = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = pair.filter("a <> b").distinct().checkpoint()
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        jump = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).select(F.col("a").alias("node"), "p")
        for _ in range(3):
            far = jump.select(F.col("node").alias("p"), F.col("p").alias("q"))
            jump = jump.join(far, "p", "left").select("node", F.coalesce("q", "p").alias("p"))
        jump = jump.checkpoint()
        if labels is None:
            labels = jump.select("node", F.col("p").alias("label"))
        else:
            labels = labels.join(jump.select(F.col("node").alias("label"), "p"), "label", "left").select(
                "node", F.coalesce("p", "label").alias("label"))
        labels = labels.checkpoint()
        for side in ("a", "b"):
            edges = edges.join(jump.select(F.col("node").alias(side), "p"), side, "left").withColumn(
                side, F.coalesce("p", side)).drop("p")
        edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct().checkpoint()
        if edges.isEmpty():
            return labels
