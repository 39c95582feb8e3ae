"""Connected components of links that Spark holds, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postfeed.llm.common import few, min_labels, written

# Rounds after which the loop gives up; each round at least halves what is left to join.
MAX_ROUNDS = 60


def spanning(links: DataFrame) -> DataFrame:
    """Links (a, b) thinned to a spanning forest within each Arrow batch; components stay the same."""
    import numpy as np
    import pyarrow as pa

    def thin(batches):
        for batch in batches:
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
            root = min_labels(len(nodes), index[: len(a)], index[len(a) :])
            other = np.flatnonzero(root != np.arange(len(nodes)))
            yield pa.record_batch({"a": nodes[other].astype(np.int64), "b": nodes[root[other]].astype(np.int64)})

    return links.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(thin, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of the links (a, b).

    Nodes hook on to the smallest grandparent of a neighbour and then skip a generation, until
    nothing changes. A hub is a key of the larger side of a join only, whose partitions Spark may
    split, and every minimum is taken before the shuffle as well as after it. Self-links are kept
    as nodes, an empty input gives an empty result. Each round is written to the shared folder.
    """
    given = written(few(links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")), "given-links")
    thin = spanning(given)
    both = written(few(thin.unionAll(thin.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()), "links")
    own = given.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # The first round: the smallest neighbour.
    near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    tree = own.join(near, "node", "left").select(F.col("node").cast("long"), F.least("node", "low").cast("long").alias("up"))
    tree = written(few(tree), "tree")
    for _ in range(MAX_ROUNDS):
        ups = tree.select(F.col("node").alias("up"), F.col("up").alias("top"))
        grown = written(few(tree.join(ups, "up").select("node", "up", "top")), "tree")
        seen = both.join(grown.select(F.col("node").alias("b"), F.col("top").alias("low")), "b")
        low = seen.groupBy(F.col("a").alias("node")).agg(F.min("low").alias("low"))
        hooked = grown.join(low, "node", "left").select("node", "up", "top", F.least("top", "low").alias("low"))
        hooked = written(few(hooked), "tree")
        offers = hooked.select("node", F.col("low").alias("up")).unionAll(
            hooked.where("low < top").select(F.col("up").alias("node"), F.col("low").alias("up"))
        ).unionAll(hooked.where("low < top").select(F.col("top").alias("node"), F.col("low").alias("up")))
        # A root points to itself; only links below it count as change.
        if hooked.where("low < top OR top < up").isEmpty():
            return hooked.select("node", F.col("top").alias("root"))
        tree = written(few(offers.groupBy("node").agg(F.min("up").alias("up"))), "tree")
    raise RuntimeError("the components did not settle")
