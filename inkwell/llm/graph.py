"""Connected components of a table of links, by contraction in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label: every node of a link with the smallest node that it reaches.

    Each round gives every node the least of itself and its neighbours, then
    draws the links between these; what was linked stays linked. A star ends in
    one round, a path of n nodes in about log n. Each round is written to the
    shared folder. Links with a null end and links to oneself are left out.
    """
    ends = lambda x, y: (F.least(x, y).alias("low"), F.greatest(x, y).alias("high"))
    pairs = materialize(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(*ends(F.col(a), F.col(b))).distinct(), "links")
    labels = None
    while not pairs.isEmpty():
        both = pairs.select(F.col("high").alias("node"), F.col("low").alias("to")).union(pairs.select("low", "high"))
        parents = materialize(both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("parent")), "parents")
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            up = parents.select(F.col("node").alias("label"), "parent")
            labels = labels.join(up, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
        labels = materialize(labels, "labels")
        lows = parents.select(F.col("node").alias("low"), F.col("parent").alias("low_up"))
        highs = parents.select(F.col("node").alias("high"), F.col("parent").alias("high_up"))
        raised = pairs.join(lows, "low").join(highs, "high").where("low_up <> high_up")
        pairs = materialize(raised.select(*ends(F.col("low_up"), F.col("high_up"))).distinct(), "links")
    if labels is None:
        return pairs.select(F.col("low").alias("node"), F.col("high").alias("label"))
    return labels
