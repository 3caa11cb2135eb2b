"""Connected components by least labels and pointer jumping over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import stage_table


def components(links: DataFrame) -> DataFrame:
    """Least reachable node (``label``) of every ``node`` in links ``a``, ``b``.

    Each round takes the least label among the neighbours with partial sums, and
    then the label of the label, so paths shrink by more than half. Tables are
    stored between rounds; a round that changes nothing ends the loop.
    """
    edges = stage_table(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage_table(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        told = edges.join(labels, F.col("a") == F.col("node")).groupBy(F.col("b").alias("to")).agg(F.min("label").alias("near"))
        least = labels.join(told, F.col("node") == F.col("to")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        parents = labels.select(F.col("node").alias("parent"), F.col("label").alias("above"))
        jumped = stage_table(
            least.join(parents, F.col("label") == F.col("parent")).select("node", "old", F.least("label", "above").alias("label")), "labels"
        )
        changed = jumped.filter("label <> old").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
