"""Connected components of a table of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiremill.session import materialize


def spread(both: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label, moved): each node with the least label among its neighbours in ``both`` (a, b) and the node that its own label names."""
    near = both.select(F.col("a").alias("of"), F.col("b").alias("near"), F.lit(None).cast(labels.schema["label"].dataType).alias("own"))
    near = near.unionByName(labels.select(F.col("node").alias("of"), F.col("label").alias("near"), F.col("label").alias("own")))
    known = labels.select(F.col("node").alias("known"), F.col("label").alias("known_label"))
    found = near.join(known, F.col("near") == F.col("known")).groupBy("of").agg(F.min("known_label").alias("found"), F.max("own").alias("own"))
    label = F.least("found", "own")
    return found.select(F.col("of").alias("node"), label.alias("label"), (label != F.col("own")).alias("moved"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable.

    Each round takes the least label among a node's neighbours, its own label being one
    more, so long chains fold in logarithmically many rounds. Every second one is
    written to the shared folder; the loop ends when it changes none. NULL ends and self links add nothing. No links, no rows.
    """
    links = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both, "component-links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    while True:
        # A label is itself a node: its own label is at most as large.
        labels = materialize(spread(both, spread(both, labels)), "component-labels")
        if not labels.filter("moved").head(1):
            return labels.select("node", "label")


def labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of ``node`` as ``name``: what links with nothing is its own."""
    own = labels.select(F.col("node").alias("labelled_node"), F.col("label").alias("found_label"))
    return rows.join(own, F.col(node) == F.col("labelled_node"), "left").withColumn(name, F.coalesce("found_label", node)).drop("labelled_node", "found_label")


def merged_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, label) after further ``links`` (a, b): only those between two components are followed, from label to label."""
    if labels is None:
        return connected_components(links)
    ends = labelled(labelled(links.select("a", "b"), labels, "a", "a_label"), labels, "b", "b_label")
    joins = materialize(ends.filter("a_label != b_label").select(F.col("a_label").alias("a"), F.col("b_label").alias("b")), "component-joins")
    if not joins.head(1):
        return labels
    up = connected_components(joins)
    fresh = up.join(labels, "node", "left_anti").select("node", "label")
    renamed = labelled(labels, up, "label", "new").select("node", F.col("new").alias("label"))
    return materialize(renamed.unionByName(fresh), "component-merged")
