"""Connected components of links, as joins and grouped minima."""

from pyspark.sql import functions as F

from riskweave import session
from riskweave.llm import tables

ROW_BYTES = 64  # of a link or a label in a join, about


def components(spark, links, a="a", b="b"):
    """(node, label) for every node of the links; the label is the smallest node of the component.

    Every round takes the least label around a node and then the label's own label, and is written to the
    shared folder. A hub costs one row per task: minima combine before the shuffle and joins are by equality.
    Tables are written by no more tasks than the number of links calls for: few links make short rounds, whatever
    the number of shuffle partitions, and the driver keeps account of fewer tasks.
    """
    rows = 2 * links.count()  # a link has two directions, and no more nodes than that
    store = lambda df, label: tables.store(spark, session.packed(df, rows, ROW_BYTES), label)
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).union(
        links.select(F.col(b).alias("u"), F.col(a).alias("v"))).where("u <> v")
    edges = store(both.distinct(), "edges")
    labels = store(edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        around = edges.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(
            F.min("label").alias("near"))
        near = labels.join(around, labels.node == around.u).select(
            "node", "label", F.least("label", "near").alias("near"))
        above = labels.select(F.col("node").alias("near"), F.col("label").alias("up"))
        found = store(near.join(above, "near").select(
            "node", F.least("near", "up").alias("label"), (F.least("near", "up") != F.col("label")).alias("moved")),
            "labels")
        moved = found.where("moved").limit(1).count()
        labels = found.select("node", "label")
        if not moved:
            return labels
