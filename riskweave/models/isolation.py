"""Isolation forest: trees grown as grouped jobs, path lengths scored in place."""

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.operators.ranking import minmax, topk

NODE = "tree int, node int, left int, right int, feature int, cut double, size int"


def mean_depth(n):
    """Average path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def sample_rows(df, key, trees, psi):
    """Rows of each tree: `psi` per tree, or all of them where there are no more.

    A hash of row and tree admits slightly more than needed and the smallest `psi` hashes stay, so
    the draw is the same on every retry and only the admitted rows are shuffled.
    """
    n = df.agg(F.count("*").alias("n")).scalar()
    span = float(2 ** 32)
    draw = lambda t: F.pmod(F.xxhash64(F.col(key), t), F.lit(2 ** 32)).cast("double") / span
    admitted = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: draw(t) < F.col("_p"))
    rate = F.least(F.lit(1.0), F.lit(1.5 * psi) / F.col("_n") + 8.0 * math.sqrt(psi) / F.col("_n"))
    rows = df.withColumn("_n", n).withColumn("_p", rate).select(
        key, "features", F.explode(admitted).alias("tree"))
    return topk(rows.withColumn("_d", draw(F.col("tree"))), ["tree"], ["_d", key], psi)


def grow(tree, x, limit):
    """Random splits of one sample, as node rows."""
    rng = np.random.default_rng(tree)
    rows, todo = [], [(0, np.arange(len(x)), 0)]
    count = 1
    while todo:
        node, idx, depth = todo.pop()
        part = x[idx]
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(idx) > 1 else []
        if depth >= limit or len(spread) == 0:
            rows.append((tree, node, -1, -1, -1, 0.0, len(idx)))
            continue
        f = int(rng.choice(spread))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        low = part[:, f] <= cut
        rows.append((tree, node, count, count + 1, f, cut, len(idx)))
        todo += [(count, idx[low], depth + 1), (count + 1, idx[~low], depth + 1)]
        count += 2
    return rows


def fit_iforest(df, key="service_name", trees=100, psi=256):
    """Node table of the forest: at most 2 * psi - 1 rows per tree, whatever the data size."""
    limit = math.ceil(math.log2(max(psi, 2)))

    def one(pdf):
        pdf = pdf.sort_values(["_d", key])
        x = np.array(pdf["features"].tolist(), dtype=float)
        depth = min(limit, math.ceil(math.log2(max(len(x), 2))))
        return pd.DataFrame(grow(int(pdf["tree"].iloc[0]), x, depth),
                            columns=["tree", "node", "left", "right", "feature", "cut", "size"])

    flat = df.select(key, vector_to_array("features").alias("features"))
    return sample_rows(flat, key, trees, psi).groupBy("tree").applyInPandas(one, NODE)


def anomaly_scores(df, forest, flag_at=0.5):
    """`anomaly_score` scaled to 0..1 over the frame, and its flag.

    The node table comes to the driver to travel with the tasks; its size is fixed by the number
    of trees and their sample size.
    """
    nodes = forest.toPandas().sort_values(["tree", "node"])
    packed = [g[["left", "right", "feature", "cut", "size"]].to_numpy() for _, g in nodes.groupby("tree")]
    psi = max((int(t[0, 4]) for t in packed), default=1)
    schema = df.select(*[c for c in df.columns if c != "features"]).schema.add("iso_raw", "double")

    def depth_of(tree, x):
        at, depth = np.zeros(len(x), dtype=int), np.zeros(len(x))
        live = np.arange(len(x))
        while len(live):
            here = tree[at[live]]
            leaf = here[:, 0] < 0
            depth[live[leaf]] += [mean_depth(int(s)) for s in here[leaf, 4]]
            live, here = live[~leaf], here[~leaf]
            low = x[live, here[:, 2].astype(int)] <= here[:, 3]
            at[live] = np.where(low, here[:, 0], here[:, 1]).astype(int)
            depth[live] += 1
        return depth

    def run(batches):
        for pdf in batches:
            x = np.array(pdf.pop("_x").tolist(), dtype=float)
            total = sum(depth_of(t, x) for t in packed) if len(x) else np.zeros(0)
            pdf["iso_raw"] = 2.0 ** (-(total / len(packed)) / max(mean_depth(psi), 1e-9))
            yield pdf

    flat = df.withColumn("_x", vector_to_array("features")).drop("features")
    scored = flat.mapInPandas(run, schema)
    scaled = minmax(scored, "iso_raw", name="anomaly_score").drop("iso_raw")
    return scaled.withColumn("anomaly_flag", (F.col("anomaly_score") >= flag_at).cast("int"))
