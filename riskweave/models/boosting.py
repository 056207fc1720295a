"""Second-order boosted trees: gradient histograms grouped by node, feature and bin; the models of all folds grow in one pass."""

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.session import packed, tasks_for, written

SCALE = 1 << 24  # gradients are summed as whole multiples of 1 / SCALE, so that sums do not depend on their order
REWRITE = 10  # trees after which the margins are written
PARTIAL = "model int, node int, feature int, bin int, g bigint, h bigint"


@dataclasses.dataclass
class Settings:
    trees: int = 100
    depth: int = 2
    rate: float = 0.05
    rows: float = 0.6  # share of the rows that a tree sees
    cols: float = 0.5  # share of the inputs that a tree sees
    alpha: float = 1.0  # L1 on leaf weights
    lam: float = 2.0  # L2 on leaf weights
    child: float = 3.0  # least sum of second derivatives in a child
    bins: int = 64
    seed: int = 42


@dataclasses.dataclass
class Tree:
    """Complete binary tree: children of node i are 2i+1 and 2i+2; feature -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @staticmethod
    def stump(depth):
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1), np.zeros(n, dtype=int), np.zeros(n), np.zeros(n))

    def leaves(self, bins):
        at = np.zeros(len(bins), dtype=int)
        while True:
            live = np.flatnonzero(self.feature[at] >= 0)
            if not len(live):
                return at
            here = at[live]
            at[live] = 2 * here + 1 + (bins[live, self.feature[here]] > self.cut[here])


def shrunk(g, alpha):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def leaf_weight(g, h, s):
    return -shrunk(g, s.alpha) / (h + s.lam)


def best_split(g, h, allowed, s):
    """(gain, feature, bin) of the best cut of one node, or None; ties to the smallest feature and bin.

    `g` and `h` are histograms by feature and bin.
    """
    total = lambda a, b: shrunk(a, s.alpha) ** 2 / (b + s.lam)
    gl, hl = np.cumsum(g, axis=1), np.cumsum(h, axis=1)
    whole_g, whole_h = gl[allowed[0], -1], hl[allowed[0], -1]
    gr, hr = whole_g - gl, whole_h - hl
    gain = 0.5 * (total(gl, hl) + total(gr, hr) - total(whole_g, whole_h))
    gain[(hl < s.child) | (hr < s.child)] = -np.inf
    gain[np.setdiff1d(np.arange(len(g)), allowed)] = -np.inf
    at = int(np.argmax(gain))
    if not gain.flat[at] > 1e-6:
        return None
    return (float(gain.flat[at]), *map(int, np.unravel_index(at, gain.shape)))


def binned(x, edges):
    """Number of edges below each value."""
    return np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)])


def drawn(hashes, tree, s):
    """Rows that a tree sees, by a hash of row and tree: the same on every retry."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.uint64) + np.uint64((s.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2 ** 63)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) < s.rows * 2.0 ** 53


def matrix(column, width):
    """A column of lists of one length as the rows of a matrix, without a Python object for each number."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(rows, kind):
    """A matrix as a column of lists."""
    stops = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(rows.reshape(-1), kind))


def gathered(batches, rows=1 << 14):
    """Batches put together to about `rows` rows, so that the work of a batch is not lost in its calls."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


@dataclasses.dataclass
class Boosted:
    edges: list
    trees: list  # of every model, a list of trees
    settings: Settings

    def margins(self, x, model=0):
        bins = binned(x, self.edges)
        return self.settings.rate * sum((t.value[t.leaves(bins)] for t in self.trees[model]), np.zeros(len(x)))

    def importances(self, model=0):
        """Mean gain of the cuts on each input, scaled to sum 1."""
        gain, cuts = np.zeros(len(self.edges)), np.zeros(len(self.edges))
        for t in self.trees[model]:
            inner = t.feature >= 0
            np.add.at(gain, t.feature[inner], t.gain[inner])
            np.add.at(cuts, t.feature[inner], 1)
        mean = np.divide(gain, cuts, out=np.zeros_like(gain), where=cuts > 0)
        return mean / mean.sum() if mean.sum() > 0 else mean


def fit(df, key, label="label", fold=None, folds=1, settings=None):
    """Trees on `features`; positive rows weigh negatives / positives, margins start at 0.

    With `fold`, one model for each of `folds` folds, fitted on the rows of the others; all grow in the same jobs. Cuts
    lie at quantiles, `bins` at most. One job a level: tasks add up gradients by node, input and bin, and what
    comes to the driver has a size fixed by models, nodes, inputs and bins. A model of one class weighs all rows alike.
    Empty input gives trees of weight 0. Null features are not allowed.
    """
    s, spark = settings or Settings(), df.sparkSession
    flat = written(spark, df.select(
        F.xxhash64(*key).alias("_h"), F.col(label).cast("double").alias("_y"),
        (F.col(fold) if fold else F.lit(-1)).cast("int").alias("_fold"),
        vector_to_array("features").alias("_x")), "boost-rows")
    width = flat.agg(F.coalesce(F.max(F.size("_x")), F.lit(0))).first()[0]
    shares = [i / s.bins for i in range(1, s.bins)]
    quantiles = flat.agg(F.count("*"), *[F.percentile_approx(F.get("_x", F.lit(i)), shares, 10000) for i in range(width)]).first()[1:]
    edges = [np.unique(np.array(q, dtype=float)) for q in quantiles]
    counts = {(r["_fold"], r["_y"]): r["count"] for r in flat.groupBy("_fold", "_y").count().collect()}
    seen = lambda m, y: sum(n for (f, v), n in counts.items() if f != m and v == y)
    weight = [seen(m, 0.0) / seen(m, 1.0) if seen(m, 1.0) and seen(m, 0.0) else 1.0 for m in range(folds)]

    def state_of(batch, bins, margins):
        return pa.RecordBatch.from_arrays([
            *[batch.column(c) for c in ("_h", "_y", "_fold")], lists(bins, pa.int32()), lists(margins, pa.float64())],
            names=["_h", "_y", "_fold", "_b", "_m"])

    def prepared(batches):
        for batch in gathered(batches):
            bins = binned(matrix(batch.column("_x"), width).astype(float), edges).astype(np.int32)
            yield state_of(batch, bins, np.zeros((len(bins), folds)))

    state = "_h bigint, _y double, _fold int, _b array<int>, _m array<double>"
    trees = [[] for _ in range(folds)]
    if not counts or not width:
        return Boosted(edges, trees, s)
    extent = sum(counts.values()), 8 * (width + folds)
    small, alone = packed(flat, *extent), tasks_for(*extent) == 1  # one task's sums need no shuffle
    table, since = written(spark, small.mapInArrow(prepared, state), "boost-state"), 0

    def margins_of(batch, fresh):
        bins = matrix(batch.column("_b"), width).astype(int)
        margins = matrix(batch.column("_m"), folds).astype(float)
        for m, done in enumerate(fresh):
            for t in done:
                margins[:, m] += s.rate * t.value[t.leaves(bins)]
        return bins, margins

    def histograms(fresh, growing, first, number, allowed):
        """Sums by model, node of the level that starts at node `first`, feature and bin."""
        nodes = first + 1

        def run(batches):
            sums = np.zeros((folds, nodes, width, s.bins, 2))
            for batch in gathered(batches):
                bins, margins = margins_of(batch, fresh)
                hashes, y, f = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_h", "_y", "_fold"))
                take = drawn(hashes, number, s)
                for m in range(folds):
                    at = growing[m].leaves(bins)
                    use = np.flatnonzero(take & (f != m) & (at >= first))
                    p = 1 / (1 + np.exp(-margins[use, m]))
                    w = np.where(y[use] == 1, weight[m], 1.0)
                    g, h = np.rint(w * (p - y[use]) * SCALE), np.rint(w * p * (1 - p) * SCALE)
                    for i in allowed:
                        place = (at[use] - first) * s.bins + bins[use, i]
                        for c, v in enumerate((g, h)):
                            sums[m, :, i, :, c] += np.bincount(place, v, nodes * s.bins).reshape(nodes, s.bins)
            found = np.argwhere(sums[..., 1] > 0)
            got = sums[tuple(found.T)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int32()) for c in found.T.astype(np.int32)], *[pa.array(c, pa.int64()) for c in got.T.astype(np.int64)]],
                names=["model", "node", "feature", "bin", "g", "h"])

        parts = table.mapInArrow(run, PARTIAL)
        out = (parts if alone else parts.groupBy("model", "node", "feature", "bin").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h"))).toPandas()
        sums = np.zeros((folds, nodes, width, s.bins, 2))
        np.add.at(sums, tuple(out[c].to_numpy() for c in ("model", "node", "feature", "bin")), out[["g", "h"]].to_numpy())
        return sums / SCALE

    for number in range(s.trees):
        few = max(1, int(s.cols * width))
        allowed = np.sort(np.random.default_rng((s.seed, number)).choice(width, few, replace=False))
        growing = [Tree.stump(s.depth) for _ in range(folds)]
        fresh = [done[len(done) - since:] for done in trees]
        for level in range(s.depth):
            first = 2 ** level - 1
            sums = histograms(fresh, growing, first, number, allowed)
            for m, tree in enumerate(growing):
                for node in range(first, 2 * first + 1):
                    g, h = sums[m, node - first, ..., 0], sums[m, node - first, ..., 1]
                    if level == 0:
                        tree.value[0] = leaf_weight(g[allowed[0]].sum(), h[allowed[0]].sum(), s)
                    if (cut := best_split(g, h, allowed, s)) is None:
                        continue
                    tree.gain[node], tree.feature[node], tree.cut[node] = cut
                    f, b = cut[1:]
                    for child, part in ((2 * node + 1, slice(0, b + 1)), (2 * node + 2, slice(b + 1, None))):
                        tree.value[child] = leaf_weight(g[f, part].sum(), h[f, part].sum(), s)
            if all(t.feature[first:2 * first + 1].max() < 0 for t in growing):
                break
        for done, tree in zip(trees, growing):
            done.append(tree)
        since += 1
        if since == REWRITE and number + 1 < s.trees:
            fresh = [done[-since:] for done in trees]

            def advanced(batches, fresh=fresh):
                for batch in gathered(batches):
                    bins, margins = margins_of(batch, fresh)
                    yield state_of(batch, bins, margins)

            table, since = written(spark, table.mapInArrow(advanced, state), "boost-state"), 0
    return Boosted(edges, trees, s)
