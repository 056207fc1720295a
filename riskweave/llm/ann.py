"""Approximate nearest neighbours by learned partitions: balanced cuts of a neighbour graph, a classifier routes."""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskweave.llm import tables

SAMPLE = 8192  # vectors that the partitions and the classifier are fitted on
NEIGHBOURS = 12
PARTS = 64
RECALL = 0.93
LENGTHS = 4  # numbers of components that get learned partitions; vectors of rarer ones are searched exactly
BLOCK = 20_000  # vectors, and queries, that one search task holds


def nearest_by_product(asks, x, k, own=False):
    """Indexes of the k rows of `x` of largest inner product with every row of `asks`, in blocks; `own`: both are the
    same rows and none finds itself."""
    out = np.empty((len(asks), min(k, len(x) - own)), dtype=np.int64)
    for a in range(0, len(asks), 1024):
        score = asks[a:a + 1024] @ x.T
        if own:
            score[np.arange(len(score)), np.arange(a, a + len(score))] = -np.inf
        out[a:a + 1024] = np.argpartition(-score, out.shape[1] - 1, axis=1)[:, :out.shape[1]]
    return out


def balanced_partition(graph, parts, seed=1, rounds=60):
    """Part of every node, of sizes that differ by little: the graph is halved at the median of the second
    eigenvector of its normalised adjacency, again and again."""
    n = len(graph)
    part = np.zeros(n, dtype=np.int64)
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    groups = [np.arange(n)]
    while len(groups) < parts:
        halves = []
        for nodes in groups:
            local = np.full(n, -1)
            local[nodes] = np.arange(len(nodes))
            inside = (local[a] >= 0) & (local[b] >= 0)
            u, v = local[a[inside]], local[b[inside]]
            degree = np.bincount(u, minlength=len(nodes)) + 1e-9
            root = np.sqrt(degree)
            x = rng.standard_normal(len(nodes))
            for _ in range(rounds):
                x -= root * (root @ x) / (root @ root)
                x = x + np.bincount(u, weights=(x / root)[v], minlength=len(nodes)) / root
                x /= np.linalg.norm(x) + 1e-30
            order = np.argsort(x / root, kind="stable")
            halves += [nodes[order[:len(nodes) // 2]], nodes[order[len(nodes) // 2:]]]
        groups = halves
    for i, nodes in enumerate(groups):
        part[nodes] = i
    return part


class Router:
    """One hidden layer from a vector to the probabilities of partitions; trained here with Adam on softmax loss.

    `target` holds the share of every partition for every training vector.
    """

    def __init__(self, x, target, hidden=128, epochs=60, batch=256, rate=0.003, seed=2):
        rng = np.random.default_rng(seed)
        d, parts = x.shape[1], target.shape[1]
        self.w = [rng.standard_normal((d, hidden)) * (2 / d) ** 0.5, np.zeros(hidden),
                  rng.standard_normal((hidden, parts)) * (1 / hidden) ** 0.5, np.zeros(parts)]
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                rows = order[i:i + batch]
                h = np.maximum(x[rows] @ self.w[0] + self.w[1], 0)
                p = self._softmax(h @ self.w[2] + self.w[3])
                p = (p - target[rows]) / len(rows)
                back = (p @ self.w[2].T) * (h > 0)
                t += 1
                for j, g in enumerate((x[rows].T @ back, back.sum(0), h.T @ p, p.sum(0))):
                    m[j] = 0.9 * m[j] + 0.1 * g
                    v[j] = 0.999 * v[j] + 0.001 * g * g
                    self.w[j] -= rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)

    @staticmethod
    def _softmax(z):
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probabilities(self, x):
        return self._softmax(np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3])


class Partitions:
    """Partitions of the vectors of one length, learned from a sample: where a row lies and which ones a query visits.

    Nearness is the inner product throughout: the graph joins each vector, as a query, with the rows of largest
    product. A row is placed by its direction and its length (a row of great length is near to many queries). A query
    is placed by its direction alone; its network learns where the neighbours of the known vectors lie. `visits`
    is the number of partitions in which held-out queries find `recall` of their neighbours.
    """

    def __init__(self, x, parts=PARTS, recall=RECALL, k=20):
        x = np.unique(x, axis=0)
        x = x[np.random.default_rng(3).permutation(len(x))]
        self.parts = 2 ** int(np.log2(max(1, min(parts, len(x) // (4 * k)))))
        self.visits = self.parts
        if self.parts == 1:
            return
        held, known = x[:len(x) // 5], x[len(x) // 5:]
        size = np.log(np.linalg.norm(known, axis=1))
        self.scale = size.mean(), max(size.std(), 1e-6)
        share = lambda part: np.eye(self.parts)[part]
        part = balanced_partition(nearest_by_product(known, known, NEIGHBOURS, own=True), self.parts)
        self.row_net = Router(self._placed(known), share(part))
        home = self.homes(known)
        near = home[nearest_by_product(known, known, k, own=True)]
        self.query_net = Router(unit(known), np.stack([share(n).mean(axis=0) for n in near]))
        turn = np.argsort(self._order(held), axis=1)
        found = np.sort(np.take_along_axis(turn, home[nearest_by_product(held, known, k)], axis=1).ravel())
        self.visits = int(found[min(len(found) - 1, int(np.ceil(recall * len(found))))]) + 1

    def _placed(self, x):
        size = np.log(np.linalg.norm(x, axis=1))
        return np.column_stack((unit(x), (size - self.scale[0]) / self.scale[1]))

    def _order(self, x):
        return np.argsort(-self.query_net.probabilities(unit(x)), axis=1, kind="stable")

    def homes(self, x):
        """Partition of every row."""
        if self.parts == 1:
            return np.zeros(len(x), dtype=np.int64)
        return self.row_net.probabilities(self._placed(x)).argmax(axis=1)

    def visited(self, x, held, least):
        """Partitions that every query visits, the most probable first: `visits`, and more until they hold `least` rows.
        `held` is the number of rows of each partition."""
        if self.parts == 1:
            return [[0]] * len(x)
        order = self._order(x)
        enough = (np.cumsum(held[order], axis=1) < least).sum(axis=1) + 1
        return [o[:max(self.visits, n)].tolist() for o, n in zip(order, enough)]


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(df, key, vector):
    """(key, vector as doubles) of vectors that are not null, not zero and of finite components only."""
    return df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda c: c != 0) & F.forall(
            "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def _matrix(column):
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _placed_by(rows, places):
    """(key, v, parts) by a function that maps a matrix of vectors of one length to lists of partitions."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                parts = pa.array(places(_matrix(batch.column(1))), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), parts], names=["key", "v", "parts"])

    return rows.mapInArrow(run, f"key {kind}, v array<double>, parts array<bigint>")


def _kept(rows):
    """Rows of lengths that are searched exactly: one partition for each length, named below 0."""
    return rows.select("key", "v", F.array(-F.size("v").cast("bigint")).alias("parts"))


def _indexed_and_asked(spark, rows, queries, sample, parts, recall, lengths, k):
    """Every row with its partition and every query with the partitions that it visits, as stored tables."""
    counts = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.col("count").desc(), "size").limit(
        lengths + 1).collect()
    learned, index, asked, seen = [r["size"] for r in counts[:lengths]], [], [], []
    for i, size in enumerate(learned):
        own = rows.where(F.size("v") == size)
        fit = own.orderBy(F.xxhash64("key"), "key", "v").limit(sample).toPandas()
        net = Partitions(np.array(fit["v"].tolist()), parts, recall, k)
        shipped = spark.sparkContext.broadcast(net)  # bounded by the two small networks
        first = i * parts
        index.append(_placed_by(own, lambda x, n=shipped, f=first: [[f + h] for h in n.value.homes(x).tolist()]))
        seen.append((own, shipped, net, first))
    rest = rows.where(~F.size("v").isin(learned)) if len(counts) > lengths else None
    if rest is not None:
        index.append(_kept(rest))
    index = tables.store(spark, reduce(DataFrame.unionByName, index).select(
        "key", "v", F.col("parts")[0].alias("part")), "indexed")
    held = {r["part"]: r["count"] for r in index.where("part >= 0").groupBy("part").count().collect()}  # lengths * parts
    for own, shipped, net, first in seen:
        size = np.array([held.get(first + p, 0) for p in range(net.parts)])

        def places(x, n=shipped, f=first, size=size):
            return [[f + p for p in visited] for visited in n.value.visited(x, size, k + 1)]

        asked.append(_placed_by(own.where(queries), places))
    if rest is not None:
        asked.append(_kept(rest.where(queries)))
    return index, tables.store(spark, reduce(DataFrame.unionByName, asked), "asked")


def search(spark, df, queries, key="vec_id", vector="embedding", k=20, sample=SAMPLE, parts=PARTS, recall=RECALL,
           block=BLOCK, lengths=LENGTHS):
    """(query_id, rank, key, score): the k rows of largest inner product found for every query, itself left out.

    Vectors meet those of their own number of components. For each of the `lengths` most frequent numbers at most
    `sample` vectors, the least by a hash of their key, are learned from: a neighbour graph by inner product is cut in
    `parts` balanced partitions, one small network learns them and another the partitions where a query's neighbours
    lie; held-out queries tell how many partitions a query must visit to find `recall` of its neighbours. Vectors of rarer lengths are
    searched exactly, a length by itself. Every row is indexed under its most probable partition. A partition is
    searched in blocks of about `block` vectors by `block` queries, so a hot partition is many tasks; each keeps the k
    best of its queries and the best of these remain. Scores are sums of double products of the stored values; ties
    go to the smaller key.

    Null, zero and non-finite vectors take no part. Fewer candidates than k give fewer rows. Rows that repeat a key are
    candidates like others, but never of a query of that key. Other columns are not read. An empty table gives no rows.
    """
    rows = usable(df, key, vector)
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"query_id {kind}, key {kind}, score double"
    if rows.isEmpty():
        return spark.createDataFrame([], f"query_id {kind}, rank int, {key} {kind}, score double")
    indexed, asked = _indexed_and_asked(spark, rows, queries, sample, parts, recall, lengths, k)
    asked = asked.select("key", "v", F.explode("parts").alias("part"))
    sizes = indexed.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("slabs")).join(
        asked.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("crowds")), "part")
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    base = indexed.join(sizes, "part").withColumn("slab", own("slabs")).withColumn("crowd", every("crowds"))
    question = asked.join(sizes, "part").withColumn("crowd", own("crowds")).withColumn("slab", every("slabs"))
    cols = ["part", "slab", "crowd", "key", "v"]

    def best(left, right):
        if not len(left) or not len(right):
            return pa.table({"query_id": left.column("key").slice(0, 0), "key": left.column("key").slice(0, 0),
                             "score": pa.array([], pa.float64())})
        names = right.column("key").combine_chunks()
        order = pa.compute.array_sort_indices(names)
        names = names.take(order)
        a, b = _matrix(left.column("v").combine_chunks()), _matrix(right.column("v").combine_chunks())
        b = b[order.to_numpy()]
        asks = left.column("key").combine_chunks()
        place = pa.compute.index_in(asks, value_set=names)
        owners = names.to_numpy(zero_copy_only=False)
        slack = 1e-9 * np.abs(b).max() * np.abs(a).max() * a.shape[1]
        got_q, got_b, got_s = [], [], []
        for first in range(0, len(a), 256):
            rough = a[first:first + 256] @ b.T
            for i in range(len(rough)):
                score, me = rough[i], place[first + i].as_py()
                if me is not None:
                    mine = owners == owners[me]
                    score[mine] = -np.inf
                if k < len(score):
                    least = np.partition(score, len(score) - k)[len(score) - k]
                    near = np.flatnonzero((score >= least - slack) & (score > -np.inf))
                else:
                    near = np.flatnonzero(score > -np.inf)
                exact = (b[near] * a[first + i]).sum(axis=1)
                top = np.lexsort((near, -exact))[:k]  # keys ascend with positions
                got_q.append(np.full(len(top), first + i))
                got_b.append(near[top])
                got_s.append(exact[top])
        return pa.table({
            "query_id": asks.take(pa.array(np.concatenate(got_q))), "key": names.take(pa.array(np.concatenate(got_b))),
            "score": np.concatenate(got_s)})

    found = question.select(cols).groupBy("part", "slab", "crowd").cogroup(
        base.select(cols).groupBy("part", "slab", "crowd")).applyInArrow(best, schema)
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("key"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), F.col("key").alias(key), "score")
