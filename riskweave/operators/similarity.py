"""Exact top-k cosine search: blocks of a fixed number of bytes on both sides, pairs skipped by distances to pivots."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators.ranking import topk
from riskweave.session import written

BLOCK_BYTES = 64 << 20  # of vectors in one block; query blocks have an eighth


def unit(matrix):
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def stack(series):
    return unit(np.array(series.tolist(), dtype=np.float64)) if len(series) else np.zeros((0, 1))


def best_of(query_ids, queries, doc_ids, docs, k):
    """The k most similar documents of each query within one block; ties by document id.

    Dot products differ in the last bits between block shapes, so they are rounded before they are ranked.
    """
    order = np.argsort(doc_ids, kind="stable")
    doc_ids, docs, k = doc_ids[order], docs[order], min(k, len(doc_ids))
    found = []
    for first in range(0, len(queries), 256):
        sims = np.round(queries[first:first + 256] @ docs.T, 9)
        least = np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k]
        for i, row in enumerate(sims):
            near = np.flatnonzero(row >= least[i])
            top = near[np.lexsort((near, -row[near]))[:k]]
            found.append((np.full(len(top), query_ids[first + i]), doc_ids[top], row[top]))
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "similarity"), map(np.concatenate, zip(*found)))))


OUT = "query_id bigint, vec_id bigint, similarity double"
MAX_PIVOTS = 1024  # shipped with tasks; more blocks than that share pivots
SLACK = 1e-8  # above the rounding of similarities
NO_ANGLE = np.sqrt(2.0)  # a zero vector has similarity 0 to all, as if at a right angle


def distances(x, pivots):
    """Distances on the unit sphere; a zero vector counts as at a right angle."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ pivots.T), 0.0))


def widened(df, more):
    return T.StructType([*df.schema.fields, *[T.StructField(name, kind) for name, kind in more]])


def topk_similar(queries, vectors, k=10, block_bytes=BLOCK_BYTES):
    """Per query the k nearest vectors by cosine, ties by vector id. Exact; a zero vector has similarity 0 to all."""
    return search(queries, vectors, k, block_bytes)[0]


def search(queries, vectors, k=10, block_bytes=BLOCK_BYTES):
    """(the k nearest, visits): `visits` has one row per query and pivot that the search looked at.

    Vectors lie with the nearest of some pivots (four for each block of `block_bytes`, MAX_PIVOTS at most), cut
    into blocks of bounded size however many lie with one. By the triangle inequality a pivot's vectors are between d - far and
    d + far from a query at distance d. A query first meets the blocks of the pivots that hold k vectors within the least
    distance; its k-th best found there then excludes every pivot whose nearest possible vector is worse. Vectors
    are copied once per block of queries that visits theirs. A table of one block is searched at once.
    """
    spark = queries.sparkSession
    size = lambda df: df.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    (nq, width), (nv, wide) = size(queries), size(vectors)
    rows = max(1, block_bytes // (8 * max(width, wide, 1)))
    query_blocks = max(1, -(-nq // max(1, rows // 8)))
    few = min(MAX_PIVOTS, 4 * -(-nv // rows)) if nv > rows else 1
    drawn = vectors.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(few).toPandas()
    pivots = stack(drawn["embedding"])
    pivots = pivots[np.linalg.norm(pivots, axis=1) > 0]

    def place(batches):
        for pdf in batches:
            x = stack(pdf["embedding"])
            far = distances(x, pivots) if len(pivots) else np.full((len(x), 1), NO_ANGLE)
            near = np.where(np.linalg.norm(x, axis=1) > 0, far.argmin(axis=1) if len(pivots) else -1, -1)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "embedding": pdf["embedding"], "pivot": near.astype(np.int32),
                                "far": far[np.arange(len(x)), near]})

    only = vectors.select("vec_id", "embedding")
    placed = only.mapInPandas(place, widened(only, [("pivot", T.IntegerType()), ("far", T.DoubleType())]))
    placed = written(spark, placed, "placed") if few > 1 else placed
    held = {r["pivot"]: (r["n"], r["a"], r["b"]) for r in placed.groupBy("pivot").agg(
        F.count("*").alias("n"), F.min("far").alias("a"), F.max("far").alias("b")).collect()}
    order = np.array(sorted(held), dtype=int)
    count, least, most = (np.array([held[p][i] for p in order], dtype=float) for i in range(3))
    chunks = spark.createDataFrame([(int(p), int(-(-held[p][0] // rows))) for p in order], "pivot int, chunks int")

    def bounds(x):
        """Least and greatest distance of a query's vectors to those of every pivot."""
        zero = np.linalg.norm(x, axis=1, keepdims=True) == 0
        d = distances(x, pivots[order[order >= 0]]) if (order >= 0).any() else np.zeros((len(x), 0))
        d = np.hstack([np.full((len(x), int((order < 0).sum())), NO_ANGLE), d])
        flat = zero | (order < 0)
        low = np.where(flat, NO_ANGLE, np.maximum(0.0, np.maximum(d - most, least - d)))
        return low, np.where(flat, NO_ANGLE, d + most)

    def first(batches):
        for pdf in batches:
            _, high = bounds(stack(pdf["embedding"]))
            rank = np.argsort(high, axis=1, kind="stable")
            need = (np.cumsum(count[rank], axis=1) < k).sum(axis=1) + 1
            pdf["pivots"] = [order[r[:n]].tolist() for r, n in zip(rank, need)]
            yield pdf

    def later(batches):
        for pdf in batches:
            low, _ = bounds(stack(pdf["embedding"]))
            worth = 1.0 - low ** 2 / 2 >= pdf.pop("_least").fillna(-np.inf).to_numpy()[:, None] - SLACK
            pdf["pivots"] = [np.setdiff1d(order[w], p).tolist() for w, p in zip(worth, pdf["pivots"])]
            yield pdf

    asked = queries.select("query_id", "embedding", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int").alias("qb"))
    schema = widened(asked, [("pivots", T.ArrayType(T.IntegerType()))])
    stored = placed.join(chunks, "pivot").select("vec_id", "embedding", "pivot", F.pmod(
        F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk"))

    def pairs(visits):
        each = visits.withColumn("pivot", F.explode("pivots")).join(chunks, "pivot").withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        block = ["qb", "pivot", "chunk"]
        wanted = each.select(*[F.col(c).alias(f"_{c}") for c in block]).distinct()
        right = stored.join(wanted, (F.col("pivot") == F.col("_pivot")) & (F.col("chunk") == F.col("_chunk"))).select(
            "vec_id", "embedding", *[f"_{c}" for c in block])

        def pair(q, v):
            if q.empty or v.empty:
                return pd.DataFrame({"query_id": [], "vec_id": [], "similarity": []})
            return best_of(q["query_id"].to_numpy(), stack(q["embedding"]), v["vec_id"].to_numpy(),
                           stack(v["embedding"]), k)

        return each.select("query_id", "embedding", *block).groupBy(*block).cogroup(
            right.groupBy(*[f"_{c}" for c in block])).applyInPandas(pair, OUT)

    best = lambda found: topk(found, ["query_id"], [F.col("similarity").desc(), "vec_id"], k, name="rank")
    seen = lambda visits: visits.select("query_id", F.explode("pivots").alias("pivot"))
    if few == 1:
        visits = asked.withColumn("pivots", F.array(*[F.lit(int(p)) for p in order]).cast("array<int>"))
        return best(pairs(visits)), seen(visits)
    opened = written(spark, asked.mapInPandas(first, schema), "visits")
    found = written(spark, best(pairs(opened)), "found")
    kth = found.where(F.col("rank") == k).select("query_id", F.col("similarity").alias("_least"))
    rest = opened.join(kth, "query_id", "left").select("query_id", "embedding", "qb", "pivots", "_least")
    rest = written(spark, rest.mapInPandas(later, schema), "visits")
    return best(found.drop("rank").unionByName(pairs(rest))), seen(opened).unionByName(seen(rest))


def similar_in_service(queries, vectors, k=10):
    """Nearest vectors among those of the query's own service, by key join."""
    dot = lambda a, b: F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    q = queries.select("query_id", "service_name", F.col("embedding").alias("_q"))
    both = vectors.join(q, "service_name")
    norm = F.sqrt(dot(F.col("_q"), F.col("_q"))) * F.sqrt(dot(F.col("embedding"), F.col("embedding")))
    sims = both.select("query_id", "vec_id", F.coalesce(
        F.try_divide(dot(F.col("_q"), F.col("embedding")), norm), F.lit(0.0)).alias("similarity"))
    return topk(sims, ["query_id"], [F.col("similarity").desc(), "vec_id"], k, name="rank")
