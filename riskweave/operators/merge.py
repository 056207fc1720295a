"""Keyed table maintenance."""

from functools import reduce

from pyspark.sql import functions as F

from riskweave.operators.ranking import first_seen, latest


def _keys_present(keys):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def upsert(target, updates, keys, order):
    """Latest-wins upsert.

    New keys are added; known keys take every column that `updates` supplies and keep the others.
    Columns unknown to the target are dropped. Within a batch the row with the largest `order` wins.
    Rows with a NULL in the key never match, as under a unique index, and skip the join altogether.
    """
    supplied = [c for c in updates.columns if c in target.columns]
    # one pass over each side: a row with a NULL in its key gets a negative or positive number of its own
    own = lambda sign: F.when(~_keys_present(keys), (F.monotonically_increasing_id() + 1) * sign).otherwise(F.lit(0))
    fresh = latest(updates.withColumn("_solo", own(1)), [*keys, "_solo"], list(order)).select(
        *supplied, "_solo", F.lit(True).alias("_new"))
    old = target.withColumn("_solo", own(-1))
    match = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"u.{k}")) for k in [*keys, "_solo"]])
    joined = old.alias("t").join(fresh.alias("u"), match, "full_outer")
    return joined.select(*[
        F.when(F.col("u._new"), F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in supplied
        else F.col(f"t.{c}")
        for c in target.columns
    ])


def insert_ignore(target, new, keys, order=None):
    """Add keys that are not there yet, the first row of each by `order` (all columns if none); ignore the rest."""
    once = first_seen(new, keys, list(order or new.columns))
    fresh = once.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*[c for c in new.columns if c in target.columns]),
                              allowMissingColumns=True)


def missing_keys(a, b, keys):
    """Keys of `a` that `b` lacks."""
    return a.select(*keys).distinct().join(b.select(*keys), keys, "left_anti")


def upsert_scores(target, scored):
    """Score rows by (run_id, service_name), all other columns overwritten."""
    return upsert(target, scored, ["run_id", "service_name"], ["scored_at"])


def upsert_chunks(target, chunks, prune_stale=False, order=None):
    """Text chunks by (collection, chunk_id).

    With `order`, a column that is one value per ingested version and rises, a batch may hold several versions
    of a document and all chunks come from the newest; without, it holds one version of each. A shorter new
    version leaves the old version's higher chunks in place unless `prune_stale`.
    """
    if order is not None:
        newest = chunks.groupBy("collection", "doc_key").agg(F.max(order).alias("_last"))
        chunks = chunks.join(newest, ["collection", "doc_key"]).filter(F.col(order) == F.col("_last")).drop("_last")
    merged = upsert(target, chunks, ["collection", "chunk_id"], ["total_chunks", "text"])
    if not prune_stale:
        return merged
    sizes = chunks.groupBy("collection", "doc_key").agg(F.max("total_chunks").alias("_now"))
    return (
        merged.join(sizes, ["collection", "doc_key"], "left")
        .filter(F.col("_now").isNull() | (F.col("chunk_index") < F.col("_now")))
        .drop("_now")
    )


def flag_kev(vulns, kev):
    """is_kev = 1 on every row whose CVE is in the catalogue; never back to 0.

    The catalogue side is one row per id; Spark broadcasts it while its measured size allows, and
    otherwise joins by key with hot vulnerability keys split at run time.
    """
    ids = kev.select(F.upper("cve_id").alias("cve_id"), F.lit(1).alias("_hit")).distinct()
    return (
        vulns.join(ids, "cve_id", "left")
        .withColumn("is_kev", F.when(F.col("_hit") == 1, 1).otherwise(F.col("is_kev")))
        .select(*vulns.columns)
    )


def in_kev(vulns, kev):
    return vulns.join(kev.select("cve_id").distinct(), "cve_id", "left_semi")


def union_feeds(*frames):
    """One table from several feeds; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_ids(df, col="cve_id"):
    return df.filter(F.col(col).isNotNull()).select(col).distinct()
