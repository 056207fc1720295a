"""Ranked deduplication, latest rows, top-k, sorts.

Rankings keep `row_number <= k`, which Spark applies per input partition before the shuffle as well
as after it, so a key that holds a third of the rows still sends k rows per input partition.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pick_per_key(df, keys, order, largest):
    """The row with the smallest or largest ordering per key; make `order` unique within a key.

    The leading hash makes the sort compare one long instead of long shared name prefixes.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    cols = [c.desc() if largest else c.asc() for c in cols]
    rank = F.row_number().over(W.partitionBy("_h", *keys).orderBy(*cols))
    return (
        df.withColumn("_h", F.xxhash64(*keys)).withColumn("_rank", rank)
        .filter(F.col("_rank") == 1).drop("_h", "_rank")
    )


def latest(df, keys, order):
    """Newest row per key."""
    return pick_per_key(df, keys, order, largest=True)


def first_seen(df, keys, order):
    """First row per key in ingest order."""
    return pick_per_key(df, keys, order, largest=False)


def prefer_nonnull(df, keys, col, order):
    """First row per key, rows where `col` is filled before rows where it is not."""
    empty = F.col(col).isNull() | (F.col(col).cast("string") == "")
    return pick_per_key(df, keys, [empty.cast("int"), *order], largest=False)


def dedup_highest(vulns, ties=("advisory_id", "source")):
    """Per service and CVE the row with the highest CVSS (NULL as 0).

    Rows without a CVE id are all kept: each gets its own group key, so they spread over tasks.
    """
    missing = F.coalesce(F.col("cve_id"), F.lit("")) == ""
    keyed = (
        vulns.withColumn("_solo", F.when(missing, F.monotonically_increasing_id()))
        .withColumn("_cve", F.when(~missing, F.col("cve_id")))
    )
    score = F.coalesce(F.col("cvss_v3_score").cast("double"), F.lit(0.0))
    last = [c for c in vulns.columns if c not in ties and c not in ("service_name", "cve_id", "cvss_v3_score")]
    order = [-score, *[t for t in ties if t in vulns.columns], *sorted(last)]
    return pick_per_key(keyed, ["service_name", "_cve", "_solo"], order, largest=False).drop("_cve", "_solo")


def topk(df, group, order, k, name="rn"):
    """First k rows per group; `order` holds sort columns that are unique within a group."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)


def recent_n(df, order, n):
    """Distinct rows, newest n overall."""
    return df.distinct().orderBy(*order).limit(n)


def recent_n_per(df, group, order, n):
    """Distinct rows, newest n of each group."""
    return topk(df.distinct(), group, order, n).drop("rn")


def value_counts(df, col, name="n"):
    """Category frequency, most frequent first, NULL left out."""
    return (
        df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias(name))
        .orderBy(F.col(name).desc(), F.col(col))
    )


def top_categories(df, col, n=20, name="n"):
    return value_counts(df, col, name).limit(n)


def in_top(df, col, n=20):
    """Rows whose category is among the n most frequent."""
    return df.join(top_categories(df, col, n).select(col), col, "left_semi")


def top_by_volume(vulns, k):
    return (
        vulns.groupBy("service_name").agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "service_name").limit(k)
    )


def minmax(df, col, eps=1e-9, name="scaled", ends=None):
    """(x - min) / (max - min + eps) over the whole frame. The extremes are `ends`, if they are known, or else a
    scalar subquery, which computes the frame once more."""
    if ends is None:
        ends = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("e")).scalar()
    else:
        ends = F.struct(*[F.lit(v).cast(df.schema[col].dataType).alias(n) for n, v in zip(("lo", "hi"), ends)])
    return (
        df.withColumn("_e", ends)
        .withColumn(name, (F.col(col) - F.col("_e.lo")) / (F.col("_e.hi") - F.col("_e.lo") + F.lit(eps)))
        .drop("_e")
    )


def leaderboard(scores, col="lr_risk_score"):
    return scores.orderBy(F.col(col).desc(), "service_name")


def newest_scores(scores, k=10):
    return scores.orderBy(F.col("scored_at").desc(), "service_name").limit(k)


def by_mean_cvss(df):
    return df.orderBy(F.col("mean_cvss").desc(), "service_name")
