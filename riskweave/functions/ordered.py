"""Global ranks and running sums without a one-task window.

Rows are cut into ordered buckets, each bucket is ranked on its own, and the bucket totals (one row
per bucket, a fixed number of buckets) give the offset to add.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS


def hashed_row_number(df, group, key, name="rn"):
    """Exact row number per group in the order of a hash of `key` (unique), spread over buckets."""
    order = F.xxhash64(*[F.col(k) for k in key])
    tagged = df.withColumn("_h", order).withColumn("_b", F.shiftright("_h", 64 - BUCKET_BITS))
    sizes = tagged.groupBy(*group, "_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    total = F.sum("_n").over(W.partitionBy(*group))
    offsets = sizes.select(*group, "_b", F.coalesce(before, F.lit(0)).alias("_off"), total.alias("group_size"))
    inside = F.row_number().over(W.partitionBy(*group, "_b").orderBy("_h", *key))
    return (
        tagged.withColumn("_i", inside)
        .join(offsets, [*group, "_b"])
        .withColumn(name, F.col("_i") + F.col("_off"))
        .drop("_h", "_b", "_i", "_off")
    )


def running_sums(df, order_col, sums, descending=True, buckets=256):
    """Running totals of `sums` along a numeric column that is distinct per row.

    Bucket edges are quantiles of the column, so a narrow or lopsided range still spreads.
    Adds `cum_<col>` (inclusive) for every column in `sums`.
    """
    shares = [i / buckets for i in range(1, buckets)]
    edges = df.agg(F.percentile_approx(order_col, shares, 10000).alias("e")).scalar()
    x = F.col(order_col)
    cut = df.withColumn("_e", edges).withColumn(
        "_b", F.coalesce(F.size(F.filter("_e", lambda e: e < x)), F.lit(0))).drop("_e")
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    totals = cut.groupBy("_b").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # one row per bucket, so this ordered window is small whatever the data size
    earlier = W.partitionBy(F.lit(0)).orderBy(direction("_b")).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_b", *[
        F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums])
    inside = W.partitionBy("_b").orderBy(direction(order_col)).rowsBetween(W.unboundedPreceding, 0)
    out = cut
    for c in sums:
        out = out.withColumn(f"_s_{c}", F.sum(c).over(inside))
    out = out.join(offsets, "_b")
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.col(f"_s_{c}") + F.col(f"_o_{c}"))
    return out.drop("_b", *[f"_s_{c}" for c in sums], *[f"_o_{c}" for c in sums])
