"""Joins whose hot keys cannot gather in one task."""

from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20
REPLICAS = 10_000_000


def fragment_join(big, small, keys, broadcast_bytes=BROADCAST_BYTES, replicas=REPLICAS):
    """Inner equi-join of a side with hot keys and a smaller one, by the measured size of the smaller.

    Up to `broadcast_bytes` of JSON text the smaller side is broadcast. Beyond, the rows of the other side are dealt over
    fragments by a hash of the whole row, whatever their key, and every row of the smaller side goes to all fragments: as
    many as there are shuffle partitions, or fewer so that its copies stay within `replicas`. A key that holds all rows
    then spreads over as many tasks. Repeated rows of one kind share a fragment. Measuring is one job over the smaller side.
    """
    row = F.octet_length(F.to_json(F.struct(*small.columns)))
    size = small.agg(F.count("*").alias("n"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()
    if size["bytes"] <= broadcast_bytes:
        return big.join(F.broadcast(small), list(keys))
    spark = big.sparkSession
    pieces = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), replicas // size["n"]))
    plain = [c for c, kind in big.dtypes if not kind.startswith(("map", "struct", "array", "variant"))]
    left = big.withColumn("_part", F.pmod(F.xxhash64(*plain), F.lit(pieces)))
    right = small.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(pieces - 1).cast("bigint"))))
    return left.join(right, [*keys, "_part"]).drop("_part")
