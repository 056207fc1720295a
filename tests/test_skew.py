from pyspark.sql import functions as F

from riskweave.operators import registry as G
from riskweave.operators.joins import fragment_join
from riskweave.operators.merge import flag_kev

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def test_a_key_with_a_third_of_the_rows_is_split_in_the_lookup_join(spark):
    """With every threshold lowered to the size of the fixture, the hot partition must be cut."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        vulns = spark.range(0, n, 1, 16).select(
            F.concat(F.lit("CVE-"), key.cast("string")).alias("cve_id"), F.lit(0).alias("is_kev"), F.col("id").alias("row"))
        kev = spark.range(0, 1000).select(F.concat(F.lit("cve-"), F.col("id").cast("string")).alias("cve_id"))
        out = flag_kev(vulns, kev)
        assert (out.count(), out.filter("is_kev = 1").count()) == (n, n // 3 + 666)
        out.write.format("noop").mode("overwrite").save()
        done = out._jdf.queryExecution()
        out._jdf.collectToPython()
        assert "skew=true" in done.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sizes(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_one_run_spreads_over_all_tasks(spark):
    """Every feature row has the same key; the smaller side is taken as too large to broadcast."""
    for k in SMALL:
        spark.conf.set(k, SMALL[k])
    try:
        features = spark.range(0, 80_000, 1, 4).selectExpr("'run-1' AS run_id", "id", "map('a', id) AS tiers")
        policies = spark.createDataFrame([("run-1", "org1"), ("run-1", "org2"), ("run-2", "org3")], "run_id string, org string")
        out = fragment_join(features, policies, ["run_id"], broadcast_bytes=0)
        assert out.columns == ["run_id", "id", "tiers", "org"]
        assert out.groupBy("org").count().orderBy("org").collect() == [("org1", 80_000), ("org2", 80_000)]
        spread = sizes(out)
        assert len(spread) > 3 and max(spread) < 2 * 160_000 / len(spread)
        few = fragment_join(features, policies, ["run_id"], broadcast_bytes=0, replicas=6)
        assert few.count() == 160_000
    finally:
        for k in SMALL:
            spark.conf.unset(k)


def test_a_small_side_is_broadcast_by_measured_size(spark):
    features, policies = spark.range(100).selectExpr("id % 3 AS run_id", "id"), spark.range(3).selectExpr("id AS run_id", "id AS p")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(fragment_join(features, policies, ["run_id"]))
    assert fragment_join(features, policies.limit(0), ["run_id"]).count() == 0


def test_aliases_with_one_prefix_gather_nowhere(spark):
    """All aliases and texts begin alike, which was one hot key for a join on first letters."""
    texts = spark.range(0, 20_000, 1, 8).selectExpr("concat('vendor number ', id) AS text")
    needles = spark.range(300).selectExpr("concat('vendor number ', id * 64) AS needle")
    want = sum(str(i).startswith(str(j * 64)) for i in range(20_000) for j in range(300))
    for k in SMALL:
        spark.conf.set(k, SMALL[k])
    try:
        for block in (1000, 100):
            out = G.contained(texts, needles, block=block)
            assert out.count() == want and len(sizes(out)) > 4
    finally:
        for k in SMALL:
            spark.conf.unset(k)
