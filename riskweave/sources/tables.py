"""Table scans and the domain views over the shared test tables."""

from pyspark.sql import functions as F


def read_parquet(spark, path):
    """Parquet scan with the schema the files have now."""
    return spark.read.parquet(path)


def read_table(spark, name, source):
    """Full scan of one table: a folder of parquet files, a catalog name, or JDBC options."""
    if isinstance(source, dict):
        return spark.read.format("jdbc").options(dbtable=name, **source).load()
    if source is None:
        return spark.table(name)
    return read_parquet(spark, f"{source}/{name}.parquet")


def scan(df, cols, predicate=None):
    """Projection and filter, both of which reach the parquet or JDBC scan."""
    if predicate is not None:
        df = df.filter(predicate)
    return df.select(*cols)


def select_params(spark, query, params=None, **frames):
    """Ad-hoc SELECT with named parameters and DataFrame arguments."""
    return spark.sql(query, args=params, **frames)


# -- views over the shared tables: each maps one table (joined to supplier) to a domain table ----


def supplier_keys(spark, sf):
    return read_table(spark, "supplier", sf).select("s_suppkey", "s_name")


def supplier_count(spark, sf):
    return read_table(spark, "supplier", sf).agg(F.count("*")).scalar()


def vulnerabilities(spark, sf):
    li = read_table(spark, "lineitem", sf)
    sup = supplier_keys(spark, sf)
    qty = F.col("l_quantity")
    text = lambda c: F.col(c).cast("string")
    return li.join(sup, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.lit("src"), (F.col("l_linenumber") % 3).cast("string")).alias("source"),
        F.concat(F.lit("CVE-"), text("l_orderkey")).alias("cve_id"),
        F.concat(F.lit("ADV-"), text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("advisory_id"),
        F.col("s_name").alias("service_name"),
        F.when(qty >= 45, "CRITICAL").when(qty >= 35, "HIGH").when(qty >= 20, "MEDIUM").otherwise("LOW")
        .alias("severity"),
        (qty / 5.0).alias("cvss_v3_score"),
        (F.col("l_discount") * 5).alias("epss_score"),
        F.when((F.col("l_returnflag") == "R") & (qty >= 48), 1).otherwise(0).alias("is_kev"),
        F.concat(F.lit("CWE-"), (F.col("l_partkey") % 40).cast("string")).alias("cwe_id"),
        (F.col("l_shipdate") + F.expr("INTERVAL 8120 DAYS")).alias("published_at"),
        F.when(F.col("l_linestatus") == "F", "npm").otherwise("PyPI").alias("ecosystem"),
    )


def incidents(spark, sf):
    ev = read_table(spark, "events", sf).withColumn(
        "svc_key", F.col("user_id") % supplier_count(spark, sf))
    kind = F.col("event_type")
    return ev.join(supplier_keys(spark, sf), F.col("svc_key") == F.col("s_suppkey")).select(
        F.col("s_name").alias("service_name"),
        F.col("event_id").cast("string").alias("incident_id"),
        F.when(kind == "error", "major").when(kind == "click", "minor").when(kind == "view", "maintenance")
        .when(kind == "purchase", "high").otherwise("low").alias("severity"),
        F.when(F.col("event_id") % 5 == 0, "investigating").otherwise("resolved").alias("status"),
        F.col("ts").alias("started_at"),
        F.floor("value").cast("int").alias("duration_minutes"),
    )


def repo_health(spark, sf):
    part = read_table(spark, "part", sf).withColumn(
        "svc_key", F.col("p_partkey") % supplier_count(spark, sf))
    return part.join(supplier_keys(spark, sf), F.col("svc_key") == F.col("s_suppkey")).select(
        F.col("s_name").alias("service_name"),
        F.concat(F.lit("org/repo"), F.col("p_partkey").cast("string")).alias("repo_full_name"),
        (F.col("p_size") * 10).alias("commit_count_90d"),
        F.col("p_size").alias("contributor_count_90d"),
        (F.col("p_partkey") % 120).cast("int").alias("open_issues"),
        (F.col("p_partkey") % 7).cast("int").alias("security_issues_open"),
        (F.col("p_retailprice") / 20.0).alias("mean_days_close_security"),
        (F.col("p_partkey") % 500).cast("int").alias("days_since_last_release"),
        F.when(F.col("p_type") == "ECONOMY", 1).otherwise(0).alias("has_security_policy"),
        F.col("p_partkey").alias("collected_seq"),
    )


def documents(spark, sf):
    slot = F.col("doc_id") % 4
    number = F.substring("source", 4, 20).cast("int").cast("string")
    return read_table(spark, "documents", sf).select(
        "doc_id",
        F.concat(F.lit("Supplier#"), F.lpad(number, 9, "0")).alias("service_name"),
        F.when(slot == 0, "documentation").when(slot == 1, "advisory_text")
        .when(slot == 2, "trust_disclosures").otherwise("incident_postmortems").alias("collection"),
        "text",
    )


def services(spark, sf):
    return read_table(spark, "supplier", sf).select(
        F.col("s_name").alias("service_name"), F.col("s_name").alias("vendor"),
        F.lit("SaaS").alias("ecosystem"), F.lit(None).cast("string").alias("github_repo"),
    )


FRAMEWORK_ORDER = ["SOC2", "PCI-DSS", "HIPAA", "ISO27001", "GDPR", "FedRAMP"]
CONTROL_ORDER = ["mfa_enforced", "waf_deployed", "network_segmentation", "endpoint_detection",
                 "vulnerability_scanning", "data_encryption_at_rest", "incident_response_plan",
                 "badge_readers"]


def policies(spark, sf):
    """One organisation policy per customer, its settings read off the customer's columns."""
    key = F.col("c_custkey")
    pick = lambda names, step: F.array_compact(F.array(*[
        F.when(F.floor(key * step / 2 ** i) % 2 == 1, F.lit(n)) for i, n in enumerate(names)]))
    return read_table(spark, "customer", sf).select(
        F.col("c_name").alias("org_name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.array_append(pick(FRAMEWORK_ORDER, 1), F.lit("SOC2")))
        .otherwise(pick(FRAMEWORK_ORDER, 1)).alias("regulatory_frameworks"),
        pick(CONTROL_ORDER, 3).alias("compensating_controls"),
        F.when(key % 3 == 0, F.create_map(F.lit("security_posture"), F.lit(0.6)))
        .when(key % 3 == 1, F.create_map(F.lit("security_posture"), F.lit(0.5), F.lit("governance"), F.lit(0.2)))
        .alias("dimension_weight_overrides"),
        F.create_map(F.concat(F.lit("Supplier#"), F.lpad((key % 10).cast("string"), 9, "0")),
                     (key % 4).cast("int")).alias("service_tiers"),
    )
