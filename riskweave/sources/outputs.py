"""Sinks and the readers that go with them."""

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.coerce import enforce


def land_raw(df, path, by=("source", "ingest_date")):
    """Raw records as JSON lines by source and day, before any merge.

    The service stays a column: a folder per service does not hold up with many services. Add
    `service_name` to `by` for that layout. Rows are clustered by folder first, big folders over several
    tasks, so a folder gets few files and not one of every task.
    """
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).json(path)


# a packed file is read by one task, so that files are kept short
PACKED_ROWS = 1 << 16


def land_payloads(df, path, fmt="text"):
    """Payload documents as packed lines: names and values repeat in every record, and lie on disk at a fraction of their
    length. Readers unpack them by the files' names."""
    df.write.option("compression", "gzip").option("maxRecordsPerFile", PACKED_ROWS).format(fmt).save(path)


def read_raw(spark, path, schema):
    return spark.read.schema(schema).json(path)


def write_features(df, path, fmt="json"):
    """Feature records by run; a run written again replaces only itself."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").format(fmt).save(path))


def read_features(spark, path, schema, run_id, fmt="json"):
    """Feature records of one run. A run that was never written is an error, an empty one is not."""
    part = f"{path}/run_id={run_id}"
    return spark.read.schema(schema).format(fmt).load(part).withColumn("run_id", F.lit(run_id))


def manifest(features, run_id, completed_at, output_path):
    """One row per run: service count and confidence breakdown. The services are `manifest_services`."""
    words = ("full_data", "partial_data", "insufficient_data")
    return features.agg(
        F.count("*").alias("service_count"),
        *[F.count_if(F.col("data_confidence") == w).alias(w) for w in words],
    ).select(F.lit(run_id).alias("run_id"), F.lit(completed_at).alias("etl_completed_at"),
             "service_count", *words, F.lit(output_path).alias("output_path"))


def manifest_services(features, run_id):
    """The service list of a run as rows, so that no task holds it whole."""
    return features.select(F.lit(run_id).alias("run_id"), "service_name")


def safe_name(col):
    """A name without slashes and blanks, and eight digits of a hash so that `a/b` and `a b` stay apart."""
    return F.concat(F.regexp_replace(col, "[/ ]", "_"), F.lit("-"), F.left(F.md5(col), F.lit(8)))


def score_docs(scores):
    """One JSON text per service with a file-safe name."""
    return scores.select("run_id", safe_name(F.col("service_name")).alias("safe_name"),
                         F.to_json(F.struct(*scores.columns)).alias("document"))


def write_score_docs(scores, path):
    """The documents of a run as JSON lines (safe_name, document) in the run's folder; a run written again
    replaces only itself."""
    (score_docs(scores).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").json(path))


def dashboard(df, weights, as_of):
    """Report table: the fixed columns, when they were scored, and the weights as columns."""
    cols = ["service_name", "vendor", "ecosystem", "open_vulns", "mean_cvss", "mean_epss", "incident_count",
            "exploit_count", "total_vulns", "vuln_density", "security_issues_open", "days_since_last_release",
            "lr_risk_score", "anomaly_score", "anomaly_flag", "risk_level"]
    return df.select(*cols, F.lit(as_of[:16]).alias("last_scored"),
                     *[F.lit(float(weights[c])).alias(f"weight_{c}") for c in C.RISK_CATEGORIES]
                     ).orderBy(F.col("lr_risk_score").desc(), "service_name")


def ensure_table(spark, name, schema, location=None):
    """Create a table if it is absent, add the columns it lacks, keep what it has."""
    where = f" LOCATION '{location}'" if location else ""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{where}")
    have = {c.lower() for c in spark.table(name).columns}
    extra = [f for f in schema.fields if f.name.lower() not in have]
    if extra:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
    return spark.table(name)


def append_enforced(df, name, schema):
    enforce(df, schema).write.mode("append").insertInto(name)
