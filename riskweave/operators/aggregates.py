"""Per-service and whole-table aggregates.

Means are exact sums divided once: values are summed as decimals, so the result does not depend on
how rows were split over tasks or on retries.
"""

from functools import reduce

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions import risk
from riskweave.functions.coerce import literal_map
from riskweave.functions.rounding import round_exact
from riskweave.operators.filters import last_year
from riskweave.operators.ranking import dedup_highest, first_seen

EXACT = "decimal(18,6)"


def exact_sum(col):
    value = F.col(col) if isinstance(col, str) else col
    return F.sum(value.cast(EXACT)).cast("double")


def exact_mean(col):
    """Mean over non-NULL values."""
    value = F.col(col) if isinstance(col, str) else col
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))


def count_where(cond):
    return F.count_if(F.coalesce(cond, F.lit(False)))


VULN_ZEROS = {
    "cvss_normalized": 0.0, "exploit_maturity_score": 0.0, "epss_score": 0.0,
    "severity_ordinal_norm": 0.0, "temporal_decay": 0.0, "cve_count": 0, "highest_cvss": 0.0,
    "is_kev_present": 0, "critical_cve_count": 0, "high_cve_count": 0, "medium_cve_count": 0,
    "low_cve_count": 0,
}


def vuln_features(vulns, as_of):
    """Security inputs per service after highest-CVSS dedup; a missing score counts as 0."""
    cols = ["service_name", "cve_id", "advisory_id", "source", "cvss_v3_score", "epss_score",
            "severity", "is_kev", "published_at"]
    slim = vulns.select(*[c for c in cols if c in vulns.columns])
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    rows = dedup_highest(slim).select(
        "service_name", zero("cvss_v3_score").alias("cvss"), zero("epss_score").alias("epss"),
        F.upper(F.coalesce("severity", F.lit("UNKNOWN"))).alias("sev"),
        F.coalesce(F.col("is_kev").cast("int"), F.lit(0)).alias("kev"),
        risk.decay("published_at", as_of).alias("decay"))
    sums = rows.groupBy("service_name").agg(
        F.count("*").alias("n"),
        exact_sum("cvss").alias("cvss"), exact_sum("epss").alias("epss"),
        exact_sum(risk.severity_ordinal("sev")).alias("ordinal"), exact_sum("decay").alias("decay"),
        F.count_if(F.col("epss") > 0.1).alias("likely"),
        F.max("cvss").alias("top"), F.max("kev").alias("kev"),
        *[F.count_if(F.col("sev") == s).cast("int").alias(f"{s.lower()}_cve_count")
          for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW")])
    n = F.col("n")
    means = sums.withColumns({
        "m_cvss": F.col("cvss") / n / 10.0, "m_likely": F.col("likely") / n, "m_epss": F.col("epss") / n,
        "m_ordinal": F.col("ordinal") / n, "m_decay": F.col("decay") / n})
    return means.select(
        "service_name",
        round_exact("m_cvss", 4).alias("cvss_normalized"),
        round_exact("m_likely", 4).alias("exploit_maturity_score"),
        round_exact("m_epss", 4).alias("epss_score"),
        round_exact("m_ordinal", 4).alias("severity_ordinal_norm"),
        round_exact("m_decay", 4).alias("temporal_decay"),
        n.cast("int").alias("cve_count"),
        round_exact("top", 1).alias("highest_cvss"),
        (F.col("kev") != 0).cast("int").alias("is_kev_present"),
        "critical_cve_count", "high_cve_count", "medium_cve_count", "low_cve_count")


INCIDENT_ZEROS = {
    "operational_risk_score": 0.0, "major_incident_count_12m": 0, "total_incident_hours_12m": 0.0,
}


def hours(minutes):
    """Minutes to hours at the four decimals of the source database's division."""
    return (minutes / F.lit(60.0)).cast("decimal(18,4)")


def incident_features(incidents, as_of):
    """Reliability inputs per service over the last year."""
    recent = last_year(incidents, as_of)
    spent = F.col("duration_hours").cast(EXACT) if "duration_hours" in incidents.columns else hours(
        F.col("duration_minutes"))
    sums = recent.groupBy("service_name").agg(
        F.count_if(risk.is_major("severity")).cast("int").alias("majors"),
        F.coalesce(F.sum(spent).cast("double"), F.lit(0.0)).alias("hours"))
    return incident_composite(sums).select(
        "service_name", round_exact("composite", 4).alias("operational_risk_score"),
        F.col("majors").alias("major_incident_count_12m"),
        round_exact("hours", 2).alias("total_incident_hours_12m"))


def incident_composite(df):
    """0.6 of the capped count of majors plus 0.4 of the capped downtime."""
    return df.withColumn(
        "composite",
        F.least(F.col("majors") / 12.0, F.lit(1.0)) * 0.6 + F.least(F.col("hours") / 100.0, F.lit(1.0)) * 0.4)


def incident_agg(incidents):
    """Incident inputs of the model: counts, mean severity, unresolved share, downtime."""
    score = F.coalesce(F.try_element_at(literal_map(C.INCIDENT_SEVERITY_SCORES), F.col("severity")), F.lit(0))
    unresolved = F.when(F.col("status") == "resolved", 0).otherwise(1)
    return incidents.groupBy("service_name").agg(
        F.count("incident_id").alias("incident_count"),
        F.avg(score).alias("avg_severity"),
        F.avg(unresolved).alias("recurrence_rate"),
        F.coalesce(F.sum("duration_minutes"), F.lit(0)).cast("bigint").alias("total_downtime"))


def vuln_agg(vulns, casefold=False, cwes=()):
    """Vulnerability inputs of the model; no dedup, NULLs skipped, lower-case severities counted.

    `cwes` adds one count column per listed weakness in the same pass over the rows.
    """
    sev = F.lower("severity") if casefold else F.col("severity")
    return vulns.groupBy("service_name").agg(
        F.count("cve_id").alias("total_vulns"),
        count_where(sev.isin("critical", "high")).alias("open_vulns"),
        exact_mean("cvss_v3_score").alias("mean_cvss"),
        F.max("cvss_v3_score").cast("double").alias("max_cvss"),
        F.coalesce(F.sum(F.col("is_kev").cast("int")), F.lit(0)).alias("exploit_count"),
        exact_mean("epss_score").alias("mean_epss"),
        *category_counts("cwe_id", cwes))


def category_counts(col, values):
    return [count_where(F.col(col) == v).alias(f"{col}_{v}") for v in values]


REPO_MEANS = ("commit_count_90d", "contributor_count_90d", "open_issues", "security_issues_open",
              "mean_days_close_security", "days_since_last_release")


def repo_agg(repo):
    return repo.groupBy("service_name").agg(
        *[exact_mean(c).alias(c) for c in REPO_MEANS],
        F.max("has_security_policy").alias("has_security_policy"))


def onehot_counts(df, key, col, values):
    """One count column per listed category, in one aggregation; rows of other categories are left out."""
    wanted = df.filter(F.col(col).isin(*values))
    return wanted.groupBy(key).agg(*category_counts(col, values))


def entity_list(vulns, order):
    """One row per service with its first ecosystem in the given order."""
    first = first_seen(vulns.select("service_name", "ecosystem", *[c for c in order if c not in
                                                                    ("service_name", "ecosystem")]),
                       ["service_name"], order)
    return first.select(
        "service_name", "ecosystem", F.col("service_name").alias("vendor"),
        F.lit(0).alias("is_oss"), F.lit(0).alias("is_saas"))


def repo_stats(commits, issues, releases, as_of, days=C.LOOKBACK_DAYS):
    """Repository activity in a window: commits, authors, open security issues, close time, release age."""
    since = risk.as_of_lit(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    by_commit = commits.filter(F.col("committed_at") >= since).groupBy("repo").agg(
        F.count("*").alias("commit_count_90d"),
        F.count_distinct(F.nullif("author", F.lit(""))).alias("contributor_count_90d"))
    secs = risk.seconds_between("created_at", "closed_at")
    security = issues.filter((F.col("created_at") >= since) & F.col("is_security"))
    closed = F.when(F.col("state") == "closed", secs)
    by_issue = security.groupBy("repo").agg(
        F.count_if(F.col("state") == "open").alias("security_issues_open"),
        (F.sum(closed).cast("double") / F.nullif(F.count(closed), F.lit(0)) / 86400.0).alias("close_days"))
    by_release = releases.groupBy("repo").agg(F.max("published_at").alias("last_release"))
    out = by_commit.join(by_issue, "repo", "full_outer").join(by_release, "repo", "full_outer")
    return out.select(
        "repo",
        F.coalesce("commit_count_90d", F.lit(0)).alias("commit_count_90d"),
        F.coalesce("contributor_count_90d", F.lit(0)).alias("contributor_count_90d"),
        F.coalesce("security_issues_open", F.lit(0)).alias("security_issues_open"),
        round_exact("close_days", 1).alias("mean_days_close_security"),
        risk.whole_days("last_release", risk.as_of_lit(as_of)).cast("int").alias("days_since_last_release"))


def repo_metrics(commits, issues, releases, repos, as_of, days=C.LOOKBACK_DAYS):
    """Repository health rows: the listed repositories with their windowed statistics."""
    stats = repo_stats(commits, issues, releases, as_of, days)
    zero = ("commit_count_90d", "contributor_count_90d", "security_issues_open")
    out = repos.join(stats, "repo", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})


def confidence_breakdown(features):
    words = ("full_data", "partial_data", "insufficient_data")
    return features.agg(*[F.count_if(F.col("data_confidence") == w).alias(w) for w in words])


def run_summary(scores):
    out = scores.agg(
        F.count("*").alias("services_scored"),
        F.coalesce(exact_mean("final_risk_score"), F.lit(0.0)).alias("mean_score"),
        count_where(F.col("is_kev_present") == 1).alias("kev_services"),
        count_where(F.col("data_confidence") == "insufficient_data").alias("insufficient_data_services"))
    return out.select("services_scored", round_exact("mean_score", 1).alias("avg_final_score"),
                      "kev_services", "insufficient_data_services")


def distribution(df, col):
    """Count and share of each value."""
    total = df.agg(F.count("*")).scalar()
    return (
        df.groupBy(col).agg(F.count("*").alias("n")).withColumn("_all", total)
        .select(F.col(col), "n", (F.col("n") / F.col("_all")).alias("share"))
    )


def global_max(df, cols):
    """Maxima over the whole frame as one struct, for use as a scalar subquery."""
    return df.agg(F.struct(*[F.max(c).cast("double").alias(c) for c in cols]).alias("m")).scalar()


def null_audit(df, cols):
    """One row: does any listed column still hold a NULL."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.agg(F.coalesce(F.max(any_null.cast("int")), F.lit(0)).alias("has_null"))


def source_counts(df, errors=None):
    """Record counts per feed; error rows, where given, are counted beside them."""
    out = df.groupBy("source").agg(F.count("*").alias("record_count"))
    if errors is None:
        return out
    bad = errors.groupBy("source").agg(F.count("*").alias("error_count"))
    return out.join(bad, "source", "full_outer").select(
        "source", F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"))


def histogram(df, col, width=1.0):
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(F.floor(F.col(col) / F.lit(float(width))).alias("bucket")).agg(F.count("*").alias("n"))
        .select("bucket", (F.col("bucket") * F.lit(float(width))).alias("bucket_from"), "n")
    )


def score_vs(df, score="risk_score"):
    """Correlation of the score with mean CVSS and with vulnerability count."""
    return df.agg(F.count("*").alias("services"), F.corr(score, "mean_cvss").alias("corr_cvss"),
                  F.corr(score, "total_vulns").alias("corr_volume"))
