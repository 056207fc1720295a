"""Feed payloads to table rows."""

from pyspark.sql import functions as F

from riskweave.functions.coerce import filled, map_severity, norm_timestamp, strip
from riskweave.functions.risk import seconds_between
from riskweave.operators.filters import not_withdrawn, usable_matches

VULN_COLUMNS = ("source", "cve_id", "advisory_id", "service_name", "ecosystem", "severity", "cvss_v3_score",
                "cvss_v3_vector", "epss_score", "is_kev", "cwe_id", "published_at", "modified_at")
INCIDENT_COLUMNS = ("service_name", "incident_id", "severity", "status", "started_at", "resolved_at",
                    "duration_minutes", "affected_components")
UNKNOWN = "unknown"


def first_of(array):
    return F.try_element_at(array, F.lit(1))


def orelse(array):
    """A list, with an empty one read as absent."""
    return F.when(F.size(array) > 0, array)


def cpe_vendor(configurations):
    """Vendor part of the first vulnerable match that names one, else unknown."""
    vendors = F.transform(usable_matches(configurations),
                          lambda m: F.split_part(m["criteria"], F.lit(":"), F.lit(4)))
    named = F.filter(vendors, lambda v: v.isNotNull() & ~v.isin("*", "-", ""))
    return F.coalesce(first_of(named), F.lit(UNKNOWN))


def pick_cvss(metrics):
    """Score, vector and severity of the primary v3.1 (else v3.0) metric; a score of 0 is absent."""
    listed = F.coalesce(orelse(metrics["cvssMetricV31"]), orelse(metrics["cvssMetricV30"]))
    primary = first_of(F.filter(listed, lambda m: m["type"] == "Primary"))
    chosen = F.coalesce(primary, first_of(listed))["cvssData"]
    return F.struct(
        F.nullif(chosen["baseScore"], F.lit(0.0)).alias("score"), chosen["vectorString"].alias("vector"),
        map_severity(chosen["baseSeverity"], "nvd").alias("severity"))


def cwe_list(weaknesses):
    """Weakness ids of the primary entries (else all), first-seen order, comma-joined."""
    primary = orelse(F.filter(weaknesses, lambda w: w["type"] == "Primary"))
    values = F.flatten(F.transform(F.coalesce(primary, weaknesses), lambda w: F.coalesce(
        F.transform(w["description"], lambda d: d["value"]), F.array().cast("array<string>"))))
    kept = F.array_distinct(F.filter(values, lambda v: v.startswith("CWE-")))
    return filled(F.array_join(kept, ","))


def none(dtype):
    return F.lit(None).cast(dtype)


CARRIED = ("raw_json", "collected_at")


def with_record(raw, collected_at=None):
    """Records with themselves as JSON text and the time they were collected; normalisers carry both on."""
    when = F.lit(collected_at).cast("timestamp_ntz")
    return raw.select("*", F.to_json(F.struct("*")).alias("raw_json"), when.alias("collected_at"))


def carried(raw):
    return [F.col(c) for c in CARRIED if c in raw.columns]


def normalize_nvd(raw, service=None):
    """CVE items to vulnerability rows; without a service the vendor of the CPE names it."""
    cve = F.col("cve")
    name = F.lit(service) if service is not None else cpe_vendor(cve["configurations"])
    out = raw.select(
        F.lit("nvd").alias("source"), strip(F.upper(cve["id"])).alias("cve_id"), name.alias("service_name"),
        F.inline(F.array(pick_cvss(cve["metrics"]))),  # a generator, so that the choice is not repeated per column
        cwe_list(cve["weaknesses"]).alias("cwe_id"), norm_timestamp(cve["published"]).alias("published_at"),
        norm_timestamp(cve["lastModified"]).alias("modified_at"), *carried(raw))
    out = out.filter(F.coalesce("cve_id", F.lit("")) != "")
    return out.select(
        "source", "cve_id", F.col("cve_id").alias("advisory_id"), "service_name", F.lit("SaaS").alias("ecosystem"),
        "severity", F.col("score").alias("cvss_v3_score"), F.col("vector").alias("cvss_v3_vector"),
        none("double").alias("epss_score"), F.lit(0).alias("is_kev"), "cwe_id", "published_at", "modified_at",
        *carried(raw))


def normalize_kev(raw, service=None):
    """Exploited-vulnerability entries; the targeted form carries no cwe_id column."""
    vendor = F.coalesce(filled(strip(F.lower("vendorProject"))), F.lit(UNKNOWN))
    added = norm_timestamp("dateAdded")
    out = raw.filter(F.coalesce("cveID", F.lit("")) != "").select(
        F.lit("kev").alias("source"), F.upper("cveID").alias("cve_id"), F.upper("cveID").alias("advisory_id"),
        (F.lit(service) if service is not None else vendor).alias("service_name"), F.lit("SaaS").alias("ecosystem"),
        F.lit("CRITICAL").alias("severity"), none("double").alias("cvss_v3_score"),
        none("string").alias("cvss_v3_vector"), none("double").alias("epss_score"), F.lit(1).alias("is_kev"),
        none("string").alias("cwe_id"), added.alias("published_at"), added.alias("modified_at"), *carried(raw))
    return out if service is None else out.drop("cwe_id")


def normalize_ghsa(nodes, service=None, ecosystem=None):
    """Advisory nodes; the general form drops withdrawn ones and names rows by package."""
    adv, pkg = F.col("advisory"), F.col("package")
    rows = nodes if service is not None else not_withdrawn(nodes)
    cves = F.filter(adv["identifiers"], lambda i: i["type"] == "CVE")
    package = F.coalesce(filled(strip(pkg["name"])), F.lit(UNKNOWN))
    eco = F.lit(ecosystem) if ecosystem is not None else F.coalesce(pkg["ecosystem"], F.lit("Unknown"))
    ids = F.transform(F.filter(adv["cwes"], lambda c: F.coalesce(c["cweId"], F.lit("")) != ""), lambda c: c["cweId"])
    return rows.select(
        F.lit("ghsa").alias("source"),
        F.coalesce(F.upper(first_of(cves)["value"]), adv["ghsaId"]).alias("cve_id"),
        adv["ghsaId"].alias("advisory_id"),
        (F.lit(service) if service is not None else package).alias("service_name"), eco.alias("ecosystem"),
        map_severity(adv["severity"], "ghsa").alias("severity"),
        F.nullif(adv["cvss"]["score"], F.lit(0.0)).alias("cvss_v3_score"),
        adv["cvss"]["vectorString"].alias("cvss_v3_vector"), none("double").alias("epss_score"),
        F.lit(0).alias("is_kev"), filled(F.array_join(ids, ",")).alias("cwe_id"),
        norm_timestamp(adv["publishedAt"]).alias("published_at"),
        norm_timestamp(adv["updatedAt"]).alias("modified_at"), *carried(nodes))


def normalize_osv(raw, service, ecosystem):
    """Open-source records; severity and score come from the record's own fields, not the vector."""
    db = F.col("database_specific")
    cves = F.filter("aliases", lambda a: F.upper(a).startswith("CVE-"))
    vectors = F.filter("severity", lambda s: s["type"] == "CVSS_V3")
    score = F.coalesce(F.nullif(db["cvss_score"], F.lit(0.0)), F.nullif(db["base_score"], F.lit(0.0)))
    return raw.select(
        F.lit("osv").alias("source"), F.coalesce(F.upper(first_of(cves)), F.col("id")).alias("cve_id"),
        F.col("id").alias("advisory_id"), F.lit(service).alias("service_name"), F.lit(ecosystem).alias("ecosystem"),
        map_severity(db["severity"], "osv").alias("severity"), score.alias("cvss_v3_score"),
        first_of(vectors)["score"].alias("cvss_v3_vector"), none("double").alias("epss_score"),
        F.lit(0).alias("is_kev"), filled(F.array_join(db["cwe_ids"], ",")).alias("cwe_id"),
        norm_timestamp("published").alias("published_at"), norm_timestamp("modified").alias("modified_at"),
        *carried(raw))


def normalize_epss(raw):
    return raw.select(F.upper("cve").alias("cve_id"), F.col("epss").try_cast("double").alias("epss_score"), *carried(raw))


def minutes_between(start, end):
    """Whole minutes between two ISO texts at their full precision, truncated toward zero."""
    when = lambda text: F.rtrim(F.replace(text, F.lit("Z"), F.lit(" "))).try_cast("timestamp_ntz")
    minutes = seconds_between(when(start), when(end)) / 60
    return F.when(minutes >= 0, F.floor(minutes)).otherwise(F.ceil(minutes)).cast("int")


def incident(service, id_, severity, status, started, resolved, minutes, components):
    values = (service, id_, severity, status, started, resolved, minutes, components)
    return [v.alias(n) for n, v in zip(INCIDENT_COLUMNS, values)]


def normalize_statuspage(raw, service):
    start, end = norm_timestamp("created_at"), norm_timestamp("resolved_at")
    severity = F.when(F.col("impact").isin("critical", "major"), "major").when(
        F.col("impact") == "minor", "minor").otherwise("maintenance")
    names = F.array_join(F.transform("components", lambda c: F.coalesce(c["name"], F.lit(""))), ", ")
    return raw.select(*incident(
        F.lit(service), F.col("id"), severity, F.coalesce(filled("status"), F.lit("resolved")), start, end,
        minutes_between(F.col("created_at"), F.col("resolved_at")), F.coalesce(names, F.lit(""))), *carried(raw))


def normalize_aws(raw, service):
    """Health events with their times as given."""
    last = F.element_at(F.split(F.coalesce("eventArn", F.lit("")), "/"), -1)
    return raw.select(*incident(
        F.lit(service), last, F.when(F.col("eventTypeCategory") == "issue", "major").otherwise("minor"),
        F.coalesce("statusCode", F.lit("resolved")), F.coalesce("startTime", F.lit("")),
        F.coalesce("endTime", F.lit("")), none("int"), F.coalesce("service", F.lit(""))), *carried(raw))


def normalize_azure(entries):
    """Status entries; each is a resolved major incident."""
    ref = F.coalesce("id", F.lit(""))
    short = F.coalesce(filled(F.element_at(F.split(ref, "/"), -1)), ref)
    return entries.select(*incident(
        F.lit("azure"), short, F.lit("major"), F.lit("resolved"), norm_timestamp("published"),
        none("timestamp_ntz"), none("int"), F.coalesce("title", F.lit(""))), *carried(entries))


def normalize_salesforce(raw, service):
    created = F.coalesce(filled("createdAt"), filled("created_at"))
    ended = F.coalesce(filled("resolvedAt"), filled("resolved_at"))
    keys = F.array_join(F.transform(
        F.filter("affectedInstances", lambda a: F.coalesce(a["key"], F.lit("")) != ""), lambda a: a["key"]), ", ")
    affected = F.coalesce(filled(keys), F.array_join("instanceKeys", ", "), F.lit(""))
    start, end = norm_timestamp(created), norm_timestamp(ended)
    return raw.filter(F.coalesce("id", F.lit("")) != "").select(*incident(
        F.lit(service), F.col("id"),
        F.when(F.lower("messageType").isin("major", "core", "incident"), "major").otherwise("minor"),
        F.when(filled("resolvedAt").isNotNull(), "resolved").otherwise("investigating"), start, end,
        minutes_between(created, ended), affected), *carried(raw))


def normalize_gcp(raw):
    return raw.select(*incident(
        F.lit("gcp"), F.col("id"), F.when(F.col("severity") == "high", "major").otherwise("minor"),
        F.when(filled("end").isNotNull(), "resolved").otherwise("investigating"), norm_timestamp("begin"),
        norm_timestamp("end"), none("int"), F.coalesce(F.array_join("affected_products", ", "), F.lit(""))), *carried(raw))


def normalize_commits(raw):
    """Commit rows of repository histories: author login and commit time."""
    return raw.select("repo", F.col("author.login").alias("author"),
                      norm_timestamp(F.col("commit.author.date")).alias("committed_at"))


def normalize_issues(raw, label="security"):
    """Issue rows with their dates, state and whether they carry the label."""
    return raw.select(
        "repo", "number", "title", "body", "state", norm_timestamp("created_at").alias("created_at"),
        norm_timestamp("closed_at").alias("closed_at"),
        F.coalesce(F.exists("labels", lambda x: x["name"] == label), F.lit(False)).alias("is_security"))
