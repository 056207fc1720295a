"""Registered queries of scans, sinks, table maintenance, filters, joins, sets and coercions."""

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions import coerce as K
from riskweave.models.training import stratified_folds as folds
from riskweave.operators import aggregates as A
from riskweave.operators import filters as D
from riskweave.operators import merge as B
from riskweave.operators import ranking as R
from riskweave.operators import registry as G
from riskweave.operators import text as X
from riskweave.plans import oracle as O
from riskweave.plans.suite_policy import FRAMEWORKS
from riskweave.session import scratch_path, written
from riskweave.sources import outputs, tables as T

AS_OF = O.AS_OF


def iso(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def table_scan(spark, sf):
    return T.read_table(spark, "supplier", sf)


def pruned_scan(spark, sf):
    return T.scan(T.read_table(spark, "lineitem", sf), ["l_orderkey", "l_quantity"],
                  (F.col("l_quantity") >= 45) & (F.col("l_returnflag") == "R"))


def params_sql(spark, sf):
    return T.select_params(spark, """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM {orders}
 WHERE o_totalprice >= :low GROUP BY o_orderpriority""", {"low": 250000.0}, orders=T.read_table(spark, "orders", sf))


def features_roundtrip(spark, sf):
    """Feature rows written by run as JSON lines and read back."""
    f = A.vuln_agg(T.vulnerabilities(spark, sf), True).withColumn("run_id", F.lit("r1"))
    path = scratch_path(spark, "features")
    outputs.write_features(f, path)
    return outputs.read_features(spark, path, f.drop("run_id").schema, "r1")


def raw_landing(spark, sf):
    """Landed raw records by source and day, counted after reading them back."""
    v = T.vulnerabilities(spark, sf).select(
        "source", "service_name", "cve_id", "advisory_id", "cvss_v3_score",
        F.date_format(F.date_trunc("year", "published_at"), "yyyy-MM-dd").alias("ingest_date"))
    path = scratch_path(spark, "raw")
    outputs.land_raw(v, path)
    back = outputs.read_raw(spark, path, v.schema)
    return back.groupBy("source", "service_name", F.col("ingest_date").cast("string").alias("ingest_date")).agg(
        F.count("*").alias("n"), F.sum(F.col("cvss_v3_score").cast("decimal(18,6)")).cast("double").alias("total"))


def score_docs(spark, sf):
    """Score documents under file-safe names."""
    s = T.read_table(spark, "part", sf).select(
        F.lit("run/1").alias("run_id"), F.concat("p_name", F.lit("/"), F.col("p_partkey").cast("string")).alias("service_name"),
        F.col("p_size").alias("final_risk_score"))
    return outputs.score_docs(s)


def ensure_table(spark, sf):
    """A catalog table made once, widened once, then filled from supplier."""
    from uuid import uuid4

    from pyspark.sql.types import StructType

    name = f"services_{uuid4().hex}"
    outputs.ensure_table(spark, name, StructType.fromDDL("name string, vendor string"), scratch_path(spark, "services"))
    outputs.ensure_table(spark, name, StructType.fromDDL("name string, vendor string, service_tier int"))
    wide = StructType.fromDDL("name string, vendor string, service_tier int")
    rows = T.read_table(spark, "supplier", sf).select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("service_tier"))
    outputs.append_enforced(rows, name, wide)
    out = written(spark, spark.table(name), "ensured")
    spark.sql(f"DROP TABLE {name}")
    return out


# -- maintenance -----------------------------------------------------------------------------------

TARGET_ORDER = ("published_at", "severity", "cvss_v3_score", "epss_score", "is_kev", "service_name", "cve_id", "cwe_id",
                "ecosystem")
UPDATE_ORDER = TARGET_ORDER[:7]


def upsert_latest(spark, sf):
    """First versions of all advisories, updated by the latest ones and by new ones without weakness ids."""
    v = T.vulnerabilities(spark, sf)
    target = R.first_seen(v, ["source", "advisory_id"], list(TARGET_ORDER))
    fresh = T.read_table(spark, "orders", sf).select(
        F.lit("src0").alias("source"), F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string")).alias("cve_id"),
        F.concat(F.lit("ADV-"), F.col("o_orderkey").cast("string"), F.lit("-0")).alias("advisory_id"),
        F.lit("orders").alias("service_name"), F.lit("LOW").alias("severity"), F.lit(1.0).alias("cvss_v3_score"),
        F.lit(0.0).alias("epss_score"), F.lit(0).alias("is_kev"), F.col("o_orderdate").alias("published_at"))
    updates = v.drop("cwe_id", "ecosystem").unionByName(fresh).withColumn("scanner", F.lit("x"))
    out = B.upsert(target, updates, ["source", "advisory_id"], list(UPDATE_ORDER))
    return out.withColumns({"published_at": iso("published_at"), "is_kev": F.col("is_kev").cast("bigint")})


def insert_ignore(spark, sf):
    v = T.vulnerabilities(spark, sf)
    known = v.filter(F.col("is_kev") == 1).groupBy(F.col("service_name")).agg(F.count("*").alias("hits"))
    new = T.services(spark, sf).select("service_name", F.lit(0).cast("bigint").alias("hits"))
    return B.insert_ignore(known, new, ["service_name"])


def upsert_scores(spark, sf):
    s = T.read_table(spark, "supplier", sf)
    at = lambda t: F.lit(t).cast("timestamp_ntz").alias("scored_at")
    old = s.select(F.lit("run-1").alias("run_id"), F.col("s_name").alias("service_name"), at("2024-01-01 00:00:00"),
                   F.col("s_acctbal").alias("final_risk_score"))
    new = s.select(F.when(F.col("s_acctbal") > 5000, "run-1").otherwise("run-2").alias("run_id"),
                   F.col("s_name").alias("service_name"), at("2024-02-01 00:00:00"),
                   (F.col("s_acctbal") * 2).alias("final_risk_score"))
    return B.upsert_scores(old, new).withColumn("scored_at", iso("scored_at"))


def chunks(spark, sf, size):
    docs = T.documents(spark, sf).select("collection", "doc_id", "text")
    return X.chunk_docs(docs, "doc_id", size)


def doc_chunks(spark, sf):
    c = chunks(spark, sf, C.MAX_CHUNK_CHARS)
    return c.select("doc_id", F.col("chunk_index").cast("bigint").alias("chunk_index"),
                    F.col("total_chunks").cast("bigint").alias("total_chunks"), F.md5("text").alias("digest"))


def upsert_chunks(spark, sf):
    """Chunks of 2048 characters replaced by chunks of 4096: higher old positions stay."""
    out = B.upsert_chunks(chunks(spark, sf, 2048), chunks(spark, sf, 4096))
    return out.select("collection", "chunk_id", F.col("total_chunks").cast("bigint").alias("total_chunks"),
                      F.md5("text").alias("digest"))


def catalogue(spark, sf):
    return T.read_table(spark, "orders", sf).filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("cve-"), F.col("o_orderkey").cast("string")).alias("cve_id"))


def kev_backfill(spark, sf):
    out = B.flag_kev(T.vulnerabilities(spark, sf), catalogue(spark, sf))
    return out.select("service_name", "source", "advisory_id", "cve_id", F.col("is_kev").cast("bigint").alias("is_kev"))


def kev_members(spark, sf):
    kev = catalogue(spark, sf).select(F.upper("cve_id").alias("cve_id"))
    return B.in_kev(T.vulnerabilities(spark, sf), kev).select("service_name", "advisory_id", "cve_id")


# -- joins -----------------------------------------------------------------------------------------


def epss_enrich(spark, sf):
    epss = T.read_table(spark, "orders", sf).select(
        F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string")).alias("cve_id"),
        ((F.col("o_custkey") % 100) / 100.0).alias("epss_score"))
    out = G.enrich_epss(T.vulnerabilities(spark, sf), epss, ("src1",))
    return out.select("service_name", "source", "advisory_id", "cve_id", "epss_score")


def alias_theta_join(spark, sf):
    part = T.read_table(spark, "part", sf)
    kev = part.select("p_partkey", F.col("p_name").alias("vendorProject"), F.col("p_brand").alias("product"))
    words = part.select(F.col("p_type").alias("service"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("alias"))
    brands = part.select(F.col("p_brand").alias("service"), F.upper(F.col("p_brand")).alias("alias"))
    every = T.read_table(spark, "region", sf).select(F.lit("all").alias("service"), F.col("r_name").alias("alias"))
    aliases = words.unionByName(brands).unionByName(every).distinct()
    return G.match_aliases(kev, aliases).select("p_partkey", "service")


def registry(spark, sf):
    s = T.read_table(spark, "supplier", sf)
    listed = F.col("s_acctbal") > 3000
    return s.filter(listed).select(
        F.lower("s_name").alias("service"),
        F.when(F.col("s_acctbal") > 6000, F.array(F.lower("s_name"), F.concat(F.lit("kw-"), F.col("s_nationkey").cast("string"))))
        .alias("nvd_keywords"),
        F.when(F.col("s_acctbal") > 8000, F.array(F.lower("s_name"), F.lit("brand")))
        .otherwise(F.array(F.lit("brand"))).alias("kev_vendors"),
        F.when(F.col("s_acctbal") > 5000, F.create_map(
            F.lit("pip"), F.array(F.concat(F.lit("lib"), F.col("s_suppkey").cast("string"))),
            F.lit("Go"), F.array(F.lit("mod-a"), F.lit("mod-b")))).alias("packages"),
        F.array(F.concat(F.lit("org/"), F.col("s_suppkey").cast("string"))).alias("github_repos"))


def registry_flatten(spark, sf):
    services = T.read_table(spark, "supplier", sf).select(F.col("s_name").alias("service"))
    reg = registry(spark, sf)
    one = lambda facet: G.flatten_registry(services, reg, facet).select(
        "service", F.lit(facet).alias("facet"),
        (F.concat("ecosystem", F.lit(":"), "value") if facet == "packages" else F.col("value")).alias("value"))
    return B.union_feeds(*[one(f) for f in ("keywords", "vendors", "packages", "repos")])


def registry_default(spark, sf):
    """Ecosystem lookup by part type, PyPI where the type is not listed."""
    part = T.read_table(spark, "part", sf)
    listed = part.groupBy("p_type").agg(F.max("p_retailprice").alias("top")).filter(F.col("p_type") != "PROMO").select(
        "p_type", F.lower("p_type").alias("ecosystem"))
    return G.lookup_or_default(part.select("p_partkey", "p_type"), listed, "p_type", {"ecosystem": F.lit("PyPI")})


def package_join(spark, sf):
    part = T.read_table(spark, "part", sf).withColumn("slot", F.col("p_partkey") % T.supplier_count(spark, sf))
    sup = T.supplier_keys(spark, sf)
    packages = part.join(sup, F.col("slot") == F.col("s_suppkey")).select(
        F.col("s_name").alias("service"), F.lower("p_type").alias("ecosystem"),
        F.concat(F.lit("pkg-"), F.col("p_partkey").cast("string")).alias("value"))
    adv = T.read_table(spark, "lineitem", sf).join(
        T.read_table(spark, "part", sf).select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.lower("p_type").alias("ecosystem"), F.concat(F.lit("pkg-"), F.col("l_partkey").cast("string")).alias("package"),
        F.concat(F.lit("GHSA-"), F.col("l_orderkey").cast("string")).alias("advisory_id"))
    return G.attach_service(adv, packages).select("service_name", "advisory_id", "ecosystem", "package")


def backfill_windows(spark, sf):
    """Windows over the order dates with the number of orders in each."""
    orders = T.read_table(spark, "orders", sf).select(F.col("o_orderdate").alias("at"))
    span = orders.agg(F.min("at").alias("start"), F.max("at").alias("end"))
    counts = orders.withColumn("start", orders.agg(F.min("at")).scalar()).groupBy(
        G.window_index(F.col("at"), F.col("start")).cast("int").alias("window_index")).agg(F.count("*").alias("n"))
    out = G.windows(span).join(counts, "window_index", "left")
    return out.select(F.col("window_index").cast("bigint").alias("window_index"), iso("window_from").alias("window_from"),
                      iso("window_to").alias("window_to"), F.coalesce("n", F.lit(0)).alias("n"))


def candidate_urls(spark, sf):
    repos = T.read_table(spark, "part", sf).select(
        F.col("p_type").alias("service"), F.concat(F.lit("org/repo"), F.col("p_partkey").cast("string")).alias("value"),
        F.when(F.col("p_size") > 25, F.concat(F.lit("https://"), F.lower(F.col("p_type")), F.lit(".example.com")))
        .otherwise("").alias("homepage"))
    return G.candidate_urls(repos)


# -- filters and sets ------------------------------------------------------------------------------


def dated(spark, sf):
    v = T.vulnerabilities(spark, sf)
    return v.withColumn("published_at", F.when(F.col("epss_score") > 0.0, F.col("published_at")))


def lookback_filters(spark, sf):
    v = dated(spark, sf)
    cols = ("service_name", "cve_id", "advisory_id")
    keep = D.lookback(v, "published_at", AS_OF, null_policy="keep").select(*cols, F.lit("keep").alias("rule"))
    drop = D.lookback(v, "published_at", AS_OF, null_policy="drop").select(*cols, F.lit("drop").alias("rule"))
    year = D.last_year(T.incidents(spark, sf), AS_OF).select(
        "service_name", F.lit("").alias("cve_id"), F.col("incident_id").alias("advisory_id"), F.lit("year").alias("rule"))
    return B.union_feeds(keep, drop, year)


def modified_window(spark, sf):
    v = D.modified_between(T.vulnerabilities(spark, sf), "2022-03-01 00:00:00", "2022-03-03 00:00:00", "published_at")
    return v.select("service_name", "cve_id", "advisory_id", iso("published_at").alias("published_at"))


def mixed_ids(spark, sf):
    v = T.vulnerabilities(spark, sf)
    return v.withColumn("cve_id", F.when(F.col("ecosystem") == "npm", F.replace("cve_id", F.lit("CVE-"), F.lit("GHSA-")))
                        .otherwise(F.col("cve_id")))


def cve_prefix(spark, sf):
    return D.cve_only(mixed_ids(spark, sf)).select("service_name", "cve_id", "advisory_id")


def union_feeds(spark, sf):
    """Three feeds with different columns in one table, counted by source."""
    v = T.vulnerabilities(spark, sf).select("source", "cve_id", "cwe_id")
    kev = catalogue(spark, sf).select(F.lit("kev").alias("source"), "cve_id")
    epss = T.read_table(spark, "orders", sf).select(
        F.lit("epss").alias("source"), F.lit(None).cast("string").alias("cve_id"), F.col("o_totalprice").alias("epss"))
    u = B.union_feeds(v, kev, epss)
    return u.groupBy("source").agg(F.count("*").alias("n"), F.count("cve_id").alias("cves"), F.count("cwe_id").alias("cwes"),
                                   F.count("epss").alias("scores"))


def distinct_ids(spark, sf):
    return B.distinct_ids(mixed_ids(spark, sf))


def missing_keys(spark, sf):
    """CVE ids of line items that the catalogue lacks."""
    return B.missing_keys(T.vulnerabilities(spark, sf), catalogue(spark, sf).select(F.upper("cve_id").alias("cve_id")), ["cve_id"])


def unregistered(spark, sf):
    """Services and sources named by documents that are not among the suppliers."""
    sources = T.read_table(spark, "documents", sf).select(F.col("source").alias("service_name"))
    return G.unregistered(T.documents(spark, sf).select("service_name").unionByName(sources), T.services(spark, sf))


def framework_intersect(spark, sf):
    """Requested frameworks of a policy that its nation's documents mention."""
    docs = T.documents(spark, sf).join(
        T.read_table(spark, "supplier", sf).select(F.col("s_name").alias("service_name"), "s_nationkey"), "service_name")
    found = X.detected_frameworks(docs, ["SOC2", "PCI-DSS", "HIPAA", "ISO27001", "GDPR", "FedRAMP", "license", "les"],
                                  group=("s_nationkey",))
    pol = T.policies(spark, sf).join(
        T.read_table(spark, "customer", sf).select(F.col("c_name").alias("org_name"), "c_nationkey"), "org_name")
    both = pol.withColumn("requested", F.array_append("regulatory_frameworks", F.lit("license"))).join(
        found, F.col("c_nationkey") == F.col("s_nationkey"))
    out = X.requested_and_found(both)
    return out.select("org_name", F.array_join("matched", ",").alias("matched"),
                      X.coverage_of(F.col("requested"), F.col("detected")).alias("coverage"))


def prefer_nonnull(spark, sf):
    v = T.vulnerabilities(spark, sf).withColumn("raw_json", F.when(F.col("cvss_v3_score") > 6, F.col("cwe_id")))
    out = R.prefer_nonnull(v, ["cve_id"], "raw_json",
                           ["published_at", "advisory_id", "service_name", "cvss_v3_score", "epss_score", "cwe_id"])
    return out.select("cve_id", "raw_json", "advisory_id", "service_name", "cvss_v3_score", "epss_score")


RECENT = ("cve_id", "service_name", "cwe_id", "published_at")


def recent_n(spark, sf):
    """The newest 100 distinct rows overall, then one per CVE."""
    v = D.cve_only(mixed_ids(spark, sf)).select(*RECENT)
    top = R.recent_n(v, [F.col("published_at").desc(), "cve_id", "service_name", "cwe_id"], 100)
    return R.first_seen(top, ["cve_id"], ["cwe_id", "service_name", "published_at"]).withColumn(
        "published_at", iso("published_at"))


def recent_per_service(spark, sf):
    v = D.cve_only(mixed_ids(spark, sf)).select(*RECENT)
    top = R.recent_n_per(v, ["service_name"], [F.col("published_at").desc(), "cve_id", "cwe_id"], 100)
    return top.withColumn("published_at", iso("published_at"))


def first_seen(spark, sf):
    v = T.vulnerabilities(spark, sf)
    out = R.first_seen(v, ["source", "advisory_id"], list(TARGET_ORDER))
    return out.select("source", "advisory_id", "service_name", "cvss_v3_score", iso("published_at").alias("published_at"))


def topk_per_group(spark, sf):
    docs = T.documents(spark, sf).select("doc_id", "service_name", "collection", F.length("text").cast("bigint").alias("chars"))
    out = R.topk(docs, ["service_name"], [F.col("chars").desc(), "doc_id"], 10)
    return out.withColumn("rn", F.col("rn").cast("bigint"))


def stratified_folds(spark, sf):
    """Size of each fold per label."""
    lab = T.read_table(spark, "labels", sf)
    return folds(lab, "quality", ["doc_id"], 5).groupBy("quality", "fold").agg(F.count("*").alias("n"))


# -- coercions -------------------------------------------------------------------------------------


def severity_map(spark, sf):
    v = T.vulnerabilities(spark, sf)
    word = F.when(F.col("severity") == "MEDIUM", "MODERATE").when(F.col("severity") == "LOW", "low").otherwise(F.col("severity"))
    w = v.withColumn("word", word)
    return w.groupBy("word", K.map_severity("word", "nvd").alias("nvd"), K.map_severity("word", "ghsa").alias("ghsa")).agg(
        F.count("*").alias("n"))


def ecosystem_map(spark, sf):
    part = T.read_table(spark, "part", sf)
    word = F.when(F.col("p_type") == "ECONOMY", "pip").when(F.col("p_type") == "SMALL", "Rust").when(
        F.col("p_type") == "LARGE", "RUBYGEMS").otherwise(F.col("p_type"))
    return part.select("p_partkey", K.norm_ecosystem(word).alias("ecosystem"))


def timestamp_norm(spark, sf):
    ev = T.read_table(spark, "events", sf)
    text = F.when(F.col("event_type") == "view", "").when(F.col("event_type") == "signup", "soon").otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123Z")))
    return ev.select("event_id", iso(K.norm_timestamp(text)).alias("at"))


def numeric_coerce(spark, sf):
    ev = T.read_table(spark, "events", sf)
    text = F.when(F.col("event_type") == "view", "n/a").when(F.col("event_type") == "click", F.lit(None)).otherwise(
        F.col("event_id").cast("string"))
    k = F.get_json_object("props", "$.k")
    return ev.withColumns({"t": text, "k": k}).select(
        "event_id", K.safe_num("t", "bigint", 999).alias("days"), K.safe_num("k", "bigint", 0).alias("k"),
        K.safe_num("t", "double", 90.0).alias("close"))


def bool_coerce(spark, sf):
    ev = T.read_table(spark, "events", sf)
    text = F.when(F.col("event_type") == "view", " True").when(F.col("event_type") == "click", "FALSE ").when(
        F.col("event_type") == "error", "1.0").when(F.col("event_type") == "signup", "maybe").otherwise(
        (F.col("event_id") % 3).cast("string"))
    return ev.withColumn("t", text).select("event_id", K.bool01("t").alias("flag"))


def rename_cols(spark, sf):
    ev = T.read_table(spark, "events", sf).select(F.col("event_id").alias("id"), "event_type")
    return K.rename_id(ev)


QUERIES = {f.__name__: f for f in (
    table_scan, pruned_scan, params_sql, features_roundtrip, raw_landing, score_docs, ensure_table, upsert_latest,
    insert_ignore, upsert_scores, doc_chunks, upsert_chunks, kev_backfill, kev_members, epss_enrich, alias_theta_join,
    registry_flatten, registry_default, package_join, backfill_windows, candidate_urls, lookback_filters,
    modified_window, cve_prefix, union_feeds, distinct_ids, missing_keys, unregistered, framework_intersect,
    prefer_nonnull, recent_n, recent_per_service, first_seen, topk_per_group, stratified_folds, severity_map,
    ecosystem_map, timestamp_norm, numeric_coerce, bool_coerce, rename_cols)}


def chunk_sql(name, size):
    """Recursive cut of each document: after the last '. ' in the limit, else at the limit."""
    strip = lambda e: f"trim({e}, {SPACES_SQL})"
    cut = (f"(CASE WHEN strpos(reverse(left(rest, {size})), ' .') = 0 THEN {size} "
           f"ELSE {size} - strpos(reverse(left(rest, {size})), ' .') END)")
    return f"""{name} AS (SELECT doc_id, collection, -1 AS i, CAST(NULL AS VARCHAR) AS piece, text AS rest FROM docs UNION ALL
 SELECT doc_id, collection, i + 1, CASE WHEN length(rest) <= {size} THEN rest ELSE {strip(f'left(rest, {cut})')} END,
 CASE WHEN length(rest) <= {size} THEN '' ELSE {strip(f'substr(rest, {cut} + 1)')} END FROM {name} WHERE rest <> '' OR i < 0)"""


SPACES_SQL = " || ".join(f"chr({ord(c)})" for c in K.SPACES)


def oracles():
    iso_ = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    cat = """kv AS (SELECT DISTINCT 'CVE-' || CAST(o_orderkey AS VARCHAR) AS cve_id FROM orders WHERE o_orderpriority = '1-URGENT')"""
    mixed = """mx AS (SELECT * REPLACE (CASE WHEN ecosystem = 'npm' THEN replace(cve_id, 'CVE-', 'GHSA-') ELSE cve_id END AS cve_id) FROM vuln)"""
    order = lambda cols, d="": ", ".join(f"{c}{d}" for c in cols)
    cols9 = ("source", "cve_id", "advisory_id", "service_name", "severity", "cvss_v3_score", "epss_score", "is_kev", "published_at")
    fw = ["SOC2", "PCI-DSS", "HIPAA", "ISO27001", "GDPR", "FedRAMP", "license", "les"]
    det = ", ".join(
        f"CASE WHEN max(CASE WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{p}{chr(39)})' for p in ps)} THEN 1 ELSE 0 END) = 1 "
        f"THEN '{f}' END" for f, ps in zip(fw, X.framework_sets(fw)))
    nvd, ghsa = C.SEVERITY_WORDS["nvd"], C.SEVERITY_WORDS["ghsa"]
    return {
        "table_scan": "SELECT * FROM supplier",
        "pruned_scan": "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_returnflag = 'R'",
        "params_sql": """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders WHERE o_totalprice >= 250000
 GROUP BY o_orderpriority""",
        "features_roundtrip": O.with_(O.VULN) + f""" SELECT service_name, count(cve_id) AS total_vulns,
 count(*) FILTER (WHERE severity IN ('CRITICAL', 'HIGH')) AS open_vulns, {O.xsum('cvss_v3_score')} / count(*) AS mean_cvss,
 max(cvss_v3_score) AS max_cvss, CAST(sum(is_kev) AS BIGINT) AS exploit_count, {O.xsum('epss_score')} / count(*) AS mean_epss,
 'r1' AS run_id FROM vuln GROUP BY service_name""",
        "raw_landing": O.with_(O.VULN) + f""" SELECT source, service_name, strftime(date_trunc('year', published_at), '%Y-%m-%d') AS ingest_date,
 count(*) AS n, {O.xsum('cvss_v3_score')} AS total FROM vuln GROUP BY ALL""",
        "score_docs": """SELECT 'run/1' AS run_id, replace(replace(p_name || '/' || CAST(p_partkey AS VARCHAR), '/', '_'), ' ', '_') || '-' || left(md5(p_name || '/' || CAST(p_partkey AS VARCHAR)), 8) AS safe_name,
 '{"run_id":"run/1","service_name":"' || p_name || '/' || CAST(p_partkey AS VARCHAR) || '","final_risk_score":' || CAST(p_size AS VARCHAR) || '}'
 AS document FROM part""",
        "ensure_table": "SELECT s_name AS name, CAST(NULL AS VARCHAR) AS vendor, s_nationkey AS service_tier FROM supplier",
        "upsert_latest": O.with_(O.VULN) + f""", tg AS (SELECT * FROM vuln QUALIFY row_number() OVER (PARTITION BY source, advisory_id
 ORDER BY {order(TARGET_ORDER)}) = 1), up0 AS (SELECT {order(cols9)} FROM vuln UNION ALL SELECT 'src0', 'CVE-' || CAST(o_orderkey AS VARCHAR),
 'ADV-' || CAST(o_orderkey AS VARCHAR) || '-0', 'orders', 'LOW', 1.0, 0.0, 0, CAST(o_orderdate AS TIMESTAMP) FROM orders),
 up AS (SELECT * FROM up0 QUALIFY row_number() OVER (PARTITION BY source, advisory_id ORDER BY {order(UPDATE_ORDER, ' DESC')}) = 1)
 SELECT up.* REPLACE (CAST(up.is_kev AS BIGINT) AS is_kev, {iso_('up.published_at')} AS published_at), tg.cwe_id, tg.ecosystem
 FROM up LEFT JOIN tg USING (source, advisory_id)""",
        "insert_ignore": O.with_(O.VULN) + """ SELECT s_name AS service_name, count(vuln.cve_id) AS hits FROM supplier
 LEFT JOIN vuln ON service_name = s_name AND is_kev = 1 GROUP BY s_name""",
        "upsert_scores": """SELECT 'run-1' AS run_id, s_name AS service_name, CASE WHEN s_acctbal > 5000 THEN '2024-02-01 00:00:00'
 ELSE '2024-01-01 00:00:00' END AS scored_at, CASE WHEN s_acctbal > 5000 THEN s_acctbal * 2 ELSE s_acctbal END AS final_risk_score FROM supplier
 UNION ALL SELECT 'run-2', s_name, '2024-02-01 00:00:00', s_acctbal * 2 FROM supplier WHERE NOT s_acctbal > 5000""",
        "doc_chunks": "WITH RECURSIVE " + O.DOCS + ", " + chunk_sql("ch", 2048) + """ SELECT doc_id, CAST(i AS BIGINT) AS chunk_index,
 count(*) OVER (PARTITION BY doc_id) AS total_chunks, md5(piece) AS digest FROM ch WHERE i >= 0""",
        "upsert_chunks": "WITH RECURSIVE " + O.DOCS + ", " + chunk_sql("ch", 2048) + ", " + chunk_sql("cn", 4096) + """,
 a AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM ch WHERE i >= 0),
 b AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM cn WHERE i >= 0)
 SELECT coalesce(a.collection, b.collection) AS collection, CAST(doc_id AS VARCHAR) || '::' || CAST(i AS VARCHAR) AS chunk_id,
 coalesce(b.n, a.n) AS total_chunks, md5(coalesce(b.piece, a.piece)) AS digest FROM a FULL JOIN b USING (doc_id, i)""",
        "kev_backfill": O.with_(O.VULN, cat) + """ SELECT service_name, source, advisory_id, cve_id,
 CAST(CASE WHEN cve_id IN (SELECT cve_id FROM kv) THEN 1 ELSE is_kev END AS BIGINT) AS is_kev FROM vuln""",
        "kev_members": O.with_(O.VULN, cat) + """ SELECT service_name, advisory_id, cve_id FROM vuln
 WHERE cve_id IN (SELECT cve_id FROM kv)""",
        "epss_enrich": O.with_(O.VULN) + """ SELECT service_name, source, advisory_id, cve_id, CASE WHEN source = 'src1' THEN
 CAST(o_custkey % 100 AS DOUBLE) / 100.0::DOUBLE ELSE epss_score END AS epss_score
 FROM vuln LEFT JOIN orders ON cve_id = 'CVE-' || CAST(o_orderkey AS VARCHAR)""",
        "alias_theta_join": """WITH al AS (SELECT p_type AS service, split_part(p_name, ' ', 1) AS alias FROM part UNION
 SELECT p_brand, upper(p_brand) FROM part) SELECT DISTINCT p_partkey, service FROM part JOIN al ON contains(lower(p_name), lower(alias))
 OR contains(lower(p_brand), lower(alias)) UNION ALL SELECT p_partkey, 'all' FROM part""",
        "registry_flatten": """SELECT s_name AS service, 'keywords' AS facet, unnest(CASE WHEN s_acctbal > 6000 THEN
 [lower(s_name), 'kw-' || CAST(s_nationkey AS VARCHAR)] ELSE [s_name] END) AS value FROM supplier UNION ALL
 SELECT s_name, 'vendors', unnest(CASE WHEN s_acctbal > 3000 THEN [lower(s_name), 'brand'] ELSE [lower(s_name)] END) FROM supplier UNION ALL
 SELECT s_name, 'packages', unnest(CASE WHEN s_acctbal > 5000 THEN ['PyPI:lib' || CAST(s_suppkey AS VARCHAR), 'Go:mod-a', 'Go:mod-b']
 ELSE ['PyPI:' || s_name] END) FROM supplier UNION ALL
 SELECT s_name, 'repos', 'org/' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 3000""",
        "registry_default": """SELECT p_partkey, p_type, CASE WHEN p_type = 'PROMO' THEN 'PyPI' ELSE lower(p_type) END AS ecosystem FROM part""",
        "package_join": """WITH pk AS (SELECT s_name AS service_name, lower(p_type) AS ecosystem, 'pkg-' || CAST(p_partkey AS VARCHAR) AS package
 FROM part JOIN supplier ON p_partkey % (SELECT count(*) FROM supplier) = s_suppkey),
 ad AS (SELECT lower(p_type) AS ecosystem, 'pkg-' || CAST(l_partkey AS VARCHAR) AS package, 'GHSA-' || CAST(l_orderkey AS VARCHAR) AS advisory_id
 FROM lineitem JOIN part ON l_partkey = p_partkey)
 SELECT service_name, advisory_id, ecosystem, package FROM ad JOIN pk USING (ecosystem, package)
 QUALIFY row_number() OVER (PARTITION BY service_name, advisory_id ORDER BY ecosystem, package) = 1""",
        "backfill_windows": f"""WITH sp AS (SELECT min(CAST(o_orderdate AS TIMESTAMP)) AS a, max(CAST(o_orderdate AS TIMESTAMP)) AS b FROM orders),
 ix AS (SELECT unnest(range(0, 100000)) AS i), w AS (SELECT i, a + INTERVAL '119 days 1 second' * i AS f, b FROM sp, ix
 WHERE a + INTERVAL '119 days 1 second' * i < b), v AS (SELECT i, f, least(f + INTERVAL 119 DAYS, b) AS t FROM w)
 SELECT CAST(i AS BIGINT) AS window_index, {iso_('f')} AS window_from, {iso_('t')} AS window_to, count(o_orderkey) AS n
 FROM v LEFT JOIN orders ON CAST(o_orderdate AS TIMESTAMP) BETWEEN f AND t GROUP BY ALL""",
        "candidate_urls": """SELECT p_type AS service, kind, CASE kind WHEN 'homepage' THEN 'https://' || lower(p_type) || '.example.com'
 ELSE 'https://github.com/org/repo' || CAST(p_partkey AS VARCHAR) || suffix END AS url FROM part, (VALUES ('homepage', ''), ('repo', ''),
 ('policy', '/security/policy'), ('advisories', '/security/advisories')) k(kind, suffix) WHERE kind <> 'homepage' OR p_size > 25""",
        "lookback_filters": O.with_(O.VULN, O.INC) + f""", d AS (SELECT service_name, cve_id, advisory_id,
 CASE WHEN epss_score > 0 THEN published_at END AS p FROM vuln)
 SELECT service_name, cve_id, advisory_id, 'keep' AS rule FROM d WHERE p IS NULL OR p >= TIMESTAMP '{AS_OF}' - INTERVAL 180 DAYS UNION ALL
 SELECT service_name, cve_id, advisory_id, 'drop' FROM d WHERE p >= TIMESTAMP '{AS_OF}' - INTERVAL 180 DAYS UNION ALL
 SELECT service_name, '', incident_id, 'year' FROM inc WHERE started_at >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS""",
        "modified_window": O.with_(O.VULN) + f""" SELECT service_name, cve_id, advisory_id, {iso_('published_at')} AS published_at FROM vuln
 WHERE published_at BETWEEN TIMESTAMP '2022-03-01 00:00:00' AND TIMESTAMP '2022-03-03 00:00:00'""",
        "cve_prefix": O.with_(O.VULN, mixed) + " SELECT service_name, cve_id, advisory_id FROM mx WHERE cve_id LIKE 'CVE-%'",
        "union_feeds": O.with_(O.VULN) + """ SELECT source, count(*) AS n, count(*) AS cves, count(cwe_id) AS cwes, CAST(0 AS BIGINT) AS scores
 FROM vuln GROUP BY source UNION ALL SELECT 'kev', count(*), count(*), 0, 0 FROM orders WHERE o_orderpriority = '1-URGENT'
 UNION ALL SELECT 'epss', count(*), 0, 0, count(*) FROM orders""",
        "distinct_ids": O.with_(O.VULN, mixed) + " SELECT DISTINCT cve_id FROM mx",
        "missing_keys": O.with_(O.VULN, cat) + " SELECT cve_id FROM vuln EXCEPT SELECT cve_id FROM kv",
        "unregistered": O.with_(O.DOCS) + " SELECT service_name FROM docs UNION SELECT source FROM documents EXCEPT SELECT s_name FROM supplier",
        "framework_intersect": O.with_(O.DOCS, O.policy_view()) + f""", fd AS (SELECT s_nationkey, list_filter([{det}], lambda x: x IS NOT NULL) AS det
 FROM docs JOIN supplier ON service_name = s_name GROUP BY s_nationkey), rq AS (SELECT org_name, list_append(fws, 'license') AS req, det FROM pol
 JOIN fd ON c_nationkey = s_nationkey) SELECT org_name, array_to_string(list_filter(list_distinct_in_order, lambda f: list_contains(det, f)), ',') AS matched,
 CAST(len(list_filter(req, lambda f: list_contains(det, f))) AS DOUBLE) / len(req) AS coverage
 FROM (SELECT *, list_filter(req, lambda f, i: list_position(req, f) = i) AS list_distinct_in_order FROM rq)""",
        "prefer_nonnull": O.with_(O.VULN) + """ SELECT cve_id, CASE WHEN cvss_v3_score > 6 THEN cwe_id END AS raw_json, advisory_id, service_name,
 cvss_v3_score, epss_score FROM vuln QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY CASE WHEN cvss_v3_score > 6 THEN 0 ELSE 1 END,
 published_at, advisory_id, service_name, cvss_v3_score, epss_score, cwe_id) = 1""",
        "recent_n": O.with_(O.VULN, mixed) + f""", r AS (SELECT DISTINCT {order(RECENT)} FROM mx WHERE cve_id LIKE 'CVE-%'
 ORDER BY published_at DESC, cve_id, service_name, cwe_id LIMIT 100) SELECT cve_id, service_name, cwe_id, {iso_('published_at')} AS published_at
 FROM r QUALIFY row_number() OVER (PARTITION BY cve_id ORDER BY cwe_id, service_name, r.published_at) = 1""",
        "recent_per_service": O.with_(O.VULN, mixed) + f""", r AS (SELECT DISTINCT {order(RECENT)} FROM mx WHERE cve_id LIKE 'CVE-%')
 SELECT cve_id, service_name, cwe_id, {iso_('published_at')} AS published_at FROM r QUALIFY row_number() OVER
 (PARTITION BY service_name ORDER BY r.published_at DESC, cve_id, cwe_id) <= 100""",
        "first_seen": O.with_(O.VULN) + f""" SELECT source, advisory_id, service_name, cvss_v3_score, {iso_('published_at')} AS published_at
 FROM vuln QUALIFY row_number() OVER (PARTITION BY source, advisory_id ORDER BY {order(f'vuln.{c}' for c in TARGET_ORDER)}) = 1""",
        "topk_per_group": O.with_(O.DOCS) + """ SELECT doc_id, service_name, collection, CAST(length(text) AS BIGINT) AS chars,
 row_number() OVER (PARTITION BY service_name ORDER BY length(text) DESC, doc_id) AS rn FROM docs QUALIFY rn <= 10""",
        "stratified_folds": """WITH n AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
 SELECT quality, CAST(f AS INT) AS fold, CAST((n + 4 - f) // 5 AS BIGINT) AS n FROM n, (SELECT unnest(range(0, 5)) AS f)""",
        "severity_map": O.with_(O.VULN) + f""", w AS (SELECT CASE severity WHEN 'MEDIUM' THEN 'MODERATE' WHEN 'LOW' THEN 'low' ELSE severity END AS word
 FROM vuln) SELECT word, {O.case_map('upper(word)', nvd, "'NONE'")} AS nvd, {O.case_map('word', ghsa, "'NONE'")} AS ghsa,
 count(*) AS n FROM w GROUP BY ALL""",
        "ecosystem_map": """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'PyPI' WHEN 'SMALL' THEN 'Cargo' WHEN 'LARGE' THEN 'RubyGems'
 ELSE p_type END AS ecosystem FROM part""",
        "timestamp_norm": f"""SELECT event_id, CASE WHEN event_type NOT IN ('view', 'signup') THEN {iso_('CAST(ts AS TIMESTAMP)')} END AS at FROM events""",
        "numeric_coerce": """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 999 ELSE event_id END AS days,
 CAST(json_extract(props, '$.k') AS BIGINT) AS k, CASE WHEN event_type IN ('view', 'click') THEN 90.0 ELSE event_id END::DOUBLE AS close FROM events""",
        "bool_coerce": """SELECT event_id, CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 0.0 WHEN 'error' THEN 1.0 WHEN 'signup' THEN 0.0
 ELSE event_id % 3 END::DOUBLE AS flag FROM events""",
        "rename_cols": "SELECT event_id AS service_id, event_type FROM events",
    }
