"""Registered queries of feed payloads: nested items built from the tables, then normalised."""

from pyspark.sql import functions as F

from riskweave.operators import filters as D
from riskweave.operators import aggregates as A
from riskweave.operators import normalize as N
from riskweave.operators import text as X
from riskweave.plans import flow
from riskweave.plans import oracle as O
from riskweave.plans.suite_text import strip
from riskweave.session import scratch_path, written
from riskweave.sources import feeds, outputs as S, policies as P, records as R, tables as T

def text(c):
    return F.col(c).cast("string")


def stamp(c):
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".000"))


def st(**fields):
    return F.struct(*[v.alias(k) for k, v in fields.items()])


def nvd_items(spark, sf):
    """CVE items from line items: two metrics, two weakness entries, three product matches each."""
    li = T.read_table(spark, "lineitem", sf)
    qty = F.col("l_quantity")
    word = F.when(qty >= 45, "Critical").when(qty >= 35, "HIGH").when(qty >= 20, "odd").otherwise("LOW")
    metric = lambda kind, score, sev: st(type=F.lit(kind), cvssData=st(
        baseScore=score, vectorString=F.concat(F.lit("V-"), F.lit(kind)), baseSeverity=sev))
    both = F.array(metric("Secondary", F.lit(9.9), F.lit("CRITICAL")), metric("Primary", F.when(qty > 5, qty / 5.0).otherwise(0.0), word))
    weak = F.array(
        st(type=F.lit("Secondary"), description=F.array(st(lang=F.lit("en"), value=F.lit("CWE-1")))),
        st(type=F.when(F.col("l_linenumber") < 5, "Primary").otherwise("Secondary"), description=F.array(
            st(lang=F.lit("en"), value=F.concat(F.lit("CWE-"), (F.col("l_partkey") % 40).cast("string"))),
            st(lang=F.lit("en"), value=F.lit("NVD-CWE-noinfo")),
            st(lang=F.lit("en"), value=F.concat(F.lit("CWE-"), (F.col("l_partkey") % 3).cast("string"))))))
    match = lambda flag, vendor: st(vulnerable=F.lit(flag), criteria=F.concat(F.lit("cpe:2.3:a:"), vendor, F.lit(":prod:1:*")))
    vendor = F.when(F.col("l_returnflag") == "A", "-").otherwise(F.concat(F.lit("v"), (F.col("l_suppkey") % 10).cast("string")))
    conf = F.array(st(nodes=F.array(st(cpeMatch=F.array(match(False, F.lit("safe")), match(True, F.lit("*")))))),
                   st(nodes=F.array(st(cpeMatch=F.array(match(True, vendor))))))
    at = F.col("l_shipdate") + F.expr("INTERVAL 8120 DAYS")
    return li.select(st(
        id=F.when(F.col("l_linenumber") == 7, F.lit(" ")).otherwise(F.concat(F.lit(" cve-"), text("l_orderkey"), F.lit("-"), text("l_linenumber"))),
        published=stamp(at), lastModified=F.when(F.col("l_linestatus") == "F", stamp(at)),
        descriptions=F.array(st(lang=F.lit("en"), value=F.lit("text"))),
        metrics=st(cvssMetricV31=F.when(F.col("l_linenumber") != 1, both), cvssMetricV30=F.when(F.col("l_linenumber") != 2, F.slice(both, 1, 1))),
        weaknesses=weak, configurations=F.when(F.col("l_linenumber") != 3, conf)).alias("cve"))


def flat_vulns(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("published_at", "modified_at")}).withColumn(
        "is_kev", F.col("is_kev").cast("bigint"))


def flat_incidents(df):
    """Times as text whatever their type, minutes as a long."""
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started_at", "resolved_at")
             if dict(df.dtypes)[c] != "string"}
    return df.withColumns({**times, "duration_minutes": F.col("duration_minutes").cast("bigint")})


def nvd_normalize(spark, sf):
    return flat_vulns(N.normalize_nvd(nvd_items(spark, sf)))


def feed_json(spark, sf):
    """The same items through landed files: one envelope per line, read back and normalised."""
    path = scratch_path(spark, "nvd")
    S.land_payloads(nvd_items(spark, sf).select(F.array(st(cve=F.col("cve"))).alias("vulnerabilities")), path, "json")
    return flat_vulns(N.normalize_nvd(feeds.read_feed(spark, path, "nvd", multi_line=False), "acme"))


def nested_filter(spark, sf):
    """Number of usable product matches of each item."""
    items = nvd_items(spark, sf)
    return items.groupBy(F.coalesce(F.size(D.usable_matches(F.col("cve.configurations"))), F.lit(-1)).cast("bigint")
                         .alias("matches")).agg(F.count("*").alias("n"))


def kev_entries(spark, sf):
    o = T.read_table(spark, "orders", sf)
    return o.select(
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("cve-"), text("o_orderkey"))).alias("cveID"),
        F.when(F.col("o_orderpriority") == "5-LOW", "  ").otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"))).alias("vendorProject"),
        F.lit("Prod").alias("product"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dateAdded"))


def kev_normalize(spark, sf):
    return flat_vulns(N.normalize_kev(kev_entries(spark, sf)))


def ghsa_nodes(spark, sf):
    o = T.read_table(spark, "orders", sf)
    p = F.col("o_orderpriority")
    ident = lambda kind, v: st(type=F.lit(kind), value=v)
    key = text("o_orderkey")
    return o.select(
        st(ghsaId=F.concat(F.lit("GHSA-"), key),
           severity=F.when(p == "1-URGENT", "CRITICAL").when(p == "2-HIGH", "HIGH").when(p == "3-MEDIUM", "MODERATE").when(
               p == "5-LOW", "LOW").otherwise("low"),
           summary=F.lit("s"), description=F.lit("d"), publishedAt=F.concat(stamp("o_orderdate"), F.lit("Z")),
           updatedAt=F.lit(None).cast("string"), withdrawnAt=F.when(F.col("o_orderstatus") == "P", F.lit("2024-01-01T00:00:00Z")),
           cvss=F.when(p != "5-LOW", st(score=(F.col("o_custkey") % 11).cast("double"), vectorString=F.lit("V"))),
           cwes=F.array(st(cweId=F.lit("CWE-1")), st(cweId=F.lit("")), st(cweId=F.concat(F.lit("CWE-"), (F.col("o_custkey") % 50).cast("string")))),
           identifiers=F.when(p == "2-HIGH", F.array(ident("GHSA", F.lit("g")))).otherwise(
               F.array(ident("GHSA", F.lit("g")), ident("CVE", F.concat(F.lit("cve-"), key))))).alias("advisory"),
        st(ecosystem=F.lit("NPM"), name=F.when(p == "1-URGENT", " ").otherwise(F.concat(F.lit("pkg"), (F.col("o_custkey") % 20).cast("string"), F.lit(" "))))
        .alias("package"))


def ghsa_normalize(spark, sf):
    return flat_vulns(N.normalize_ghsa(ghsa_nodes(spark, sf)))


def osv_records(spark, sf):
    part = T.read_table(spark, "part", sf)
    kind = F.col("p_type")
    return part.select(
        F.concat(F.lit("OSV-"), text("p_partkey")).alias("id"),
        F.when(kind == "SMALL", F.array(F.lit("GHSA-1"))).otherwise(
            F.array(F.lit("GHSA-1"), F.concat(F.lit("cve-"), text("p_partkey")), F.lit("CVE-0"))).alias("aliases"),
        F.when(kind == "LARGE", F.array(st(type=F.lit("CVSS_V2"), score=F.lit("v2")))).otherwise(
            F.array(st(type=F.lit("CVSS_V2"), score=F.lit("v2")), st(type=F.lit("CVSS_V3"), score=F.lit("v3")))).alias("severity"),
        st(cvss_score=F.when(kind == "PROMO", F.lit(0.0)).otherwise(F.col("p_size") / 5.0), base_score=F.lit(3.5),
           severity=F.when(kind == "ECONOMY", "critical").when(kind == "SMALL", "MODERATE").when(kind != "PROMO", "LOW"),
           cwe_ids=F.when(kind != "ECONOMY", F.array(F.lit("CWE-1"), F.lit("CWE-2")))).alias("database_specific"),
        F.lit("2024-01-05T10:20:30Z").alias("published"), F.lit("").alias("modified"))


def osv_normalize(spark, sf):
    return flat_vulns(N.normalize_osv(osv_records(spark, sf), "acme", "PyPI"))


def ingest_all(spark, sf):
    """Three feeds into a table that holds an older state of one, flagged after the merge; descriptions come along."""
    record = lambda df: N.with_record(df, "2024-02-01 00:00:00")
    old = N.normalize_osv(record(osv_records(spark, sf)), "before", "PyPI")
    feeds_ = [N.normalize_kev(record(kev_entries(spark, sf))), N.normalize_ghsa(record(ghsa_nodes(spark, sf))),
              N.normalize_osv(record(osv_records(spark, sf)), "acme", "PyPI")]
    urgent = T.read_table(spark, "orders", sf).filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("CVE-"), text("o_orderkey")).alias("cve_id"))
    out = flow.ingest(old, feeds_, urgent)
    return out.select("source", "advisory_id", "cve_id", "service_name", F.col("is_kev").cast("bigint").alias("is_kev"),
                      (F.length("raw_json") > 2).alias("recorded"))


def epss_rows(spark, sf):
    return T.read_table(spark, "orders", sf).select(
        F.concat(F.lit("cve-"), text("o_orderkey")).alias("cve"),
        F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(((F.col("o_custkey") % 100) / 100.0).cast("string")).alias("epss"))


def epss_normalize(spark, sf):
    return N.normalize_epss(epss_rows(spark, sf))


def statuspage_incidents(spark, sf):
    ev = T.read_table(spark, "events", sf)
    kind = F.col("event_type")
    end = F.col("ts") + F.make_dt_interval(mins=F.floor("value").cast("int"))
    return ev.select(
        text("event_id").alias("id"), F.lit("n").alias("name"), F.when(kind == "view", "").otherwise("closed").alias("status"),
        F.when(kind == "error", "critical").when(kind == "click", "minor").when(kind == "signup", "major").otherwise("none").alias("impact"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        F.when(kind != "purchase", F.concat(F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("resolved_at"),
        F.array(st(name=kind), st(name=text("user_id"))).alias("components"),
        F.array(st(status=kind, body=F.lit("b"))).alias("incident_updates"))


def statuspage_normalize(spark, sf):
    return flat_incidents(N.normalize_statuspage(statuspage_incidents(spark, sf), "acme"))


def aws_events(spark, sf):
    ev = T.read_table(spark, "events", sf)
    kind = F.col("event_type")
    return ev.select(
        F.concat(F.lit("arn:aws:health::event/EC2/"), text("event_id")).alias("eventArn"),
        F.when(kind == "error", "issue").otherwise("note").alias("eventTypeCategory"), F.when(kind != "view", "open").alias("statusCode"),
        text("user_id").alias("startTime"), F.lit(None).cast("string").alias("endTime"), kind.alias("service"))


def aws_normalize(spark, sf):
    return flat_incidents(N.normalize_aws(aws_events(spark, sf), "aws"))


def feed_atom(spark, sf):
    """Status entries written as an XML feed, read back and normalised."""
    ev = T.read_table(spark, "events", sf)
    path = scratch_path(spark, "atom")
    rows = ev.select(
        F.concat(F.lit("https://status/"), text("event_id"), F.when(F.col("event_type") == "view", F.lit("/")).otherwise("")).alias("id"),
        F.concat(F.lit("t & "), F.col("event_type")).alias("title"), F.lit("s").alias("summary"),
        F.when(F.col("event_type") != "click", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).alias("published"))
    rows.write.format("xml").option("rootTag", "feed").option("rowTag", "entry").save(path)
    return flat_incidents(N.normalize_azure(feeds.read_atom(spark, path)))


def feed_salesforce(spark, sf):
    """Incident documents of three shapes, one per line, read back and normalised."""
    o = T.read_table(spark, "orders", sf)
    p = F.col("o_orderpriority")
    at = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    item = st(
        id=F.when(p == "4-NOT SPECIFIED", "").otherwise(text("o_orderkey")), message=F.lit("m"),
        messageType=F.when(p == "1-URGENT", "Major").when(p == "2-HIGH", "Core").otherwise("minor"),
        createdAt=F.when(F.col("o_orderstatus") == "O", at("o_orderdate")), created_at=at("o_orderdate"),
        resolvedAt=F.when(F.col("o_orderstatus") == "F", at(F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES"))),
        resolved_at=F.when(p == "5-LOW", at(F.col("o_orderdate") + F.expr("INTERVAL 30 MINUTES"))),
        instanceKeys=F.array(F.lit("k1"), F.lit("k2")),
        affectedInstances=F.when(p == "2-HIGH", F.array(st(key=F.lit("a1")), st(key=F.lit("")))))
    one = F.array(item)
    doc = F.when(F.col("o_orderstatus") == "O", F.to_json(one)).when(F.col("o_orderstatus") == "F", F.to_json(st(data=one))).otherwise(
        F.to_json(st(incidents=one)))
    path = scratch_path(spark, "salesforce")
    S.land_payloads(o.select(doc.alias("value")), path)
    return flat_incidents(N.normalize_salesforce(feeds.read_salesforce(spark, path, whole=False), "salesforce"))


def gcp_incidents(spark, sf):
    ev = T.read_table(spark, "events", sf)
    kind = F.col("event_type")
    return ev.select(
        text("event_id").alias("id"), F.when(kind == "error", "high").otherwise("low").alias("severity"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")).alias("begin"),
        F.when(kind == "view", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))).alias("end"),
        F.array(kind, text("user_id")).alias("affected_products"))


def gcp_normalize(spark, sf):
    return flat_incidents(N.normalize_gcp(gcp_incidents(spark, sf)))


def github_issue_items(spark, sf):
    o = T.read_table(spark, "orders", sf)
    return o.select(F.col("o_orderkey").alias("number"), F.lit("t").alias("title"), F.lit("open").alias("state"),
                    F.array(st(name=F.col("o_orderpriority"))).alias("labels"))


# items of each feed and the text that ends in their number
LANDED = {
    "nvd": (nvd_items, "cve.id"), "kev": (kev_entries, "cveID"), "ghsa": (ghsa_nodes, "advisory.ghsaId"),
    "osv": (osv_records, "id"), "epss": (epss_rows, "cve"), "statuspage": (statuspage_incidents, "id"),
    "aws": (aws_events, "eventArn"), "gcp": (gcp_incidents, "id"), "github_issues": (github_issue_items, "number")}


def landed_records(spark, sf, feed):
    """Documents of a feed, one per line, some of them broken, read back as records and written once.

    By the item's number modulo 13: 3 is cut off, 5 has a second item that is no object, 7 has its list under another
    field (where the feed has no envelope: is the bare object).
    """
    make, ident = LANDED[feed]
    field = feeds.ENVELOPES[feed][0]
    wrap = lambda body: F.concat(F.lit(f'{{"{field}":[' if field else "["), body, F.lit("]}" if field else "]"))
    rest = F.regexp_extract(text(ident), r"(\d+)$", 1).try_cast("bigint") % 13
    lines = make(spark, sf).select(rest.alias("rest"), F.to_json(F.struct("*")).alias("item")).select(
        F.when(F.col("rest") == 3, F.regexp_replace(wrap(F.col("item")), "(?s).{3}$", ""))
        .when(F.col("rest") == 5, wrap(F.concat("item", F.lit(',"no object"'))))
        .when(F.col("rest") == 7, F.concat(F.lit('{"other":['), "item", F.lit("]}")) if field else F.col("item"))
        .otherwise(wrap(F.col("item"))).alias("value"))
    path = scratch_path(spark, feed)
    S.land_payloads(lines, path)
    return written(spark, R.read_records(spark, path, feed, multi_line=False), f"{feed}-records", compression="zstd")


def feed_records(spark, sf):
    """Good and broken records of nine feeds."""
    return R.record_counts(*[landed_records(spark, sf, feed) for feed in LANDED])


def feed_rejects(spark, sf):
    """Items that are no objects, with where they stood, and broken documents, of three feeds."""
    bad = R.rejected(*[landed_records(spark, sf, feed) for feed in ("kev", "aws", "osv")])
    return bad.groupBy("feed", "error", F.col("position").cast("bigint").alias("position"),
                       F.when(F.col("error") == "item", F.col("raw")).alias("text")).agg(F.count("*").alias("n"))


def ingest_files(spark, sf):
    """Three feeds from landed files, some records broken, into a table with an older state of one."""
    old = N.normalize_osv(N.with_record(osv_records(spark, sf)), "before", "PyPI")
    table, _ = flow.ingest_records(old, {
        "kev": (landed_records(spark, sf, "kev"), N.normalize_kev),
        "ghsa": (landed_records(spark, sf, "ghsa"), N.normalize_ghsa),
        "osv": (landed_records(spark, sf, "osv"), lambda raw: N.normalize_osv(raw, "acme", "PyPI"))},
        collected_at="2024-02-01 00:00:00")
    return table.select("source", "advisory_id", "cve_id", "service_name", F.col("is_kev").cast("bigint").alias("is_kev"),
                        F.coalesce(F.col("collected_at").isNotNull(), F.lit(False)).alias("collected"))


def policy_files(spark, sf):
    """Policies written as JSON files, read back and validated."""
    path = scratch_path(spark, "policies")
    T.policies(spark, sf).write.json(path)
    good, bad = P.check_policies(spark.read.schema(P.POLICY).json(path))
    return good.select("org_name", F.lit(1).alias("valid")).unionByName(bad.select("org_name", F.lit(0).alias("valid"))).withColumn(
        "valid", F.col("valid").cast("bigint"))


def incident_texts(spark, sf):
    """Incident texts of four feeds, the feed beside the text."""
    talk = T.read_table(spark, "conversations", sf)
    key = F.concat(text("conv_id"), F.lit("-"), text("turn"))
    azure = talk.select(key.alias("id"), F.col("role").alias("title"), F.col("text").alias("summary"))
    sales = talk.select(key.alias("id"), F.col("text").alias("message"))
    aws = talk.select(F.concat(F.lit("arn/"), key).alias("eventArn"), st(
        latestDescription=F.when(F.col("role") == "user", F.col("text"))).alias("eventDescription"))
    gcp = talk.select(key.alias("id"), F.lit("desc").alias("external_desc"), F.when(
        F.col("role") == "user", F.array(st(text=F.col("text")), st(text=F.lit("end")))).alias("updates"))
    parts = [X.incident_text(df, s).select("id", F.md5("text").alias("digest"), F.lit(s).alias("feed"))
             for df, s in ((azure, "azure"), (sales, "salesforce"), (aws, "aws"), (gcp, "gcp"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def advisory_texts(spark, sf):
    return X.advisory_text(ghsa_nodes(spark, sf))


def github_activity(spark, sf):
    """Repository statistics from commit and issue payloads."""
    li, o = T.read_table(spark, "lineitem", sf), T.read_table(spark, "orders", sf)
    z = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    repo = lambda c: F.concat(F.lit("org/repo"), text(c)).alias("repo")
    commits = N.normalize_commits(li.select(
        repo("l_suppkey"), F.when(F.col("l_linestatus") == "F", st(login=F.concat(F.lit("u"), text("l_linenumber")))).alias("author"),
        st(author=st(date=z("l_shipdate"))).alias("commit")))
    issues = N.normalize_issues(o.select(
        repo("o_custkey"), F.col("o_orderkey").alias("number"), F.lit("t").alias("title"), F.lit("b").alias("body"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"), z("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") != "O", z(F.col("o_orderdate") + F.expr("INTERVAL 36 HOURS"))).alias("closed_at"),
        F.array(st(name=F.lit("bug")), st(name=F.when(F.col("o_orderpriority") == "1-URGENT", "security").otherwise("ui"))).alias("labels")))
    releases = o.select(repo("o_custkey"), F.col("o_orderdate").alias("published_at"))
    out = A.repo_stats(commits, issues, releases, "2001-06-01 00:00:00", 720)
    return out.withColumn("days_since_last_release", F.col("days_since_last_release").cast("bigint"))


QUERIES = {f.__name__: f for f in (
    nvd_normalize, feed_json, nested_filter, kev_normalize, ghsa_normalize, osv_normalize, epss_normalize, statuspage_normalize,
    aws_normalize, feed_atom, feed_salesforce, gcp_normalize, policy_files,
    incident_texts, advisory_texts, github_activity, ingest_all, feed_records, feed_rejects, ingest_files)}


def oracles():
    iso = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S')"
    at = "CAST(l_shipdate AS TIMESTAMP) + INTERVAL 8120 DAYS"
    sev = """CASE WHEN l_linenumber = 1 THEN 'CRITICAL' WHEN l_quantity >= 45 THEN 'CRITICAL' WHEN l_quantity >= 35 THEN 'HIGH'
 WHEN l_quantity >= 20 THEN 'NONE' ELSE 'LOW' END"""
    a, b = "'CWE-' || CAST(l_partkey % 40 AS VARCHAR)", "'CWE-' || CAST(l_partkey % 3 AS VARCHAR)"
    cwe = f"""CASE WHEN l_linenumber < 5 THEN {a} || CASE WHEN {a} = {b} THEN '' ELSE ',' || {b} END
 ELSE array_to_string(list_filter(['CWE-1', {a}, {b}], lambda x, i: list_position(['CWE-1', {a}, {b}], x) = i), ',') END"""

    def nvd(service):
        return f"""SELECT 'nvd' AS source, id AS cve_id, id AS advisory_id, {service} AS service_name, 'SaaS' AS ecosystem, {sev} AS severity,
 CASE WHEN l_linenumber = 1 THEN 9.9 WHEN l_quantity > 5 THEN l_quantity / 5.0 END::DOUBLE AS cvss_v3_score,
 CASE WHEN l_linenumber = 1 THEN 'V-Secondary' ELSE 'V-Primary' END AS cvss_v3_vector, CAST(NULL AS DOUBLE) AS epss_score,
 CAST(0 AS BIGINT) AS is_kev, {cwe} AS cwe_id, {iso(at)} AS published_at, CASE WHEN l_linestatus = 'F' THEN {iso(at)} END AS modified_at
 FROM (SELECT *, 'CVE-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id FROM lineitem) WHERE l_linenumber <> 7"""

    ev = "CAST(ts AS TIMESTAMP)"
    inc = lambda service, id_, severity, status, start, end, minutes, comp, src: f"""SELECT {service} AS service_name, {id_} AS incident_id,
 {severity} AS severity, {status} AS status, {start} AS started_at, {end} AS resolved_at, CAST({minutes} AS BIGINT) AS duration_minutes,
 {comp} AS affected_components FROM {src}"""
    p = "o_orderpriority"
    odate = "CAST(o_orderdate AS TIMESTAMP)"
    eid = "CAST(event_id AS VARCHAR)"
    made = {
        "nvd_normalize": nvd("CASE WHEN l_linenumber = 3 OR l_returnflag = 'A' THEN 'unknown' ELSE 'v' || CAST(l_suppkey % 10 AS VARCHAR) END"),
        "feed_json": nvd("'acme'"),
        "nested_filter": "SELECT CAST(CASE WHEN l_linenumber = 3 THEN -1 ELSE 2 END AS BIGINT) AS matches, count(*) AS n FROM lineitem GROUP BY 1",
        "kev_normalize": f"""SELECT 'kev' AS source, 'CVE-' || CAST(o_orderkey AS VARCHAR) AS cve_id, 'CVE-' || CAST(o_orderkey AS VARCHAR) AS advisory_id,
 CASE WHEN {p} = '5-LOW' THEN 'unknown' ELSE lower({p}) END AS service_name, 'SaaS' AS ecosystem, 'CRITICAL' AS severity,
 CAST(NULL AS DOUBLE) AS cvss_v3_score, CAST(NULL AS VARCHAR) AS cvss_v3_vector, CAST(NULL AS DOUBLE) AS epss_score, CAST(1 AS BIGINT) AS is_kev,
 CAST(NULL AS VARCHAR) AS cwe_id, strftime({odate}, '%Y-%m-%d 00:00:00') AS published_at, strftime({odate}, '%Y-%m-%d 00:00:00') AS modified_at
 FROM orders WHERE o_orderstatus <> 'P'""",
        "ghsa_normalize": f"""SELECT 'ghsa' AS source, CASE WHEN {p} = '2-HIGH' THEN 'GHSA-' ELSE 'CVE-' END || CAST(o_orderkey AS VARCHAR) AS cve_id,
 'GHSA-' || CAST(o_orderkey AS VARCHAR) AS advisory_id, CASE WHEN {p} = '1-URGENT' THEN 'unknown' ELSE 'pkg' || CAST(o_custkey % 20 AS VARCHAR) END AS service_name,
 'NPM' AS ecosystem, CASE {p} WHEN '1-URGENT' THEN 'CRITICAL' WHEN '2-HIGH' THEN 'HIGH' WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' ELSE 'NONE' END AS severity,
 CASE WHEN {p} <> '5-LOW' AND o_custkey % 11 > 0 THEN CAST(o_custkey % 11 AS DOUBLE) END AS cvss_v3_score, CASE WHEN {p} <> '5-LOW' THEN 'V' END AS cvss_v3_vector,
 CAST(NULL AS DOUBLE) AS epss_score, CAST(0 AS BIGINT) AS is_kev, 'CWE-1,CWE-' || CAST(o_custkey % 50 AS VARCHAR) AS cwe_id, {iso(odate)} AS published_at,
 CAST(NULL AS VARCHAR) AS modified_at FROM orders WHERE o_orderstatus <> 'P'""",
        "osv_normalize": """SELECT 'osv' AS source, CASE WHEN p_type = 'SMALL' THEN 'OSV-' ELSE 'CVE-' END || CAST(p_partkey AS VARCHAR) AS cve_id,
 'OSV-' || CAST(p_partkey AS VARCHAR) AS advisory_id, 'acme' AS service_name, 'PyPI' AS ecosystem, CASE p_type WHEN 'ECONOMY' THEN 'CRITICAL'
 WHEN 'SMALL' THEN 'NONE' WHEN 'PROMO' THEN 'NONE' ELSE 'LOW' END AS severity, CASE WHEN p_type = 'PROMO' THEN 3.5 ELSE p_size / 5.0 END::DOUBLE AS cvss_v3_score,
 CASE WHEN p_type <> 'LARGE' THEN 'v3' END AS cvss_v3_vector, CAST(NULL AS DOUBLE) AS epss_score, CAST(0 AS BIGINT) AS is_kev,
 CASE WHEN p_type <> 'ECONOMY' THEN 'CWE-1,CWE-2' END AS cwe_id, '2024-01-05 10:20:30' AS published_at, CAST(NULL AS VARCHAR) AS modified_at FROM part""",
        "epss_normalize": f"""SELECT 'CVE-' || CAST(o_orderkey AS VARCHAR) AS cve_id, CASE WHEN {p} <> '5-LOW' THEN CAST(o_custkey % 100 AS DOUBLE) / 100.0::DOUBLE END
 AS epss_score FROM orders""",
        "statuspage_normalize": inc("'acme'", eid, "CASE event_type WHEN 'error' THEN 'major' WHEN 'signup' THEN 'major' WHEN 'click' THEN 'minor' ELSE 'maintenance' END",
                                    "CASE WHEN event_type = 'view' THEN 'resolved' ELSE 'closed' END", iso(ev),
                                    f"CASE WHEN event_type <> 'purchase' THEN {iso(ev + ' + INTERVAL 1 MINUTE * CAST(floor(value) AS INT)')} END",
                                    "CASE WHEN event_type <> 'purchase' THEN floor(value) END", "event_type || ', ' || CAST(user_id AS VARCHAR)", "events"),
        "aws_normalize": inc("'aws'", eid, "CASE WHEN event_type = 'error' THEN 'major' ELSE 'minor' END", "CASE WHEN event_type <> 'view' THEN 'open' ELSE 'resolved' END",
                             "CAST(user_id AS VARCHAR)", "''", "NULL", "event_type", "events"),
        "feed_atom": inc("'azure'", f"CASE WHEN event_type = 'view' THEN 'https://status/' || {eid} || '/' ELSE {eid} END", "'major'", "'resolved'",
                         f"CASE WHEN event_type <> 'click' THEN {iso(ev)} END", "CAST(NULL AS VARCHAR)", "NULL", "'t & ' || event_type", "events"),
        "feed_salesforce": inc("'salesforce'", "CAST(o_orderkey AS VARCHAR)", f"CASE WHEN {p} IN ('1-URGENT', '2-HIGH') THEN 'major' ELSE 'minor' END",
                               "CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE 'investigating' END", iso(odate),
                               f"CASE WHEN o_orderstatus = 'F' THEN {iso(odate + ' + INTERVAL 90 MINUTES')} WHEN {p} = '5-LOW' THEN {iso(odate + ' + INTERVAL 30 MINUTES')} END",
                               f"CASE WHEN o_orderstatus = 'F' THEN 90 WHEN {p} = '5-LOW' THEN 30 END", f"CASE WHEN {p} = '2-HIGH' THEN 'a1' ELSE 'k1, k2' END",
                               f"orders WHERE {p} <> '4-NOT SPECIFIED'"),
        "gcp_normalize": inc("'gcp'", eid, "CASE WHEN event_type = 'error' THEN 'major' ELSE 'minor' END", "CASE WHEN event_type = 'view' THEN 'resolved' ELSE 'investigating' END",
                             iso(ev), f"CASE WHEN event_type = 'view' THEN {iso(ev)} END", "NULL", "event_type || ', ' || CAST(user_id AS VARCHAR)", "events"),
        "incident_texts": f"""WITH k AS (SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, role, text FROM conversations),
 t AS (SELECT id, {strip("role || chr(10) || chr(10) || text")} AS x, 'azure' AS feed, 31 AS least FROM k UNION ALL
 SELECT id, {strip("'Salesforce Incident ' || id || ': ' || text")}, 'salesforce', 31 FROM k UNION ALL
 SELECT id, {strip("text")}, 'aws', 1 FROM k WHERE role = 'user' UNION ALL
 SELECT id, {strip("'desc' || chr(10) || chr(10) || text || ' end'")}, 'gcp', 1 FROM k WHERE role = 'user')
 SELECT id, md5(x) AS digest, feed FROM t WHERE length(x) >= least""",
        "advisory_texts": "SELECT DISTINCT 'ghsa::GHSA-' || CAST(o_orderkey AS VARCHAR) AS id, 's' || chr(10) || chr(10) || 'd' AS text FROM orders",
        "github_activity": f"""WITH lo AS (SELECT TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 720 DAYS AS t),
 c AS (SELECT l_suppkey AS k, count(*) AS n, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_linenumber END) AS a FROM lineitem
 WHERE CAST(l_shipdate AS TIMESTAMP) >= (SELECT t FROM lo) GROUP BY 1),
 i AS (SELECT o_custkey AS k, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, CASE WHEN count(*) FILTER (WHERE o_orderstatus <> 'O') > 0 THEN 1.5 END AS d
 FROM orders WHERE o_orderpriority = '1-URGENT' AND {odate} >= (SELECT t FROM lo) GROUP BY 1),
 r AS (SELECT o_custkey AS k, max({odate}) AS m FROM orders GROUP BY 1)
 SELECT 'org/repo' || CAST(k AS VARCHAR) AS repo, coalesce(n, 0) AS commit_count_90d, coalesce(a, 0) AS contributor_count_90d,
 coalesce(o, 0) AS security_issues_open, CAST(d AS DOUBLE) AS mean_days_close_security,
 CAST({O.days_between('m', "TIMESTAMP '2001-06-01 00:00:00'")} AS BIGINT) AS days_since_last_release
 FROM c FULL JOIN i USING (k) FULL JOIN r USING (k)""",
        "policy_files": "SELECT c_name AS org_name, CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS valid FROM customer",
    }
    ids = "source, advisory_id, cve_id, service_name, is_kev"
    feeds_ = " UNION ALL ".join(f"SELECT {ids} FROM ({made[n]})" for n in ("kev_normalize", "ghsa_normalize", "osv_normalize"))
    made["ingest_all"] = f"""WITH u AS ({feeds_}), kv AS (SELECT 'CVE-' || CAST(o_orderkey AS VARCHAR) AS id FROM orders
 WHERE o_orderpriority = '1-URGENT') SELECT source, advisory_id, cve_id, service_name,
 CAST(CASE WHEN cve_id IN (SELECT id FROM kv) THEN 1 ELSE is_kev END AS BIGINT) AS is_kev, true AS recorded FROM u"""
    keys = {"nvd": ("l_linenumber", "lineitem", "l_linenumber <> 7"), "osv": ("p_partkey", "part", "true"),
            "kev": ("o_orderkey", "orders", "o_orderstatus <> 'P'")}
    keys |= {f: ("o_orderkey", "orders", "true") for f in ("ghsa", "epss", "github_issues")}
    keys |= {f: ("event_id", "events", "true") for f in ("statuspage", "aws", "gcp")}
    states = []
    for feed, (key, table, numbered) in keys.items():
        seven = "['envelope']" if feeds.ENVELOPES[feed][0] else "['accepted']"
        states.append(f"""SELECT '{feed}' AS feed, unnest(CASE k WHEN 3 THEN ['document'] WHEN 5 THEN ['accepted', 'item']
 WHEN 7 THEN {seven} ELSE ['accepted'] END) AS error FROM (SELECT CASE WHEN {numbered} THEN {key} % 13 END AS k FROM {table})""")
    all_states = " UNION ALL ".join(states)
    made["feed_records"] = f"SELECT feed, error, count(*) AS n FROM ({all_states}) GROUP BY 1, 2"
    made["feed_rejects"] = f"""SELECT feed, error, CAST(CASE WHEN error = 'item' THEN 1 ELSE -1 END AS BIGINT) AS position,
 CASE WHEN error = 'item' THEN 'no object' END AS text, count(*) AS n FROM ({all_states})
 WHERE error <> 'accepted' AND feed IN ('kev', 'aws', 'osv') GROUP BY 1, 2"""
    num = "CAST(regexp_extract(advisory_id, '([0-9]+)$', 1) AS BIGINT) % 13"
    made["ingest_files"] = f"""WITH k AS (SELECT {ids}, true AS collected FROM ({made["kev_normalize"]}) WHERE {num} NOT IN (3, 7)),
 g AS (SELECT {ids}, true AS collected FROM ({made["ghsa_normalize"]}) WHERE {num} NOT IN (3, 7)),
 o AS (SELECT source, advisory_id, cve_id, CASE WHEN {num} = 3 THEN 'before' ELSE service_name END AS service_name, is_kev,
 {num} <> 3 AS collected FROM ({made["osv_normalize"]})), u AS (SELECT * FROM k UNION ALL SELECT * FROM g UNION ALL SELECT * FROM o)
 SELECT source, advisory_id, cve_id, service_name, CAST(CASE WHEN cve_id IN (SELECT cve_id FROM k) THEN 1 ELSE is_kev END AS BIGINT) AS is_kev,
 collected FROM u"""
    return made
