"""Registered queries of the model features, drill-down and reports."""

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions import risk
from riskweave.models import metrics as Q
from riskweave.operators import aggregates as A
from riskweave.operators import filters as D
from riskweave.operators import model_features as M
from riskweave.operators import ranking as R
from riskweave.plans import flow
from riskweave.plans import oracle as O
from riskweave.sources import outputs, tables as T

AS_OF = O.AS_OF
WEIGHTS = M.normalised_weights(dict(zip(C.RISK_CATEGORIES, (0.25, 0.2, 0.2, 0.15, 0.15, 0.1))))
ENTITY_ORDER = ("published_at", "advisory_id", "source", "ecosystem")


def longs(df, *cols):
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def incident_agg_model(spark, sf):
    return A.incident_agg(T.incidents(spark, sf))


def vuln_agg_model(spark, sf):
    return A.vuln_agg(T.vulnerabilities(spark, sf), casefold=True)


def repo_agg_model(spark, sf):
    return longs(A.repo_agg(T.repo_health(spark, sf)), "has_security_policy")


def cwe_top20(spark, sf):
    return R.top_categories(T.vulnerabilities(spark, sf), "cwe_id", 20)


def cwe_frequency(spark, sf):
    return R.value_counts(T.vulnerabilities(spark, sf), "cwe_id")


def cwe_members(spark, sf):
    return R.in_top(T.vulnerabilities(spark, sf), "cwe_id", 20).select("service_name", "cve_id", "advisory_id", "cwe_id")


def cwe_onehot(spark, sf):
    v = T.vulnerabilities(spark, sf)
    names = [r[0] for r in R.top_categories(v, "cwe_id", 20).select("cwe_id").collect()]
    wide = A.onehot_counts(v, "service_name", "cwe_id", names)
    return wide.unpivot(["service_name"], M.cwe_columns(wide), "column", "n")


def entity_list(spark, sf):
    return longs(A.entity_list(T.vulnerabilities(spark, sf), ENTITY_ORDER), "is_oss", "is_saas")


def frame(spark, sf, codes=False):
    return flow.model_frame(T.vulnerabilities(spark, sf), T.repo_health(spark, sf), T.incidents(spark, sf),
                            ENTITY_ORDER, top=20, casefold=True, codes=codes)


BASE = ("commit_count_90d", "contributor_count_90d", "open_issues", "security_issues_open",
        "mean_days_close_security", "days_since_last_release", "has_security_policy", "incident_count",
        "avg_severity", "recurrence_rate", "total_downtime", "total_vulns", "open_vulns", "mean_cvss", "max_cvss",
        "exploit_count", "mean_epss")
COMPOUND = ("vuln_density", "risk_velocity", "patch_debt", "exploit_ratio", "epss_risk")


def feature_join(spark, sf):
    df = M.join_features(
        A.entity_list(T.vulnerabilities(spark, sf), ENTITY_ORDER), A.repo_agg(T.repo_health(spark, sf)),
        A.incident_agg(T.incidents(spark, sf)), A.vuln_agg(T.vulnerabilities(spark, sf), True))
    return longs(df.select("service_name", "ecosystem", "vendor", *BASE), "has_security_policy")


def compound_features(spark, sf):
    return frame(spark, sf).select("service_name", *COMPOUND)


def high_risk_label(spark, sf):
    return longs(frame(spark, sf).select("service_name", "high_risk"), "high_risk")


def null_audit(spark, sf):
    return longs(A.null_audit(frame(spark, sf), BASE), "has_null")


def category_codes(spark, sf):
    v = A.entity_list(T.vulnerabilities(spark, sf), ENTITY_ORDER)
    return M.encode(v, ["ecosystem", "vendor"]).select("service_name", "ecosystem_enc", "vendor_enc")


def weighted_features(spark, sf):
    df = M.apply_weights(frame(spark, sf), WEIGHTS)
    return df.select("service_name", *[f for f in C.MODEL_FEATURES if not f.endswith("_enc")])


def settled(spark, sf):
    """The frame written once, with the maxima and ends that drill-down and scaling need."""
    return flow.settled_frame(spark, frame(spark, sf), ("mean_epss",))


def scored(spark, sf):
    """The frame with a simple stand-in score, so that reports can be checked without a fitted model."""
    df, _, ends = settled(spark, sf)
    df = R.minmax(df.withColumn("lr_risk_score", F.col("mean_cvss") / 10.0), "mean_epss", name="anomaly_score",
                  ends=ends["mean_epss"])
    return df.withColumns({"anomaly_flag": (F.col("anomaly_score") >= 0.5).cast("int"),
                           "risk_level": risk.risk_band("lr_risk_score", 0.5, 0.52)})


def risk_bands(spark, sf):
    return scored(spark, sf).select("service_name", "lr_risk_score", "risk_level")


def minmax_scores(spark, sf):
    return longs(scored(spark, sf).select("service_name", "anomaly_score", "anomaly_flag"), "anomaly_flag")


def label_band_counts(spark, sf):
    s = scored(spark, sf)
    a = A.distribution(s, "risk_level").withColumnRenamed("risk_level", "value")
    b = A.distribution(s, "high_risk").select(F.col("high_risk").cast("string").alias("value"), "n", "share")
    return a.withColumn("kind", F.lit("band")).unionByName(b.withColumn("kind", F.lit("label")))


def risk_area_drilldown(spark, sf):
    df, maxima, _ = settled(spark, sf)
    return M.risk_areas(df, WEIGHTS, maxima)


def risk_drivers_top10(spark, sf):
    df, maxima, _ = settled(spark, sf)
    d = M.risk_drivers(df, WEIGHTS, maxima=maxima)
    return longs(d.select("service_name", "area", "feature", "value", "weighted", "rank", "level"), "rank")


def cwe_labels(spark, sf):
    return M.cwe_present(frame(spark, sf))


def leaderboard(spark, sf):
    cols = ("service_name", "vendor", "ecosystem", "open_vulns", "mean_cvss", "mean_epss", "exploit_count",
            "incident_count", "lr_risk_score", "anomaly_score", "anomaly_flag", "risk_level")
    return longs(R.leaderboard(scored(spark, sf)).select(*cols), "anomaly_flag")


def mean_cvss_order(spark, sf):
    cols = ("service_name", "vendor", "ecosystem", "open_vulns", "mean_cvss", "mean_epss", "exploit_count",
            "incident_count", "high_risk")
    return longs(R.by_mean_cvss(frame(spark, sf)).select(*cols), "high_risk")


def dashboard(spark, sf):
    return longs(outputs.dashboard(scored(spark, sf), WEIGHTS, AS_OF), "anomaly_flag")


def service_search(spark, sf):
    s = frame(spark, sf).select("service_name", "total_vulns")
    plain = D.search_service(s, "#00000000").withColumn("kind", F.lit("text"))
    pattern = D.search_service(s, "0{7}[1-3]", regex=True).withColumn("kind", F.lit("pattern"))
    exact = D.for_service(s, "SUPPLIER#000000007").withColumn("kind", F.lit("name"))
    return plain.unionByName(pattern).unionByName(exact)


def cvss_histogram(spark, sf):
    return A.histogram(T.vulnerabilities(spark, sf), "cvss_v3_score", 1.0)


def score_vs(spark, sf):
    df = frame(spark, sf).withColumn("risk_score", F.col("mean_epss") * 100.0)
    out = A.score_vs(df)
    return out.select("services", F.round("corr_cvss", 6).alias("corr_cvss"),
                      F.round("corr_volume", 6).alias("corr_volume"))


def top_by_volume(spark, sf):
    return R.top_by_volume(T.vulnerabilities(spark, sf), 15)


def newest_scores(spark, sf):
    runs = T.read_table(spark, "orders", sf).select(
        F.concat(F.lit("Service#"), F.col("o_custkey").cast("string"), F.lit("-"), F.col("o_orderkey").cast("string"))
        .alias("service_name"), F.col("o_orderdate").alias("scored_at"), F.col("o_totalprice").alias("final_risk_score"))
    out = R.newest_scores(runs, 10)
    return out.select("service_name", F.date_format("scored_at", "yyyy-MM-dd HH:mm:ss").alias("scored_at"),
                      "final_risk_score")


def source_counts(spark, sf):
    v = T.vulnerabilities(spark, sf)
    errors = T.incidents(spark, sf).filter(F.col("severity") == "major").select(
        F.concat(F.lit("src"), (F.col("duration_minutes") % 4).cast("string")).alias("source"))
    return A.source_counts(v, errors)


def judged(spark, sf):
    """Document labels with a score on the length of the text, so that ties occur."""
    docs = T.read_table(spark, "documents", sf).select("doc_id", F.floor(F.col("n_chars") / 50).alias("len50"))
    lab = T.read_table(spark, "labels", sf)
    return lab.join(docs, "doc_id").select(
        "quality", (F.least(F.col("len50"), F.lit(100)) / 100.0).alias("score"))


def rank_auc(spark, sf):
    return Q.rank_auc(judged(spark, sf), "score", "quality")


def roc_points(spark, sf):
    return Q.roc_points(judged(spark, sf), "score", "quality")


def confusion_metrics(spark, sf):
    return Q.confusion(judged(spark, sf), "score", "quality", 0.2)


def class_report(spark, sf):
    return Q.class_report(judged(spark, sf), "score", "quality", 0.2)


def model_choice(spark, sf):
    """Choice between candidates whose quality is the mean label of a document source group."""
    docs = T.read_table(spark, "documents", sf).select("doc_id", "lang")
    name = F.when(F.col("lang") == "en", "Random Forest").when(F.col("lang") == "fr", "Boosted Trees").when(
        F.col("lang") == "de", "Neural Network").otherwise("Logistic Regression")
    m = T.read_table(spark, "labels", sf).join(docs, "doc_id").groupBy(name.alias("model")).agg(
        F.avg("quality").alias("cv_auc"))
    return Q.choose_model(m)


def repo_activity(spark, sf):
    """Commits, issues and releases of repositories drawn from orders, line items and events."""
    li, orders = T.read_table(spark, "lineitem", sf), T.read_table(spark, "orders", sf)
    shift = F.expr("INTERVAL 8120 DAYS")
    repo = lambda c: F.concat(F.lit("org/repo"), F.col(c).cast("string"))
    commits = li.select(repo("l_suppkey").alias("repo"), (F.col("l_shipdate") + shift).alias("committed_at"),
                        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("u"), F.col("l_linenumber").cast("string")))
                        .alias("author"))
    issues = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        repo("l_suppkey").alias("repo"), (F.col("o_orderdate") + shift).alias("created_at"),
        F.when(F.col("l_returnflag") != "N", F.col("o_orderdate") + shift + F.make_dt_interval(
            days=F.col("l_linenumber"), hours=F.col("l_quantity").cast("int"))).alias("closed_at"),
        F.when(F.col("l_returnflag") == "N", "open").otherwise("closed").alias("state"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_security"))
    releases = orders.select(repo("o_custkey").alias("repo"), (F.col("o_orderdate") + shift).alias("published_at"))
    return commits, issues, releases


def repo_stats(spark, sf):
    commits, issues, releases = repo_activity(spark, sf)
    return longs(A.repo_stats(commits, issues, releases, "2023-10-01 00:00:00"), "days_since_last_release")


def repo_metrics(spark, sf):
    commits, issues, releases = repo_activity(spark, sf)
    repos = T.read_table(spark, "supplier", sf).select(
        F.concat(F.lit("org/repo"), F.col("s_suppkey").cast("string")).alias("repo"),
        F.col("s_name").alias("service_name"), F.col("s_nationkey").cast("bigint").alias("open_issues"))
    return longs(A.repo_metrics(commits, issues, releases, repos, "2023-10-01 00:00:00"), "days_since_last_release")


QUERIES = {f.__name__: f for f in (
    incident_agg_model, vuln_agg_model, repo_agg_model, cwe_top20, cwe_frequency, cwe_members, cwe_onehot, entity_list,
    feature_join, compound_features, high_risk_label, null_audit, category_codes, weighted_features, risk_bands,
    minmax_scores, label_band_counts, risk_area_drilldown, risk_drivers_top10, cwe_labels, leaderboard,
    mean_cvss_order, dashboard, service_search, cvss_histogram, score_vs, top_by_volume, newest_scores, source_counts,
    rank_auc, roc_points, confusion_metrics, class_report, model_choice, repo_stats, repo_metrics)}


ENT = """ent AS (SELECT service_name, ecosystem, service_name AS vendor FROM vuln QUALIFY row_number() OVER
 (PARTITION BY service_name ORDER BY published_at, advisory_id, source, ecosystem) = 1)"""
RAGG = f"""ragg AS (SELECT service_name, {', '.join(f"{O.xsum(c)} / count({c}) AS {c}" for c in A.REPO_MEANS)},
 CAST(max(has_security_policy) AS BIGINT) AS has_security_policy FROM repo GROUP BY service_name)"""
IAGG = """iagg AS (SELECT service_name, count(incident_id) AS incident_count,
 avg(CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END) AS avg_severity,
 avg(CASE WHEN status = 'resolved' THEN 0 ELSE 1 END) AS recurrence_rate,
 CAST(coalesce(sum(duration_minutes), 0) AS BIGINT) AS total_downtime FROM inc GROUP BY service_name)"""
VAGG = f"""vagg AS (SELECT service_name, count(cve_id) AS total_vulns,
 count(*) FILTER (WHERE lower(severity) IN ('critical', 'high')) AS open_vulns,
 {O.xsum('cvss_v3_score')} / count(cvss_v3_score) AS mean_cvss, max(cvss_v3_score) AS max_cvss,
 CAST(sum(is_kev) AS BIGINT) AS exploit_count, {O.xsum('epss_score')} / count(epss_score) AS mean_epss
 FROM vuln GROUP BY service_name)"""
TOP = """top AS (SELECT cwe_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, cwe_id) AS r FROM vuln
 GROUP BY cwe_id ORDER BY n DESC, cwe_id LIMIT 20)"""
CWE = """cc AS (SELECT ent.service_name, top.cwe_id, top.r, count(vuln.cwe_id) AS n FROM ent CROSS JOIN top LEFT JOIN vuln
 ON vuln.service_name = ent.service_name AND vuln.cwe_id = top.cwe_id GROUP BY ALL)"""
FRAME = f"""fr0 AS (SELECT ent.*, {', '.join(f'coalesce({c}, 0) AS {c}' for c in BASE)} FROM ent LEFT JOIN ragg USING (service_name)
 LEFT JOIN iagg USING (service_name) LEFT JOIN vagg USING (service_name)),
fr AS (SELECT *, CAST(open_vulns AS DOUBLE) / (total_vulns + 1) AS vuln_density, incident_count * recurrence_rate AS risk_velocity,
 days_since_last_release * security_issues_open AS patch_debt, CAST(exploit_count AS DOUBLE) / (total_vulns + 1) AS exploit_ratio,
 mean_epss * total_vulns AS epss_risk, CAST(mean_cvss >= 7.0 OR exploit_count >= 1 OR mean_epss >= 0.1 OR incident_count >= 3 AS BIGINT)
 AS high_risk FROM fr0)"""
SCORED = """sc0 AS (SELECT *, mean_cvss / 10.0::DOUBLE AS lr_risk_score, (mean_epss - (SELECT min(mean_epss) FROM fr)) /
 ((SELECT max(mean_epss) FROM fr) - (SELECT min(mean_epss) FROM fr) + 1e-9::DOUBLE) AS anomaly_score FROM fr),
sc AS (SELECT *, CAST(anomaly_score >= 0.5 AS BIGINT) AS anomaly_flag, CASE WHEN lr_risk_score > 0 AND lr_risk_score <= 0.5 THEN 'Low'
 WHEN lr_risk_score > 0.5 AND lr_risk_score <= 0.52::DOUBLE THEN 'Medium' WHEN lr_risk_score > 0.52::DOUBLE AND lr_risk_score <= 1 THEN 'High' END
 AS risk_level FROM sc0)"""
JUDGED = """jd AS (SELECT quality, least(floor(n_chars / 50.0), 100) / 100.0::DOUBLE AS score FROM labels JOIN documents USING (doc_id))"""


def scaled_sql(n):
    if n in ("mean_cvss", "max_cvss"):
        return f"{n} / 10.0::DOUBLE"
    if n == "avg_severity":
        return f"{n} / 4.0::DOUBLE"
    if n in M.SCALED_BY_MAX:
        return f"{n} / ((SELECT CAST(max({n}) AS DOUBLE) FROM fr) + 1.0::DOUBLE)"
    return f"CAST({n} AS DOUBLE)"


def label_case(col):
    return O.case_map(col, {k: v for k, v in C.CWE_LABELS.items()}, col)


LEVEL = "CASE WHEN {0} >= 0.7::DOUBLE THEN 'HIGH' WHEN {0} >= 0.4::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS level"


FRAME_CTES = [O.VULN, O.INC, O.REPO, ENT, RAGG, IAGG, VAGG, FRAME]


def oracles():
    fr = FRAME_CTES
    frame_sql, scored_sql = O.with_(*fr), O.with_(*fr, SCORED)
    wts = M.feature_weights([f for f in C.MODEL_FEATURES if not f.endswith("_enc")], WEIGHTS)
    area_rows, driver_rows, pos = [], [], 0
    for area, cat, names in M.AREAS:
        w = f"{WEIGHTS[cat]!r}::DOUBLE"
        raw = "least((" + " + ".join(scaled_sql(n) for n in names) + f") / {len(names)}.0::DOUBLE, 1.0::DOUBLE)"
        area_rows.append(f"SELECT service_name, '{area}' AS area, {raw} AS raw, {w} AS weight FROM fr")
        for n in names:
            driver_rows.append(f"SELECT service_name, '{area}' AS area, '{n}' AS feature, {pos} AS pos, {scaled_sql(n)} AS value, "
                               f"{w} AS weight FROM fr")
            pos += 1
    cw = f"{WEIGHTS['cwe_attack_types']!r}::DOUBLE"
    area_rows.append(f"""SELECT service_name, 'CWE Attack Types' AS area, least(coalesce(CAST(sum(n) AS DOUBLE) / nullif(count(*)
 FILTER (WHERE n > 0), 0), 0.0::DOUBLE), 1.0::DOUBLE) AS raw, {cw} AS weight FROM cc GROUP BY service_name""")
    driver_rows.append(f"SELECT service_name, 'CWE Attack Types' AS area, {label_case('cwe_id')} AS feature, {pos} + r AS pos, "
                       f"CAST(n AS DOUBLE) AS value, {cw} AS weight FROM cc WHERE n > 0")
    leader = ("service_name, vendor, ecosystem, open_vulns, mean_cvss, mean_epss, exploit_count, incident_count, "
              "lr_risk_score, anomaly_score, anomaly_flag, risk_level")
    stats = """cm AS (SELECT 'org/repo' || CAST(l_suppkey AS VARCHAR) AS repo, CAST(l_shipdate AS TIMESTAMP) + INTERVAL 8120 DAYS AS committed_at,
 CASE WHEN l_linestatus = 'F' THEN 'u' || CAST(l_linenumber AS VARCHAR) END AS author FROM lineitem),
iss AS (SELECT 'org/repo' || CAST(l_suppkey AS VARCHAR) AS repo, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 8120 DAYS AS created_at,
 CASE WHEN l_returnflag <> 'N' THEN l_linenumber * 86400 + CAST(l_quantity AS BIGINT) * 3600 END AS secs, o_orderpriority = '1-URGENT' AS sec
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
rl AS (SELECT 'org/repo' || CAST(o_custkey AS VARCHAR) AS repo, max(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 8120 DAYS) AS last FROM orders GROUP BY 1),
lo AS (SELECT TIMESTAMP '2023-10-01 00:00:00' - INTERVAL 180 DAYS AS t),
c1 AS (SELECT repo, count(*) AS commits, count(DISTINCT author) AS authors FROM cm WHERE committed_at >= (SELECT t FROM lo) GROUP BY repo),
i1 AS (SELECT repo, count(*) FILTER (WHERE secs IS NULL) AS opened, CAST(sum(secs) AS DOUBLE) / nullif(count(secs), 0) / 86400.0::DOUBLE AS d
 FROM iss WHERE sec AND created_at >= (SELECT t FROM lo) GROUP BY repo),
st AS (SELECT repo, coalesce(commits, 0) AS commit_count_90d, coalesce(authors, 0) AS contributor_count_90d,
 coalesce(opened, 0) AS security_issues_open, """ + O.rnd("d", 1) + """ AS mean_days_close_security,
 CAST(""" + O.days_between("last", "TIMESTAMP '2023-10-01 00:00:00'") + """ AS BIGINT) AS days_since_last_release
 FROM c1 FULL JOIN i1 USING (repo) FULL JOIN rl USING (repo))"""
    pr = "CAST({0} AS DOUBLE) / nullif({0} + {1}, 0)"
    conf = """cf AS (SELECT count(*) FILTER (WHERE score >= 0.2::DOUBLE AND quality = 1) AS tp, count(*) FILTER (WHERE score >= 0.2::DOUBLE AND quality <> 1) AS fp,
 count(*) FILTER (WHERE score < 0.2::DOUBLE AND quality = 1) AS fn, count(*) FILTER (WHERE score < 0.2::DOUBLE AND quality <> 1) AS tn FROM jd)"""
    rep = lambda name, tp, fp, fn: f"SELECT '{name}' AS class, {tp} AS hit, {fp} AS extra, {fn} AS lost FROM cf"
    return {
        "incident_agg_model": O.with_(O.INC, IAGG) + " SELECT * FROM iagg",
        "vuln_agg_model": O.with_(O.VULN, VAGG) + " SELECT * FROM vagg",
        "repo_agg_model": O.with_(O.REPO, RAGG) + " SELECT * FROM ragg",
        "cwe_top20": O.with_(O.VULN, TOP) + " SELECT cwe_id, n FROM top",
        "cwe_frequency": O.with_(O.VULN) + " SELECT cwe_id, count(*) AS n FROM vuln GROUP BY cwe_id",
        "cwe_members": O.with_(O.VULN, TOP) + """ SELECT service_name, cve_id, advisory_id, cwe_id FROM vuln
 WHERE cwe_id IN (SELECT cwe_id FROM top)""",
        "cwe_onehot": O.with_(O.VULN, ENT, TOP, CWE) + """ SELECT service_name, 'cwe_id_' || cwe_id AS "column", n FROM cc""",
        "entity_list": O.with_(O.VULN, ENT) + """ SELECT *, CAST(0 AS BIGINT) AS is_oss, CAST(0 AS BIGINT) AS is_saas FROM ent""",
        "feature_join": frame_sql + f" SELECT service_name, ecosystem, vendor, {', '.join(BASE)} FROM fr",
        "compound_features": frame_sql + f" SELECT service_name, {', '.join(COMPOUND)} FROM fr",
        "high_risk_label": frame_sql + " SELECT service_name, high_risk FROM fr",
        "null_audit": frame_sql + " SELECT CAST(max(CAST(" + " OR ".join(f"{c} IS NULL" for c in BASE)
        + " AS INT)) AS BIGINT) AS has_null FROM fr",
        "category_codes": O.with_(O.VULN, ENT) + """ SELECT service_name, dense_rank() OVER (ORDER BY ecosystem) - 1 AS ecosystem_enc,
 dense_rank() OVER (ORDER BY vendor) - 1 AS vendor_enc FROM ent""",
        "weighted_features": frame_sql + " SELECT service_name, " + ", ".join(
            f"{f} * {w!r}::DOUBLE AS {f}" for f, w in wts.items()) + " FROM fr",
        "risk_bands": scored_sql + " SELECT service_name, lr_risk_score, risk_level FROM sc",
        "minmax_scores": scored_sql + " SELECT service_name, anomaly_score, anomaly_flag FROM sc",
        "label_band_counts": scored_sql + """ SELECT 'band' AS kind, risk_level AS value, count(*) AS n,
 count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM sc) AS share FROM sc GROUP BY risk_level UNION ALL
 SELECT 'label', CAST(high_risk AS VARCHAR), count(*), count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM sc) FROM sc GROUP BY high_risk""",
        "risk_area_drilldown": O.with_(*fr, TOP, CWE, "ar AS (" + " UNION ALL ".join(area_rows) + ")") + f"""
 SELECT service_name, area, raw, raw * weight AS weighted, weight, {LEVEL.format('raw')},
 CAST(sum(CAST(raw * weight AS DECIMAL(18,12))) OVER (PARTITION BY service_name) AS DOUBLE) AS weighted_total FROM ar""",
        "risk_drivers_top10": O.with_(*fr, TOP, CWE, "dr AS (" + " UNION ALL ".join(driver_rows) + ")") + f"""
 SELECT service_name, area, feature, value, value * weight AS weighted, {LEVEL.format('value')},
 row_number() OVER (PARTITION BY service_name ORDER BY value * weight DESC, pos) AS rank FROM dr QUALIFY rank <= 10""",
        "cwe_labels": O.with_(O.VULN, ENT, TOP, CWE) + f""" SELECT service_name, cwe_id AS cwe, n, {label_case('cwe_id')} AS label
 FROM cc WHERE n > 0""",
        "leaderboard": scored_sql + f" SELECT {leader} FROM sc ORDER BY lr_risk_score DESC, service_name",
        "mean_cvss_order": frame_sql + """ SELECT service_name, vendor, ecosystem, open_vulns, mean_cvss, mean_epss, exploit_count,
 incident_count, high_risk FROM fr ORDER BY mean_cvss DESC, service_name""",
        "dashboard": scored_sql + f""" SELECT service_name, vendor, ecosystem, open_vulns, mean_cvss, mean_epss, incident_count,
 exploit_count, total_vulns, vuln_density, security_issues_open, days_since_last_release, lr_risk_score, anomaly_score,
 anomaly_flag, risk_level, '{AS_OF[:16]}' AS last_scored, """ + ", ".join(
            f"{v!r}::DOUBLE AS weight_{k}" for k, v in WEIGHTS.items()) + " FROM sc",
        "service_search": frame_sql + """ SELECT service_name, total_vulns, 'text' AS kind FROM fr WHERE contains(lower(service_name), '#00000000')
 UNION ALL SELECT service_name, total_vulns, 'pattern' FROM fr WHERE regexp_matches(lower(service_name), '0{7}[1-3]')
 UNION ALL SELECT service_name, total_vulns, 'name' FROM fr WHERE lower(service_name) = 'supplier#000000007'""",
        "cvss_histogram": O.with_(O.VULN) + """ SELECT CAST(floor(cvss_v3_score) AS BIGINT) AS bucket, floor(cvss_v3_score) AS bucket_from,
 count(*) AS n FROM vuln GROUP BY ALL""",
        "score_vs": frame_sql + """ SELECT count(*) AS services, round(corr(mean_epss * 100.0::DOUBLE, mean_cvss), 6) AS corr_cvss,
 round(corr(mean_epss * 100.0::DOUBLE, total_vulns), 6) AS corr_volume FROM fr""",
        "top_by_volume": O.with_(O.VULN) + " SELECT service_name, count(*) AS n FROM vuln GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15",
        "newest_scores": """SELECT 'Service#' || CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) AS service_name,
 strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS scored_at, o_totalprice AS final_risk_score FROM orders
 ORDER BY scored_at DESC, service_name LIMIT 10""",
        "source_counts": O.with_(O.VULN, O.INC) + """, a AS (SELECT source, count(*) AS n FROM vuln GROUP BY 1),
 b AS (SELECT 'src' || CAST(duration_minutes % 4 AS VARCHAR) AS source, count(*) AS n FROM inc WHERE severity = 'major' GROUP BY 1)
 SELECT source, coalesce(a.n, 0) AS record_count, coalesce(b.n, 0) AS error_count FROM a FULL JOIN b USING (source)""",
        "rank_auc": O.with_(JUDGED) + """, g AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality <> 1) AS q
 FROM jd GROUP BY score), h AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
 SELECT CAST(sum(p * (2 * below + q)) AS DOUBLE) / (sum(p) * sum(q) * 2) AS auc, CAST(sum(p) AS BIGINT) AS positives,
 CAST(sum(q) AS BIGINT) AS negatives FROM h""",
        "roc_points": O.with_(JUDGED) + """, g AS (SELECT score, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality <> 1) AS q
 FROM jd GROUP BY score) SELECT score AS threshold, CAST(sum(q) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(q) FROM g) AS fpr,
 CAST(sum(p) OVER (ORDER BY score DESC) AS DOUBLE) / (SELECT sum(p) FROM g) AS tpr FROM g""",
        "confusion_metrics": O.with_(JUDGED, conf) + f""", r AS (SELECT *, coalesce({pr.format('tp', 'fp')}, 0) AS precision,
 coalesce({pr.format('tp', 'fn')}, 0) AS recall FROM cf) SELECT *, coalesce(precision * recall * 2 / nullif(precision + recall, 0), 0) AS f1 FROM r""",
        "class_report": O.with_(JUDGED, conf) + ", u AS (" + rep("Low risk", "tn", "fn", "fp") + " UNION ALL "
        + rep("High risk", "tp", "fp", "fn") + f"""), r AS (SELECT class, coalesce({pr.format('hit', 'extra')}, 0) AS precision,
 coalesce({pr.format('hit', 'lost')}, 0) AS recall, hit + lost AS support FROM u)
 SELECT *, coalesce(precision * recall * 2 / nullif(precision + recall, 0), 0) AS f1 FROM r""",
        "model_choice": """WITH m AS (SELECT CASE lang WHEN 'en' THEN 'Random Forest' WHEN 'fr' THEN 'Boosted Trees' WHEN 'de' THEN 'Neural Network'
 ELSE 'Logistic Regression' END AS model, avg(quality) AS q FROM labels JOIN documents USING (doc_id) GROUP BY 1)
 SELECT CASE WHEN abs((SELECT q FROM m WHERE model = 'Random Forest') - (SELECT q FROM m WHERE model = 'Boosted Trees')) < 0.01
 THEN 'Boosted Trees' ELSE (SELECT model FROM m ORDER BY q DESC, model DESC LIMIT 1) END AS model""",
        "repo_stats": "WITH " + stats + " SELECT * FROM st",
        "repo_metrics": "WITH " + stats + """ SELECT repo, s_name AS service_name, CAST(s_nationkey AS BIGINT) AS open_issues,
 coalesce(commit_count_90d, 0) AS commit_count_90d, coalesce(contributor_count_90d, 0) AS contributor_count_90d,
 coalesce(security_issues_open, 0) AS security_issues_open, mean_days_close_security, days_since_last_release
 FROM supplier LEFT JOIN st ON repo = 'org/repo' || CAST(s_suppkey AS VARCHAR)""",
    }
