"""SQL pieces shared by the reference queries of the registered plans."""

import math

from riskweave import constants as C

AS_OF = "2024-02-01 00:00:00"

VULN = """vuln AS (SELECT 'src' || CAST(l_linenumber % 3 AS VARCHAR) AS source,
 'CVE-' || CAST(l_orderkey AS VARCHAR) AS cve_id,
 'ADV-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS advisory_id,
 s_name AS service_name,
 CASE WHEN l_quantity >= 45 THEN 'CRITICAL' WHEN l_quantity >= 35 THEN 'HIGH' WHEN l_quantity >= 20 THEN 'MEDIUM'
 ELSE 'LOW' END AS severity, l_quantity / 5.0::DOUBLE AS cvss_v3_score, l_discount * 5 AS epss_score,
 CASE WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 1 ELSE 0 END AS is_kev,
 'CWE-' || CAST(l_partkey % 40 AS VARCHAR) AS cwe_id,
 CAST(l_shipdate AS TIMESTAMP) + INTERVAL 8120 DAYS AS published_at,
 CASE WHEN l_linestatus = 'F' THEN 'npm' ELSE 'PyPI' END AS ecosystem
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)"""

INC = """inc AS (SELECT s_name AS service_name, CAST(event_id AS VARCHAR) AS incident_id,
 CASE event_type WHEN 'error' THEN 'major' WHEN 'click' THEN 'minor' WHEN 'view' THEN 'maintenance'
 WHEN 'purchase' THEN 'high' ELSE 'low' END AS severity,
 CASE WHEN event_id % 5 = 0 THEN 'investigating' ELSE 'resolved' END AS status,
 CAST(ts AS TIMESTAMP) AS started_at, CAST(floor(value) AS INT) AS duration_minutes
 FROM events JOIN supplier ON user_id % (SELECT count(*) FROM supplier) = s_suppkey)"""

REPO = """repo AS (SELECT s_name AS service_name, 'org/repo' || CAST(p_partkey AS VARCHAR) AS repo_full_name,
 p_size * 10 AS commit_count_90d, p_size AS contributor_count_90d, CAST(p_partkey % 120 AS INT) AS open_issues,
 CAST(p_partkey % 7 AS INT) AS security_issues_open, p_retailprice / 20.0::DOUBLE AS mean_days_close_security,
 CAST(p_partkey % 500 AS INT) AS days_since_last_release,
 CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS has_security_policy, p_partkey AS collected_seq
 FROM part JOIN supplier ON p_partkey % (SELECT count(*) FROM supplier) = s_suppkey)"""

DOCS = """docs AS (SELECT doc_id,
 'Supplier#' || lpad(CAST(CAST(substr(source, 4) AS INT) AS VARCHAR), 9, '0') AS service_name,
 CASE doc_id % 4 WHEN 0 THEN 'documentation' WHEN 1 THEN 'advisory_text' WHEN 2 THEN 'trust_disclosures'
 ELSE 'incident_postmortems' END AS collection, text FROM documents)"""

SVC = """svc AS (SELECT s_name AS service_name, s_name AS vendor, 'SaaS' AS ecosystem FROM supplier)"""


def bits(names, step):
    items = ", ".join(
        f"CASE WHEN floor(c_custkey * {step} / {2 ** i}.0) % 2 = 1 THEN '{n}' END" for i, n in enumerate(names))
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def policy_view():
    from riskweave.sources.tables import CONTROL_ORDER, FRAMEWORK_ORDER

    fw, ctl = bits(FRAMEWORK_ORDER, 1), bits(CONTROL_ORDER, 3)
    return f"""pol AS (SELECT c_custkey, c_nationkey, c_name AS org_name,
 CASE WHEN c_mktsegment = 'MACHINERY' THEN list_append({fw}, 'SOC2') ELSE {fw} END AS fws, {ctl} AS ctls,
 CASE WHEN c_custkey % 3 = 0 THEN 0.6 WHEN c_custkey % 3 = 1 THEN 0.5 END::DOUBLE AS o_sec,
 CASE WHEN c_custkey % 3 = 1 THEN 0.2 END::DOUBLE AS o_gov,
 c_custkey % 10 AS tier_key, CAST(c_custkey % 4 AS INT) AS tier FROM customer)"""


def rnd(expr, digits):
    """Round half to even on the exact binary value of a double."""
    s = f"{float(10 ** digits)!r}::DOUBLE"
    hi = "(v * 134217729.0::DOUBLE - (v * 134217729.0::DOUBLE - v))"
    low = f"floor(v * {s})"
    part = f"(v * {s} - {low})"
    err = f"(({hi} * {s} - v * {s}) + (v - {hi}) * {s})"
    up = (f"CASE WHEN {part} <> 0.5::DOUBLE THEN {part} > 0.5::DOUBLE WHEN {err} <> 0 THEN {err} > 0 "
          f"ELSE CAST({low} AS BIGINT) % 2 <> 0 END")
    return f"list_transform([CAST({expr} AS DOUBLE)], lambda v: ({low} + CASE WHEN {up} THEN 1 ELSE 0 END) / {s})[1]"


def days_between(a, b):
    """Whole days, floored."""
    return f"CAST(floor(date_diff('microsecond', {a}, {b}) / 86400000000.0::DOUBLE) AS INT)"


def decay(col, as_of=AS_OF):
    age = days_between(col, f"TIMESTAMP '{as_of}'")
    return f"coalesce({rnd(f'exp({-math.log(2)!r}::DOUBLE * {age} / 365.0::DOUBLE)', 4)}, 0.5::DOUBLE)"


def ordinal(col):
    return (f"CASE upper({col}) WHEN 'CRITICAL' THEN 1.0 WHEN 'HIGH' THEN 0.75 WHEN 'MEDIUM' THEN 0.5 "
            f"WHEN 'LOW' THEN 0.25 ELSE 0.1 END")


def xsum(expr):
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,6))) AS DOUBLE)"


DEDUP = """ded AS (SELECT * FROM vuln QUALIFY row_number() OVER (PARTITION BY service_name, cve_id
 ORDER BY cvss_v3_score DESC, advisory_id, source, epss_score, is_kev, published_at, severity) = 1)"""

VULN_FEATURES = f"""vs AS (SELECT service_name, count(*) AS n, {xsum('cvss_v3_score')} AS cvss,
 {xsum('epss_score')} AS epss, {xsum(ordinal('severity'))} AS ordinal, {xsum(decay('published_at'))} AS decay,
 count(*) FILTER (WHERE epss_score > 0.1::DOUBLE) AS likely, max(cvss_v3_score) AS top, max(is_kev) AS kev,
 count(*) FILTER (WHERE severity = 'CRITICAL') AS crit, count(*) FILTER (WHERE severity = 'HIGH') AS high,
 count(*) FILTER (WHERE severity = 'MEDIUM') AS med, count(*) FILTER (WHERE severity = 'LOW') AS low
 FROM ded GROUP BY service_name),
vf AS (SELECT service_name, {rnd('cvss / n / 10.0::DOUBLE', 4)} AS cvss_normalized,
 {rnd('likely / n', 4)} AS exploit_maturity_score, {rnd('epss / n', 4)} AS epss_score,
 {rnd('ordinal / n', 4)} AS severity_ordinal_norm, {rnd('decay / n', 4)} AS temporal_decay,
 CAST(n AS BIGINT) AS cve_count, {rnd('top', 1)} AS highest_cvss, CAST(kev AS BIGINT) AS is_kev_present,
 CAST(crit AS BIGINT) AS critical_cve_count, CAST(high AS BIGINT) AS high_cve_count,
 CAST(med AS BIGINT) AS medium_cve_count, CAST(low AS BIGINT) AS low_cve_count FROM vs)"""

INC_FEATURES = f"""isum AS (SELECT service_name,
 count(*) FILTER (WHERE lower(severity) IN {C.MAJOR_SEVERITIES}) AS majors,
 coalesce(CAST(sum(CAST(duration_minutes / 60.0::DOUBLE AS DECIMAL(18,4))) AS DOUBLE), 0) AS hours FROM inc
 WHERE started_at >= TIMESTAMP '{AS_OF}' - INTERVAL 365 DAYS GROUP BY service_name),
inf AS (SELECT service_name, {rnd('least(majors / 12.0::DOUBLE, 1.0::DOUBLE) * 0.6::DOUBLE + least(hours / 100.0::DOUBLE, 1.0::DOUBLE) * 0.4::DOUBLE', 4)}
 AS operational_risk_score, CAST(majors AS BIGINT) AS major_incident_count_12m,
 {rnd('hours', 2)} AS total_incident_hours_12m FROM isum)"""

REPO_LATEST = """rlast AS (SELECT * FROM repo QUALIFY row_number() OVER (PARTITION BY service_name
 ORDER BY collected_seq DESC) = 1)"""

REPO_FEATURES = f"""rf AS (SELECT service_name,
 {rnd('(least(commit_count_90d / 500.0::DOUBLE, 1.0::DOUBLE) * 0.5::DOUBLE + least(contributor_count_90d / 50.0::DOUBLE, 1.0::DOUBLE) * 0.5::DOUBLE) * 0.5::DOUBLE + greatest(0.0::DOUBLE, 1.0::DOUBLE - days_since_last_release / 365.0::DOUBLE) * 0.3::DOUBLE + has_security_policy * 0.2::DOUBLE', 4)}
 AS repo_maturity_score, {rnd('least(mean_days_close_security / 180.0::DOUBLE, 1.0::DOUBLE)', 4)} AS mean_sec_close_days_norm,
 {rnd('least(days_since_last_release / 365.0::DOUBLE, 1.0::DOUBLE)', 4)} AS days_since_release_norm,
 CAST(commit_count_90d AS BIGINT) AS commit_count_90d, CAST(contributor_count_90d AS BIGINT) AS contributor_count_90d,
 CAST(days_since_last_release AS BIGINT) AS days_since_release,
 CAST(has_security_policy AS BIGINT) AS has_security_policy FROM rlast)"""


def big(*cols):
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)


def with_(*ctes):
    return "WITH " + ",\n".join(ctes)


def in_list(words):
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def case_map(col, pairs, default):
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {col} {arms} ELSE {default} END"


def weights_ctes(policies="pol"):
    """Weight columns of each policy: fold of the framework changes, overrides, two normalisations."""
    d = C.FRAMEWORK_DELTAS
    start = "[" + ", ".join(f"{C.DEFAULT_WEIGHTS[x]!r}::DOUBLE" for x in C.DIMENSIONS) + "]"
    arms = " ".join(
        f"WHEN '{k}' THEN [" + ", ".join(
            f"greatest(0.0::DOUBLE, acc[{i + 1}] + ({v!r})::DOUBLE)" for i, v in enumerate(vals)) + "]"
        for k, vals in d.items())
    names = ["sec", "mat", "rel", "gov"]
    norm = lambda src: ", ".join(
        f"CASE WHEN t = 0 THEN 0.25::DOUBLE ELSE {rnd(f'{src}{n} / t', 6)} END AS n{n}" for n in names)
    return f"""steps AS (SELECT c_custkey, 0 AS i, {start} AS acc, fws, len(fws) AS n FROM {policies}
 UNION ALL SELECT c_custkey, i + 1, CASE fws[i + 1] {arms} ELSE acc END, fws, n FROM steps WHERE i < n),
w1 AS (SELECT c_custkey, acc[1] AS rsec, acc[2] AS rmat, acc[3] AS rrel, acc[4] AS rgov,
 acc[1] + acc[2] + acc[3] + acc[4] AS t FROM steps WHERE i = n),
w2 AS (SELECT c_custkey, {norm('r')} FROM w1),
w3 AS (SELECT p.c_custkey, o_sec IS NOT NULL AS has_over, nsec, nmat, nrel, ngov, coalesce(o_sec, nsec) AS xsec,
 nmat AS xmat, nrel AS xrel, coalesce(o_gov, ngov) AS xgov FROM w2 JOIN {policies} p USING (c_custkey)),
w4 AS (SELECT *, xsec + xmat + xrel + xgov AS t FROM w3),
w5 AS (SELECT c_custkey, {', '.join(f"CASE WHEN NOT has_over THEN n{n} WHEN t = 0 THEN 0.25::DOUBLE ELSE {rnd(f'x{n} / t', 6)} END AS w{n}" for n in names)} FROM w4)"""
