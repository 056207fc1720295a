"""Registered queries of the policy score family."""

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions import risk
from riskweave.operators import aggregates as A
from riskweave.operators import ranking as R
from riskweave.operators import scoring as S
from riskweave.operators import text as X
from riskweave.plans import flow
from riskweave.plans import oracle as O
from riskweave.sources import outputs, policies as P, tables as T

AS_OF = O.AS_OF
RUN = "run-1"
FRAMEWORKS = ["SOC2", "HIPAA", "license"]
CONTROLS = ["mfa_enforced", "network_segmentation", "badge_readers"]
# words that occur in the shared prose, beside some of the usual ones
DOC_WORDS = ("token", "license", "secret", "password", "the", "quei", "ouè")
GUIDE_WORDS = ("license", "copyright", "the ", "security", "ation", "nicht")
LEXICON = {"the": 0.2, "of": -0.1, "and": 0.1, "der": -0.3, "nicht": -1.5, "les": 0.4, "pour": 0.5, "error": -1.6}


def longs(df, *cols):
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


COUNTS = ("cve_count", "is_kev_present", "critical_cve_count", "high_cve_count", "medium_cve_count", "low_cve_count")


def vuln_features(spark, sf):
    return longs(A.vuln_features(T.vulnerabilities(spark, sf), AS_OF), *COUNTS)


def dedup_keep_highest(spark, sf):
    best = R.dedup_highest(T.vulnerabilities(spark, sf))
    return best.select("service_name", "cve_id", "advisory_id", "source", "cvss_v3_score")


def temporal_decay(spark, sf):
    v = T.vulnerabilities(spark, sf)
    return v.select("cve_id", "advisory_id", "service_name", risk.decay("published_at", AS_OF).alias("decay"),
                    risk.severity_ordinal("severity").alias("ordinal"))


def incident_features(spark, sf):
    return longs(A.incident_features(T.incidents(spark, sf), AS_OF), "major_incident_count_12m")


def latest_repo(spark, sf):
    repo = R.latest(T.repo_health(spark, sf), ["service_name"], ["collected_seq"])
    return longs(repo.select("service_name", "repo_full_name", "collected_seq", "open_issues"), "open_issues")


def repo_features(spark, sf):
    repo = R.latest(T.repo_health(spark, sf), ["service_name"], ["collected_seq"])
    return longs(S.repo_features(S.feature_view(repo)), "commit_count_90d", "contributor_count_90d",
                 "days_since_release", "has_security_policy")


def features(spark, sf):
    return flow.service_features(
        T.services(spark, sf), T.vulnerabilities(spark, sf), T.repo_health(spark, sf), T.incidents(spark, sf),
        T.documents(spark, sf), FRAMEWORKS, X.lexicon_frame(spark, LEXICON), AS_OF, RUN,
        repo_order=("collected_seq",), doc_terms=DOC_WORDS, guide_terms=GUIDE_WORDS)


def run_policy(spark, sf):
    """The policy of the run: the named frameworks and controls, under the first customer's name."""
    first = T.read_table(spark, "customer", sf).agg(F.min_by("c_name", "c_custkey").alias("org_name"))
    return first.select(
        "org_name", F.array(*[F.lit(f) for f in FRAMEWORKS]).alias("regulatory_frameworks"),
        F.array(*[F.lit(c) for c in CONTROLS]).alias("compensating_controls"),
        F.lit(None).cast("map<string,double>").alias("dimension_weight_overrides"))


def scores(spark, sf):
    return flow.policy_scores(features(spark, sf), run_policy(spark, sf), AS_OF)


SCORE_OUT = ("raw_score", "discounted_score", "final_risk_score", *[f"{d}_score" for d in C.DIMENSIONS])
INDEX_OUT = ("security_posture_index", "operational_maturity_index", "reliability_index", "governance_index",
             "kev_severity_index", "patch_velocity_index")
TEXT_OUT = ("doc_quality_score", "security_guidance_score", "trust_coverage_score", "incident_sentiment_score")


def service_risk_scores(spark, sf):
    """Ranked policy scores of every service."""
    s = scores(spark, sf)
    return s.select("service_name", *INDEX_OUT, *TEXT_OUT, "data_confidence", *SCORE_OUT, "active_controls",
                    "ospc_org_name").orderBy(F.col("final_risk_score").desc(), "service_name")


def service_features(spark, sf):
    f = features(spark, sf)
    return longs(f.select("service_name", *[c for c in A.VULN_ZEROS], *[c for c in S.REPO_ZEROS],
                          *[c for c in A.INCIDENT_ZEROS], *TEXT_OUT, "governance_composite", "data_confidence"),
                 *COUNTS, "major_incident_count_12m", "commit_count_90d", "contributor_count_90d",
                 "days_since_release", "has_security_policy")


def text_ctes():
    def hits(words, coll):
        return " + ".join(
            f"max(CASE WHEN collection = '{coll}' AND contains(low, '{w}') THEN 1 ELSE 0 END)" for w in sorted(words))

    fw = " + ".join(
        "max(CASE WHEN collection = 'trust_disclosures' AND (" + " OR ".join(f"contains(low, '{p}')" for p in ps)
        + ") THEN 1 ELSE 0 END)" for ps in X.framework_sets(FRAMEWORKS))
    lex = ", ".join(f"('{w}', {v})" for w, v in LEXICON.items())
    return f"""lo AS (SELECT *, lower(text) AS low FROM docs),
lex AS (SELECT * FROM (VALUES {lex}) t(word, valence)),
mood AS (SELECT service_name, doc_id, CAST(sum(CAST(valence AS DECIMAL(18,4))) AS DOUBLE) AS s FROM
 (SELECT service_name, doc_id, unnest(regexp_extract_all(low, '[a-z]+')) AS word FROM lo
  WHERE collection = 'incident_postmortems') JOIN lex USING (word) GROUP BY ALL),
msum AS (SELECT service_name, CAST(sum(CAST(s / sqrt(s * s + 15.0::DOUBLE) AS DECIMAL(18,9))) AS DOUBLE) AS cs
 FROM mood GROUP BY service_name),
tx AS (SELECT service_name, {hits(DOC_WORDS, 'documentation')} AS d, {hits(GUIDE_WORDS, 'advisory_text')} AS g,
 {fw} AS t, bool_or(collection <> 'incident_postmortems' AND length(text) > 0) AS has_docs,
 count(*) FILTER (WHERE collection = 'incident_postmortems' AND length(trim(text)) > 0) AS live
 FROM lo GROUP BY service_name),
tf AS (SELECT service_name, {O.rnd(f'd / {len(DOC_WORDS)}.0::DOUBLE', 4)} AS doc_quality_score,
 {O.rnd(f'g / {len(GUIDE_WORDS)}.0::DOUBLE', 4)} AS security_guidance_score,
 {O.rnd(f't / {len(FRAMEWORKS)}.0::DOUBLE', 4)} AS trust_coverage_score,
 CASE WHEN live > 0 THEN {O.rnd('greatest(0.0::DOUBLE, least(1.0::DOUBLE, (1.0::DOUBLE - coalesce(cs, 0) / live) / 2.0::DOUBLE))', 4)}
 ELSE 0.0 END AS incident_sentiment_score, has_docs FROM tx LEFT JOIN msum USING (service_name))"""


def feature_ctes():
    zero = lambda cols, t: ", ".join(f"coalesce({t}.{c}, {v}) AS {c}" for c, v in cols.items())
    gov = ("(1.0::DOUBLE - doc_quality_score) * 0.25::DOUBLE + (1.0::DOUBLE - security_guidance_score) * 0.25::DOUBLE + "
           "(1.0::DOUBLE - trust_coverage_score) * 0.25::DOUBLE + incident_sentiment_score * 0.25::DOUBLE")
    text = {c: 0.0 for c in TEXT_OUT}
    return [
        O.VULN, O.DEDUP, O.VULN_FEATURES, O.INC, O.INC_FEATURES, O.REPO, O.REPO_LATEST, O.REPO_FEATURES, O.DOCS, O.SVC,
        text_ctes(),
        f"""j AS (SELECT svc.service_name, {zero(A.VULN_ZEROS, 'vf')}, {zero(S.REPO_ZEROS, 'rf')},
 {zero(A.INCIDENT_ZEROS, 'inf')}, {zero(text, 'tf')}, rf.service_name IS NOT NULL AS has_repo,
 inf.service_name IS NOT NULL AS has_inc, coalesce(tf.has_docs, false) AS has_docs
 FROM svc LEFT JOIN vf USING (service_name) LEFT JOIN rf USING (service_name)
 LEFT JOIN inf USING (service_name) LEFT JOIN tf USING (service_name))""",
        f"""f AS (SELECT *, {O.rnd('greatest(0.0::DOUBLE, least(1.0::DOUBLE, ' + gov + '))', 4)} AS governance_composite,
 {O.rnd('cvss_normalized * 0.30::DOUBLE + exploit_maturity_score * 0.25::DOUBLE + epss_score * 0.20::DOUBLE + severity_ordinal_norm * 0.15::DOUBLE + (1.0::DOUBLE - temporal_decay) * 0.10::DOUBLE', 4)} AS security_posture_index,
 {O.rnd('repo_maturity_score * 0.50::DOUBLE + (1.0::DOUBLE - mean_sec_close_days_norm) * 0.30::DOUBLE + (1.0::DOUBLE - days_since_release_norm) * 0.20::DOUBLE', 4)} AS operational_maturity_index,
 operational_risk_score AS reliability_index,
 {O.rnd('is_kev_present * 0.6::DOUBLE + least(CAST(critical_cve_count AS DOUBLE) / greatest(cve_count, 1), 1.0::DOUBLE) * 0.4::DOUBLE', 4)} AS kev_severity_index,
 {O.rnd('(1.0::DOUBLE - mean_sec_close_days_norm) * 0.7::DOUBLE + has_security_policy * 0.3::DOUBLE', 4)} AS patch_velocity_index,
 CASE (CASE WHEN cve_count >= 3 THEN 1 ELSE 0 END) + has_repo::INT + has_inc::INT + has_docs::INT
 WHEN 4 THEN 'full_data' WHEN 3 THEN 'partial_data' WHEN 2 THEN 'partial_data' ELSE 'insufficient_data' END
 AS data_confidence FROM j)""",
    ]


def run_weights():
    """Weights of the run's policy, folded in Python from the fixed changes (a constant of the query)."""
    w = list(C.DEFAULT_WEIGHTS.values())
    for f in FRAMEWORKS:
        if f in C.FRAMEWORK_DELTAS:
            w = [max(0.0, a + b) for a, b in zip(w, C.FRAMEWORK_DELTAS[f])]
    return [round(x / sum(w), 6) for x in w]


def score_ctes():
    w = run_weights()
    idx = ("security_posture_index", "operational_maturity_index", "reliability_index", "governance_composite")
    dims = ", ".join(f"{O.rnd(f'{i} * {x!r}::DOUBLE * 100.0::DOUBLE', 1)} AS {d}_score"
                     for i, x, d in zip(idx, w, C.DIMENSIONS))
    raw = " + ".join(f"{x!r}::DOUBLE * {i}" for i, x in zip(idx, w))
    disc = "raw_score"
    for c in CONTROLS:
        disc = f"{disc} * (1.0::DOUBLE - {C.CONTROL_RATES.get(c, 0.0)!r}::DOUBLE)"
    return feature_ctes() + [
        f"s1 AS (SELECT *, governance_composite AS governance_index, {dims}, {O.rnd(f'({raw}) * 100.0::DOUBLE', 1)} AS raw_score FROM f)",
        f"s2 AS (SELECT *, {O.rnd(disc, 1)} AS discounted_score FROM s1)",
        f"""s3 AS (SELECT *, {O.rnd("greatest(0.0::DOUBLE, least(100.0::DOUBLE, CASE WHEN data_confidence = 'insufficient_data' THEN " + O.rnd('discounted_score * 0.75::DOUBLE', 1) + " ELSE discounted_score END))", 1)} AS final_risk_score,
 '{','.join(CONTROLS)}' AS active_controls, (SELECT arg_min(c_name, c_custkey) FROM customer) AS ospc_org_name FROM s2)""",
    ]


def run_policies(spark, sf):
    """One policy per run: each nation is a run under the policy of its first customer."""
    pol = T.policies(spark, sf).join(
        T.read_table(spark, "customer", sf).select(F.col("c_name").alias("org_name"), "c_custkey", "c_nationkey"),
        "org_name")
    firsts = R.first_seen(pol.drop("service_tiers", "dimension_weight_overrides"), ["c_nationkey"], ["c_custkey"])
    extra = T.policies(spark, sf).select("org_name", "service_tiers", "dimension_weight_overrides")
    return firsts.join(extra, "org_name").withColumn(
        "run_id", F.concat(F.lit("run-"), F.col("c_nationkey").cast("string"))).drop("c_custkey", "c_nationkey")


def service_runs(spark, sf):
    return T.read_table(spark, "supplier", sf).select(
        F.col("s_name").alias("service_name"),
        F.concat(F.lit("run-"), F.col("s_nationkey").cast("string")).alias("run_id"),
        (F.pmod(F.floor("s_acctbal"), F.lit(97)) / 97.0).alias("security_posture_index"),
        (F.pmod(F.floor("s_acctbal"), F.lit(89)) / 89.0).alias("operational_maturity_index"),
        (F.pmod(F.floor("s_acctbal"), F.lit(83)) / 83.0).alias("reliability_index"),
        (F.pmod(F.floor("s_acctbal"), F.lit(79)) / 79.0).alias("governance_index"),
        F.when(F.col("s_suppkey") % 5 == 0, "insufficient_data").otherwise("full_data").alias("data_confidence"))


def controls_discount(spark, sf):
    """Scores of services under the policy of their run."""
    s = S.score(service_runs(spark, sf), run_policies(spark, sf), AS_OF)
    return s.select("service_name", "run_id", "ospc_org_name", "active_controls", *SCORE_OUT)


def weight_composition(spark, sf):
    w = S.compose_weights(T.policies(spark, sf))
    return w.select("org_name", *[f"w_{d}" for d in C.DIMENSIONS])


def tier_attach(spark, sf):
    t = S.attach_tier(service_runs(spark, sf).select("service_name", "run_id"), run_policies(spark, sf))
    return t.select("service_name", "run_id", "org_name", F.col("service_tier").cast("bigint").alias("service_tier"))


def raw_policies(spark, sf):
    """Policies with the faults that validation has to find."""
    p = T.policies(spark, sf)
    key = F.substring("org_name", 10, 9).cast("bigint")
    return p.withColumns({
        "org_key": F.col("org_name"),
        "compensating_controls": F.when(key % 11 != 0, F.col("compensating_controls")),
        "org_name": F.when(key % 13 == 0, F.lit("")).otherwise(F.col("org_name")),
        "dimension_weight_overrides": F.when(key % 17 == 0, F.create_map(F.lit("governance"), F.lit(1.5)))
        .otherwise(F.col("dimension_weight_overrides"))})


def policy_validation(spark, sf):
    good, bad = P.check_policies(raw_policies(spark, sf))
    return good.select("org_key", F.lit("").alias("violations")).unionByName(
        bad.select("org_key", F.array_join("violations", ",").alias("violations")))


def data_confidence(spark, sf):
    return A.confidence_breakdown(features(spark, sf))


def run_manifest(spark, sf):
    m = outputs.manifest(features(spark, sf), RUN, AS_OF, "/features")
    return m


def manifest_services(spark, sf):
    return outputs.manifest_services(T.services(spark, sf), RUN)


def run_summary(spark, sf):
    return A.run_summary(scores(spark, sf))


def score_table(spark, sf):
    """The stored score rows; decimals as doubles and the time as text for comparison."""
    t = S.to_score_table(scores(spark, sf))
    out = []
    for f in t.schema.fields:
        kind = f.dataType.simpleString()
        c = F.col(f.name)
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "int":
            c = c.cast("bigint")
        elif kind == "timestamp_ntz":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return t.select(*out)


QUERIES = {f.__name__: f for f in (
    service_risk_scores, service_features, vuln_features, dedup_keep_highest, temporal_decay, incident_features,
    latest_repo, repo_features, controls_discount, weight_composition, tier_attach, policy_validation,
    data_confidence, run_manifest, manifest_services, run_summary, score_table)}


def oracles():
    base = [O.VULN, O.DEDUP, O.VULN_FEATURES]
    vf = O.with_(*base)
    feats = O.with_(*feature_ctes())
    scored = O.with_(*score_ctes())
    cols = lambda names: ", ".join(names)
    firsts = """fp AS (SELECT * FROM pol QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) = 1)"""
    runs = """sr AS (SELECT s_name AS service_name, 'run-' || CAST(s_nationkey AS VARCHAR) AS run_id, s_nationkey,
 (floor(s_acctbal)::BIGINT % 97 + 97) % 97 / 97.0::DOUBLE AS a, (floor(s_acctbal)::BIGINT % 89 + 89) % 89 / 89.0::DOUBLE AS b,
 (floor(s_acctbal)::BIGINT % 83 + 83) % 83 / 83.0::DOUBLE AS c, (floor(s_acctbal)::BIGINT % 79 + 79) % 79 / 79.0::DOUBLE AS d,
 s_suppkey % 5 = 0 AS thin, s_suppkey FROM supplier)"""
    rate = "CASE x " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in C.CONTROL_RATES.items()) + " ELSE 0.0::DOUBLE END"
    prod = f"list_reduce(list_prepend(raw_score, list_transform(ctls, lambda x: 1.0::DOUBLE - {rate})), lambda p, q: p * q)"
    dims = ", ".join(f"{O.rnd(f'{i} * {w} * 100.0::DOUBLE', 1)} AS {d}_score" for i, w, d in zip(
        "abcd", ("wsec", "wmat", "wrel", "wgov"), C.DIMENSIONS))
    ctl = "WITH RECURSIVE " + ",\n".join([
        O.policy_view(), O.weights_ctes(), firsts, runs,
        f"""q1 AS (SELECT service_name, run_id, org_name AS ospc_org_name, array_to_string(ctls, ',') AS active_controls,
 ctls, thin, {dims}, {O.rnd('(wsec * a + wmat * b + wrel * c + wgov * d) * 100.0::DOUBLE', 1)} AS raw_score
 FROM sr JOIN fp ON s_nationkey = c_nationkey JOIN w5 USING (c_custkey))""",
        f"q2 AS (SELECT *, {O.rnd(prod, 1)} AS discounted_score FROM q1)"]) + f"""
SELECT service_name, run_id, ospc_org_name, active_controls, {', '.join(f'{d}_score' for d in C.DIMENSIONS)}, raw_score,
 discounted_score, CASE WHEN thin THEN {O.rnd('discounted_score * 0.75::DOUBLE', 1)} ELSE discounted_score END AS final_risk_score
FROM q2"""
    table = []
    for c, t in C.SCORE_TABLE:
        if c == "scored_at":
            table.append(f"'{AS_OF}' AS scored_at")
        elif c == "run_id":
            table.append(f"'{RUN}' AS run_id")
        elif c in ("vendor", "ecosystem"):
            table.append(f"{'service_name' if c == 'vendor' else chr(39) + 'SaaS' + chr(39)} AS {c}")
        elif t == "int":
            table.append(f"CAST({c} AS BIGINT) AS {c}")
        elif t.startswith("decimal"):
            table.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            table.append(c)
    return {
        "vuln_features": vf + " SELECT * FROM vf",
        "dedup_keep_highest": O.with_(O.VULN, O.DEDUP)
        + " SELECT service_name, cve_id, advisory_id, source, cvss_v3_score FROM ded",
        "temporal_decay": O.with_(O.VULN) + f""" SELECT cve_id, advisory_id, service_name,
 {O.decay('published_at')} AS decay, CAST({O.ordinal('severity')} AS DOUBLE) AS ordinal FROM vuln""",
        "incident_features": O.with_(O.INC, O.INC_FEATURES) + " SELECT * FROM inf",
        "latest_repo": O.with_(O.REPO, O.REPO_LATEST)
        + " SELECT service_name, repo_full_name, collected_seq, CAST(open_issues AS BIGINT) AS open_issues FROM rlast",
        "repo_features": O.with_(O.REPO, O.REPO_LATEST, O.REPO_FEATURES) + " SELECT * FROM rf",
        "service_features": feats + f""" SELECT service_name, {cols(A.VULN_ZEROS)}, {cols(S.REPO_ZEROS)},
 {cols(A.INCIDENT_ZEROS)}, {cols(TEXT_OUT)}, governance_composite, data_confidence FROM f""",
        "service_risk_scores": scored + f""" SELECT service_name, {cols(INDEX_OUT)}, {cols(TEXT_OUT)},
 data_confidence, {cols(SCORE_OUT)}, active_controls, ospc_org_name FROM s3
 ORDER BY final_risk_score DESC, service_name""",
        "score_table": scored + " SELECT " + ", ".join(table) + " FROM s3",
        "run_summary": scored + f""" SELECT count(*) AS services_scored,
 {O.rnd('CAST(sum(CAST(final_risk_score AS DECIMAL(18,6))) AS DOUBLE) / count(*)', 1)} AS avg_final_score,
 count(*) FILTER (WHERE is_kev_present = 1) AS kev_services,
 count(*) FILTER (WHERE data_confidence = 'insufficient_data') AS insufficient_data_services FROM s3""",
        "data_confidence": feats + """ SELECT count(*) FILTER (WHERE data_confidence = 'full_data') AS full_data,
 count(*) FILTER (WHERE data_confidence = 'partial_data') AS partial_data,
 count(*) FILTER (WHERE data_confidence = 'insufficient_data') AS insufficient_data FROM f""",
        "run_manifest": feats + f""" SELECT '{RUN}' AS run_id, '{AS_OF}' AS etl_completed_at, count(*) AS service_count,
 count(*) FILTER (WHERE data_confidence = 'full_data') AS full_data,
 count(*) FILTER (WHERE data_confidence = 'partial_data') AS partial_data,
 count(*) FILTER (WHERE data_confidence = 'insufficient_data') AS insufficient_data,
 '/features' AS output_path FROM f""",
        "manifest_services": f"SELECT '{RUN}' AS run_id, s_name AS service_name FROM supplier",
        "weight_composition": "WITH RECURSIVE " + O.policy_view() + ",\n" + O.weights_ctes() + """
 SELECT org_name, wsec AS w_security_posture, wmat AS w_operational_maturity, wrel AS w_service_reliability,
 wgov AS w_governance FROM w5 JOIN pol USING (c_custkey)""",
        "controls_discount": ctl,
        "tier_attach": O.with_(O.policy_view(), firsts, runs) + """ SELECT service_name, run_id, org_name,
 CAST(CASE WHEN s_suppkey = tier_key THEN tier END AS BIGINT) AS service_tier
 FROM sr JOIN fp ON s_nationkey = c_nationkey""",
        "policy_validation": """SELECT c_name AS org_key, concat_ws(',', CASE WHEN c_custkey % 13 = 0 THEN 'org_name' END,
 CASE WHEN c_custkey % 11 = 0 THEN 'compensating_controls' END,
 CASE WHEN c_custkey % 4 = 0 THEN 'service_tiers' END,
 CASE WHEN c_custkey % 17 = 0 THEN 'dimension_weight_overrides' END) AS violations FROM customer""",
    }
