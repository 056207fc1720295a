import datetime
import math
import random

import pytest
from conftest import AS_OF, ago, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions import risk
from riskweave.functions.rounding import round_exact
from riskweave.operators import aggregates as A
from riskweave.operators import ranking as R
from riskweave.operators import scoring as S
from riskweave.operators import text as X
from riskweave.plans import flow
from riskweave.sources import policies as P

VULN = ("service_name string, cve_id string, advisory_id string, source string, cvss_v3_score double, epss_score double,"
        " severity string, is_kev int, published_at timestamp_ntz")
CASES = {
    "sample": [(9.8, .85, "CRITICAL", 30, 1), (7.2, .12, "HIGH", 500, 0), (4.5, .03, "MEDIUM", 30, 0)],
    "stripe": [(8.5, .30, "HIGH", 30, 0), (9.1, .75, "CRITICAL", 30, 1)],
    "requests": [(5.0, .05, "MEDIUM", 500, 0)],
}
REPOS = {"sample": (120, 15, 45, 1, 14.0), "stripe": (200, 25, 10, 1, 7.0), "requests": (50, 8, 90, 1, 30.0)}
INCIDENTS = {"sample": [("critical", 4.5), ("major", 1.0), ("minor", .25)], "stripe": [("major", 2.0)]}


@pytest.fixture(scope="module")
def inputs(spark):
    v = [(s, f"CVE-{s}-{i}", f"A-{s}-{i}", "nvd", c, e, sev, k, ago(d))
         for s, vs in CASES.items() for i, (c, e, sev, d, k) in enumerate(vs)]
    r = [(s, *x, 1) for s, x in REPOS.items()]
    i = [(s, f"{s}-{n}", sev, h, ago(10)) for s, xs in INCIDENTS.items() for n, (sev, h) in enumerate(xs)]
    return dict(
        services=spark.createDataFrame([(s, s, "SaaS", None) for s in (*CASES, "empty-svc")],
                                       "service_name string, vendor string, ecosystem string, github_repo string"),
        vulns=spark.createDataFrame(v, VULN),
        repo=spark.createDataFrame(r, "service_name string, commit_count_90d int, contributor_count_90d int,"
                                      " days_since_last_release int, has_security_policy int,"
                                      " mean_days_close_security double, collected_at int"),
        incidents=spark.createDataFrame(i, "service_name string, incident_id string, severity string,"
                                           " duration_hours double, started_at timestamp_ntz"),
        docs=spark.createDataFrame([], "doc_id bigint, service_name string, collection string, text string"))


@pytest.fixture(scope="module")
def features(spark, inputs):
    df = flow.service_features(**inputs, frameworks=[], lexicon=X.lexicon_frame(spark), as_of=AS_OF, run_id="r")
    return {r["service_name"]: r.asDict() for r in df.collect()}


GOLDEN = {
    "cvss_normalized": (.7167, .88, .5, 0), "exploit_maturity_score": (.6667, 1.0, 0, 0),
    "epss_score": (.3333, .525, .05, 0), "severity_ordinal_norm": (.75, .875, .5, 0),
    "temporal_decay": (.7587, .9446, .3869, 0), "repo_maturity_score": (.598, .7168, .491, 0),
    "mean_sec_close_days_norm": (.0778, .0389, .1667, 0), "days_since_release_norm": (.1233, .0274, .2466, 0),
    "operational_risk_score": (.123, .058, 0, 0), "major_incident_count_12m": (2, 1, 0, 0),
    "total_incident_hours_12m": (5.75, 2.0, 0, 0), "security_posture_index": (.585, .7558, .2963, .1),
    "operational_maturity_index": (.751, .8413, .6462, .5), "kev_severity_index": (.7333, .8, 0, 0),
    "patch_velocity_index": (.9455, .9728, .8833, .7),
}


@pytest.mark.parametrize("column", GOLDEN)
def test_feature_goldens(features, column):
    got = [features[s][column] for s in ("sample", "stripe", "requests", "empty-svc")]
    assert got == pytest.approx(GOLDEN[column], abs=1e-9)


def test_empty_service_has_release_default_and_thin_data(features):
    assert features["empty-svc"]["days_since_release"] == 999
    assert features["empty-svc"]["data_confidence"] == "insufficient_data"
    assert features["sample"]["data_confidence"] == "partial_data"


def test_rounding_is_that_of_the_exact_value(spark):
    xs = [2.675, 0.25, 0.35, 27.749999999999996, 1.005, 2.5, -2.675, 0.71665] + [random.Random(1).random() * 100 for _ in range(500)]
    xs += [i / 20000 for i in range(2000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (1, 2, 4, 6):
        assert all(r == round(x, d) for x, r in rows(df.select("x", round_exact("x", d))))


def test_decay(spark):
    ages = [1, 30, 180, 365, 500, 730, -1, None]
    df = spark.createDataFrame([(a, ago(a)) for a in ages], "a int, t timestamp_ntz")
    got = dict(rows(df.select("a", risk.decay("t", AS_OF))))
    assert got == {1: .9981, 30: .9446, 180: .7105, 365: .5, 500: .3869, 730: .25, -1: 1.0019, None: .5}


def test_days_are_floored(spark):
    df = spark.createDataFrame([(ago(-1) - datetime.timedelta(hours=23),), (ago(1) + datetime.timedelta(seconds=1),)], "t timestamp_ntz")
    assert [r[0] for r in rows(df.select(risk.age_days("t", AS_OF)))] == [-1, 0]


POLICY = "org_name string, regulatory_frameworks array<string>, compensating_controls array<string>, dimension_weight_overrides map<string,double>"


def weights(spark, frameworks, overrides=None):
    df = spark.createDataFrame([("o", frameworks, [], overrides)], POLICY)
    return rows(S.compose_weights(df), *[f"w_{d}" for d in C.DIMENSIONS])[0]


@pytest.mark.parametrize("frameworks,overrides,want", [
    ([], None, (.4, .25, .2, .15)),
    (["SOC2"], None, (.35, .27, .18, .20)),
    (["SOC2", "PCI-DSS", "HIPAA"], None, (.48, .14, .07, .31)),
    (["SOC2", "PCI-DSS", "HIPAA", "ISO27001", "GDPR", "FedRAMP"], None, (.5625, 0, 0, .4375)),
    ([], {"security_posture": .6}, (.5, .208333, .166667, .125)),
    (["SOC2", "ISO27001"], {"security_posture": .5, "governance": .2}, (.46729, .205607, .140187, .186916)),
    ([], {d: 0.0 for d in C.DIMENSIONS}, (.25, .25, .25, .25)),
    (None, {"other": .9}, (.4, .25, .2, .15)),
])
def test_weights(spark, frameworks, overrides, want):
    assert weights(spark, frameworks, overrides) == pytest.approx(want, abs=1e-6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([*C.FRAMEWORK_DELTAS, "other"]), max_size=8), min_size=1, max_size=8))
def test_weights_follow_the_fold(spark, lists):
    df = spark.createDataFrame([(str(i), f, [], None) for i, f in enumerate(lists)], POLICY)
    for name, *got in rows(S.compose_weights(df), "org_name", *[f"w_{d}" for d in C.DIMENSIONS]):
        w = list(C.DEFAULT_WEIGHTS.values())
        for f in lists[int(name)]:
            w = [max(0.0, a + b) for a, b in zip(w, C.FRAMEWORK_DELTAS.get(f, (0, 0, 0, 0)))]
        assert got == pytest.approx([x / sum(w) for x in w], abs=1e-6)
        assert sum(got) == pytest.approx(1, abs=5e-6)


def score(spark, frameworks, controls, confidence):
    f = spark.createDataFrame([("r", "s", .78, .72, .30, .30, confidence)],
                              "run_id string, service_name string, security_posture_index double, operational_maturity_index double,"
                              " reliability_index double, governance_index double, data_confidence string")
    p = S.bind_policies(spark.createDataFrame([("org", frameworks, controls, None)], POLICY), "r")
    return S.score(f, p, AS_OF).collect()[0]


@pytest.mark.parametrize("frameworks,controls,confidence,dims,raw,discounted,final", [
    ([], [], "full_data", (31.2, 18.0, 6.0, 4.5), 59.7, 59.7, 59.7),
    ([], [], "insufficient_data", (31.2, 18.0, 6.0, 4.5), 59.7, 59.7, 44.8),
    ([], [], None, (31.2, 18.0, 6.0, 4.5), 59.7, 59.7, 44.8),
    (["SOC2"], ["mfa_enforced"], "full_data", (27.3, 19.4, 5.4, 6.0), 58.1, 55.2, 55.2),
    (["SOC2"], ["mfa_enforced"], "insufficient_data", (27.3, 19.4, 5.4, 6.0), 58.1, 55.2, 41.4),
    ([], ["mfa_enforced", "network_segmentation", "made_up"], "full_data", (31.2, 18.0, 6.0, 4.5), 59.7, 55.0, 55.0),
])
def test_scores(spark, frameworks, controls, confidence, dims, raw, discounted, final):
    r = score(spark, frameworks, controls, confidence)
    assert tuple(r[f"{d}_score"] for d in C.DIMENSIONS) == dims
    assert (r["raw_score"], r["discounted_score"], r["final_risk_score"]) == (raw, discounted, final)
    assert r["active_controls"] == ",".join(controls)


def test_all_controls_multiply(spark):
    df = spark.createDataFrame([(list(C.CONTROL_RATES),)], "c array<string>")
    assert rows(df.select(S.discounted(F.lit(1.0), F.col("c"))))[0][0] == pytest.approx(.7993964, abs=1e-7)


def test_empty_service_scores_20_8(spark, inputs, features):
    row = {k: v for k, v in features["empty-svc"].items() if k.endswith("_index") or k in ("run_id", "service_name", "data_confidence")}
    f = spark.createDataFrame([row])
    p = S.bind_policies(spark.createDataFrame([("org", [], [], None)], POLICY), "r")
    r = S.score(f, p, AS_OF).collect()[0]
    assert (r["raw_score"], r["final_risk_score"]) == (27.7, 20.8)


def test_score_table_types(spark, inputs):
    f = flow.service_features(**inputs, frameworks=["SOC2"], lexicon=X.lexicon_frame(spark), as_of=AS_OF, run_id="r")
    p = S.bind_policies(spark.createDataFrame([("org", ["SOC2"], ["mfa_enforced"], None)], POLICY), "r")
    t = S.to_score_table(S.score(f, p, AS_OF))
    assert [(n, d) for n, d in t.dtypes] == [(n, d) for n, d in C.SCORE_TABLE]
    assert len(t.columns) == 31 and t.count() == 4


def test_dedup_keeps_highest_and_every_row_without_id(spark):
    v = spark.createDataFrame([
        ("s", "CVE-1", "a", "n", 5.0, None, "HIGH", 0, None), ("s", "CVE-1", "b", "n", 7.0, None, "HIGH", 0, None),
        ("s", "CVE-1", "c", "n", None, None, "HIGH", 0, None), ("s", None, "d", "n", 1.0, None, None, None, None),
        ("s", None, "d", "n", 1.0, None, None, None, None), ("s", "", "e", "n", 1.0, None, "LOW", 0, None)], VULN)
    assert sorted(r[0] for r in rows(R.dedup_highest(v), "advisory_id")) == ["b", "d", "d", "e"]
    f = A.vuln_features(v, AS_OF).collect()[0]
    assert (f["cve_count"], f["cvss_normalized"], f["temporal_decay"], f["severity_ordinal_norm"]) == (4, .25, .5, .3)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["C1", "C2", None]), st.sampled_from([None, 1.0, 5.0, 9.0])),
                min_size=1, max_size=20), st.randoms())
def test_dedup_does_not_depend_on_row_order(spark, items, rnd):
    table = [(s, c, f"adv{i}", "n", x, .1, "LOW", 0, None) for i, (s, c, x) in enumerate(items)]
    mixed = list(table)
    rnd.shuffle(mixed)
    one, two = (sorted(rows(R.dedup_highest(spark.createDataFrame(t, VULN)), "advisory_id")) for t in (table, mixed))
    assert one == two
    best = {}
    for s, c, adv, _, x, *_ in table:
        key = (s, c) if c else (s, adv)
        if key not in best or (-(x or 0), adv) < best[key]:
            best[key] = (-(x or 0), adv)
    assert one == sorted((adv,) for _, adv in best.values())


def test_hot_key_is_cut_before_the_shuffle(spark):
    v = spark.createDataFrame([("s", "C", "a", "n", 1.0, .1, "LOW", 0, None)], VULN)
    plan = R.dedup_highest(v)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("n,repo,inc,docs,want", [
    (3, True, True, True, "full_data"), (2, True, True, True, "partial_data"), (3, True, False, False, "partial_data"),
    (2, True, False, False, "insufficient_data"), (0, False, False, False, "insufficient_data")])
def test_confidence(spark, n, repo, inc, docs, want):
    df = spark.createDataFrame([(n, repo, inc, docs)], "cve_count int, has_repo boolean, has_incidents boolean, has_docs boolean")
    assert rows(S.data_confidence(df), "data_confidence") == [(want,)]


@pytest.mark.parametrize("signals,want", [((0, 0, 0, 0), .75), ((1, 1, 1, 0), 0.0), ((0, 0, 0, 1), 1.0), ((.5, .25, .75, .4), .475)])
def test_governance(spark, signals, want):
    df = spark.createDataFrame([tuple(map(float, signals))], "doc_quality_score double, security_guidance_score double,"
                               " trust_coverage_score double, incident_sentiment_score double")
    assert rows(S.governance(df), "governance_composite")[0][0] == pytest.approx(want)


def test_policy_rules(spark):
    good = ("o", ["x"], [], {"s": 3}, {"governance": 1.0}, None)
    bad = ("", None, None, {"s": 4}, {"governance": 1.1}, None)
    ok, rejected = P.check_policies(spark.createDataFrame([good, bad], P.POLICY))
    assert ok.count() == 1
    assert rejected.collect()[0]["violations"] == [
        "org_name", "regulatory_frameworks", "compensating_controls", "service_tiers", "dimension_weight_overrides"]


def test_incident_minutes_use_four_decimal_hours(spark):
    df = spark.createDataFrame([("s", "HIGH", 1, ago(1))] * 3 + [("s", None, None, ago(1)), ("s", "p1", 60, ago(400)), ("s", "low", 5, None)],
                               "service_name string, severity string, duration_minutes int, started_at timestamp_ntz")
    r = A.incident_features(df, AS_OF).collect()[0]
    assert (r["major_incident_count_12m"], r["total_incident_hours_12m"]) == (3, .05)


def test_repo_defaults(spark):
    df = spark.createDataFrame([("s", None, None, None, None, None)], "service_name string, commit_count_90d int,"
                               " contributor_count_90d int, days_since_release int, has_security_policy int, mean_sec_close_days double")
    r = S.repo_features(df).collect()[0]
    assert (r["mean_sec_close_days_norm"], r["days_since_release_norm"], r["repo_maturity_score"], r["days_since_release"]) == (.5, 1.0, 0.0, 999)


def test_decay_formula_matches_python(spark):
    df = spark.createDataFrame([(d, ago(d)) for d in range(0, 900, 37)], "a int, t timestamp_ntz")
    for a, got in rows(df.select("a", risk.decay("t", AS_OF))):
        assert got == round(math.exp(-math.log(2) * a / 365), 4)


def test_one_run_and_joined_scores_agree(spark, inputs):
    f = flow.service_features(**inputs, frameworks=["SOC2"], lexicon=X.lexicon_frame(spark), as_of=AS_OF, run_id="r")
    p = spark.createDataFrame([("org", ["SOC2", "GDPR"], ["waf_deployed"], {"governance": .4})], POLICY)
    joined = S.score(f, S.bind_policies(p, "r"), AS_OF)
    single = flow.policy_scores(f, p, AS_OF)
    cols = ("service_name", "raw_score", "final_risk_score", "ospc_org_name", "active_controls")
    assert sorted(rows(joined, *cols)) == sorted(rows(single, *cols))
    assert "Nested" not in single._jdf.queryExecution().executedPlan().toString()
