"""Policy score: repository features, indices, confidence, weights, controls, final score."""

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.coerce import literal_map, safe_num
from riskweave.functions.risk import as_of_lit
from riskweave.functions.rounding import clamp, round_exact
from riskweave.operators.joins import fragment_join

REPO_ZEROS = {
    "repo_maturity_score": 0.0, "mean_sec_close_days_norm": 0.0, "days_since_release_norm": 0.0,
    "commit_count_90d": 0, "contributor_count_90d": 0, "days_since_release": 999,
    "has_security_policy": 0,
}


def repo_features(repo):
    """Maturity inputs from one repository row per service."""
    safe = repo.select(
        "service_name",
        safe_num("commit_count_90d", "int").alias("commit_count_90d"),
        safe_num("contributor_count_90d", "int").alias("contributor_count_90d"),
        safe_num("days_since_release", "int", 999).alias("days_since_release"),
        safe_num("has_security_policy", "int").alias("has_security_policy"),
        safe_num("mean_sec_close_days", "double", 90.0).alias("close"))
    one = F.lit(1.0)
    activity = (F.least(F.col("commit_count_90d") / 500.0, one) * 0.5
                + F.least(F.col("contributor_count_90d") / 50.0, one) * 0.5)
    age = F.col("days_since_release") / 365.0
    raw = safe.withColumns({
        "m": activity * 0.5 + F.greatest(F.lit(0.0), one - age) * 0.3 + F.col("has_security_policy") * 0.2,
        "c": F.least(F.col("close") / 180.0, one), "r": F.least(age, one)})
    return raw.select(
        "service_name", round_exact("m", 4).alias("repo_maturity_score"),
        round_exact("c", 4).alias("mean_sec_close_days_norm"),
        round_exact("r", 4).alias("days_since_release_norm"),
        "commit_count_90d", "contributor_count_90d", "days_since_release", "has_security_policy")


def feature_view(repo):
    """Source column names of repository health to those of the features."""
    return repo.select(
        "service_name", "commit_count_90d", "contributor_count_90d",
        F.col("days_since_last_release").alias("days_since_release"), "has_security_policy",
        F.col("mean_days_close_security").alias("mean_sec_close_days"))


def rounded(df, digits, **formulas):
    """Add SQL formulas as columns, each rounded on its own exact value."""
    raw = df.withColumns({f"_x_{n}": F.expr(f) for n, f in formulas.items()})
    return raw.withColumns({n: round_exact(f"_x_{n}", digits) for n in formulas}).drop(*[f"_x_{n}" for n in formulas])


def governance(df, name="governance_composite"):
    """Mean of the four text signals as risk; higher is worse."""
    return rounded(df, 4, **{name: (
        "greatest(0D, least(1D, (1D - doc_quality_score) * 0.25D + (1D - security_guidance_score) * 0.25D"
        " + (1D - trust_coverage_score) * 0.25D + incident_sentiment_score * 0.25D))")})


POSTURE = ("cvss_normalized * 0.30D + exploit_maturity_score * 0.25D + epss_score * 0.20D"
           " + severity_ordinal_norm * 0.15D + (1D - temporal_decay) * 0.10D")
MATURITY = ("repo_maturity_score * 0.50D + (1D - mean_sec_close_days_norm) * 0.30D"
            " + (1D - days_since_release_norm) * 0.20D")
KEV_SEVERITY = ("is_kev_present * 0.6D"
                " + least(CAST(critical_cve_count AS DOUBLE) / greatest(cve_count, 1), 1D) * 0.4D")
PATCH_VELOCITY = "(1D - mean_sec_close_days_norm) * 0.7D + has_security_policy * 0.3D"


def posture_index(df):
    return rounded(df, 4, security_posture_index=POSTURE)


def maturity_index(df, maturity_as_risk=False):
    """Higher is better as the index formula has it; `maturity_as_risk` flips the sign."""
    return rounded(df, 4, operational_maturity_index=f"1D - ({MATURITY})" if maturity_as_risk else MATURITY)


def aux_indices(df):
    """Reliability, exploited-severity and patch-velocity indices."""
    out = rounded(df, 4, kev_severity_index=KEV_SEVERITY, patch_velocity_index=PATCH_VELOCITY)
    return out.withColumn("reliability_index", F.col("operational_risk_score"))


def all_indices(df, maturity_as_risk=False):
    """The six indices in two projections; governance must be there."""
    out = rounded(
        df, 4, security_posture_index=POSTURE, kev_severity_index=KEV_SEVERITY, patch_velocity_index=PATCH_VELOCITY,
        operational_maturity_index=f"1D - ({MATURITY})" if maturity_as_risk else MATURITY)
    return out.withColumns({"reliability_index": F.col("operational_risk_score"),
                            "governance_index": F.col("governance_composite")})


def data_confidence(df, min_cves=C.MIN_CVES_FULL):
    """Of four kinds of data: all present is full, two or three partial, fewer insufficient."""
    present = ((F.col("cve_count") >= min_cves).cast("int") + F.col("has_repo").cast("int")
               + F.col("has_incidents").cast("int") + F.col("has_docs").cast("int"))
    return df.withColumn("data_confidence", F.when(present == 4, "full_data").when(present >= 2, "partial_data")
                         .otherwise("insufficient_data"))


# -- weights ---------------------------------------------------------------------------------------


def _normalise_columns(df, cols):
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    even = F.lit(round(1.0 / len(cols), 6))
    df = df.withColumn("_t", total).withColumns({f"_q_{c}": F.try_divide(F.col(c), F.col("_t")) for c in cols})
    return df.withColumns({
        c: F.when(F.col("_t") == 0, even).otherwise(round_exact(f"_q_{c}", 6)) for c in cols
    }).drop("_t", *[f"_q_{c}" for c in cols])


def delta_map():
    return F.create_map(*[x for name, d in C.FRAMEWORK_DELTAS.items()
                          for x in (F.lit(name), F.array(*[F.lit(v) for v in d]))])


def compose_weights(policies):
    """Weight columns `w_<dimension>` per policy.

    Framework changes are folded in list order with a floor of 0 after each, then normalised;
    overrides of known dimensions follow and are normalised again.
    """
    dims = C.DIMENSIONS
    start = F.struct(*[F.lit(C.DEFAULT_WEIGHTS[d]).alias(d) for d in dims])
    known = F.filter(
        F.transform(F.coalesce("regulatory_frameworks", F.array().cast("array<string>")),
                    lambda f: F.try_element_at(delta_map(), f)),
        lambda d: d.isNotNull())
    folded = F.aggregate(
        known, start,
        lambda acc, d: F.struct(*[F.greatest(F.lit(0.0), acc[n] + d[i]).alias(n) for i, n in enumerate(dims)]))
    cols = [f"w_{d}" for d in dims]
    out = policies.withColumn("_w", folded)
    out = out.withColumns({f"w_{d}": F.col(f"_w.{d}") for d in dims}).drop("_w")
    out = _normalise_columns(out, cols)
    over = F.col("dimension_weight_overrides")
    before = {f"_b_{c}": F.col(c) for c in cols}
    out = out.withColumns(before).withColumns({
        f"w_{d}": F.coalesce(F.try_element_at(over, F.lit(d)), F.col(f"w_{d}")) for d in dims})
    out = _normalise_columns(out, cols)
    some = F.coalesce(F.size(over), F.lit(0)) > 0
    return out.withColumns({c: F.when(some, F.col(c)).otherwise(F.col(f"_b_{c}")) for c in cols}).drop(*before)


def control_rates(controls):
    """Discount rate of each control in list order; unknown names discount nothing."""
    return F.transform(F.coalesce(controls, F.array().cast("array<string>")),
                        lambda c: F.coalesce(F.try_element_at(literal_map(C.CONTROL_RATES), c), F.lit(0.0)))


def discounted(raw, controls):
    """Raw score after every control in list order, one rounding at the end."""
    return F.aggregate(control_rates(controls), raw.cast("double"), lambda acc, r: acc * (F.lit(1.0) - r))


INDEX_OF = {
    "security_posture": "security_posture_index",
    "operational_maturity": "operational_maturity_index",
    "service_reliability": "reliability_index",
    "governance": "governance_index",
}


TERMS = ("org_name", "compensating_controls", *[f"w_{d}" for d in C.DIMENSIONS])


def score(features, policies, as_of):
    """Score rows of every (run, policy) pair, joined on run_id.

    `policies` names the run each organisation's policy applies to. Weights are composed on the
    policy rows, before the join.
    """
    return _scored(fragment_join(features, compose_weights(policies).select("run_id", *TERMS), ["run_id"]), as_of)


def score_run(features, policy, as_of):
    """Score rows of one run under its one policy, which travels as a scalar subquery and not as a join."""
    terms = compose_weights(policy).select(F.struct(*TERMS).alias("p")).scalar()
    df = features.withColumn("_p", terms)
    return _scored(df.withColumns({t: F.col(f"_p.{t}") for t in TERMS}).drop("_p"), as_of)


def _scored(df, as_of):
    part = {d: f"coalesce({INDEX_OF[d]}, 0D)" for d in C.DIMENSIONS}
    df = df.withColumns({
        **{f"_d_{d}": F.expr(f"{part[d]} * w_{d} * 100D") for d in C.DIMENSIONS},
        "_raw": F.expr("(" + " + ".join(f"w_{d} * {part[d]}" for d in C.DIMENSIONS) + ") * 100D")})
    df = df.withColumns({**{f"{d}_score": round_exact(f"_d_{d}", 1) for d in C.DIMENSIONS},
                         "raw_score": round_exact("_raw", 1)})
    df = df.withColumn("_disc", discounted(F.col("raw_score"), F.col("compensating_controls")))
    df = df.withColumn("discounted_score", round_exact("_disc", 1))
    thin = F.coalesce("data_confidence", F.lit("insufficient_data")) == "insufficient_data"
    df = df.withColumn("_cut", F.col("discounted_score") * C.CONFIDENCE_PENALTY)
    df = df.withColumn("_pen", clamp(F.when(thin, round_exact("_cut", 1)).otherwise(F.col("discounted_score")), 0, 100))
    df = df.withColumns({
        "final_risk_score": round_exact("_pen", 1), "scored_at": as_of_lit(as_of), "ospc_org_name": F.col("org_name"),
        "active_controls": F.array_join("compensating_controls", ",")})
    return df.drop("_raw", "_disc", "_cut", "_pen", "compensating_controls", "org_name",
                   *[f"{p}_{d}" for p in ("_d", "w") for d in C.DIMENSIONS])


def bind_policies(policies, run_id):
    """Apply policies to one run."""
    return policies.withColumn("run_id", F.lit(run_id))


def per_policy(features, policies):
    """Feature rows with the policy or policies of their run, joined on run_id; one run may hold all rows."""
    return fragment_join(features, policies, ["run_id"])


def attach_tier(df, policies, name="service_tier"):
    """Tier 1..3 of a service from its run's policy map; NULL when not listed."""
    tiers = policies.select("run_id", "org_name", "service_tiers")
    return fragment_join(df, tiers, ["run_id"]).withColumn(
        name, F.try_element_at("service_tiers", F.col("service_name"))).drop("service_tiers")


def to_score_table(scored):
    """The 31 score columns in table order and table types."""
    return scored.select(*[F.col(c).cast(t).alias(c) for c, t in C.SCORE_TABLE])
