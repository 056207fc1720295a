"""End-to-end plans: service features, policy scores, model frame."""

from functools import reduce

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.rounding import clamp, round_exact
from riskweave.operators import aggregates as A
from riskweave.operators import model_features as M
from riskweave.operators import scoring as S
from riskweave.operators import text as X
from riskweave.operators.merge import flag_kev, union_feeds, upsert
from riskweave.operators.ranking import latest, top_categories
from riskweave.session import written, written_with
from riskweave.sources import records as R
from riskweave.sources.outputs import land_raw

TEXT_ZEROS = {"doc_quality_score": 0.0, "security_guidance_score": 0.0, "trust_coverage_score": 0.0,
              "incident_sentiment_score": 0.0, "has_docs": False}


def text_features(docs, frameworks, lexicon, doc_terms=C.DOC_QUALITY_TERMS, guide_terms=C.GUIDANCE_TERMS):
    """The four text scores per service, from one pass of bit masks plus one of lexicon words."""
    doc_words, guide_words = sorted(set(doc_terms)), sorted(set(guide_terms))
    wanted = list(dict.fromkeys(frameworks))
    of = lambda name: F.col("collection") == name
    has_text = F.coalesce(F.length("text"), F.lit(0)) > 0
    low = docs.withColumn("_low", F.lower("text"))
    none = F.lit(0).cast("bigint")
    kinds = {"d": ("documentation", [[w] for w in doc_words]), "g": ("advisory_text", [[w] for w in guide_words]),
             "t": ("trust_disclosures", X.framework_sets(wanted))}
    parts = {f"{k}{i}": F.when(of(name), X.hit_mask("_low", sets[i * X.MASK_BITS:(i + 1) * X.MASK_BITS])).otherwise(none)
             for k, (name, sets) in kinds.items() for i in range(max(1, -(-len(sets) // X.MASK_BITS)))}
    masks = low.select(
        "service_name", *[c.alias(n) for n, c in parts.items()],
        (has_text & F.col("collection").isin("documentation", "advisory_text", "trust_disclosures")).alias("h"),
        (of("incident_postmortems") & (F.length(X.strip(F.coalesce("text", F.lit("")))) > 0)).alias("live"))
    seen = masks.groupBy("service_name").agg(
        *[F.bit_or(n).alias(n) for n in parts],
        F.bool_or("h").alias("has_docs"), F.count_if("live").alias("live"))
    moods = X.compound_sums(docs.filter(of("incident_postmortems")), lexicon)
    out = seen.join(moods, "service_name", "left")
    found = reduce(lambda a, b: a + b, [
        F.getbit(f"t{i // X.MASK_BITS}", F.lit(i % X.MASK_BITS)).cast("int") * frameworks.count(f)
        for i, f in enumerate(wanted)], F.lit(0))
    seen_of = lambda k: reduce(lambda a, b: a + b, [F.bit_count(n) for n in parts if n[0] == k])
    mean = F.coalesce("compound_sum", F.lit(0.0)) / F.col("live")
    out = out.withColumns({
        "_d": seen_of("d") / float(len(doc_words)), "_g": seen_of("g") / float(len(guide_words)),
        "_t": found / float(max(len(frameworks), 1)),
        "_s": F.when(F.col("live") > 0, clamp((F.lit(1.0) - mean) / 2.0, 0, 1)).otherwise(F.lit(0.0))})
    return out.select(
        "service_name", round_exact("_d", 4).alias("doc_quality_score"),
        round_exact("_g", 4).alias("security_guidance_score"),
        round_exact("_t", 4).alias("trust_coverage_score"),
        round_exact("_s", 4).alias("incident_sentiment_score"), "has_docs")


def assemble(services, vuln, repo, incident, text):
    """One row per service: four per-service aggregates joined to the service list, gaps filled."""
    flagged = lambda df, name: df.withColumn(name, F.lit(True))
    out = services
    for side in (vuln, flagged(repo, "has_repo"), flagged(incident, "has_incidents"), text):
        out = out.join(side, "service_name", "left")
    return out.fillna({**A.VULN_ZEROS, **S.REPO_ZEROS, **A.INCIDENT_ZEROS, **TEXT_ZEROS,
                       "has_repo": False, "has_incidents": False})


def service_features(services, vulns, repo, incidents, docs, frameworks, lexicon, as_of, run_id,
                     repo_order=("collected_at",), **text_options):
    """Feature record of every service of a run."""
    newest = latest(repo, ["service_name"], list(repo_order))
    df = assemble(
        services, A.vuln_features(vulns, as_of), S.repo_features(S.feature_view(newest)),
        A.incident_features(incidents, as_of), text_features(docs, frameworks, lexicon, **text_options))
    df = S.all_indices(S.governance(df))
    return S.data_confidence(df).withColumn("run_id", F.lit(run_id)).drop("has_repo", "has_incidents", "has_docs")


def ingest(target, feeds, kev, since=None, keys=("source", "advisory_id"), order=("modified_at", "service_name", "cve_id")):
    """Normalised feeds into the vulnerability table: recent rows of all feeds, latest wins, then the flags.

    Flags come last, so a row that a feed brings unflagged is flagged again. `since` keeps rows modified then or later
    and rows without a time.
    """
    batch = union_feeds(*feeds)
    if since is not None:
        batch = batch.filter(F.col("modified_at").isNull() | (F.col("modified_at") >= F.lit(since).cast("timestamp_ntz")))
    return flag_kev(upsert(target, batch, list(keys), list(order)), kev)


def ingest_records(target, landed, collected_at=None, since=None):
    """Records of landed files into the vulnerability table, and those that were rejected.

    `landed` maps feeds to (records, normaliser): records of `sources.records.read_records`, best written once since good
    and broken ones are read apart. The catalogue that flags rows is the `kev` feed among them; a stored row whose
    new record is broken keeps its state.
    """
    feeds = {name: normalise(R.accepted(records, collected_at)) for name, (records, normalise) in landed.items()}
    kev = feeds["kev"] if "kev" in feeds else target.filter(F.col("source") == "kev")
    return ingest(target, list(feeds.values()), kev, since), R.rejected(*[records for records, _ in landed.values()])


def ingest_files(spark, target, landed, reject_path=None, multi_line=True, **options):
    """Landed files into the vulnerability table. `landed` maps feeds to (path, normaliser). Files are parsed once;
    rejected records are added below `reject_path`, by feed. Returns the table and the rejected records."""
    read = {name: (written(spark, R.read_records(spark, path, name, multi_line), f"{name}-records"), normalise)
            for name, (path, normalise) in landed.items()}
    table, bad = ingest_records(target, read, **options)
    if reject_path is not None:
        land_raw(bad, reject_path, by=("feed",))
    return table, bad


def policy_scores(features, policy, as_of):
    """Score rows of a run under its policy, best first left to the report."""
    return S.score_run(features, policy, as_of)


def model_frame(vulns, repo, incidents, entity_order, top, thresholds=C.HIGH_RISK_THRESHOLDS, casefold=False,
                codes=True):
    """Model input of every service. The most frequent weakness names (at most `top`) become columns."""
    names = [r[0] for r in top_categories(vulns, "cwe_id", top).select("cwe_id").collect()]
    df = M.join_features(A.entity_list(vulns, entity_order), A.repo_agg(repo), A.incident_agg(incidents),
                         A.vuln_agg(vulns, casefold, names))
    df = M.high_risk(M.compound_features(df), thresholds)
    return M.encode_flags(M.encode(df, ["ecosystem", "vendor"])) if codes else df


def settled_frame(spark, df, scaled=()):
    """A model frame written once: (table, maxima for the drill-down, {column: (least, greatest)} of `scaled`).

    The extremes are read from the written columns, so reports compute the frame once however many of them they need.
    """
    ends = {f"{c}|{n}": f(c) for c in scaled for n, f in (("lo", F.min), ("hi", F.max))}
    table, facts = written_with(spark, df, "frame", **M.scale_facts(), **ends)
    return table, {n: facts[n] for n in M.SCALED_BY_MAX}, {c: (facts[f"{c}|lo"], facts[f"{c}|hi"]) for c in scaled}
