"""Service registry: facets, lookups, alias matching, URL and window derivation."""

import pandas as pd
from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.coerce import norm_ecosystem
from riskweave.functions.risk import seconds_between
from riskweave.operators.ranking import first_seen, latest

REGISTRY = (
    "service string, nvd_keywords array<string>, kev_vendors array<string>,"
    " packages map<string,array<string>>, status_url string, status_provider string, github_repos array<string>")


def read_registry(spark, path):
    return spark.read.schema(REGISTRY).json(path)


def flatten_registry(services, registry, facet):
    """One row per service and facet value, with the fallbacks of services that are not listed.

    `services` has `service`; facets are keywords, vendors, packages and repos.
    """
    named = services.select("service").join(
        registry.withColumnRenamed("service", "_key"), F.lower("service") == F.col("_key"), "left")
    if facet == "keywords":
        values = F.when(F.coalesce(F.size("nvd_keywords"), F.lit(0)) > 0, F.col("nvd_keywords")).otherwise(
            F.array("service"))
        return named.select("service", F.explode(values).alias("value"))
    if facet == "vendors":
        listed = F.coalesce("kev_vendors", F.array().cast("array<string>"))
        values = F.when(F.array_contains(listed, F.lower("service")), listed).otherwise(
            F.concat(F.array(F.lower("service")), listed))
        return named.select("service", F.explode(values).alias("value"))
    if facet == "packages":
        # without listed packages the service itself is the package of the default ecosystem
        fallback = F.map_from_arrays(F.array(F.lit("PyPI")), F.array(F.array("service")))
        listed = F.when(F.coalesce(F.size("packages"), F.lit(0)) > 0, F.col("packages")).otherwise(fallback)
        flat = named.select("service", F.explode(listed).alias("ecosystem", "names"))
        return flat.select("service", norm_ecosystem("ecosystem").alias("ecosystem"), F.explode("names").alias("value"))
    return named.select("service", F.explode("github_repos").alias("value"))


def lookup_or_default(df, registry, key, defaults):
    """Left lookup; columns the registry does not fill take their default."""
    out = df.join(registry, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in defaults.items()})


def attach_service(advisories, packages):
    """Advisories of a package to the services that use it, each advisory once per service.

    `packages` has service, ecosystem, value; `advisories` has ecosystem, package, advisory_id.
    """
    named = packages.select(F.col("service").alias("service_name"), "ecosystem", F.col("value").alias("package"))
    both = advisories.drop("service_name").join(named, ["ecosystem", "package"])
    return first_seen(both, ["service_name", "advisory_id"], ["ecosystem", "package"])


def unregistered(df, services):
    return df.select("service_name").distinct().join(services.select("service_name"), "service_name", "left_anti")


def enrich_epss(vulns, epss, sources=("osv",), order=("epss_score",)):
    """Exploit probability by CVE id, the last of an id by `order`, for the listed sources; other rows keep theirs."""
    scores = latest(epss, ["cve_id"], list(order)).select("cve_id", F.col("epss_score").alias("_epss"))
    mine = F.col("source").isin(*sources)
    return (
        vulns.join(scores, "cve_id", "left")
        .withColumn("epss_score", F.when(mine, F.col("_epss")).otherwise(F.col("epss_score")))
        .select(*vulns.columns)
    )


BLOCK_NEEDLES = 50_000  # patterns of one automaton
PAIR = "text string, needle string"


def automaton(needles):
    """One automaton that finds all of the patterns in a single pass over a text."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for needle in needles:
        if needle:
            made.add_word(needle, needle)
    if len(made):
        made.make_automaton()
    return made


def hits(made, texts):
    """(text, needle) of every pattern in every text, each pair once."""
    found = [(t, n) for t in texts for n in ({m for _, m in made.iter(t)} if len(made) and t else ())]
    return pd.DataFrame({"text": [t for t, _ in found], "needle": [n for _, n in found]}, dtype="object")


def contained(haystacks, needles, block=BLOCK_NEEDLES):
    """(text, needle) for every needle, not empty, that is a substring of a text. Both inputs are distinct texts.

    Up to `block` needles are one automaton, shipped to where the texts are scanned: nothing is shuffled and no part of a
    text is a key. Beyond, needles are dealt into blocks of about that size, texts into as many shares as there are
    shuffle partitions, and every share meets every block in one cogroup; a task holds one automaton at a time.
    """
    spark, some = needles.sparkSession, needles.select("needle").filter("needle <> ''")
    n = some.count()
    if n <= block:
        shipped = [r[0] for r in some.collect()]  # at most `block`
        shared = spark.sparkContext.broadcast(shipped)

        def scan(batches):
            made = automaton(shared.value)
            for batch in batches:
                yield hits(made, batch["text"])

        return haystacks.select("text").filter("text IS NOT NULL").mapInPandas(scan, PAIR)
    blocks, shares = -(-n // block), int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = lambda k, name: F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(name)
    of = lambda c, k, name: F.pmod(F.xxhash64(c), F.lit(k)).cast("int").alias(name)
    left = haystacks.filter("text IS NOT NULL").select("text", of("text", shares, "_s"), every(blocks, "_b"))
    right = some.select("needle", of("needle", blocks, "_b"), every(shares, "_s"))

    def meet(texts, words):
        return hits(automaton(words["needle"]), texts["text"])

    return left.groupBy("_s", "_b").cogroup(right.groupBy("_s", "_b")).applyInPandas(meet, PAIR)


def match_aliases(kev, aliases):
    """Catalogue entries tagged with every service whose alias is part of the vendor or the product.

    `aliases` has service, alias; service `all`, and one with an empty alias (part of every text), takes every
    entry. Texts are matched once per distinct value, whatever number of rows carries it.
    """
    whole = (F.lower("service") == "all") | (F.col("alias") == "")
    takers = aliases.filter(whole).select("service").distinct()
    rows = kev.withColumns({"_v": F.lower(F.coalesce("vendorProject", F.lit(""))),
                            "_p": F.lower(F.coalesce("product", F.lit("")))})
    texts = rows.select(F.explode(F.array("_v", "_p")).alias("text")).distinct()
    words = aliases.join(takers, "service", "left_anti").select("service", F.lower("alias").alias("needle")).distinct()
    named = contained(texts, words.select("needle").distinct()).join(words, "needle").select("text", "service").distinct()
    pairs = rows.select("_v", "_p").distinct()
    tagged = (
        pairs.join(named.withColumnRenamed("text", "_v"), "_v").select("_v", "_p", "service")
        .union(pairs.join(named.withColumnRenamed("text", "_p"), "_p").select("_v", "_p", "service"))
        .distinct()
    )
    matched = rows.join(tagged, ["_v", "_p"]).select(*kev.columns, "service")
    everyone = takers.agg(F.collect_set("service").alias("_s")).select("_s").scalar()
    rest = kev.withColumn("service", F.explode(everyone))
    return matched.unionByName(rest)


def windows(span, max_days=C.WINDOW_DAYS, start="start", end="end"):
    """Consecutive windows of at most `max_days`; the next starts a second after the last ends."""
    step = F.expr(f"INTERVAL {int(max_days)} DAYS 1 SECOND")
    full = F.expr(f"INTERVAL {int(max_days)} DAYS")
    out = span.filter(F.col(start) < F.col(end)).select("*", F.posexplode(
        F.sequence(F.col(start), F.col(end), step)).alias("window_index", "window_from"))
    out = out.filter(F.col("window_from") < F.col(end))
    return out.select("window_index", "window_from",
                      F.least(F.col("window_from") + full, F.col(end)).alias("window_to"))


def window_index(col, start, max_days=C.WINDOW_DAYS):
    """Index of the window a timestamp falls in, by arithmetic instead of a range join."""
    return F.floor(seconds_between(start, col) / (max_days * 86400 + 1))


def candidate_urls(registry_repos):
    """Pages worth reading for each repository: homepage, repository, policy, advisories."""
    root = F.concat(F.lit("https://github.com/"), F.col("value"))
    home = F.when(F.coalesce("homepage", F.lit("")).startswith("http"), F.col("homepage"))
    page = lambda kind, url: F.struct(F.lit(kind).alias("kind"), url.alias("url"))
    pages = F.array(page("homepage", home), page("repo", root), page("policy", F.concat(root, F.lit("/security/policy"))),
                    page("advisories", F.concat(root, F.lit("/security/advisories"))))
    return registry_repos.select("service", F.explode(pages).alias("p")).select(
        "service", "p.kind", "p.url").filter(F.col("url").isNotNull())

