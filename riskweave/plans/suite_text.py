"""Registered queries of text, pages and similarity."""

from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.operators import filters as D
from riskweave.operators import similarity as S
from riskweave.operators import text as X
from riskweave.plans import oracle as O
from riskweave.plans.suite_policy import DOC_WORDS, LEXICON
from riskweave.plans.suite_tables import SPACES_SQL
from riskweave.sources import tables as T

GROUP = ("service_name", "collection")
ASKED = ["SOC2", "GDPR", "License", "les", "les", "nowhere"]
PATTERNS = ("license", " (le|the) ", r"copyright \d{4}", "nicht")


def keyword_density(spark, sf):
    return X.keyword_density(T.documents(spark, sf), DOC_WORDS, GROUP)


def keyword_sets(spark, sf):
    """Density of the two standard word sets over whole documents."""
    docs = T.documents(spark, sf)
    a = X.keyword_density(docs, C.DOC_QUALITY_TERMS, ("doc_id",), "quality")
    b = X.keyword_density(docs, C.GUIDANCE_TERMS, ("doc_id",), "guidance")
    return a.join(b, "doc_id")


def keyword_hits(spark, sf):
    return X.keyword_hits(T.documents(spark, sf), DOC_WORDS).select("doc_id", F.col("keyword_hits").cast("bigint").alias("hits"))


def framework_coverage(spark, sf):
    return X.framework_coverage(T.documents(spark, sf), ASKED, GROUP)


def framework_tags(spark, sf):
    tagged = X.tag_frameworks(T.documents(spark, sf))
    return tagged.select("doc_id", F.array_join("frameworks", ",").alias("frameworks"))


def service_blobs(spark, sf):
    """Every document with text under its service and collection."""
    return X.service_texts(T.documents(spark, sf)).select(*GROUP, "doc_id", F.md5("text").alias("digest"))


def line_filter(spark, sf):
    docs = D.drop_boilerplate(T.documents(spark, sf), PATTERNS)
    return docs.select("doc_id", F.md5("text").alias("digest"))


def topic_gate(spark, sf):
    return D.topic_gate(T.documents(spark, sf), (*C.COMPLIANCE_PATTERNS, "licen.e")).select("doc_id")


def length_floor(spark, sf):
    return D.min_length(T.documents(spark, sf), "text", 200).select("doc_id")


def sentiment_risk(spark, sf):
    return X.sentiment_risk(T.documents(spark, sf), X.lexicon_frame(spark, LEXICON), GROUP)


# frequent words of the shared texts in the place of boosters and negations
POSITIONS = {"boosters": {"the": .293, "la": .293, "of": -.293}, "negations": ("in", "and", "que"), "contrast": "is"}


def sentiment_rules(spark, sf):
    """Sentiment of a service's documents with the rules on neighbouring words."""
    docs, words = T.documents(spark, sf), X.lexicon_frame(spark, LEXICON)
    return X.sentiment_risk(docs, words, GROUP, rules=POSITIONS)


def statuspage_text(spark, sf):
    talk = T.read_table(spark, "conversations", sf)
    text = X.statuspage_text(F.col("role"), F.array(
        F.struct(F.col("role").alias("status"), F.col("text").alias("body")),
        F.struct(F.lit(None).cast("string").alias("status"), F.lit("done").alias("body"))))
    kept = X.keep_incident_text(talk.select("conv_id", "turn", text.alias("text")), "statuspage")
    return kept.select("conv_id", "turn", F.md5("text").alias("digest"))


def issue_text(spark, sf):
    """Issue texts of all turns of each speaker role."""
    talk = T.read_table(spark, "conversations", sf).select(
        F.col("role").alias("repo"), "conv_id", "turn", F.col("role").alias("title"), F.col("text").alias("body"))
    return X.issue_text(talk).select("repo", "conv_id", "turn", F.md5("text").alias("digest"))


def description_fallback(spark, sf):
    """Descriptions from the stored record, else a second, else a third source."""
    o = T.read_table(spark, "orders", sf)
    cve = F.concat(F.lit("CVE-"), F.col("o_orderkey").cast("string")).alias("cve_id")
    entry = lambda lang, text: F.struct(F.lit(lang).alias("lang"), text.alias("value"))
    note = F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("\t"))
    descs = F.array(entry("fr", F.lit("non")), entry("en", note))
    flat = F.to_json(F.struct(descs.alias("descriptions")))
    nested = F.to_json(F.struct(F.struct(descs.alias("descriptions")).alias("cve")))
    raw = F.when(F.col("o_orderstatus") == "F", nested).when(F.col("o_orderpriority") == "5-LOW", flat).when(
        F.col("o_orderpriority") == "1-URGENT", "{broken")
    vulns = o.select(cve, raw.alias("raw_json"))
    nvd = o.filter(F.col("o_totalprice") < 300000).select(cve, F.array(
        entry("en", F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("  ")).otherwise(F.lit("second")))).alias("descriptions"))
    mitre = o.filter(F.col("o_totalprice") < 400000).select(cve, F.array(
        entry("en", F.lit(" ")), entry("en-US", F.col("o_orderpriority"))).alias("descriptions"))
    return X.cve_description(vulns, nvd, mitre)


def label_means(spark, sf):
    """Mean vector of each label, as the query vectors."""
    e = T.read_table(spark, "embeddings", sf).select("label", F.posexplode("embedding").alias("i", "x"))
    means = e.groupBy("label", "i").agg(F.avg("x").alias("x"))
    packed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    return packed.select(F.col("label").cast("bigint").alias("query_id"), F.transform("v", lambda p: p["x"]).alias("embedding"))


def topk_similar(spark, sf):
    """The ten vectors nearest to each label's mean."""
    out = S.topk_similar(label_means(spark, sf), T.read_table(spark, "embeddings", sf), 10)
    return out.select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("bigint").alias("rank"))


def similar_in_service(spark, sf):
    """The ten vectors nearest to each label's mean among those of the label."""
    q = label_means(spark, sf).withColumn("service_name", F.col("query_id").cast("string"))
    v = T.read_table(spark, "embeddings", sf).withColumn("service_name", F.col("label").cast("string"))
    out = S.similar_in_service(q, v, 10)
    return out.select("query_id", "vec_id", F.round("similarity", 6).alias("similarity"))


TOPICS = ("thereron", "eaupa")


def page_text(spark, sf):
    out = X.extract_pages(T.read_table(spark, "pages", sf), "docs")
    return out.select("page_id", "title", F.md5("text").alias("digest"))


def trust_pages(spark, sf):
    """Pages that pass the topic gate, with their framework tags."""
    out = X.extract_pages(T.read_table(spark, "pages", sf), "trust", (*C.COMPLIANCE_PATTERNS, *TOPICS))
    return out.select("page_id", "title", F.array_join("frameworks", ",").alias("frameworks"))


def page_links(spark, sf):
    out = X.extract_links(T.read_table(spark, "pages", sf))
    return out.withColumn("link_index", F.col("link_index").cast("bigint"))


def incident_blocks(spark, sf):
    """Incident blocks of status pages made from conversation turns."""
    safe = F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(
        F.lit('<html><body><div class="incident-box"><b class="incident-title"> '), F.col("role"),
        F.lit('</b><div class="updates">'), safe, F.lit('</div></div><div class="incident-box">no title</div></body></html>'))
    pages = T.read_table(spark, "conversations", sf).select(
        (F.col("conv_id") * 10000 + F.col("turn")).alias("page_id"), F.lit("https://status.example.com/").alias("url"),
        html.alias("html"))
    out = X.extract_blocks(pages)
    return out.select("page_id", F.col("block_index").cast("bigint").alias("block_index"), F.md5("text").alias("digest"))


QUERIES = {f.__name__: f for f in (
    keyword_density, keyword_sets, keyword_hits, framework_coverage, framework_tags, service_blobs, line_filter, topic_gate,
    length_floor, sentiment_risk, sentiment_rules, statuspage_text, issue_text, description_fallback, topk_similar, similar_in_service,
    page_text, trust_pages, page_links, incident_blocks)}


def strip(e):
    return f"trim({e}, {SPACES_SQL})"


LINE_END_SQL = r"'\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'"


def lines_sql(e, patterns):
    rx = "(?i)" + "|".join(patterns)
    return strip(f"array_to_string(list_filter(regexp_split_to_array({e}, {LINE_END_SQL}), lambda l: length({strip('l')}) > 15 "
                 f"AND NOT regexp_matches(l, '{rx}')), chr(10))")


def nodes_sql(e):
    """Text nodes of an HTML fragment, trimmed, one per line; only the character references of the pages."""
    un = f"list_transform(regexp_split_to_array({e}, '<[^>]*>'), lambda n: {strip(unescape('n'))})"
    return f"array_to_string(list_filter({un}, lambda n: n <> ''), chr(10))"


def unescape(e):
    """The character references of the pages; a text cut off in the middle of one still counts."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''")):
        e = f"replace({e}, '{a}', '{b}')"
    return f"regexp_replace(replace({e}, '&nbsp;', chr(160)), '&amp;?', '&', 'g')"


def oracles():
    def dens(words, group, name):
        hits = " + ".join(f"max(CASE WHEN contains(lower(text), '{w}') THEN 1 ELSE 0 END)" for w in sorted(set(words)))
        return f"SELECT {group}, {O.rnd(f'({hits}) / {len(set(words))}.0::DOUBLE', 4)} AS {name} FROM docs GROUP BY ALL"

    cov = " + ".join(
        f"{ASKED.count(f)} * max(CASE WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{p}{chr(39)})' for p in ps)} THEN 1 ELSE 0 END)"
        for f, ps in zip(dict.fromkeys(ASKED), X.framework_sets(list(dict.fromkeys(ASKED)))))
    tags = ", ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN '{n}' END" for n, p in C.FRAMEWORK_TAG_PATTERNS.items())
    lex = ", ".join(f"('{w}', {v})" for w, v in LEXICON.items())
    topics = "(?i)" + "|".join((*C.COMPLIANCE_PATTERNS, "licen.e"))
    cos = """qv AS (SELECT label AS query_id, list(x ORDER BY i) AS q FROM (SELECT label, i, avg(x) AS x FROM (SELECT label,
 unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY ALL) GROUP BY label),
 sim AS (SELECT query_id, vec_id, label, round(list_cosine_similarity(q, embedding::DOUBLE[]), 9) AS s FROM qv, embeddings)"""
    skip = "nav|footer|script|style|aside|form|noscript"

    def page(skips, boiler, floor):
        gone = f"regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
        for t in skips:
            gone = f"regexp_replace({gone}, '(?is)<{t}\\b.*?</{t}>', '', 'g')"
        body = f"regexp_extract({gone}, '(?is)<article\\b[^>]*>(.*?)</article>', 1)"
        title = "regexp_extract(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)"
        joined = f"array_to_string(list_transform(regexp_split_to_array({title}, '<[^>]*>'), lambda n: {strip(unescape('n'))}), '')"
        return f"""pg AS (SELECT page_id, {joined} AS title, {nodes_sql(body)} AS raw FROM pages),
 pt AS (SELECT page_id, title, {lines_sql('raw', boiler)} AS text FROM pg)""", f"length(text) >= {floor}"

    docs_cte, docs_ok = page([*skip.split("|"), "header"], C.DOCS_BOILERPLATE, 200)
    trust_cte, trust_ok = page(skip.split("|"), C.TRUST_BOILERPLATE, 150)
    gone = "regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?is)<script\\b.*?</script>', '', 'g')"
    host = lambda c: f"regexp_extract({c}, '^https?://([^/?#]*)', 1)"
    links = f"""hp AS (SELECT page_id, url, regexp_extract({gone}, '(?is)<body\\b[^>]*>(.*)', 1) AS body FROM pages),
 hr AS (SELECT page_id, url, generate_subscripts(h, 1) AS pos, split_part(replace(unnest(h), '&amp;', '&'), '#', 1) AS cut FROM
 (SELECT page_id, url, regexp_extract_all(body, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["'']', 1) AS h FROM hp)),
 fl AS (SELECT page_id, url, pos, CASE WHEN cut = '' THEN split_part(url, '#', 1) WHEN regexp_matches(cut, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN cut
 WHEN starts_with(cut, '//') THEN regexp_extract(url, '^(https?):', 1) || ':' || cut
 WHEN starts_with(cut, '/') THEN regexp_extract(url, '^(https?://[^/?#]+)', 1) || cut
 WHEN starts_with(cut, '?') THEN regexp_replace(url, '[?#].*$', '') || cut
 ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '([^/:])/[^/]*$', '\\1') || '/' || cut END AS link FROM hr),
 al AS (SELECT page_id, 0 AS pos, url AS link FROM pages UNION ALL SELECT page_id, pos, link FROM fl
 WHERE starts_with(link, 'http') AND {host('link')} = {host('url')}),
 fs AS (SELECT page_id, link, min(pos) AS pos FROM al GROUP BY ALL)"""
    note = "o_orderpriority"
    return {
        "keyword_density": O.with_(O.DOCS) + " " + dens(DOC_WORDS, "service_name, collection", "density"),
        "keyword_sets": O.with_(O.DOCS) + ", a AS (" + dens(C.DOC_QUALITY_TERMS, "doc_id", "quality") + "), b AS ("
        + dens(C.GUIDANCE_TERMS, "doc_id", "guidance") + ") SELECT * FROM a JOIN b USING (doc_id)",
        "keyword_hits": O.with_(O.DOCS) + " SELECT doc_id, CAST(" + " + ".join(
            f"contains(lower(text), '{w}')::INT" for w in DOC_WORDS) + " AS BIGINT) AS hits FROM docs",
        "framework_coverage": O.with_(O.DOCS) + f""" SELECT service_name, collection, {O.rnd(f'({cov}) / {len(ASKED)}.0::DOUBLE', 4)} AS coverage
 FROM docs GROUP BY ALL""",
        "framework_tags": f"SELECT doc_id, array_to_string(list_filter([{tags}], lambda x: x IS NOT NULL), ',') AS frameworks FROM documents",
        "service_blobs": O.with_(O.DOCS) + """ SELECT service_name, collection, doc_id, md5(text) AS digest FROM docs WHERE length(text) > 0""",
        "line_filter": f"SELECT doc_id, md5({lines_sql('text', PATTERNS)}) AS digest FROM documents",
        "topic_gate": f"SELECT doc_id FROM documents WHERE regexp_matches(text, '{topics}')",
        "length_floor": "SELECT doc_id FROM documents WHERE length(text) >= 200",
        "sentiment_risk": O.with_(O.DOCS) + f""", lex AS (SELECT * FROM (VALUES {lex}) t(word, valence)),
 lv AS (SELECT * FROM docs WHERE length({strip('text')}) > 0),
 m AS (SELECT service_name, collection, doc_id, CAST(sum(CAST(valence AS DECIMAL(18,4))) AS DOUBLE) AS s FROM (SELECT service_name, collection, doc_id,
 unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM lv) JOIN lex USING (word) GROUP BY ALL),
 c AS (SELECT service_name, collection, CAST(sum(CAST(s / sqrt(s * s + 15.0::DOUBLE) AS DECIMAL(18,9))) AS DOUBLE) AS cs FROM m GROUP BY ALL),
 n AS (SELECT service_name, collection, count(*) AS n FROM lv GROUP BY ALL)
 SELECT service_name, collection, {O.rnd('greatest(0.0::DOUBLE, least(1.0::DOUBLE, (1.0::DOUBLE - coalesce(cs, 0) / n) / 2.0::DOUBLE))', 4)}
 AS incident_sentiment_score FROM n LEFT JOIN c USING (service_name, collection)""",
        "sentiment_rules": O.with_(O.DOCS) + f""", lex AS (SELECT * FROM (VALUES {lex}) t(word, valence)),
 lv AS (SELECT * FROM docs WHERE length({strip('text')}) > 0),
 tk AS (SELECT *, unnest(regexp_extract_all(text, '[A-Za-z'']+')) AS raw, unnest(range(len(regexp_extract_all(text, '[A-Za-z'']+')))) AS pos FROM lv),
 pv AS (SELECT *, lag(lower(raw), 1) OVER d AS w1, lag(lower(raw), 2) OVER d AS w2, lag(lower(raw), 3) OVER d AS w3,
 lag(raw, 1) OVER d AS r1, lag(raw, 2) OVER d AS r2, lag(raw, 3) OVER d AS r3,
 min(CASE WHEN lower(raw) = 'is' THEN pos END) OVER (PARTITION BY doc_id) AS turn,
 bool_or(length(raw) > 1 AND raw = upper(raw)) OVER (PARTITION BY doc_id) AND NOT bool_and(length(raw) > 1 AND raw = upper(raw)) OVER (PARTITION BY doc_id)
 AS mixed FROM tk WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
 a0 AS (SELECT pv.*, valence::DOUBLE + sign(valence) * CASE WHEN mixed AND length(raw) > 1 AND raw = upper(raw) THEN 0.733::DOUBLE ELSE 0 END AS v
 FROM pv JOIN lex ON lower(raw) = lex.word WHERE lower(raw) NOT IN ('the', 'la', 'of')),
 """ + ",\n ".join(f"""a{d} AS (SELECT * EXCLUDE (v), CASE WHEN w{d} IN ('in', 'and', 'que') OR w{d} LIKE '%n''t' THEN v * -0.74::DOUBLE ELSE v END AS v FROM
 (SELECT * REPLACE (v + CASE WHEN v < 0 THEN -1 ELSE 1 END * CASE WHEN w{d} IN ('the', 'la', 'of') THEN (CASE w{d} WHEN 'of' THEN -0.293::DOUBLE ELSE 0.293::DOUBLE END
 + CASE WHEN mixed AND length(r{d}) > 1 AND r{d} = upper(r{d}) THEN 0.733::DOUBLE ELSE 0 END) * {fade}::DOUBLE ELSE 0 END AS v) FROM a{d - 1}))"""
                 for d, fade in ((1, 1.0), (2, 0.95), (3, 0.9))) + """,
 sm AS (SELECT service_name, collection, doc_id, any_value(text) AS text, CAST(sum(CAST(v * CASE WHEN turn IS NULL OR pos = turn THEN 1.0::DOUBLE
 WHEN pos < turn THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END AS DECIMAL(18,9))) AS DOUBLE) AS s0 FROM a3 GROUP BY ALL),
 m AS (SELECT *, s0 + sign(s0) * (least(length(text) - length(replace(text, '!', '')), 4) * 0.292::DOUBLE + CASE
 WHEN length(text) - length(replace(text, '?', '')) < 2 THEN 0.0::DOUBLE WHEN length(text) - length(replace(text, '?', '')) < 4
 THEN (length(text) - length(replace(text, '?', ''))) * 0.18::DOUBLE ELSE 0.96::DOUBLE END) AS s FROM sm),
 c AS (SELECT service_name, collection, CAST(sum(CAST(s / sqrt(s * s + 15.0::DOUBLE) AS DECIMAL(18,9))) AS DOUBLE) AS cs FROM m GROUP BY ALL),
 n AS (SELECT service_name, collection, count(*) AS n FROM lv GROUP BY ALL)""" + f"""
 SELECT service_name, collection, {O.rnd('greatest(0.0::DOUBLE, least(1.0::DOUBLE, (1.0::DOUBLE - coalesce(cs, 0) / n) / 2.0::DOUBLE))', 4)}
 AS incident_sentiment_score FROM n LEFT JOIN c USING (service_name, collection)""",
        "statuspage_text": f"""WITH t AS (SELECT conv_id, turn, {strip("'Incident: ' || role || chr(10) || chr(10) || '[' || role || '] ' || text || chr(10) || chr(10) || '[] done'")} AS x
 FROM conversations) SELECT conv_id, turn, md5(x) AS digest FROM t WHERE length(x) > 100""",
        "issue_text": f"""WITH t AS (SELECT role AS repo, conv_id, turn, {strip("role || chr(10) || chr(10) || text")} AS x FROM conversations)
 SELECT repo, conv_id, turn, md5(x) AS digest FROM t WHERE length(x) >= 50""",
        "description_fallback": f"""WITH d AS (SELECT 'CVE-' || CAST(o_orderkey AS VARCHAR) AS cve_id,
 CASE WHEN o_orderstatus = 'F' OR {note} = '5-LOW' THEN {note} END AS a,
 CASE WHEN o_totalprice < 300000 AND {note} <> '2-HIGH' THEN 'second' END AS b, CASE WHEN o_totalprice < 400000 THEN {note} END AS c FROM orders)
 SELECT cve_id, coalesce(a, b, c) AS description, CASE WHEN a IS NOT NULL THEN 'raw_json' WHEN b IS NOT NULL THEN 'nvd_api' ELSE 'mitre_api' END AS origin
 FROM d WHERE coalesce(a, b, c) IS NOT NULL""",
        "topk_similar": "WITH " + cos + """ SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(s, 6) AS similarity,
 row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM sim QUALIFY rank <= 10""",
        "similar_in_service": "WITH " + cos + """ SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, round(s, 6) AS similarity FROM sim
 WHERE label = query_id QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) <= 10""",
        "page_text": f"WITH {docs_cte} SELECT page_id, title, md5(text) AS digest FROM pt WHERE {docs_ok}",
        "trust_pages": f"""WITH {trust_cte} SELECT page_id, title, array_to_string(list_filter([{tags}], lambda x: x IS NOT NULL), ',') AS frameworks
 FROM pt WHERE {trust_ok} AND regexp_matches(text, '{"(?i)" + "|".join((*C.COMPLIANCE_PATTERNS, *TOPICS))}')""",
        "page_links": f"""WITH {links} SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS link_index FROM fs""",
        "incident_blocks": f"""SELECT conv_id * 10000 + turn AS page_id, CAST(0 AS BIGINT) AS block_index, md5({strip('role')} || chr(10) || {strip('text')}) AS digest
 FROM conversations""",
    }
