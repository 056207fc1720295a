"""Text analytics over document tables."""

from functools import reduce
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions.coerce import filled, strip
from riskweave.functions.rounding import clamp, round_exact
from riskweave.operators.filters import any_case, keep_lines
from riskweave.operators.ranking import first_seen, topk

MASK_BITS = 62


def quoted(word):
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def hit_mask(name, phrase_sets):
    """Bit i is set when any phrase of set i occurs as a substring of the (lower-case) text column."""
    if not phrase_sets:
        return F.lit(0).cast("bigint")
    bits = []
    for i, phrases in enumerate(phrase_sets):
        found = " OR ".join(f"contains(`{name}`, {quoted(p)})" for p in phrases)
        bits.append(f"IF({found}, {1 << i}L, 0L)")
    return F.expr(" | ".join(bits))


def grouped_hits(docs, group, phrase_sets):
    """Per group the number of phrase sets seen in any of its documents.

    Each document becomes one or more bit masks in the scan stage and the masks are OR-ed on the
    map side, so no text is shuffled and the size of a group does not matter.
    """
    blocks = [phrase_sets[i:i + MASK_BITS] for i in range(0, len(phrase_sets), MASK_BITS)]
    low = docs.withColumn("_low", F.lower("text"))
    masks = low.select(*group, *[hit_mask("_low", b).alias(f"_m{i}")
                                 for i, b in enumerate(blocks)])
    hits = masks.groupBy(*group).agg(*[F.bit_or(f"_m{i}").alias(f"_m{i}") for i in range(len(blocks))])
    return hits, [f"_m{i}" for i in range(len(blocks))]


def keyword_density(docs, keywords, group=("service_name",), name="density"):
    """Distinct keywords found (as substrings, lower-cased) over the size of the set, 4 places.

    Judged document by document: a phrase cut in two by a document boundary does not count.
    """
    words = sorted(set(keywords))
    hits, cols = grouped_hits(docs, list(group), [[w] for w in words])
    found = reduce(lambda a, b: a + b, [F.bit_count(c) for c in cols])
    return hits.withColumn("_share", found / F.lit(float(len(words)))).select(
        *group, round_exact("_share", 4).alias(name))


def keyword_hits(docs, keywords):
    """Number of distinct keywords in each document."""
    low = F.lower("text")
    return docs.withColumn("keyword_hits", reduce(
        lambda a, b: a + b, [F.contains(low, F.lit(k)).cast("int") for k in sorted(set(keywords))]))


def framework_sets(frameworks):
    """Phrases of each framework; an unknown one stands for its own lower-case name."""
    return [list(C.FRAMEWORK_SYNONYMS.get(f, (f.lower(),))) for f in frameworks]


def framework_coverage(docs, frameworks, group=("service_name",), name="coverage"):
    """Share of the requested frameworks with any phrase in the group's documents, 4 places."""
    if not frameworks:
        return docs.select(*group).distinct().withColumn(name, F.lit(0.0))
    distinct = list(dict.fromkeys(frameworks))
    hits, cols = grouped_hits(docs, list(group), framework_sets(distinct))
    found = reduce(lambda a, b: a + b, [
        F.getbit(cols[i // MASK_BITS], F.lit(i % MASK_BITS)).cast("int") * frameworks.count(f)
        for i, f in enumerate(distinct)])
    return hits.withColumn("_share", found / F.lit(float(len(frameworks)))).select(
        *group, round_exact("_share", 4).alias(name))


def detected_frameworks(docs, frameworks, group=("service_name",), name="detected"):
    """Array of the listed frameworks found in the group's documents."""
    hits, cols = grouped_hits(docs, list(group), framework_sets(frameworks))
    return hits.select(*group, F.array_compact(F.array(*[
        F.when(F.getbit(cols[i // MASK_BITS], F.lit(i % MASK_BITS)) == 1, F.lit(f))
        for i, f in enumerate(frameworks)])).alias(name))


def coverage_of(requested, detected):
    """Share of a policy's frameworks that were detected, from two array columns."""
    n = F.size(requested)
    found = F.size(F.filter(requested, lambda f: F.array_contains(detected, f)))
    return F.when(n > 0, found / n.cast("double")).otherwise(F.lit(0.0))


def requested_and_found(df, requested="requested", detected="detected", name="matched"):
    return df.withColumn(name, F.array_intersect(requested, detected))


def tag_frameworks(df, col="text", name="frameworks"):
    """Names of the compliance frameworks a text mentions, in tag order."""
    tags = [F.when(F.col(col).rlike("(?i)" + p), F.lit(n)) for n, p in C.FRAMEWORK_TAG_PATTERNS.items()]
    return df.withColumn(name, F.array_compact(F.array(*tags)))


def service_texts(docs, k=None, order=None, group=("service_name", "collection")):
    """The documents of every group that have text, one row each, so no task holds the text of a group.

    With k, only the first k of a group by `order`, say by falling relevance, with their rank as `rn`.
    """
    live = docs.filter(F.coalesce(F.length("text"), F.lit(0)) > 0)
    return live if k is None else topk(live, list(group), order, k)


# -- sentiment -------------------------------------------------------------------------------------

# A small lexicon of our own on the usual -4..4 scale; pass a table to use another one.
DEFAULT_LEXICON = {
    "breach": -2.5, "broken": -2.0, "crash": -2.2, "critical": -1.4, "damage": -2.4, "degraded": -1.8,
    "delay": -1.3, "error": -1.6, "exploit": -1.8, "fail": -2.3, "failed": -2.3, "failure": -2.4,
    "impact": -0.6, "lost": -1.5, "outage": -2.6, "severe": -1.9, "unavailable": -2.0, "wrong": -2.1,
    "excellent": 2.7, "fixed": 1.3, "good": 1.9, "great": 3.1, "healthy": 1.7, "improved": 1.6,
    "recovered": 1.5, "reliable": 1.9, "resolved": 1.4, "safe": 1.8, "secure": 1.7, "stable": 1.4,
    "success": 2.4, "successful": 2.4,
}


def lexicon_frame(spark, words=None):
    """A lexicon as a local table: Spark knows its size, so it goes to the words and the words of the texts are not shuffled."""
    pairs = words or DEFAULT_LEXICON
    return spark.createDataFrame(pa.table({
        "word": pa.array(pairs.keys(), pa.string()), "valence": pa.array(pairs.values(), pa.float64())}))


def doc_compound(docs, lexicon, group=("service_name",), key="doc_id"):
    """Compound valence s / sqrt(s^2 + 15) of the documents that hold any lexicon word."""
    words = docs.select(*group, key, F.explode(
        F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    sums = words.join(lexicon, "word").groupBy(*group, key).agg(
        F.sum(F.col("valence").cast("decimal(18,4)")).cast("double").alias("s"))
    return sums.withColumn("compound", F.col("s") / F.sqrt(F.col("s") * F.col("s") + 15.0))


# Fixed values of the usual valence rules.
BOOST, CAPITALS, NEGATED, EXCLAIMED, QUESTIONED = 0.293, 0.733, -0.74, 0.292, 0.18
FADE = (1.0, 0.95, 0.9)  # of a booster one, two, three words ahead
RULES = {
    "boosters": {
        "absolutely": BOOST, "amazingly": BOOST, "completely": BOOST, "deeply": BOOST, "entirely": BOOST, "especially": BOOST,
        "extremely": BOOST, "fully": BOOST, "greatly": BOOST, "highly": BOOST, "hugely": BOOST, "incredibly": BOOST,
        "intensely": BOOST, "more": BOOST, "most": BOOST, "particularly": BOOST, "quite": BOOST, "really": BOOST,
        "so": BOOST, "thoroughly": BOOST, "totally": BOOST, "unusually": BOOST, "utterly": BOOST, "very": BOOST,
        "almost": -BOOST, "barely": -BOOST, "hardly": -BOOST, "less": -BOOST, "little": -BOOST, "marginally": -BOOST,
        "occasionally": -BOOST, "partly": -BOOST, "scarcely": -BOOST, "slightly": -BOOST, "somewhat": -BOOST},
    "negations": ("cannot", "neither", "never", "none", "nope", "nor", "not", "nothing", "nowhere", "rarely", "seldom",
                  "despite", "without"),
    "contrast": "but",
}


def position_compound(docs, lexicon, group=("service_name",), key="doc_id", rules=RULES):
    """Compound valence of the documents that hold any lexicon word, by rules on the words around each of them.

    Words are `[A-Za-z']+`; each takes its three predecessors along, so the lexicon meets single rows and no text is put
    together again. Nearest first, a predecessor that boosts adds its value in the direction of the word, less
    the further it is, and one that negates (or ends in n't) turns and damps the word; "never so" and "never this" raise it,
    "without doubt" leaves it. A word in capitals among others weighs more. Words before the first `contrast` count
    half, those after it half as much again. Up to four exclamation marks, and two question marks or more, push the sum away from 0.
    A booster is never counted as a lexicon word. A null or empty text has no words.
    """
    words = F.regexp_extract_all("text", F.lit("[A-Za-z']+"), F.lit(0))
    shout = lambda w: (F.length(w) > 1) & (w == F.upper(w))
    times = lambda mark: F.length("text") - F.length(F.replace(F.col("text"), F.lit(mark)))
    # a word of capitals beside one that is none: words are ASCII, so upper case is the lack of a-z
    mixed = F.rlike("text", F.lit("(?<![A-Za-z'])[A-Z']{2,}+(?![A-Za-z'])")) & F.rlike(
        "text", F.lit("[a-z]|(?<![A-Za-z'])[A-Z'](?![A-Za-z'])"))
    texts = docs.select(*group, key, words.alias("_t"), times("!").alias("_loud"), times("?").alias("_asked"), mixed.alias("_mixed"))
    # whole lists are moved and lower-cased at once: a lambda for each word takes several times as long
    texts = texts.filter(F.size("_t") > 0).withColumn("_l", F.split(F.lower(F.array_join("_t", " ")), " ")).withColumn(
        "_turn", F.array_position("_l", rules["contrast"]))
    behind = lambda d: F.concat(F.array(*[F.lit(None).cast("string")] * d), "_t").alias(f"_w{d}")
    around = F.arrays_zip(F.col("_l").alias("word"), F.col("_t").alias("_w0"), *map(behind, (1, 2, 3)))
    one = texts.select(*group, key, "_loud", "_asked", "_mixed", "_turn", F.posexplode(around).alias("_at", "_a")).select(
        *group, key, "_loud", "_asked", "_mixed", "_turn", "_a.*", (F.col("_at") + 1).alias("_at"))
    one = one.filter(~F.col("word").isin(list(rules["boosters"]))).join(lexicon, "word")
    sign = lambda v: F.when(v < 0, -1.0).otherwise(1.0)
    louder = lambda w: F.when(F.col("_mixed") & shout(F.col(w)), CAPITALS).otherwise(0.0)
    low = lambda d: F.lower(F.col(f"_w{d}"))
    near = lambda test: lambda d: F.lit(False) if d == 1 else F.coalesce(
        test(low(1)) if d == 2 else test(low(1)) | test(low(2)), F.lit(False))
    raised, certain = near(lambda w: w.isin("so", "this")), near(lambda w: w == "doubt")
    one = one.withColumn("_v", F.col("valence") + sign(F.col("valence")) * louder("_w0"))
    for d, fade in zip((1, 2, 3), FADE):
        value = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in rules["boosters"].items() for x in pair]), low(d)), F.lit(0.0))
        boost = F.when(value != 0, (value + louder(f"_w{d}")) * fade).otherwise(0.0)
        one = one.withColumn("_v", F.col("_v") + sign(F.col("_v")) * boost)
        denied = low(d).isin(list(rules["negations"])) | low(d).endswith("n't")
        one = one.withColumn("_v", F.when(raised(d) & (low(d) == "never"), F.col("_v") * 1.25).when(
            certain(d) & (low(d) == "without"), F.col("_v")).when(denied, F.col("_v") * NEGATED).otherwise(F.col("_v")))
    half = F.when(F.col("_turn") == 0, 1.0).when(F.col("_at") < F.col("_turn"), 0.5).when(
        F.col("_at") > F.col("_turn"), 1.5).otherwise(1.0)
    sums = one.groupBy(*group, key).agg(
        F.sum((F.col("_v") * half).cast("decimal(18,9)")).cast("double").alias("_s"),
        F.max("_loud").alias("_loud"), F.max("_asked").alias("_asked"))
    push = F.least("_loud", F.lit(4)) * EXCLAIMED + F.when(F.col("_asked") < 2, 0.0).when(
        F.col("_asked") < 4, F.col("_asked") * QUESTIONED).otherwise(0.96)
    s = F.col("_s") + F.when(F.col("_s") == 0, 0.0).otherwise(sign(F.col("_s")) * push)
    return sums.select(*group, key, s.alias("s")).withColumn(
        "compound", F.col("s") / F.sqrt(F.col("s") * F.col("s") + 15.0))


def compound_sums(docs, lexicon, group=("service_name",), key="doc_id", rules=None):
    each = position_compound(docs, lexicon, group, key, rules) if rules else doc_compound(docs, lexicon, group, key)
    return each.groupBy(*group).agg(
        F.sum(F.col("compound").cast("decimal(18,9)")).cast("double").alias("compound_sum"))


def sentiment_risk(docs, lexicon, group=("service_name",), key="doc_id", name="incident_sentiment_score", rules=None):
    """(1 - mean compound) / 2 per group over its non-blank documents, clamped, 4 places.

    Documents without any lexicon word count as neutral. With `rules` (RULES), the words around a lexicon word count.
    """
    live = docs.filter(F.length(strip(F.coalesce("text", F.lit("")))) > 0)
    counts = live.groupBy(*group).agg(F.count("*").alias("_n"))
    out = counts.join(compound_sums(live, lexicon, group, key, rules), list(group), "left")
    mean = F.coalesce("compound_sum", F.lit(0.0)) / F.col("_n")
    return out.withColumn("_r", clamp((F.lit(1.0) - mean) / 2.0, 0, 1)).select(
        *group, round_exact("_r", 4).alias(name))


# -- chunks ----------------------------------------------------------------------------------------


def split_text(text, max_chars):
    """Cut after the last full stop followed by a space within the limit, else at the limit."""
    pieces = []
    while len(text) > max_chars:
        stop = text.rfind(". ", 0, max_chars)
        cut = stop + 1 if stop >= 0 else max_chars
        pieces.append(text[:cut].strip())
        text = text[cut:].strip()
    return pieces + [text] if text or not pieces else pieces


def chunk_docs(docs, key, max_chars=C.MAX_CHUNK_CHARS):
    """One row per chunk with its position, the chunk count and the id `<key>::<index>`."""

    @F.pandas_udf("array<string>")
    def pieces(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_text(t or "", max_chars))

    cut = docs.withColumn("_pieces", pieces("text")).drop("text")
    return chunk_positions(cut, key)


def chunk_positions(df, key, pieces="_pieces"):
    out = df.withColumn("total_chunks", F.size(pieces))
    out = out.select(*[c for c in out.columns if c != pieces], F.posexplode(pieces).alias("chunk_index", "text"))
    return out.withColumns({
        "doc_key": F.col(key).cast("string"),
        "chunk_id": F.concat_ws("::", F.col(key).cast("string"), F.col("chunk_index").cast("string"))})


# -- pages -----------------------------------------------------------------------------------------

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIP_DOCS = frozenset("nav footer script style aside header form noscript".split())
SKIP_TRUST = SKIP_DOCS - {"header"}


class PageText(HTMLParser):
    """Collect (open ancestors, text) pairs; skipped elements swallow their content."""

    def __init__(self, skip):
        super().__init__(convert_charrefs=True)
        self.skip, self.path, self.serial, self.parts = skip, [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID_TAGS:
            self.serial += 1
            self.path.append((tag, dict(attrs), self.serial))

    def handle_endtag(self, tag):
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                del self.path[i:]
                break

    def handle_data(self, data):
        text = data.strip()
        if text:
            self.parts.append((list(self.path), text))

    def visible(self):
        return [(p, t) for p, t in self.parts if not any(tag in self.skip for tag, _, _ in p)]


def page_parts(html, skip):
    parser = PageText(skip)
    parser.feed(html or "")
    parser.close()
    return parser


def inside(parts, test):
    """Texts of the first element (in page order) that passes `test`, or None."""
    hits = [node[2] for path, _ in parts for node in path if test(node)]
    if not hits:
        return None
    first = min(hits)
    return [text for path, text in parts if any(node[2] == first for node in path)]


def main_text(html, skip, ids, classes):
    parser = page_parts(html, skip)
    seen = parser.visible()
    has = lambda node, attr, words: node[0] == "div" and any(
        w in (node[1].get(attr) or "").lower() for w in words)
    tests = [lambda n: n[0] == "main", lambda n: n[0] == "article", lambda n: has(n, "id", ids)]
    if classes:
        tests.append(lambda n: has(n, "class", classes))
    tests.append(lambda n: n[0] == "body")
    body = next((t for t in (inside(seen, test) for test in tests) if t is not None), [])
    title = inside(parser.parts, lambda n: n[0] == "h1") or inside(parser.parts, lambda n: n[0] == "title")
    return "".join(title) if title else None, "\n".join(body)


PAGE_RULES = {
    "docs": (SKIP_DOCS, ("content", "main", "body"), ("content", "main", "body"), C.DOCS_BOILERPLATE, 200),
    "trust": (SKIP_TRUST, ("content", "main"), (), C.TRUST_BOILERPLATE, 150),
}


def extract_pages(pages, rules="docs", topics=C.COMPLIANCE_PATTERNS):
    """Title and main text of every page; short pages drop out, trust pages also need a topic."""
    skip, ids, classes, boilerplate, floor = PAGE_RULES[rules]

    def parse(batches):
        for pdf in batches:
            found = [main_text(h, skip, ids, classes) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"],
                                "title": [t for t, _ in found], "text": [b for _, b in found]})

    out = pages.select("page_id", "url", "html").mapInPandas(
        parse, "page_id bigint, url string, title string, text string")
    out = out.withColumn("text", keep_lines(F.col("text"), boilerplate)).filter(F.length("text") >= floor)
    out = out.withColumn("title", F.coalesce("title", F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit(""))))
    if rules == "trust":
        out = tag_frameworks(out.filter(F.col("text").rlike(any_case(topics))))
    return out


def incident_blocks_of(html, limit=None):
    parser = page_parts(html, frozenset())
    blocks = {}
    for path, text in parser.parts:
        for depth, (tag, attrs, serial) in enumerate(path):
            if tag == "div" and "incident" in (attrs.get("class") or ""):
                blocks.setdefault(serial, []).append((path[depth + 1:], text))
    out = []
    for serial in sorted(blocks)[:limit]:
        pick = lambda words: inside(blocks[serial], lambda n: any(w in (n[1].get("class") or "") for w in words))
        title, body = pick(("title", "name")), pick(("body", "update", "details"))
        if title is not None:
            out.append("".join(title) + "\n" + "".join(body or []))
    return out


def extract_blocks(pages, limit=None):
    """Text of the incident blocks of each status page, of the first `limit` if given."""

    def parse(batches):
        for pdf in batches:
            found = [incident_blocks_of(h, limit) for h in pdf["html"]]
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "blocks": found})

    out = pages.select("page_id", "url", "html").mapInPandas(
        parse, "page_id bigint, url string, blocks array<string>")
    return out.select("page_id", "url", F.posexplode("blocks").alias("block_index", "text"))


# where links are looked for, in this order: main part, a documentation menu, the whole body
LINK_REGIONS = (
    r"(?is)<main\b[^>]*>(.*?)</main>",
    r"(?is)<nav\b[^>]*aria-label\s*=\s*[\"'][^\"']*(?:doc|sec|toc)[^\"']*[\"'][^>]*>(.*?)</nav>",
    r"(?is)<body\b[^>]*>(.*)",
)


AUTHORITY = r"(?i)^https?://([^/?#]*)"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&amp;", "&"))


def resolved(link):
    """A link with `.` and `..` segments of its path taken away, as browsers resolve them."""
    head = F.regexp_extract(link, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    tail = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    path = F.substr(link, F.length(head) + 1, F.length(link) - F.length(head) - F.length(tail))
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"),
        lambda acc, p: F.when(p == ".", acc).when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))))
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    plain = F.concat(head, F.when(F.size(closed) > 0, F.concat(F.lit("/"), F.array_join(closed, "/"))).otherwise(F.lit("")), tail)
    return F.when((head != "") & path.rlike(r"(^|/)\.\.?(/|$)"), plain).otherwise(link)


def extract_links(pages, cap=None):
    """Links of a page to its own host and port, fragments cut, in first-seen order, the page itself first.

    All links, or the first `cap`. Everything happens inside the row: no shuffle.
    """
    url = F.col("url")
    base = F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    bare = F.regexp_replace(F.regexp_replace("html", r"(?s)<!--.*?-->", ""), r"(?is)<script\b.*?</script>", "")
    region = F.coalesce(*[filled(F.regexp_extract("html", p, 1)) for p in LINK_REGIONS])
    tags = F.regexp_extract_all(region, F.lit(HREF), F.lit(0))

    def full(tag):
        value = F.concat(*[F.regexp_extract(tag, HREF, g) for g in (1, 2, 3)])
        for name, char in REFERENCES:
            value = F.replace(value, F.lit(name), F.lit(char))
        cut = F.split_part(value, F.lit("#"), F.lit(1))
        return resolved(
            F.when(cut == "", F.split_part(url, F.lit("#"), F.lit(1)))
            .when(cut.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), cut)
            .when(cut.startswith("//"), F.concat(F.regexp_extract(url, r"^(https?):", 1), F.lit(":"), cut))
            .when(cut.startswith("/"), F.concat(base, cut))
            .when(cut.startswith("?"), F.concat(F.regexp_replace(url, r"[?#].*$", ""), cut))
            .otherwise(F.concat(folder, F.lit("/"), cut)))

    own = F.regexp_extract(url, AUTHORITY, 1)
    same = lambda link: link.startswith("http") & (F.regexp_extract(link, AUTHORITY, 1) == own)
    found = F.array_distinct(F.concat(F.array(url), F.filter(F.transform(F.coalesce(
        tags, F.array().cast("array<string>")), full), same)))
    if cap is not None:
        found = F.slice(found, 1, cap)
    return pages.select("page_id", "url", bare.alias("html")).select(
        "page_id", F.posexplode(found).alias("link_index", "link"))


# -- text assembly ---------------------------------------------------------------------------------

# Least length of an incident text per feed.
INCIDENT_TEXT_FLOOR = {"statuspage": 101, "azure": 31, "salesforce": 31, "aws": 1, "gcp": 1}


def keep_incident_text(df, source, col="text"):
    """Trim the assembled text and drop what is too short for its feed."""
    return df.withColumn(col, strip(col)).filter(F.length(col) >= INCIDENT_TEXT_FLOOR[source])


def statuspage_text(name, updates):
    """Incident name, then one paragraph `[status] body` per update."""
    lines = F.transform(updates, lambda u: F.concat(
        F.lit("["), F.coalesce(u["status"], F.lit("")), F.lit("] "), F.coalesce(u["body"], F.lit(""))))
    return F.concat(F.lit("Incident: "), F.coalesce(name, F.lit("")), F.lit("\n\n"), F.array_join(lines, "\n\n"))


def incident_text(raw, source):
    """(id, text) of a feed's incidents: the text each feed offers, kept when long enough."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    para = lambda a, b: F.concat(blank(a), F.lit("\n\n"), blank(b))
    rows = raw
    if source == "statuspage":
        text = statuspage_text(F.col("name"), F.col("incident_updates"))
    elif source == "azure":
        text = para(F.col("title"), F.col("summary"))
    elif source == "salesforce":
        text = F.concat(F.lit("Salesforce Incident "), F.col("id"), F.lit(": "), blank(F.col("message")))
    elif source == "aws":
        text = blank(F.col("eventDescription.latestDescription"))
        rows = raw.withColumn("id", F.element_at(F.split("eventArn", "/"), -1))
    else:
        told = F.array_join(F.transform("updates", lambda u: F.coalesce(u["text"], F.lit(""))), " ")
        rows = raw.filter(F.coalesce(told, F.lit("")) != "")
        text = para(F.col("external_desc"), told)
    return keep_incident_text(rows.select("id", text.alias("text")), source)


def advisory_text(nodes):
    """Summary and description of each advisory once, under the id `ghsa::<advisory>`."""
    adv = F.col("advisory")
    text = F.concat(F.coalesce(adv["summary"], F.lit("")), F.lit("\n\n"), F.coalesce(adv["description"], F.lit("")))
    rows = nodes.select(F.concat(F.lit("ghsa::"), adv["ghsaId"]).alias("id"), text.alias("text"))
    return first_seen(rows.filter(F.length(strip("text")) > 0), ["id"], ["text"])


def issue_text(issues, order=None, cap=None):
    """Title and body of the issues of a repository, those of 50 characters or more; of the first `cap` if given."""
    first = issues if cap is None else topk(issues, ["repo"], order, cap)
    text = strip(F.concat(F.coalesce("title", F.lit("")), F.lit("\n\n"), F.coalesce("body", F.lit(""))))
    return first.withColumn("text", text).filter(F.length("text") >= 50).drop("rn", "title", "body")


DESCRIPTIONS = "array<struct<lang:string,value:string>>"


def english(descriptions):
    """First English description, trimmed; empty counts as absent."""
    first = F.filter(descriptions, lambda d: d["lang"] == "en")
    return filled(strip(F.try_element_at(first, F.lit(1))["value"]))


def english_any(descriptions):
    """First non-empty description in any kind of English."""
    live = F.filter(descriptions, lambda d: d["lang"].startswith("en") & (F.length(strip(d["value"])) > 0))
    return strip(F.try_element_at(live, F.lit(1))["value"])


def stored_descriptions(raw_json):
    """Description list of a stored record, at the top or below `cve`."""
    parsed = F.from_json(raw_json, f"cve struct<descriptions:{DESCRIPTIONS}>, descriptions {DESCRIPTIONS}")
    return F.coalesce(parsed["cve"]["descriptions"], parsed["descriptions"])


def cve_description(vulns, nvd, mitre):
    """Description of each CVE from the stored record, else the second, else the third source."""
    stored = vulns.withColumn("_raw", english(stored_descriptions(F.col("raw_json"))))
    second = nvd.select("cve_id", english(F.col("descriptions")).alias("_nvd"))
    third = mitre.select("cve_id", english_any(F.col("descriptions")).alias("_mitre"))
    out = stored.join(second, "cve_id", "left").join(third, "cve_id", "left")
    out = out.withColumns({
        "description": F.coalesce("_raw", "_nvd", "_mitre"),
        "origin": F.when(F.col("_raw").isNotNull(), "raw_json").when(F.col("_nvd").isNotNull(), "nvd_api")
        .otherwise("mitre_api")})
    return out.filter(F.col("description").isNotNull()).drop("_raw", "_nvd", "_mitre", "raw_json")
