import numpy as np
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.operators import filters as D
from riskweave.operators import similarity as S
from riskweave.operators import text as X
from riskweave.plans import flow

DOC = "doc_id bigint, service_name string, collection string, text string"


def docs(spark, *texts):
    return spark.createDataFrame([(i, "s", "documentation", t) for i, t in enumerate(texts)], DOC)


@pytest.mark.parametrize("texts,want", [
    (["the alpha is here"], .25), (["alpha and beta"], .5), (["ALPHA BETA"], .5), (["alphabetical"], .25),
    (["alpha alpha", "gamma"], .5), ([""], 0.0), ([None], 0.0), (["alpha beta gamma delta"], 1.0)])
def test_density(spark, texts, want):
    assert rows(X.keyword_density(docs(spark, *texts), ["alpha", "beta", "gamma", "delta"]), "density") == [(want,)]


def test_density_rounds_to_four_places_and_takes_many_words(spark):
    assert rows(X.keyword_density(docs(spark, "x and y"), ["x", "y", "zz"]), "density") == [(.6667,)]
    many = [f"w{i:03d}" for i in range(150)]
    assert rows(X.keyword_density(docs(spark, " ".join(many[:75])), many), "density") == [(.5,)]
    assert len(C.DOC_QUALITY_TERMS) == 21 and len(C.GUIDANCE_TERMS) == 21


def test_phrase_over_a_document_boundary_needs_the_joined_text(spark):
    d = docs(spark, "grant access", "control lists")
    assert rows(X.keyword_density(d, ["access control"]), "density") == [(0.0,)]
    joined = docs(spark, " ".join(r[0] for r in rows(X.service_texts(d).orderBy("doc_id"), "text")))
    assert rows(X.keyword_density(joined, ["access control"]), "density") == [(1.0,)]


def test_all_texts_of_a_service_and_the_first_on_request(spark):
    d = docs(spark, *[f"text {i}" for i in range(11)], "", None)
    assert X.service_texts(d).count() == 11
    assert sorted(r[0] for r in rows(X.service_texts(d, 2, [F.col("doc_id").desc()]), "text")) == ["text 10", "text 9"]


def test_text_scores_over_any_number_of_terms(spark):
    d = docs(spark, " ".join(f"w{i:02d}" for i in range(65))).withColumn("collection", F.lit("documentation"))
    got = flow.text_features(d, [f"FW{i}" for i in range(70)], X.lexicon_frame(spark), [f"w{i:02d}" for i in range(130)], ["w01"])
    assert rows(got, "doc_quality_score", "trust_coverage_score") == [(.5, 0.0)]


@pytest.mark.parametrize("texts,asked,want", [
    (["We hold SOC 2 reports"], ["SOC2"], 1.0), (["ISO/IEC 27001 certified"], ["ISO27001", "HIPAA"], .5),
    (["payment card industry"], ["PCI-DSS", "GDPR", "SOC2"], .3333), (["our CustomFW"], ["CUSTOMFW"], 1.0),
    (["general data", "protection"], ["GDPR"], 0.0), (["gdpr"], ["GDPR", "GDPR", "SOC2"], .6667), (["gdpr"], [], 0.0)])
def test_coverage(spark, texts, asked, want):
    assert rows(X.framework_coverage(docs(spark, *texts), asked), "coverage") == [(want,)]


def test_coverage_from_detected_arrays_agrees(spark):
    d = X.detected_frameworks(docs(spark, "SOC 2 and gdpr"), ["SOC2", "GDPR", "HIPAA"])
    asked = F.array(*[F.lit(x) for x in ("SOC2", "HIPAA", "GDPR", "SOC2")])
    assert rows(d.select(X.coverage_of(asked, F.col("detected"))))[0][0] == .75


@pytest.mark.parametrize("texts,low,high", [
    (["great success, all stable and secure"], 0.0, .49), (["outage failure severe damage"], .51, 1.0),
    (["nothing to say here"], .5, .5), (["  ", "outage"], .51, 1.0)])
def test_sentiment_direction(spark, texts, low, high):
    got = rows(X.sentiment_risk(docs(spark, *texts), X.lexicon_frame(spark)), "incident_sentiment_score")[0][0]
    assert low <= got <= high


def test_rules_on_neighbouring_words(spark):
    """One text per rule, sums by hand: good 2, bad -2."""
    want = {
        "good": 2.0, "very good": 2.293, "very big good": 2 + .293 * .95, "slightly bad": -1.707, "not good": -1.48,
        "not a very good": (2 + .293) * -.74, "isn't good": -1.48, "good!!": 2 + .584, "bad!!!!!!": -2 - 1.168,
        "bad??": -2.36, "bad????": -2.96, "GOOD day": 2.733, "GOOD DAY": 2.0, "VERY good day": 2 + .293 + .733,
        "good but bad": 1 - 3, "never so good": (2 + .293) * 1.25, "without doubt good": 2.0, "far away not one good": -1.48,
        "not in any way good": 2.0, "very": None, "": None}
    lexicon = X.lexicon_frame(spark, {"good": 2.0, "bad": -2.0, "very": 1.0})
    got = dict(rows(X.position_compound(docs(spark, *want, None), lexicon), "doc_id", "s"))
    for i, (text, value) in enumerate(want.items()):
        assert got.get(i) == (None if value is None else pytest.approx(value, abs=1e-6)), text


@pytest.mark.parametrize("rules", [None, X.RULES])
def test_words_of_texts_are_not_shuffled_to_the_lexicon(spark, rules):
    """One exchange of sums by document, one by group; none of the words below the lexicon's join."""
    found = X.compound_sums(docs(spark, "good but bad"), X.lexicon_frame(spark, {"good": 2.0, "bad": -2.0}), rules=rules)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_lexicon_frame_keeps_words_and_values(spark):
    frame = X.lexicon_frame(spark, {"good": 2, "bad": -2.5, "odd": None})
    assert dict(frame.dtypes) == {"word": "string", "valence": "double"}
    assert sorted(rows(frame.na.fill(0.0))) == [("bad", -2.5), ("good", 2.0), ("odd", 0.0)]
    assert dict(rows(X.lexicon_frame(spark))) == X.DEFAULT_LEXICON


def test_sentiment_of_no_documents(spark):
    assert rows(X.sentiment_risk(docs(spark, " ", None), X.lexicon_frame(spark))) == []


@settings(max_examples=40, deadline=None)
@given(st.text("ab. \n", max_size=120), st.integers(3, 20))
def test_chunks_keep_all_text(text, size):
    pieces = X.split_text(text, size)
    assert all(len(p) <= max(size, len(text) if len(text) <= size else size) for p in pieces)
    assert "".join("".join(pieces).split()) == "".join(text.split())
    assert len(pieces) >= 1


def test_chunk_boundaries(spark):
    assert X.split_text("One. Two three four", 10) == ["One.", "Two three", "four"] or X.split_text("One. Two three four", 10)[0] == "One."
    assert X.split_text("x" * 25, 10) == ["x" * 10, "x" * 10, "x" * 5]
    got = rows(X.chunk_docs(docs(spark, "y" * 5000, "short", None), "doc_id"), "doc_id", "chunk_index", "total_chunks", "chunk_id")
    assert got == [(0, 0, 3, "0::0"), (0, 1, 3, "0::1"), (0, 2, 3, "0::2"), (1, 0, 1, "1::0"), (2, 0, 1, "2::0")]


HTML = """<html><head><title>T</title><style>x</style></head><body><nav>menu menu menu menu</nav>
<header>site header is long enough to stay</header><article><h1>Head <b>line</b></h1><p>A line that is long enough.</p>
<p>short</p><p>We use a COOKIE banner on this page.</p><form>form text that is long enough</form><!-- hidden comment text here -->
<script>var a = "script text that is long";</script><p>Compliance with SOC 2 &amp; GDPR rules.</p></article>
<footer>footer text that is long</footer></body></html>"""


def page(spark, html, url="https://h.example/docs/a.html"):
    return spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")


def test_main_text():
    title, text = X.main_text(HTML, X.SKIP_DOCS, ("content",), ("content",))
    assert title == "Headline"
    assert text.split("\n") == ["Head", "line", "A line that is long enough.", "short", "We use a COOKIE banner on this page.",
                                "Compliance with SOC 2 & GDPR rules."]


@pytest.mark.parametrize("html,want", [
    ("<body><div id='x'>no</div><div id='MainBox'>yes<div>deep</div></div></body>", "yes\ndeep"),
    ("<body><div class='page-content'>yes</div>rest</body>", "yes"), ("<body>all<p>of it</body>", "all\nof it"),
    ("<main>m</main><article>a</article>", "m"), ("plain", "")])
def test_container_choice(html, want):
    assert X.main_text(html, X.SKIP_DOCS, ("content", "main", "body"), ("content", "main", "body"))[1] == want


def test_page_job_filters_lines_and_topics(spark):
    long = HTML.replace("short", "w" * 220)
    out = X.extract_pages(page(spark, long), "trust").collect()
    assert out[0]["frameworks"] == ["SOC 2", "GDPR"]
    assert out[0]["text"].split("\n") == ["A line that is long enough.", "w" * 220, "Compliance with SOC 2 & GDPR rules."]
    assert X.extract_pages(page(spark, HTML), "docs").count() == 0
    bare = "<body>" + "z" * 230 + "</body>"
    assert rows(X.extract_pages(page(spark, bare), "docs"), "title") == [("/docs/a.html",)]
    assert X.extract_pages(page(spark, bare), "trust").count() == 0


def test_links(spark):
    html = ("<body><a href='b.html#x'>1</a><a class=q href=\"/c\">2</a><a href='b.html'>3</a><a href='http://other.example/'>4</a>"
            "<a href='//h.example/d'>5</a><a href='mailto:x@y'>6</a><a href='#top'>7</a><a href='?p=1&amp;q=2'>8</a>"
            "<!-- <a href='/no'>9</a> --></body>")
    got = [r[0] for r in rows(X.extract_links(page(spark, html)).orderBy("link_index"), "link")]
    assert got == ["https://h.example/docs/a.html", "https://h.example/docs/b.html", "https://h.example/c", "https://h.example/d",
                   "https://h.example/docs/a.html?p=1&q=2"]
    many = "<body>" + "".join(f"<a href='/p{i}'>x</a>" for i in range(40)) + "</body>"
    assert X.extract_links(page(spark, many)).count() == 41 and X.extract_links(page(spark, many), 20).count() == 20
    odd = ("<body><a href=https://h.example:8443/p>1</a><a href=plain>2</a><a href='../up/./x?a=../b'>3</a><a href='/a/../..'>4</a>"
           "<a href='q&quot;&lt;'>5</a></body>")
    assert [r[0] for r in rows(X.extract_links(page(spark, odd)).orderBy("link_index"), "link")][1:] == [
        "https://h.example/docs/plain", "https://h.example/up/x?a=../b", "https://h.example/", 'https://h.example/docs/q"<']
    plan = X.extract_links(page(spark, odd))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    first = "<body><a href='/out'>x</a><main><a href='/in'>x</a></main></body>"
    assert [r[0] for r in rows(X.extract_links(page(spark, first)).orderBy("link_index"), "link")][1:] == ["https://h.example/in"]


def test_incident_blocks():
    html = "<div class='incident-list'>" + "".join(
        f"<div class='incident'><h3 class='incident-title'> T{i} </h3><p class='update'>b<i>{i}</i></p></div>" for i in range(60)) + "</div>"
    assert len(X.incident_blocks_of(html)) == 61
    got = X.incident_blocks_of(html, 50)
    assert got[0] == "T0\nb0" and got[1] == "T0\nb0" and got[2] == "T1\nb1" and len(got) == 50


def test_lines_and_tags(spark):
    d = docs(spark, "keep this line, it is long\nsmall\r\nAll Rights Reserved by someone another long enough line", "PCI DSS, nist and soc-2")
    assert rows(D.drop_boilerplate(d, C.DOCS_BOILERPLATE), "text")[0][0] == "keep this line, it is long\nanother long enough line"
    assert rows(X.tag_frameworks(d), "frameworks")[1][0] == ["SOC 2", "PCI-DSS", "NIST"]


def vectors(spark, n, name, seed, dim=8):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim)).astype("float32")
    return data, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], f"{name} bigint, embedding array<float>")


@pytest.mark.parametrize("block_bytes", [64 << 20, 8 * 8 * 16])
def test_similarity_equals_brute_force_over_blocks(spark, block_bytes):
    q, qdf = vectors(spark, 7, "query_id", 1)
    v, vdf = vectors(spark, 300, "vec_id", 2)
    unit = lambda m: m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    sims = unit(q) @ unit(v).T
    got = rows(S.topk_similar(qdf, vdf, 5, block_bytes=block_bytes), "query_id", "rank", "vec_id")
    want = [(i, r + 1, int(j)) for i in range(7) for r, j in enumerate(np.argsort(-sims[i])[:5])]
    assert sorted(got) == sorted(want)


def test_similarity_skips_pivots_on_clustered_vectors(spark):
    """Clustered vectors with copies and zeros, more than one cluster of blocks: all ties kept, most pivots not looked at."""
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(40, 8)), 25, axis=0) + rng.normal(size=(1000, 8)) * .02
    x[:6], x[100:103] = x[0], 0.0
    ask = np.vstack([x[[0, 30, 500, 999]] + .001, np.zeros((1, 8))])
    unit = lambda m: np.divide(m, n := np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=n > 0)
    sims = np.round(unit(ask) @ unit(x).T, 9)
    frame = lambda m, name: spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(m)], f"{name} bigint, embedding array<double>")
    got, visits = S.search(frame(ask, "query_id"), frame(x, "vec_id").repartition(4), 7, block_bytes=64 * 50)
    want = [(i, r + 1, int(j)) for i in range(5) for r, j in enumerate(np.lexsort((np.arange(1000), -sims[i]))[:7])]
    assert sorted(rows(got, "query_id", "rank", "vec_id")) == want
    per = dict(rows(visits.groupBy("query_id").count()))
    pivots = max(per.values())
    assert per[4] == pivots > 40 and all(per[i] < pivots / 3 for i in range(4))
    assert visits.distinct().count() == visits.count()
    assert S.topk_similar(frame(ask, "query_id"), frame(x, "vec_id").limit(0), 3).count() == 0


def test_incident_and_issue_texts(spark):
    df = spark.createDataFrame([("n", [("s", "b"), (None, "c")])], "name string, u array<struct<status:string,body:string>>")
    assert rows(df.select(X.statuspage_text(F.col("name"), F.col("u"))))[0][0] == "Incident: n\n\n[s] b\n\n[] c"
    issues = spark.createDataFrame([("r", i, "t" * (60 if i % 2 else 10), None) for i in range(80)], "repo string, number int, title string, body string")
    assert sorted(r[0] for r in rows(X.issue_text(issues, ["number"], 50), "number")) == [i for i in range(50) if i % 2]
    assert sorted(r[0] for r in rows(X.issue_text(issues), "number")) == [i for i in range(80) if i % 2]


def test_rules_run_over_whole_lists(spark):
    docs = spark.createDataFrame([("s", 1, t) for t in ("GREAT good", "GREAT")] + [("s", 2, "..."), ("s", 3, None), ("s", 4, "a 'GOOD' x")],
                                 "service_name string, doc_id int, text string")
    words = spark.createDataFrame([("great", 3.0), ("good", 2.0), ("", 1.0)], "word string, valence double")
    out = X.position_compound(docs, words)
    assert sorted((r.doc_id, round(r.s, 6)) for r in out.collect()) == [(1, 8.733)]
    assert "lambdafunction" not in out._jdf.queryExecution().optimizedPlan().toString()
