import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskweave.operators import normalize as N
from riskweave.session import scratch_path
from riskweave.sources import feeds


def parse(spark, ddl, *docs):
    return spark.createDataFrame([(d,) for d in docs], "j string").select(F.from_json("j", feeds.as_struct(ddl)).alias("x")).select("x.*")


def cpe(spark, *matches):
    body = ",".join(f'{{"vulnerable":{str(v).lower()},"criteria":"{c}"}}' for v, c in matches)
    return parse(spark, feeds.NVD_ITEM, f'{{"cve":{{"id":"CVE-1","configurations":[{{"nodes":[{{"cpeMatch":[{body}]}}]}}]}}}}')


@pytest.mark.parametrize("matches,want", [
    ([(True, "cpe:2.3:a:acme:prod:1")], "acme"), ([(False, "cpe:2.3:a:acme:p:1"), (True, "cpe:2.3:a:beta:p:1")], "beta"),
    ([(True, "cpe:2.3:a:*:p"), (True, "cpe:2.3:a:-:p"), (True, "cpe:2.3:a::p"), (True, "cpe:2.3:a:z:p")], "z"),
    ([(True, "cpe:2.3:a")], "unknown"), ([(False, "cpe:2.3:a:acme:p")], "unknown"), ([], "unknown")])
def test_cpe_vendor(spark, matches, want):
    assert rows(N.normalize_nvd(cpe(spark, *matches)), "service_name") == [(want,)]


def test_nvd_without_parts(spark):
    raw = parse(spark, feeds.NVD_ITEM, '{"cve":{"id":" cve-9 "}}', '{"cve":{"id":"  "}}', '{"cve":{}}')
    r = N.normalize_nvd(raw).collect()
    assert len(r) == 1
    assert (r[0]["cve_id"], r[0]["severity"], r[0]["cvss_v3_score"], r[0]["cwe_id"], r[0]["service_name"]) == ("CVE-9", "NONE", None, None, "unknown")


def test_kev_and_ghsa_names(spark):
    kev = parse(spark, feeds.KEV_ITEM, '{"cveID":"cve-1","vendorProject":" Acme ","dateAdded":"2024-01-02"}', '{"cveID":"CVE-2"}', '{"product":"x"}')
    assert rows(N.normalize_kev(kev), "cve_id", "service_name") == [("CVE-1", "acme"), ("CVE-2", "unknown")]
    assert "cwe_id" not in N.normalize_kev(kev, "acme").columns
    nodes = parse(spark, feeds.GHSA_NODE, '{"advisory":{"ghsaId":"G1","severity":"MODERATE"},"package":{"ecosystem":"NPM","name":" p "}}',
                  '{"advisory":{"ghsaId":"G2","withdrawnAt":"2024-01-01"},"package":{}}')
    assert rows(N.normalize_ghsa(nodes), "cve_id", "service_name", "severity") == [("G1", "p", "MEDIUM")]
    assert N.normalize_ghsa(nodes, "svc", "npm").count() == 2


@pytest.mark.parametrize("prefix", [None, "atom"])
def test_azure_atom_with_and_without_prefix(spark, prefix):
    path = scratch_path(spark, "atom")
    p = f"{prefix}:" if prefix else ""
    ns = ' xmlns:atom="http://www.w3.org/2005/Atom"' if p else ' xmlns="http://www.w3.org/2005/Atom"'
    entry = "".join(f"<{p}entry><{p}id>http://x/{i}</{p}id><{p}title>t{i} &amp; u</{p}title><{p}published>2024-01-0{i}T01:02:03Z"
                    f"</{p}published></{p}entry>" for i in (1, 2))
    spark.createDataFrame([(f"<{p}feed{ns}>{entry}</{p}feed>",)], "v string").coalesce(1).write.text(path)
    got = N.normalize_azure(feeds.read_atom(spark, path, prefix))
    assert sorted(rows(got, "incident_id", "affected_components")) == [("1", "t1 & u"), ("2", "t2 & u")]


def test_statuspage_minutes_truncate(spark):
    raw = parse(spark, feeds.STATUSPAGE_INCIDENT, '{"id":"1","impact":"critical","status":"","created_at":"2024-01-01T00:00:00.900Z","resolved_at":"2024-01-01T00:02:00.100Z"}',
                '{"id":"2","impact":"none","status":"x","created_at":"2024-01-01T00:01:59Z","resolved_at":"2024-01-01T00:00:00Z","components":[{"name":"a"},{"name":"b"}]}')
    assert rows(N.normalize_statuspage(raw, "s"), "severity", "status", "duration_minutes", "affected_components") == [
        ("major", "resolved", 1, ""), ("maintenance", "x", -1, "a, b")]


@pytest.mark.parametrize("doc", ['[{"id":"1"}]', '{"data":[{"id":"1"}]}', '{"incidents":[{"id":"1"}]}'])
def test_salesforce_shapes(spark, doc):
    path = scratch_path(spark, "sf")
    spark.createDataFrame([(doc,)], "v string").write.text(path)
    assert rows(N.normalize_salesforce(feeds.read_feed(spark, path, "salesforce"), "s"), "incident_id", "status") == [("1", "investigating")]


def test_salesforce_document_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"data":\n [{"id":"1"},\n {"id":"2"}]}\n')
    assert sorted(rows(feeds.read_feed(spark, str(tmp_path), "salesforce"), "id")) == [("1",), ("2",)]


@pytest.mark.parametrize("feed,doc,want", [
    ("nvd", '{"vulnerabilities":[{"cve":{"id":"a"}},{"cve":{"id":"b"}}]}', 2), ("kev", '{"vulnerabilities":[{"cveID":"a"}]}', 1),
    ("epss", '{"data":[{"cve":"a","epss":"0.5"}]}', 1), ("gcp", '[{"id":"1"},{"id":"2"}]', 2), ("osv", '{"id":"x"}', 1),
    ("aws", '{"events":[]}', 0)])
def test_envelopes(spark, feed, doc, want):
    path = scratch_path(spark, feed)
    spark.createDataFrame([(doc,)], "v string").write.text(path)
    assert feeds.read_feed(spark, path, feed).count() == want
