import pytest
from conftest import rows
from pyspark.sql import functions as F

from riskweave.operators import normalize as N
from riskweave.plans import flow, suite_feeds
from riskweave.session import scratch_path, written
from riskweave.sources import feeds, outputs
from riskweave.sources import records as R


def landed(spark, feed, *docs, **options):
    path = scratch_path(spark, feed)
    spark.createDataFrame([(d,) for d in docs], "v string").coalesce(1).write.text(path)
    return R.read_records(spark, path, feed, multi_line=False, **options)


def judged(records):
    return sorted(rows(records, "position", "error", "raw"), key=str)


@pytest.mark.parametrize("feed,doc,want", [
    ("kev", '{"vulnerabilities":[{"cveID":"a"}', [(-1, "document")]),
    ("kev", '{"vulnerabilities":{"cveID":"a"}}', [(-1, "document")]),
    ("kev", "[]", [(-1, "document")]), ("kev", "not json", [(-1, "document")]),
    ("kev", "{}", [(-1, "envelope")]), ("kev", '{"vulnerabilities":null}', [(-1, "envelope")]),
    ("kev", '{"vulnerabilities":[]}', []),
    ("kev", '{"vulnerabilities":[null,{"cveID":"a"},3,"",[1],"{}"]}',
     [(0, "item"), (1, None), (2, "item"), (3, "item"), (4, "item"), (5, None)]),
    ("nvd", '{"vulnerabilities":[{"cve":"x"},{"cve":{"id":"a"}},{}]}', [(0, "item"), (1, None), (2, None)]),
    ("ghsa", '{"nodes":[{"advisory":{"cvss":{"score":"high"}}},{"advisory":{}}]}', [(0, "item"), (1, None)]),
    ("epss", '{"data":[{"cve":"a","epss":"x"},7]}', [(0, None), (1, "item")]),
    ("statuspage", '{"incidents":[{"components":"c"},{"components":[]}]}', [(0, "item"), (1, None)]),
    ("aws", '{"events":[{"eventDescription":[]},{}]}', [(0, "item"), (1, None)]),
    ("osv", '{"id":"x"}', [(0, None)]), ("osv", ' [{"id":"x"},{"aliases":"a"}]', [(0, None), (1, "item")]),
    ("osv", '[{"id":"x"},', [(-1, "document")]), ("gcp", "3", [(0, "item")]),
    ("github_commits", '[{"sha":"s","author":null},{"commit":1}]', [(0, None), (1, "item")]),
    ("github_issues", '[{"number":1},{"number":"one"}]', [(0, None), (1, "item")]),
    ("salesforce", '{"data":[{"id":"1"},5]}', [(0, None), (1, "item")]), ("salesforce", '{"incidents":[{"id":"1"}]}', [(0, None)]),
    ("salesforce", '[{"id":"1"},{"instanceKeys":{}}]', [(0, None), (1, "item")]), ("salesforce", '{"id":"1"', [(-1, "document")])])
def test_every_broken_record_is_named(spark, feed, doc, want):
    assert [(p, e) for p, e, _ in judged(landed(spark, feed, doc))] == want


def test_text_of_rejects_and_blank_lines(spark):
    records = landed(spark, "kev", "", "  ", '{"vulnerabilities":[{"cveID":"b"}, {"cveID":"a" , "dateAdded":"2024-01-02"},5]}', "{cut")
    assert judged(records) == [
        (-1, "document", "{cut"), (0, None, '{"cveID":"b"}'), (1, None, '{"cveID":"a","dateAdded":"2024-01-02"}'), (2, "item", "5")]
    assert sorted(rows(R.rejected(records), "feed", "error", "raw")) == [("kev", "document", "{cut"), ("kev", "item", "5")]
    assert sorted(rows(R.record_counts(records, landed(spark, "aws", "{}")))) == [
        ("aws", "envelope", 1), ("kev", "accepted", 2), ("kev", "document", 1), ("kev", "item", 1)]
    out = N.normalize_kev(R.accepted(records, "2024-02-01 00:00:00"))
    assert sorted(rows(out, "cve_id", "raw_json"))[1] == ("B", '{"cveID":"b"}') and "collected_at" in out.columns
    assert all(f.startswith("file:") for (f,) in rows(R.accepted(records, keep=("file",)), "file"))


def test_whole_files_and_an_empty_one(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"vulnerabilities":\n [{"cveID":\n"a"}]}')
    (tmp_path / "b.json").write_text("\n")
    assert sorted(rows(R.read_records(spark, str(tmp_path), "kev"), "error", "position"), key=str) == [("document", -1), (None, 0)]


@pytest.mark.parametrize("feed", [*feeds.ENVELOPES, "salesforce"])
def test_no_documents(spark, feed):
    assert landed(spark, feed).count() == 0


def test_good_files_read_as_before(spark):
    path = scratch_path(spark, "osv")
    docs = ['{"id":"x","aliases":["cve-1"],"database_specific":{"cvss_score":5.5}}', '[{"id":"y"},{"id":"z"}]']
    spark.createDataFrame([(d,) for d in docs], "v string").write.text(path)
    new = R.accepted(R.read_records(spark, path, "osv", multi_line=False)).drop("raw_json", "collected_at")
    old = feeds.read_feed(spark, path, "osv", multi_line=False)
    assert new.columns == old.columns and sorted(new.collect(), key=str) == sorted(old.collect(), key=str)


def test_ingest_files_keeps_state_of_broken_rows_and_lands_rejects(spark, tmp_path):
    def put(name, *docs):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.json").write_text("\n".join(docs))
        return str(tmp_path / name)

    before = written(spark, N.normalize_osv(landed(spark, "osv", '[{"id":"CVE-1"},{"id":"CVE-2"}]').select("item.*"), "old", "PyPI"), "before")
    plan = {"osv": (put("osv", '{"id":"CVE-1"}', '{"id":"CVE-2"', '{"id":"CVE-3"}'), lambda raw: N.normalize_osv(raw, "new", "PyPI")),
            "kev": (put("kev", '{"vulnerabilities":[{"cveID":"CVE-2","vendorProject":"v"},false]}'), N.normalize_kev)}
    rejects = str(tmp_path / "rejects")
    table, bad = flow.ingest_files(spark, before, plan, rejects, multi_line=False)
    assert sorted(rows(table, "source", "cve_id", "service_name", "is_kev")) == [
        ("kev", "CVE-2", "v", 1), ("osv", "CVE-1", "new", 0), ("osv", "CVE-2", "old", 1), ("osv", "CVE-3", "new", 0)]
    assert bad.count() == 2
    again = spark.read.schema("file string, position int, error string, raw string, feed string").json(rejects)
    assert sorted(rows(again, "feed", "error", "position", "raw")) == [("kev", "item", 0 + 1, "false"), ("osv", "document", -1, '{"id":"CVE-2"')]


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*") if f.is_file())


def test_landed_payloads_take_less_disk_than_the_items_text(spark, tmp_path, monkeypatch):
    items = spark.range(4000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"),
        (F.col("id") % 100).alias("l_suppkey"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        F.lit("A").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), F.lit("1998-01-02").cast("timestamp_ntz").alias("l_shipdate"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    folders = iter("abc")
    monkeypatch.setattr(suite_feeds, "scratch_path", lambda spark, label: str(tmp_path / next(folders)))
    monkeypatch.setattr(outputs, "PACKED_ROWS", 1000)
    text = suite_feeds.nvd_items(spark, str(tmp_path)).select(F.sum(F.length(F.to_json("cve")))).first()[0]
    assert suite_feeds.feed_json(spark, str(tmp_path)).count() == 4000 - 4000 // 7
    assert R.record_counts(suite_feeds.landed_records(spark, str(tmp_path), "nvd")).agg(F.sum("n")).first()[0] > 4000
    for made in "ab":
        assert folder_bytes(tmp_path / made) < text / 8
        assert len(list((tmp_path / made).glob("part-*"))) >= 4
