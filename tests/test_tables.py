import datetime

import pytest
from conftest import AS_OF, ago, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave import session
from riskweave.functions import coerce as K
from riskweave.operators import filters as D
from riskweave.operators import merge as B
from riskweave.operators import ranking as R
from riskweave.operators import registry as G
from riskweave.session import scratch_path
from riskweave.sources import outputs

T = "source string, advisory_id string, service string, cwe string, kev int"
U = "source string, advisory_id string, service string, kev int, seq int, extra string"


def test_upsert_rules(spark):
    target = spark.createDataFrame([("n", "1", "a", "CWE-1", 1), ("n", "2", "b", "CWE-2", 0), ("n", None, "c", "CWE-3", 0)], T)
    updates = spark.createDataFrame([
        ("n", "1", "x", 0, 1, "z"), ("n", "1", "y", None, 2, "z"), ("k", "9", "new", 1, 1, "z"), ("n", None, "loose", 1, 1, "z"),
        ("n", None, "loose2", 1, 2, "z")], U)
    got = sorted(rows(B.upsert(target, updates, ["source", "advisory_id"], ["seq"])), key=str)
    assert got == sorted([
        ("n", "1", "y", "CWE-1", None), ("n", "2", "b", "CWE-2", 0), ("k", "9", "new", None, 1),
        ("n", None, "c", "CWE-3", 0), ("n", None, "loose", None, 1), ("n", None, "loose2", None, 1)], key=str)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("123"), st.integers(0, 5)), max_size=12),
       st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("1234"), st.integers(0, 5)), min_size=1, max_size=12))
def test_upsert_is_idempotent_and_matches_a_dict(spark, old, new):
    start = {(s, a): v for s, a, v in old}
    target = spark.createDataFrame([(*k, v) for k, v in start.items()], "s string, a string, v int")
    updates = spark.createDataFrame([(*r, i) for i, r in enumerate(new)], "s string, a string, v int, seq int")
    once = B.upsert(target, updates, ["s", "a"], ["seq"])
    want = {**start, **{(s, a): v for s, a, v in new}}
    assert sorted(rows(once)) == sorted((*k, v) for k, v in want.items())
    assert sorted(rows(B.upsert(once, updates, ["s", "a"], ["seq"]))) == sorted(rows(once))


def test_kev_flag_never_resets(spark):
    v = spark.createDataFrame([("C1", 0), ("C2", 1), ("C3", 0), (None, 0)], "cve_id string, is_kev int")
    kev = spark.createDataFrame([("c1",), ("C1",)], "cve_id string")
    assert sorted(rows(B.flag_kev(v, kev)), key=str) == sorted([("C1", 1), ("C2", 1), ("C3", 0), (None, 0)], key=str)


def test_stale_chunks_stay_unless_pruned(spark):
    schema = "collection string, doc_key string, chunk_id string, chunk_index int, total_chunks int, text string"
    old = spark.createDataFrame([("d", "1", f"1::{i}", i, 3, "o") for i in range(3)] + [("d", "2", "2::0", 0, 1, "o")], schema)
    new = spark.createDataFrame([("d", "1", "1::0", 0, 1, "n")], schema)
    assert sorted(rows(B.upsert_chunks(old, new), "chunk_id", "text")) == [
        ("1::0", "n"), ("1::1", "o"), ("1::2", "o"), ("2::0", "o")]
    assert sorted(rows(B.upsert_chunks(old, new, prune_stale=True), "chunk_id", "text")) == [("1::0", "n"), ("2::0", "o")]


def test_chunks_come_from_one_version(spark):
    schema = "collection string, doc_key string, chunk_id string, chunk_index int, total_chunks int, text string, seq int"
    old = spark.createDataFrame([], schema)
    new = spark.createDataFrame([("d", "1", f"1::{i}", i, 2, t, n) for n, pair in enumerate(("za", "bz")) for i, t in enumerate(pair)], schema)
    assert sorted(rows(B.upsert_chunks(old, new, order="seq"), "chunk_id", "text")) == [("1::0", "b"), ("1::1", "z")]


def test_first_row_is_added_and_last_score_counts(spark):
    new = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "k int, v string, n int").repartition(3)
    assert sorted(rows(B.insert_ignore(new.filter("k = 2"), new, ["k"], ["n"]), "k", "v")) == [(1, "a"), (2, "c")]
    v = spark.createDataFrame([("osv", "C1", .1)], "source string, cve_id string, epss_score double")
    e = spark.createDataFrame([("C1", .9, 1), ("C1", .3, 2)], "cve_id string, epss_score double, seq int")
    assert rows(G.enrich_epss(v, e, order=("seq",)), "epss_score") == [(.3,)]


def test_upsert_keeps_null_keys_in_one_pass(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "c"), (2, "d"), (None, "e"), (None, "e")], "k int, v string")
    out = B.upsert(old, new, ["k"], ["v"])
    assert sorted(rows(out), key=str) == sorted(
        [(1, "c"), (2, "d"), (None, "b"), (None, "b"), (None, "e"), (None, "e")], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 2 and "Union" not in plan


def test_empty_alias_takes_every_entry(spark):
    kev = spark.createDataFrame([("acme", "x"), (None, "y")], "vendorProject string, product string")
    aliases = spark.createDataFrame([("s", ""), ("s", "acme"), ("t", "ACM"), ("all", "-")], "service string, alias string")
    assert sorted(r[0] for r in rows(G.match_aliases(kev, aliases), "service")) == ["all", "all", "s", "s", "t"]


def test_scratch_needs_a_shared_folder_off_local():
    class Off:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: {})
        conf = {}
    with pytest.raises(ValueError):
        session.shared_dir(Off)


def test_lookback_null_rules(spark):
    df = spark.createDataFrame([(1, ago(10)), (2, ago(180)), (3, ago(181)), (4, None)], "i int, t timestamp_ntz")
    assert sorted(r[0] for r in rows(D.lookback(df, "t", AS_OF))) == [1, 2, 4]
    assert sorted(r[0] for r in rows(D.lookback(df, "t", AS_OF, null_policy="drop"))) == [1, 2]


def test_coercions(spark):
    df = spark.createDataFrame([("true",), (" FALSE",), ("1.0",), ("2",), ("x",), (None,)], "s string")
    assert [r[0] for r in rows(df.select(K.bool01("s")))] == [1, 0, 1, 2, 0, 0]
    assert [r[0] for r in rows(df.select(K.safe_num("s", "double", 90)))] == [90, 90, 1, 2, 90, 90]
    t = spark.createDataFrame([("2024-01-05T10:20:30.999Z",), ("2024-01-05",), ("",), ("x",), (None,)], "s string")
    assert [r[0] for r in rows(t.select(K.norm_timestamp("s")))] == [
        datetime.datetime(2024, 1, 5, 10, 20, 30), datetime.datetime(2024, 1, 5), None, None, None]
    e = spark.createDataFrame([("PIP",), ("rust",), ("Hex",), (None,)], "s string")
    assert [r[0] for r in rows(e.select(K.norm_ecosystem("s")))] == ["PyPI", "Cargo", "Hex", None]
    out = K.enforce(e.withColumn("n", F.lit("7")), StructType.fromDDL("n int, missing double"))
    assert rows(out)[0] == (7, None)


def test_aliases_match_vendor_or_product(spark):
    kev = spark.createDataFrame([(1, "Acme Corp", "Widget"), (2, "Other", "ACME tool"), (3, "Zed", "Thing"), (4, None, "ab")],
                                "id int, vendorProject string, product string")
    al = spark.createDataFrame([("acme", "acme"), ("acme", "widget"), ("short", "b"), ("zed", "zed"), ("all", "whatever")],
                               "service string, alias string")
    assert sorted(rows(G.match_aliases(kev, al), "id", "service")) == sorted(
        [(1, "acme"), (2, "acme"), (3, "zed"), (4, "short")] + [(i, "all") for i in (1, 2, 3, 4)])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("abc ", min_size=1, max_size=9), min_size=1, max_size=12), st.sets(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=8))
def test_contained_equals_brute_force(spark, texts, needles):
    h = spark.createDataFrame([(t,) for t in texts], "text string")
    n = spark.createDataFrame([(x,) for x in needles], "needle string")
    want = sorted((t, x) for t in texts for x in needles if x in t)
    assert sorted(rows(G.contained(h, n))) == want
    assert sorted(rows(G.contained(h, n, block=2))) == want  # several automata


def test_contained_with_nulls_empty_and_no_rows(spark):
    h = spark.createDataFrame([("",), (None,), ("aé",), ("x" * 100000 + "aé",)], "text string")
    n = spark.createDataFrame([("",), (None,), ("é",), ("aé",)], "needle string")
    for block in (50, 1):
        assert sorted((len(t), x) for t, x in rows(G.contained(h, n, block=block))) == [
            (2, "aé"), (2, "é"), (100002, "aé"), (100002, "é")]
        assert G.contained(h.limit(0), n, block=block).count() == 0
    assert G.contained(h, n.limit(0)).count() == 0


def test_one_automaton_needs_no_shuffle(spark):
    h = spark.range(1000).selectExpr("concat('common prefix ', id) AS text")
    n = spark.range(500).selectExpr("concat('common prefix ', id) AS needle")
    out = G.contained(h, n)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == sum(str(i).startswith(str(j)) for i in range(1000) for j in range(500))


def test_registry_fallbacks(spark):
    s = spark.createDataFrame([("Acme",), ("Nobody",)], "service string")
    reg = spark.createDataFrame([("acme", ["k1", "k2"], ["brand"], {"pip": ["p1"]}, None, None, ["o/r"])], G.REGISTRY)
    get = lambda facet: sorted(tuple(r) for r in G.flatten_registry(s, reg, facet).collect())
    assert get("keywords") == [("Acme", "k1"), ("Acme", "k2"), ("Nobody", "Nobody")]
    assert get("vendors") == [("Acme", "acme"), ("Acme", "brand"), ("Nobody", "nobody")]
    assert get("packages") == [("Acme", "PyPI", "p1"), ("Nobody", "PyPI", "Nobody")]
    assert get("repos") == [("Acme", "o/r")]


def test_windows_cover_180_days_in_two(spark):
    span = spark.createDataFrame([(ago(180), ago(0))], "start timestamp_ntz, end timestamp_ntz")
    got = rows(G.windows(span), "window_from", "window_to")
    assert got == [(ago(180), ago(61)), (ago(61) + datetime.timedelta(seconds=1), ago(0))]


def test_epss_only_touches_its_sources(spark):
    v = spark.createDataFrame([("osv", "C1", .1), ("nvd", "C1", .2), ("osv", "C2", .3)], "source string, cve_id string, epss_score double")
    e = spark.createDataFrame([("C1", .9)], "cve_id string, epss_score double")
    assert sorted(rows(G.enrich_epss(v, e)), key=str) == [("nvd", "C1", .2), ("osv", "C1", .9), ("osv", "C2", None)]


def test_prefer_nonnull_and_latest(spark):
    df = spark.createDataFrame([("C", None, 3), ("C", "", 1), ("C", "x", 9), ("C", "y", 2)], "k string, raw string, o int")
    assert rows(R.prefer_nonnull(df, ["k"], "raw", ["o"]), "raw") == [("y",)]
    assert rows(R.latest(df, ["k"], ["o"]), "raw") == [("x",)]


def test_features_of_a_run_replace_only_that_run(spark):
    path = scratch_path(spark, "t")
    mk = lambda run, v: spark.createDataFrame([(run, "s", v)], "run_id string, service_name string, x int")
    for run, v in (("a", 1), ("b", 2), ("a", 3)):
        outputs.write_features(mk(run, v), path)
    schema = "service_name string, x int"
    assert rows(outputs.read_features(spark, path, schema, "a"), "x") == [(3,)]
    assert rows(outputs.read_features(spark, path, schema, "b"), "x") == [(2,)]


def test_ensure_table_twice(spark):
    spark.sql("DROP TABLE IF EXISTS t_services")
    a, b = StructType.fromDDL("name string"), StructType.fromDDL("name string, tier int")
    outputs.ensure_table(spark, "t_services", a)
    outputs.append_enforced(spark.createDataFrame([("x",)], "name string"), "t_services", a)
    outputs.ensure_table(spark, "t_services", b)
    outputs.ensure_table(spark, "t_services", b)
    assert rows(spark.table("t_services")) == [("x", None)]
    spark.sql("DROP TABLE t_services")


def test_score_documents_on_disk(spark):
    path = scratch_path(spark, "docs")
    outputs.write_score_docs(spark.createDataFrame([("r", "a/b c", 1.5)], "run_id string, service_name string, s double"), path)
    got = spark.read.json(f"{path}/run_id=r").select("safe_name", F.get_json_object("document", "$.service_name").alias("n"))
    assert rows(got, "n") == [("a/b c",)] and rows(got, "safe_name")[0][0].startswith("a_b_c-")
