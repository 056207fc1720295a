import datetime

from conftest import rows

from riskweave.operators.merge import flag_kev, upsert
from riskweave.session import scratch_path
from riskweave.streaming import ingest as N

SCHEMA = "k string, cve_id string, v int, is_kev int, seq int, modified_at timestamp_ntz"


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").json(path)


def test_upsert_stream_equals_batch_over_several_polls(spark):
    path, cp = scratch_path(spark, "in"), scratch_path(spark, "cp")
    kev = spark.createDataFrame([("C1",)], "cve_id string")
    table = N.KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"])
    polls = [[("a", "C1", 1, 0, 1, None), ("b", "C2", 1, 0, 1, None), (None, "C1", 5, 0, 1, None)],
             [("a", "C1", 2, 0, 2, None)], [("c", "C1", 3, 0, 3, None), ("b", "C3", 9, 0, 3, None)]]
    batch = spark.createDataFrame([], SCHEMA)
    for data in polls:
        land(spark, path, data)
        N.upsert_stream(N.land_stream(spark, path, SCHEMA), table, ["seq"], cp, kev).awaitTermination()
        batch = flag_kev(upsert(batch, spark.createDataFrame(data, SCHEMA), ["k"], ["seq"]), kev)
    cols = ("k", "cve_id", "v", "is_kev")
    assert sorted(rows(table.read(), *cols), key=str) == sorted(rows(batch, *cols), key=str)
    # a batch that runs again changes nothing, not even rows without a key
    table.merge(spark.createDataFrame(polls[2], SCHEMA), 2, ["seq"], lambda r: flag_kev(r, kev))
    table.merge(spark.createDataFrame(polls[0][2:], SCHEMA), 0, ["seq"], lambda r: flag_kev(r, kev))
    assert sorted(rows(table.read(), *cols), key=str) == sorted(rows(batch, *cols), key=str)


def files(spark, table):
    return set(spark.read.parquet(table.path + "/rows").inputFiles())


def test_a_batch_writes_its_own_rows_and_nothing_else(spark):
    table = N.KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"])
    table.merge(spark.createDataFrame([(f"k{i}", "C", i, 0, 1, None) for i in range(60)], SCHEMA), 0, ["seq"])
    before = files(spark, table)
    table.merge(spark.createDataFrame([("k7", "C", 99, 0, 2, None), ("k7", "C", 98, 0, 1, None)], SCHEMA), 1, ["seq"])
    added = files(spark, table) - before
    assert before <= files(spark, table) and spark.read.parquet(*added).count() == 1
    assert table.read().count() == 60 and rows(table.read().filter("k = 'k7'"), "v") == [(99,)]
    assert rows(table.read(version=0).filter("k = 'k7'"), "v") == [(7,)]


def test_a_batch_that_was_killed_is_not_seen_and_runs_again(spark):
    table = N.KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"])
    batches = [[("a", "C", 1, 0, 1, None), (None, "C", 5, 0, 1, None)], [("a", "C", 2, 0, 2, None), (None, "C", 6, 0, 2, None)]]
    frames = [spark.createDataFrame(b, SCHEMA) for b in batches]
    table.merge(frames[0], 0, ["seq"])
    # the rows of batch 1 are there, but its driver is lost before the commit
    frames[1].selectExpr("*", "'delta' AS _kind", "1L AS _version").write.mode("append").partitionBy("_kind", "_version").parquet(
        table.path + "/rows")
    assert sorted(r[0] for r in rows(table.read(), "v")) == [1, 5]
    assert table.merge(frames[1], 1, ["seq"]) and not table.merge(frames[1], 1, ["seq"])
    assert sorted(r[0] for r in rows(table.read(), "v")) == [2, 5, 6]


def test_bases_give_the_same_table_and_keep_old_columns(spark):
    table = N.KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"], least=2)
    want = {}
    for n in range(7):
        data = [(f"k{(n * 3 + i) % 10}", "C", 100 * n + i, 0, n, None) for i in range(4)]
        table.merge(spark.createDataFrame(data, SCHEMA), n, ["seq"])
        want.update({r[0]: r[2] for r in data})
    kinds = [r[0] for r in rows(table.commits(), "kind")]
    assert kinds.count("base") >= 2 and kinds.count("delta") == 7
    assert dict(rows(table.read(), "k", "v")) == want
    table.merge(spark.createDataFrame([("k1", 7)], "k string, is_kev int"), 7)
    assert rows(table.read().filter("k = 'k1'"), "v", "is_kev") == [(want["k1"], 7)]


def test_rows_are_flagged_when_the_catalogue_grows(spark):
    table = N.KeyedTable(spark, scratch_path(spark, "t"), SCHEMA, ["k"])
    table.merge(spark.createDataFrame([("a", "C1", 1, 0, 1, None), ("b", "C2", 1, 0, 1, None), ("c", "C2", 1, 1, 1, None)], SCHEMA), 0, ["seq"])
    path, cp = scratch_path(spark, "ids"), scratch_path(spark, "cp")
    polls = [(["C9"], 0), (["c2", None, "C2"], 1)]
    for ids, written in polls:
        spark.createDataFrame([(i,) for i in ids], "cve_id string").coalesce(1).write.mode("append").parquet(path)
        N.catalogue_stream(N.land_stream(spark, path, "cve_id string", "parquet"), table, cp).awaitTermination()
        assert rows(table.commits().filter("stream = 'catalogue'").orderBy("version"), "n")[-1] == (written,)
    assert sorted(rows(table.read(), "k", "v", "is_kev")) == [("a", 1, 0), ("b", 1, 1), ("c", 1, 1)]


def test_repeated_records_pass_once(spark):
    from datetime import datetime

    path, out, cp = (scratch_path(spark, x) for x in ("in", "out", "cp"))
    at = datetime(2024, 1, 5)
    for data in ([("a", "C1", 1, 0, 1, at)], [("a", "C1", 1, 0, 1, at), ("b", "C2", 1, 0, 1, at)]):
        land(spark, path, data)
        s = N.dedup_stream(N.land_stream(spark, path, SCHEMA), ["k"])
        N.append_stream(s, out, cp).awaitTermination()
    assert sorted(r[0] for r in rows(spark.read.parquet(out), "k")) == ["a", "b"]


def test_overlap_dedup_forgets_after_the_delay(spark):
    """Polls with a repeat inside the overlap, one after its state is gone, and a row older than the watermark."""
    path, out, cp = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    at = lambda day: datetime.datetime(2024, 1, day)
    row = lambda k, day: (k, "C", 1, 0, 1, at(day))
    for data in ([row("a", 1), row("b", 1)], [row("a", 2), row("c", 10)], [row("a", 9), row("d", 2), row("c", 11)]):
        land(spark, path, data)
        s = N.dedup_stream(N.land_stream(spark, path, SCHEMA), ["k"], "2 days")
        N.append_stream(s, out, cp).awaitTermination()
    assert sorted(rows(spark.read.parquet(out).selectExpr("k", "day(modified_at)"))) == [("a", 1), ("a", 9), ("b", 1), ("c", 10)]
