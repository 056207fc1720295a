import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskweave import constants as C
from riskweave.functions import risk
from riskweave.functions.ordered import hashed_row_number, running_sums
from riskweave.models import boosting, network
from riskweave.models import isolation as I
from riskweave.models import metrics as Q
from riskweave.models import training as L
from riskweave.operators import model_features as M
from riskweave.operators import ranking as R
from riskweave.plans import flow

WEIGHTS = dict(zip(C.RISK_CATEGORIES, (.3, .2, .2, .1, .1, .1)))


def test_bands_are_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, .1, .4, .41, .7, .71, 1.0, 1.1, None)], "x double")
    assert [r[0] for r in rows(df.select(risk.risk_band("x")))] == [None, "Low", "Low", "Medium", "Medium", "High", "High", None, None]


def test_label_is_an_or_with_unknown_as_false(spark):
    df = spark.createDataFrame([(7.0, 0, 0.0, 0), (6.9, 0, .09, 2), (0.0, 1, 0.0, 0), (0.0, 0, .1, 0), (0.0, 0, 0.0, 3), (None, 0, None, 0)],
                               "mean_cvss double, exploit_count int, mean_epss double, incident_count int")
    assert [r[0] for r in rows(M.high_risk(df), "high_risk")] == [1, 0, 1, 1, 1, 0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    names = sorted({n for _, _, ns in M.AREAS for n in ns})
    data = [(f"s{i}", *[float(x) for x in rng.random(len(names)) * 5], int(i % 3), 0) for i in range(6)]
    ddl = "service_name string, " + ", ".join(f"{n} double" for n in names) + ", `cwe_id_CWE-79` int, `cwe_id_CWE-1` int"
    return names, data, spark.createDataFrame(data, ddl)


def test_risk_areas_against_plain_python(spark, frame):
    names, data, df = frame
    top = {n: max(d[1 + names.index(n)] for d in data) for n in names}

    def value(row, n):
        x = row[1 + names.index(n)]
        if n in ("mean_cvss", "max_cvss"):
            return x / 10
        return x / 4 if n == "avg_severity" else x / (top[n] + 1) if n in M.SCALED_BY_MAX else x

    want = {}
    for row in data:
        for area, cat, ns in M.AREAS:
            want[row[0], area] = min(sum(value(row, n) for n in ns) / len(ns), 1.0) * WEIGHTS[cat]
        want[row[0], "CWE Attack Types"] = (1.0 if row[-2] else 0.0) * WEIGHTS["cwe_attack_types"]
    got = {(s, a): w for s, a, w in rows(M.risk_areas(df, WEIGHTS), "service_name", "area", "weighted")}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    drivers = M.risk_drivers(df, WEIGHTS)
    per = {s: n for s, n in rows(drivers.groupBy("service_name").count())}
    assert set(per.values()) == {10}
    named = rows(M.cwe_present(df), "service_name", "cwe", "label")
    assert ("s1", "CWE-79", "Cross-Site Scripting (XSS)") in named and not any(c == "CWE-1" for _, c, _ in named)


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation ") + plan.count("LogicalRDD")


def test_settled_frame_is_read_once_and_gives_the_same(spark, frame):
    _, _, df = frame
    table, maxima, ends = flow.settled_frame(spark, df, ("mean_epss",))
    assert maxima == {n: df.agg(F.max(n)).first()[0] for n in M.SCALED_BY_MAX}
    assert ends == {"mean_epss": tuple(df.agg(F.min("mean_epss"), F.max("mean_epss")).first())}
    for make in (M.risk_areas, M.risk_drivers):
        once = make(table, WEIGHTS, maxima=maxima)
        assert sorted(once.collect()) == sorted(make(df, WEIGHTS).collect())
        assert scans(once) == 1 and "scalar-subquery" not in once._jdf.queryExecution().optimizedPlan().toString()
    scaled = R.minmax(table, "mean_epss", ends=ends["mean_epss"])
    assert scans(scaled) == 1 and sorted(scaled.collect()) == sorted(R.minmax(df, "mean_epss").collect())


def test_settled_frame_without_rows(spark, frame):
    _, _, df = frame
    table, maxima, ends = flow.settled_frame(spark, df.limit(0), ("mean_epss",))
    assert set(maxima.values()) == {None} and ends == {"mean_epss": (None, None)}
    assert M.risk_areas(table, WEIGHTS, maxima).count() == 0 == R.minmax(table, "mean_epss", ends=ends["mean_epss"]).count()


def test_names_and_weights(spark):
    names = spark.createDataFrame([("cwe_id_CWE-79,CWE-9",), ("open_vulns",), ("x",)], "feature string")
    assert [r[0] for r in rows(M.with_display_names(names), "display")] == [
        "Cross-Site Scripting (XSS) + CWE-9", "Open High/Critical Vulns", "x"]
    w = M.feature_weights(["open_vulns", "vendor_enc", "cwe_id_X", "avg_severity"], WEIGHTS)
    assert w["open_vulns"] == .2 and w["vendor_enc"] == pytest.approx(1 / 6) and w["cwe_id_X"] == .1 and w["avg_severity"] == .1
    assert sum(M.normalised_weights({k: 2.0 for k in WEIGHTS}).values()) == pytest.approx(1)


def test_join_fills_only_numbers(spark):
    e = spark.createDataFrame([("a", None), ("b", "x")], "service_name string, ecosystem string")
    r = spark.createDataFrame([("b", 2.0)], "service_name string, v double")
    assert sorted(rows(M.join_features(e, r))) == [("a", None, 0.0), ("b", "x", 2.0)]


def test_codes_are_alphabetical(spark):
    words = [f"w{i:04d}" for i in range(500)] + ["Zed", "é", "a"]
    df = spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "c string")
    got = dict(rows(M.encode(df, ["c"]).select("c", "c_enc").distinct()))
    assert got == {w: i for i, w in enumerate(sorted([*words, "unknown"]))}


def test_running_sums_on_lopsided_values(spark):
    xs = [i / 1e6 for i in range(1000)] + [float(i) for i in range(1, 50)]
    df = spark.createDataFrame([(x, i % 7) for i, x in enumerate(xs)], "x double, n bigint")
    got = dict(rows(running_sums(df, "x", ["n"]), "x", "cum_n"))
    total = 0
    for x, n in sorted(((x, i % 7) for i, x in enumerate(xs)), reverse=True):
        total += n
        assert got[x] == total


def test_row_numbers_and_folds(spark):
    df = spark.createDataFrame([(i, int(i < 37)) for i in range(200)], "k bigint, y int")
    r = rows(hashed_row_number(df, ["y"], ["k"]), "y", "rn", "group_size")
    for y, n in ((1, 37), (0, 163)):
        assert sorted(rn for a, rn, _ in r if a == y) == list(range(1, n + 1)) and {g for a, _, g in r if a == y} == {n}
    sizes = [n for _, _, n in rows(L.stratified_folds(df, "y", ["k"]).groupBy("y", "fold").count())]
    assert sorted(sizes) == [7, 7, 7, 8, 8, 32, 32, 33, 33, 33]
    train, test = L.stratified_split(df, "y", ["k"])
    assert (train.count(), test.count()) == (140, 60)
    few, same = L.stratified_split(df.limit(10), "y", ["k"])
    assert few.count() == same.count() == 10


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_with_ties(spark, seed):
    rng = np.random.default_rng(seed)
    pts = [(float(round(s, 1)), int(y)) for s, y in zip(rng.random(150), rng.integers(0, 2, 150))]
    df = spark.createDataFrame(pts, "s double, y int")
    pos, neg = [s for s, y in pts if y], [s for s, y in pts if not y]
    want = sum((a > b) + .5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert rows(Q.rank_auc(df, "s", "y"), "auc")[0][0] == pytest.approx(want)
    last = rows(Q.roc_points(df, "s", "y").orderBy("threshold"), "fpr", "tpr")[0]
    assert last == (1.0, 1.0)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(.1, 1), (.2, 1)], "s double, y int")
    assert rows(Q.rank_auc(df, "s", "y"), "auc") == [(None,)]
    assert rows(Q.confusion(df, "s", "y"), "precision", "recall", "f1") == [(0.0, 0.0, 0.0)]


@pytest.mark.parametrize("scores,want", [((.80, .805, .9), "Boosted Trees"), ((.9, .8, .7), "Random Forest"), ((.7, .8, .95), "Neural Network")])
def test_model_choice(spark, scores, want):
    df = spark.createDataFrame(list(zip(("Random Forest", "Boosted Trees", "Neural Network"), scores)), "model string, cv_auc double")
    assert rows(Q.choose_model(df)) == [(want,)]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(5)
    xs = np.vstack([rng.normal(size=(400, 3)), [[9.0, 9.0, 9.0]]])
    df = spark.createDataFrame([(f"p{i}", *map(float, x), float(x[0] + .3 * x[1] > 0)) for i, x in enumerate(xs)],
                               "service_name string, a double, b double, c double, label double")
    return L.balance(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))


def test_isolation_forest_finds_the_outlier(spark, points):
    forest = I.fit_iforest(points, trees=40, psi=64)
    sizes = rows(forest.filter(F.col("node") == 0).select("size").distinct())
    assert sizes == [(64,)] and forest.select("tree").distinct().count() == 40
    out = I.anomaly_scores(points.select("service_name", "features"), forest)
    top = out.orderBy(F.col("anomaly_score").desc()).first()
    assert top["service_name"] == "p400" and top["anomaly_flag"] == 1 and top["anomaly_score"] == pytest.approx(1, abs=1e-6)
    small = I.fit_iforest(points.limit(20), trees=3)
    assert rows(small.filter(F.col("node") == 0).select("size").distinct()) == [(20,)]


def test_logistic_regression_matches_the_penalised_optimum(spark, points):
    """Gradient of the summed balanced loss plus half the squared norm is zero at the fit."""
    n = points.count()
    model = L.lr_pipeline(n).fit(points)
    w, b = model.stages[1].coefficients.toArray(), model.stages[1].intercept
    data = np.array([[*r["features"], r["label"], r["class_weight"]] for r in points.collect()])
    x, y, s = data[:, :3], data[:, 3], data[:, 4]
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    scale = x.std(axis=0) / x.std(axis=0, ddof=1)
    wz = w * scale
    p = 1 / (1 + np.exp(-(z @ wz + b)))
    grad = wz + .01 * (z * ((p - y) * s)[:, None]).sum(axis=0)
    assert np.abs(grad).max() < 2e-2 * np.abs(wz).max()
    scored = L.with_score(model, points, "p")
    assert Q.rank_auc(scored, "p", "label").first()["auc"] > .95


def test_boosted_trees_against_plain_python(spark, points):
    """Leaf weights with L1, L2 and least child weight, cuts and margins of a few trees on all rows and inputs."""
    s = boosting.Settings(trees=12, rows=1.0, cols=1.0, bins=16)
    model = boosting.fit(points, ["service_name"], settings=s)
    data = np.array([[*r["features"], r["label"]] for r in points.collect()])
    x, y = data[:, :3], data[:, 3]
    weight, margin = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0), np.zeros(len(y))

    def worth(g, h):
        return max(abs(g) - s.alpha, 0) ** 2 / (h + s.lam)

    def grow(rows, depth, g, h):
        best, best_gain = None, 1e-6
        for f in range(3) if depth else ():
            for cut in model.edges[f]:
                low = rows[x[rows, f] <= cut]
                high = rows[x[rows, f] > cut]
                if h[low].sum() >= s.child and h[high].sum() >= s.child:
                    gain = .5 * (worth(g[low].sum(), h[low].sum()) + worth(g[high].sum(), h[high].sum()) - worth(
                        g[rows].sum(), h[rows].sum()))
                    if gain > best_gain + 1e-5:
                        best, best_gain = (low, high), gain
        if best is None:
            total = g[rows].sum()
            return {int(i): -np.sign(total) * max(abs(total) - s.alpha, 0) / (h[rows].sum() + s.lam) for i in rows}
        return grow(best[0], depth - 1, g, h) | grow(best[1], depth - 1, g, h)

    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-margin))
        value = grow(np.arange(len(y)), 2, weight * (p - y), weight * p * (1 - p))
        margin += s.rate * np.array([value[i] for i in range(len(y))])
    assert np.abs(model.margins(x) - margin).max() < 1e-4
    assert model.importances().sum() == pytest.approx(1) and model.importances().argmax() == 0


def test_sums_of_many_tasks_equal_those_of_one(spark, points, monkeypatch):
    s, t = boosting.Settings(trees=2), network.Settings(steps=3)
    trees, net = boosting.fit(points, ["service_name"], settings=s), network.fit(points, ["service_name"], settings=t)
    monkeypatch.setattr("riskweave.session.TASK_BYTES", 2048)
    x = np.array([r["features"].toArray() for r in points.collect()])
    assert np.array_equal(boosting.fit(points, ["service_name"], settings=s).margins(x), trees.margins(x))
    assert np.allclose(network.fit(points, ["service_name"], settings=t).margins(x), net.margins(x), atol=1e-4)


def test_boosted_folds_equal_fits_of_their_own(spark, points):
    folded = points.withColumn("fold", F.pmod(F.xxhash64("service_name"), F.lit(2)).cast("int"))
    s = boosting.Settings(trees=3)
    both = boosting.fit(folded, ["service_name"], fold="fold", folds=2, settings=s)
    x = np.array([r["features"].toArray() for r in points.collect()])
    for m in (0, 1):
        alone = boosting.fit(folded.filter(F.col("fold") != m), ["service_name"], settings=s)
        got, want = both.margins(x, m), alone.margins(x)
        assert np.corrcoef(got, want)[0, 1] > .8
    scored = L.score_rows(folded, both, "p", "fold")
    assert Q.rank_auc(scored, "p", "label").first()["auc"] > .85
    assert boosting.fit(folded.limit(0), ["service_name"], settings=s).trees == [[]]


def test_network_gradient_and_learning(spark, points):
    rng, s = np.random.default_rng(2), network.Settings(hidden=(4, 3))
    x, y, theta = rng.normal(size=(9, 3)), rng.integers(0, 2, 9).astype(float), network.start(3, s)
    grad, loss = network.gradient(theta, x, y, s)
    for i in range(len(theta)):
        step = np.zeros(len(theta))
        step[i] = 1e-6
        assert (network.gradient(theta + step, x, y, s)[1] - network.gradient(theta - step, x, y, s)[1]) / 2e-6 == pytest.approx(
            grad[i], abs=1e-4)
    folded = points.withColumn("fold", F.pmod(F.xxhash64("service_name"), F.lit(2)).cast("int"))
    model = network.fit(folded, ["service_name"], fold="fold", folds=2, settings=network.Settings(steps=40))
    first, last = model.history[0], model.history[-1]
    assert all(b[1] < .7 * a[1] for a, b in zip(first, last))
    assert Q.rank_auc(L.score_rows(folded, model, "p", "fold"), "p", "label").first()["auc"] > .95
    empty = network.fit(points.limit(0), ["service_name"], settings=network.Settings(steps=3))
    assert len(empty.thetas) == 1


def test_batches_pass_as_matrices_and_in_large_parts():
    rows = np.arange(24, dtype=np.int32).reshape(8, 3)
    batch = lambda part: pa.RecordBatch.from_arrays([boosting.lists(part, pa.int32())], names=["b"])
    dealt = [batch(rows[:2]), batch(rows[:0]), batch(rows[2:5]), batch(rows[5:])]
    parts = [boosting.matrix(b.column("b"), 3) for b in boosting.gathered(iter(dealt), 4)]
    assert [len(p) for p in parts] == [5, 3] and np.array_equal(np.concatenate(parts), rows)
    assert list(boosting.gathered(iter([batch(rows[:0])]))) == []
