"""Values printed with the small fixed inputs of FIXTURES.md."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.scalar import extract_title
from millrace.operators import boost, factor, features, linear, metrics, similarity, stats, voronoi
from millrace.operators.quantiles import exact_quantiles
from millrace.sources.text import read_libsvm_long



def test_zscore(spark):
    df = spark.createDataFrame([(1.0, -1.0, 2.0), (2.0, 0.0, 0.0), (0.0, 1.0, -1.0)], "a double, b double, c double")
    z = features.ZScore(["a", "b", "c"]).fit(df)
    assert np.allclose(list(z.mean.values()), [1, 0, 1 / 3])
    assert np.allclose(list(z.std.values()), [0.81649658, 0.81649658, 1.24721913])
    constant = features.ZScore(["k"]).fit(spark.createDataFrame([(5.0,), (5.0,)], "k double"))
    assert constant.std["k"] == 1.0


def test_pearson(spark):
    df = spark.createDataFrame(list(zip([1, 2, 39, 0, 8], [1, 2, 38, 0, 8])), "a int, b int")
    assert stats.pearson_corr(df, "a", "b").first()[0] == pytest.approx(0.9999862313609312)


def test_boxplot(spark):
    df = spark.createDataFrame([(float(x),) for x in (12, 15, 17, 19, 20, 23, 25, 28, 30, 33, 34, 35, 36, 37)], "x double")
    assert tuple(exact_quantiles(df, [], "x", [0.25, 0.5, 0.75]).first()) == (19.25, 26.5, 33.75)


def test_roc(spark):
    hard = spark.createDataFrame(list(zip([1, 1, 1, 1, 0, 0, 0, 0], [1, 0, 1, 1, 0, 1, 1, 0])), "y int, p int")
    assert tuple(metrics.binary_confusion(hard, "y", "p").first()) == (3, 2, 2, 1)
    assert metrics.auc_hard(hard, "y", "p").first()[0] == pytest.approx(0.625)
    soft = spark.createDataFrame(list(zip([1, 1, 1, 1, 0, 0, 0, 0], [.8, .3, .9, .6, .1, .5, .7, .2])), "y int, p double")
    assert metrics.auc_rank(soft, "y", "p").first()[0] == pytest.approx(0.8125)
    assert metrics.auc_polygon(metrics.roc_points(soft, "y", "p")).first()[0] == pytest.approx(0.8125)


DISHES = [
    [2, 0, 0, 4, 4, 0, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 5], [0, 0, 0, 0, 0, 0, 0, 1, 0, 4, 0],
    [3, 3, 4, 0, 3, 0, 0, 2, 2, 0, 0], [5, 5, 5, 0, 0, 0, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0, 0, 5, 0, 0, 5, 0],
    [4, 0, 4, 0, 0, 0, 0, 0, 0, 0, 5], [0, 0, 0, 0, 0, 4, 0, 0, 0, 0, 4], [0, 0, 0, 0, 0, 0, 5, 0, 0, 5, 0],
    [0, 0, 0, 3, 0, 0, 0, 0, 4, 5, 0], [1, 1, 2, 1, 1, 2, 1, 0, 4, 5, 0]]


def dishes(spark):
    return spark.createDataFrame([(u, i, float(r)) for u, row in enumerate(DISHES) for i, r in enumerate(row) if r],
                                 "u long, i long, r double")


def test_svd_values_and_items(spark):
    model = factor.SvdFactors(k=5, max_iter=12, tol=1e-7).fit(dishes(spark))
    want = np.linalg.svd(np.array(DISHES, float), compute_uv=False)
    assert np.allclose(model.singular_values, want[:5], atol=1e-3)
    u, s, vt = np.linalg.svd(np.array(DISHES, float))
    got = {r["i"]: r["x"] for r in model.item_factors().collect()}
    assert np.allclose(np.abs([got[i][0] for i in range(11)]), np.abs(vt[0]), atol=1e-2)


def test_svd_makes_no_block_after_the_last_round(spark, monkeypatch):
    plain, made = factor._multiply, []
    monkeypatch.setattr(factor, "_multiply", lambda *a: (made.append(a[3]), plain(*a))[1])
    factor.SvdFactors(k=2, max_iter=3, tol=0.0).fit(dishes(spark))
    assert made == ["u", "i", "u", "i", "u"]


def test_svd_energy(spark):
    model = factor.SvdFactors(energy=0.9, max_iter=12, tol=1e-7).fit(dishes(spark))
    want = np.linalg.svd(np.array(DISHES, float), compute_uv=False) ** 2
    assert len(model.singular_values) == int(np.argmax(np.cumsum(want) / want.sum() >= 0.9)) + 1


def test_svd_recommend_brute_force(spark):
    r = dishes(spark)
    model = factor.SvdFactors(k=4, max_iter=12, tol=1e-7).fit(r)
    x = {row["i"]: np.array(row["x"]) for row in model.item_factors().collect()}
    got = {(row["u"], row["i"]): row["score"] for row in factor.svd_recommend(r, model, 3).collect()}
    m = np.array(DISHES, float)
    for u in range(11):
        scores = {}
        for i in np.flatnonzero(m[u] == 0):
            sims = [0.5 + 0.5 * x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) for j in np.flatnonzero(m[u])]
            scores[i] = np.dot(sims, m[u][m[u] > 0]) / sum(sims)
        best = sorted(scores.values(), reverse=True)[:3]
        mine = sorted((s for (a, _), s in got.items() if a == u), reverse=True)
        assert np.allclose(mine, best)


def test_gradient_ascent_twin(spark):
    x = np.array([[1, -0.2, 1.1], [1, 0.9, 2.3], [1, 1.4, -0.3], [1, -1.2, 0.2], [1, 0.1, -2.0], [1, -0.5, -0.7]])
    y = np.array([1, 1, 1, 0, 0, 0])
    df = spark.createDataFrame([(*map(float, row), int(t)) for row, t in zip(x, y)], "a double, b double, c double, y int")
    w = np.ones(3)
    for _ in range(8):
        w = w + 0.01 * x.T @ (y - 1 / (1 + np.exp(-x @ w)))
    assert np.allclose(linear.logreg_gradient_ascent(df, ["a", "b", "c"], "y", 0.01, 8), w)


def test_voronoi_grid(spark):
    seeds = spark.createDataFrame([(y * 3 + x, x, y) for y in range(3) for x in range(3)], "id long, x int, y int")
    cells = voronoi.voronoi_cells(seeds, 3, 3)
    assert all(r["area"] == 1 for r in voronoi.cell_areas(cells).collect())
    pairs = {(r["a"], r["b"]) for r in voronoi.voronoi_neighbours(cells).collect()}
    assert pairs == {(i, i + 1) for i in range(9) if i % 3 < 2} | {(i, i + 3) for i in range(6)}


def test_euclid_and_pearson_small(spark):
    r = spark.createDataFrame([(1, 1, 3.0), (1, 2, 5.0), (2, 1, 1.0), (2, 2, 2.0), (3, 9, 4.0)], "u long, i long, r double")
    e = similarity.euclid_similarity(r).collect()
    assert [(x["a"], x["b"]) for x in e] == [(1, 2)]
    assert e[0]["sim"] == pytest.approx(1 / (1 + math.sqrt(4 + 9)))
    assert similarity.pearson_similarity(r).first()["sim"] == pytest.approx(1.0)


def test_titles(spark):
    df = spark.createDataFrame([("Braund, Mr. Owen Harris",), ("NoTitle",)], "name string")
    rows = df.select(*[extract_title("name", m).alias(m) for m in ("word", "spaced", "between")]).collect()
    assert tuple(rows[0]) == ("Mr", "Mr", "Mr")
    assert tuple(rows[1]) == ("", "", "")


def test_dump_text(spark):
    model = boost.BoostModel(["a"], boost.Params(), [boost.Tree(nodes={
        0: boost.Node(0, 0, 0, feature=0, threshold=0.5, missing_left=True), 1: boost.Node(1, 0, 0, leaf=1.5),
        2: boost.Node(2, 0, 0, leaf=-1.25)})])
    lines = [r["line"] for r in boost.dump_trees(model, spark).orderBy("node").collect()]
    assert lines == ["0:[f0<0.500000] yes=1,no=2,missing=1", "\t1:leaf=1.500000", "\t2:leaf=-1.250000"]


# --- boosting against a brute-force twin on own rows ---------------------------------------------
def best_split(rows, features, p, lam=1.0):
    """(gain, feature, threshold) of the best cut of ``(x, y)`` rows at margin p, missing values on the better side."""
    best = (0.0, -1, 0.0)
    score = lambda part: sum(p - y for _, y in part) ** 2 / (sum(p * (1 - p) for _ in part) + lam)
    for j in range(features):
        for t in sorted({x[j] for x, _ in rows if x[j] is not None}):
            low, high, none = ([r for r in rows if r[0][j] is not None and r[0][j] < t], [r for r in rows if r[0][j] is not None and r[0][j] >= t],
                               [r for r in rows if r[0][j] is None])
            for left, right in ((low + none, high), (low, high + none)):
                gain = score(left) + score(right) - score(rows)
                if left and right and gain > best[0] + 1e-9:
                    best = (gain, j, t)
    return best


def test_first_split_matches_brute_force(spark):
    rows = [((i % 7 if i % 5 else None, (i * i) % 11), int((i * i) % 11 > 4 or i % 7 == 3)) for i in range(80)]
    df = spark.createDataFrame([(i, None if x[0] is None else float(x[0]), float(x[1]), y) for i, (x, y) in enumerate(rows)],
                               "id long, a double, b double, y int")
    model = boost.NewtonBoost(objective="binary:logistic", num_round=1, max_depth=1, min_child_weight=0.0).fit(df, "id", ["a", "b"], "y")
    gain, feature, threshold = best_split(rows, 2, 0.5)
    root = model.trees[0].nodes[0]
    assert (root.feature, root.threshold) == (feature, threshold)
    assert root.gain == pytest.approx(gain)


def test_nan_and_null_go_the_missing_way_in_models_of_any_size(spark, monkeypatch):
    model = boost.BoostModel(["a"], boost.Params(objective="reg:linear", base_score=0.0), [boost.Tree(nodes={
        0: boost.Node(0, 0, 0, feature=0, threshold=0.5, missing_left=True), 1: boost.Node(1, 0, 0, leaf=1.0), 2: boost.Node(2, 0, 0, leaf=-1.0)})])
    df = spark.createDataFrame([(float("nan"),), (None,), (0.0,), (1.0,)], "a double")
    small = [r["pred"] for r in model.predict(df).collect()]
    monkeypatch.setattr(boost, "CASE_NODES", 0)
    assert small == [r["pred"] for r in model.predict(df).collect()] == [1.0, 1.0, 1.0, -1.0]


def test_libsvm_zero_based_and_unordered(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1 5:2.5 0:1\n0\n\n1 3:4\n")
    rows = [tuple(r)[1:] for r in read_libsvm_long(spark, str(tmp_path)).collect()]
    assert rows == [(1.0, 5, 2.5), (1.0, 0, 1.0), (0.0, None, None), (1.0, 3, 4.0)]
