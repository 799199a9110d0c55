"""Adaptive cells, merged modes, tiled ranking gradients, boosting histograms and ordered neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import boost, cluster, joins, metrics, quantiles


def test_epsilon_join_with_a_hot_cell(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.random((300, 2)) * 10, 5 + rng.random((500, 2)) * 0.3])
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(x)], "id long, x double, y double")
    got = {(r["a"], r["b"]) for r in joins.epsilon_range_join(df, "id", ["x", "y"], 0.31, cell_rows=60).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert got == {(a, b) for a, b in zip(*np.nonzero(np.triu(d <= 0.31, 1)))}


def test_merged_modes_are_those_of_the_plain_loop(spark):
    rng = np.random.default_rng(1)
    modes = [(float(m), float(a), float(b)) for m, (a, b) in zip(rng.integers(1, 30, 400), rng.random((400, 2)) * 6)]
    kept = []
    for m, a, b in sorted(modes, key=lambda r: (-r[0], r[1], r[2])):
        if all(math.dist((a, b), k) > 0.5 for k in kept):
            kept.append((a, b))
    got = cluster.merged_modes(spark.createDataFrame(modes, "mass double, x double, y double"), ["x", "y"], 0.5).orderBy("id").collect()
    assert [(r["x"], r["y"]) for r in got] == kept and [r["id"] for r in got] == list(range(len(kept)))


def brute_pairwise(y, m):
    g, h = np.zeros(len(y)), np.zeros(len(y))
    for lo in range(0, len(y), 500):
        s = np.sign(y[lo: lo + 500, None] - y[None])
        p = np.where(s != 0, 1 / (1 + np.exp(s * (m[lo: lo + 500, None] - m[None]))), 0)
        g[lo: lo + 500], h[lo: lo + 500] = -(s * p).sum(1), (2 * p * (1 - p)).sum(1)
    return g, h


def test_ranking_gradients_of_one_large_group(spark):
    rng = np.random.default_rng(2)
    n = 8_000
    y, m = rng.integers(0, 4, n).astype(float), rng.standard_normal(n)
    rows = [(i, "big", float(a), float(b)) for i, (a, b) in enumerate(zip(y, m))] + [(n + i, "small", float(i % 2), 0.5 * i) for i in range(6)] + [(n + 6, "lone", 1.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, grp string, y double, m double")
    got = {r["id"]: (r["g"], r["h"]) for r in boost.pairwise_gradients(df, "grp", "y", "m").collect()}
    g, h = brute_pairwise(y, m)
    assert np.allclose([got[i] for i in range(n)], np.stack([g, h], 1), rtol=1e-9, atol=1e-9)
    g, h = brute_pairwise(np.array([i % 2 for i in range(6)], float), np.arange(6) * 0.5)
    assert np.allclose([got[n + i] for i in range(6)], np.stack([g, h], 1)) and got[n + 6] == (0.0, 0.0)


@pytest.fixture(scope="module")
def xor(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (1200, 5)).astype(float)
    y = ((x[:, 0] > 8) ^ (x[:, 1] > 12)).astype(int) ^ (rng.random(1200) < 0.1)
    rows = [(i, *[None if rng.random() < 0.05 else float(v) for v in a], int(t), i % 7) for i, (a, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, x3 double, x4 double, y int, grp int").persist()


NAMES = [f"x{j}" for j in range(5)]


def test_histogram_rows_do_not_grow_with_the_table(spark, xor):
    def rows(df):
        parts = df.coalesce(2).select(F.array(*[F.coalesce(c, F.lit(-1)).cast("smallint") for c in NAMES]).alias("bins"), F.array(F.struct(
            F.lit(0).alias("s"), (F.col("id") % 3).cast("int").alias("node"), F.col("y").cast("double").alias("g"), F.lit(1.0).alias("h"))).alias("c"))
        return parts.mapInArrow(boost._histograms(23), "s int, node int, f int, b int, g double, h double")

    some, many = rows(xor), rows(xor.unionByName(xor).unionByName(xor))
    assert some.count() <= 2 * 3 * 5 * 21 and many.count() <= 1.1 * some.count()
    want = {(r["id"] % 3, j, -1 if r[f"x{j}"] is None else int(r[f"x{j}"])): 0 for r in xor.collect() for j in range(5)}
    for r in xor.collect():
        for j in range(5):
            want[r["id"] % 3, j, -1 if r[f"x{j}"] is None else int(r[f"x{j}"])] += r["y"]
    got = {(r["node"], r["f"], r["b"]): r["g"] for r in some.groupBy("node", "f", "b").agg(F.sum("g").alias("g")).collect()}
    assert got == want


def test_sampled_features_follow_from_the_seed(xor):
    def trees(seed):
        model = boost.NewtonBoost(objective="binary:logistic", num_round=2, max_depth=2, colsample_bytree=0.6, colsample_bylevel=0.7, colsample_bynode=0.5, seed=seed).fit(xor, "id", NAMES, "y")
        return [{n.feature for n in t.nodes.values() if n.feature >= 0} for t in model.trees], [(n.feature, n.threshold) for t in model.trees for n in t.nodes.values()]

    used, first = trees(1)
    assert all(len(u) <= 3 for u in used) and first == trees(1)[1]
    assert any(trees(s)[1] != first for s in (2, 3))


def test_dart_keeps_a_constant_plan(xor):
    fit = boost.NewtonBoost(objective="binary:logistic", dart=True, rate_drop=0.4, one_drop=True, num_round=6, max_depth=2)
    sizes = []
    grow = fit._with_margins
    fit._with_margins = lambda table, new: (sizes.append(len(str(fit._margins()[0]))), grow(table, new))[1]
    model = fit.fit(xor, "id", NAMES, "y")
    # each tree adds one number to the expression, not its splits
    assert max(np.diff(sizes)) < 60
    direct = [r[0] for r in model.predict(xor, margin=True).orderBy("id").select("pred").collect()]
    stored = [r[0] for r in fit.table.orderBy("key").select(fit._margins()[0]).collect()]
    assert np.allclose(direct, stored, atol=1e-9)


def test_ready_metrics_and_the_best_round(xor):
    train, test = xor.where("id % 4 <> 0"), xor.where("id % 4 = 0")
    model = boost.NewtonBoost(objective="binary:logistic", num_round=3, max_depth=2).fit(train, "id", NAMES, "y", watch={"train": train, "test": test}, metric=["error@0.4", "logloss", "auc"])
    assert set(model.history[0]) == {f"{t}-{m}" for t in ("train", "test") for m in ("error@0.4", "logloss", "auc")}
    values = [h["test-auc"] for h in model.history]
    assert model.best_round == values.index(max(values)) and model.best_trees() == model.best_round + 1
    ranks = boost.NewtonBoost(objective="rank:pairwise", num_round=2, max_depth=2).fit(train, "id", NAMES, "y", group="grp", watch={"train": train})
    assert all(0 < h["train"] <= 1 for h in ranks.history) and ranks.history[-1]["train"] >= ranks.history[0]["train"] - 0.05
    with pytest.raises(ValueError):
        boost.ready_metric("nothing")


def test_previous_rows_and_areas(spark):
    rng = np.random.default_rng(5)
    pts = [(g, float(a), float(b)) for g in ("a", "b", None) for a, b in zip(np.sort(rng.random(700)), np.sort(rng.random(700)))]
    df = spark.createDataFrame(pts, "g string, x double, y double").repartition(7)
    got = quantiles.previous_rows(df, ["g"], ["x", "y"], ["x"]).collect()
    for g in ("a", "b", None):
        own = sorted((r["x"], r["prev_x"]) for r in got if r["g"] == g and r["prev_x"] is not None)
        xs = sorted(x for k, x, _ in pts if k == g)
        assert own == list(zip(xs[1:], xs))
    areas = {r["g"]: r["auc"] for r in metrics.auc_polygon(df.unionByName(df), "x", "y", ["g"]).collect()}
    for g in ("a", "b", None):
        p = [(0, 0), *sorted((x, y) for k, x, y in pts if k == g), (1, 1)]
        assert abs(areas[g] - sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(p, p[1:]))) < 1e-9
