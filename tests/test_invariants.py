"""Invariants and brute-force twins, with the split paths for hot groups forced on."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.scalar import key_hash
from millrace.operators import boost, c45, cluster, factor, graph, joins, linear, metrics, nearest, quantiles, reduce, similarity, stats, text, validate
from millrace.operators.pairs import pair_moments
from millrace.operators.quantiles import ordered_rank, running_sums
from millrace.plans import views
from millrace.streaming import jobs

rng = np.random.default_rng(5)


@pytest.fixture(scope="module")
def hot(spark):
    """Item 0 holds a third of all cells."""
    cells = {(u, 0) for u in range(60)} | {(int(u), int(i)) for u, i in zip(rng.integers(0, 60, 120), rng.integers(1, 25, 120))}
    rows = [(u, i, float(rng.integers(1, 6))) for u, i in sorted(cells)]
    return rows, spark.createDataFrame(rows, "u long, i long, r double").persist()


def brute_moments(rows):
    by = defaultdict(dict)
    for u, i, r in rows:
        by[u][i] = r
    out = {}
    for a in by:
        for b in by:
            common = by[a].keys() & by[b].keys()
            if a < b and common:
                x, y = np.array([by[a][i] for i in common]), np.array([by[b][i] for i in common])
                out[a, b] = (len(x), x.sum(), y.sum(), (x * x).sum(), (y * y).sum(), (x * y).sum())
    return out


@pytest.mark.parametrize("sizes", [{}, {"heavy": 8, "tile": 7, "slab": 3}, {"heavy": 0, "tile": 16, "slab": 50}])
def test_pair_moments_heavy_and_light(hot, sizes):
    rows, df = hot
    got = {(r["a"], r["b"]): tuple(r)[2:] for r in pair_moments(df, "u", "i", "r", **sizes).collect()}
    want = brute_moments(rows)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k]) for k in want)


@pytest.mark.parametrize("weight", ["similarity", "distance"])
@pytest.mark.parametrize("mean_over", ["rated", "all"])
def test_predict_user_dense_twin(spark, hot, weight, mean_over):
    rows, df = hot
    m = np.zeros((60, 25))
    for u, i, r in rows:
        m[u, i] = r
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    sim = unit @ unit.T
    if weight == "distance":
        sim = 1 - sim
    if mean_over == "all":
        mean = m.mean(axis=1)
        diff = m - mean[:, None]
    else:
        mean = m.sum(axis=1) / (m > 0).sum(axis=1)
        diff = np.where(m > 0, m - mean[:, None], 0)
    want = mean[:, None] + sim @ diff / np.abs(sim).sum(axis=1)[:, None]
    cells = spark.createDataFrame([(u, i) for u in range(0, 60, 7) for i in range(25)], "u long, i long")
    for r in similarity.predict_user_based(df, cells, weight, mean_over, 25).collect():
        assert r["pred"] == pytest.approx(want[r["u"], r["i"]], abs=1e-9)


@pytest.mark.parametrize("weight", ["similarity", "distance"])
def test_predict_item_dense_twin(spark, hot, weight):
    rows, df = hot
    items = sorted({i for _, i, _ in rows})
    m = np.zeros((60, len(items)))
    for u, i, r in rows:
        m[u, items.index(i)] = r
    unit = m / np.linalg.norm(m, axis=0, keepdims=True)
    sim = unit.T @ unit if weight == "similarity" else 1 - unit.T @ unit
    want = m @ sim / np.abs(sim).sum(axis=1)[None, :]
    cells = spark.createDataFrame([(u, i) for u in range(0, 60, 9) for i in items], "u long, i long")
    for r in similarity.predict_item_based(df, cells, weight).collect():
        assert r["pred"] == pytest.approx(want[r["u"], items.index(r["i"])], abs=1e-9)


@pytest.mark.parametrize("heavy", [1_000, 12, 3])
def test_predict_item_by_lists_and_by_pairs(spark, hot, heavy):
    """Repeated cells add up, a wanted item may be rated, and nulls match nothing, whichever way a user or item goes."""
    rows, _ = hot
    rows = [*rows, (3, 0, 2.0), (3, 0, 1.0), (5, 7, 4.0), (5, 7, 4.0)]
    df = spark.createDataFrame([*rows, (None, 1, 3.0), (4, None, 2.0), (61, 2, None)], "u long, i long, r double")
    items, m, norm = sorted({i for _, i, _ in rows}), defaultdict(float), defaultdict(float)
    for u, i, r in rows:
        m[u, i] += r
    for _, i, r in [*rows, (None, 1, 3.0)]:
        norm[i] += r * r
    x = {(u, i): r / math.sqrt(norm[i]) for (u, i), r in m.items()}
    users = range(60)
    sim = {(a, b): 1.0 if a == b else sum(x.get((v, a), 0) * x.get((v, b), 0) for v in users) for a in items for b in items}
    cells = [(u, i) for u in range(0, 60, 5) for i in items] + [(None, 1), (4, None), (99, 0), (3, 99)]
    got = {(r["u"], r["i"]): r["num"] for r in similarity._weighted_ratings(
        *similarity_rows(df), spark.createDataFrame(cells, "u long, i long"), heavy).groupBy("u", "i").agg(F.sum("part").alias("num")).collect()}
    for u, i in cells[:-4]:
        want = sum(m.get((u, j), 0) * sim[i, j] for j in items)
        assert (got.get((u, i)) or 0) == pytest.approx(want, abs=1e-9), (u, i)
    assert not any(got.get(c) for c in cells[-4:])


def similarity_rows(df):
    norms = similarity.entity_norms(df, "i")
    return df.join(norms, "i").select("u", "i", "r", (F.col("r") / F.col("norm")).alias("x")), norms


def test_predict_item_makes_no_row_for_each_pair_of_items(spark, monkeypatch):
    monkeypatch.setattr(similarity, "pair_moments", lambda *a, **k: pytest.fail("pairs of items are made"))
    df = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u in range(20) for i in range(8) if (u * i) % 3], "u long, i long, r double")
    assert similarity.predict_item_based(df, df.select("u", "i")).count() == df.count()


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.integers(0, 6), st.integers(0, 6)), st.integers(1, 5), min_size=5, max_size=30))
def test_similarities_in_range(spark, cells):
    df = spark.createDataFrame([(u, i, float(r)) for (u, i), r in cells.items()], "u long, i long, r double")
    for f, low in ((similarity.euclid_similarity, 0), (similarity.pearson_similarity, -1), (similarity.cosine_similarity, -1)):
        for r in f(df).collect():
            assert low - 1e-9 <= r["sim"] <= 1 + 1e-9


def test_quantiles_by_rank_equal_percentile(spark):
    rows = [("hot", float(x)) for x in rng.normal(size=900).round(2)] + [("cold", float(x)) for x in rng.integers(0, 5, 60)] + [("one", 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    a = {r["k"]: tuple(r)[1:] for r in quantiles.exact_quantiles(df, ["k"], "v", probs).collect()}
    b = {r["k"]: tuple(r)[1:] for r in quantiles.exact_quantiles(df, ["k"], "v", probs, group_values=20).collect()}
    for k in a:
        assert np.allclose(a[k], b[k]), k
    want = np.quantile([v for k, v in rows if k == "hot"], probs)
    assert np.allclose(a["hot"], want)


def test_describe_table_narrows_columns_of_many_values_by_rank(spark, monkeypatch):
    rows = [(float(x), float(y)) for x, y in zip(rng.normal(size=600).round(3), rng.integers(0, 5, 600))]
    df = spark.createDataFrame(rows + [(None, 1.0)], "wide double, narrow double")
    want = {r["column"]: tuple(r)[1:] for r in stats.describe_table(df, ["wide", "narrow"]).collect()}
    monkeypatch.setattr(stats, "GROUP_VALUES", 20)
    found = {r["column"]: tuple(r)[1:] for r in stats.describe_table(df, ["wide", "narrow"]).collect()}
    assert found.keys() == want.keys() and all(np.allclose(found[c], want[c]) for c in want)
    assert tuple(quantiles.exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], "wide", [0.5], 20).first()) == pytest.approx((0, want["wide"][6]))


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_in_buckets(spark, descending):
    values = rng.integers(0, 50, 400) / 10
    df = spark.createDataFrame([(float(v), 1) for v in values], "o double, n int")
    got = {r["o"]: r["cum_n"] for r in quantiles.running_sums(df, "o", ["n"], descending, bucket_rows=7).collect()}
    for o, n in got.items():
        assert n == ((values >= o) if descending else (values <= o)).sum()


def test_ranks_in_buckets(spark):
    rows = [(i, "a" if i % 3 else "b", float(v)) for i, v in enumerate(np.where(rng.random(300) < 0.5, 1.0, rng.random(300)))]
    df = spark.createDataFrame(rows, "id long, g string, s double")
    got = {r["id"]: r["rank"] for r in quantiles.ordered_rank(df, ["g"], "s", "id", descending=True, bucket_rows=20).collect()}
    for g in "ab":
        order = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))
        assert [got[r[0]] for r in order] == list(range(1, len(order) + 1))
    hashed = df.withColumn("h", (F.col("id") * 37) % 1000)
    rank = {r["id"]: r["rank"] for r in quantiles.ordered_rank(hashed, ["g"], "h", "id", False, bucket_rows=30).collect()}
    for g in "ab":
        order = sorted((r for r in rows if r[1] == g), key=lambda r: ((r[0] * 37) % 1000, r[0]))
        assert [rank[r[0]] for r in order] == list(range(1, len(order) + 1))


def points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, x array<double>")


@pytest.mark.parametrize("block", [5, 2048])
def test_knn_join_brute_force(spark, block):
    x = np.vstack([rng.normal(size=(40, 3)), rng.normal(size=(20, 3)) + 4, np.tile([[1.0, 2.0, 3.0]], (30, 1))])
    df = points(spark, x)
    d = np.sqrt(nearest.squared_distances(x, x))
    got = defaultdict(list)
    for r in nearest.knn_join(df, df, 4, exclude_self=True, pivots=6, block=block).collect():
        got[r["qid"]].append((r["rank"], r["cid"], r["dist"]))
    for q in range(len(x)):
        order = sorted((d[q, j], j) for j in range(len(x)) if j != q)[:4]
        assert [(c, pytest.approx(s)) for _, c, s in sorted(got[q])] == [(j, pytest.approx(s)) for s, j in order]
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4]


def test_pairs_within_brute_force(spark):
    x = np.vstack([rng.normal(size=(50, 5)), np.zeros((10, 5))])
    d = np.sqrt(nearest.squared_distances(x, x))
    got = {(r["a"], r["b"]) for r in nearest.pairs_within(points(spark, x), 1.5, pivots=7, block=8).collect()}
    assert got == {(a, b) for a in range(60) for b in range(a + 1, 60) if d[a, b] <= 1.5}


def test_epsilon_join_salted(spark):
    x = rng.random((80, 2)) * 0.5
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, x double, y double")
    d = np.sqrt(nearest.squared_distances(x, x))
    want = {(a, b) for a in range(80) for b in range(a + 1, 80) if d[a, b] <= 0.1}
    got = [(r["a"], r["b"]) for r in joins.epsilon_range_join(df, "id", ["x", "y"], 0.1, cell_rows=3).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def brute_dbscan(x, eps, least):
    d = np.sqrt(nearest.squared_distances(x, x))
    core = (d <= eps).sum(axis=1) >= least
    label = np.full(len(x), -1)
    for s in range(len(x)):
        if core[s] and label[s] < 0:
            stack, label[s] = [s], s
            while stack:
                for j in np.flatnonzero((d[stack.pop()] <= eps) & core & (label < 0)):
                    label[j] = s
                    stack.append(j)
    for p in np.flatnonzero(~core):
        near = [(d[p, q], label[q]) for q in np.flatnonzero(core) if d[p, q] <= eps]
        if near:
            label[p] = min(near)[1]
    return core, label


@pytest.mark.parametrize("light", [10_000, 1])
def test_dbscan_brute_force(spark, light):
    x = np.vstack([rng.normal(size=(120, 2)) * 0.3, rng.normal(size=(100, 2)) * 0.3 + 2, rng.random((60, 2)) * 4 - 1,
                   np.tile([[3.5, -0.5]], (20, 1))])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, x double, y double")
    core, label = brute_dbscan(x, 0.15, 5)
    got = {r["id"]: (r["kind"], r["cluster"]) for r in cluster.dbscan(df, "id", ["x", "y"], 0.15, 5, light).collect()}
    assert len(got) == len(x)
    for i in range(len(x)):
        assert (got[i][0] == "core") == core[i]
        assert got[i][1] == label[i]


def test_components_chain(spark):
    nodes = spark.range(40)
    edges = spark.createDataFrame([(i, i + 1) for i in range(24)] + [(30, 31), (31, 32), (32, 30)], "src long, dst long")
    got = {r["id"]: r["component"] for r in graph.connected_components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(25)) and got[30] == got[31] == got[32] == 30 and got[39] == 39 and len(got) == 40


def test_mean_shift_two_blobs(spark):
    x = np.vstack([rng.normal(size=(60, 2)) * 0.1, rng.normal(size=(60, 2)) * 0.1 + 3])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, x double, y double")
    got = {r["id"]: r["cluster"] for r in cluster.mean_shift(df, "id", ["x", "y"], 1.0).collect()}
    assert len({got[i] for i in range(60)}) == 1 and len({got[i] for i in range(60, 120)}) == 1 and got[0] != got[60]


def test_lloyd_objective_falls(spark):
    x = rng.random((300, 2))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, x double, y double")
    _, history = cluster.lloyd_kmeans(df, "id", ["x", "y"], 5)
    assert all(b <= a + 1e-9 for a, b in zip(history, history[1:]))
    seeds = cluster.kmeanspp_seeds(df, "id", ["x", "y"], 5)
    assert len({tuple(s) for s in seeds}) == 5


def test_pca_scores_have_component_variance(spark):
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    df = points(spark, x)
    pca = reduce.Pca(4).fit(df, "x")
    scores = np.array([r["scores"] for r in pca.transform(df, "x").collect()])
    assert np.allclose(np.cov(scores.T), np.diag(pca.variance), atol=1e-8)
    assert np.allclose(sorted(pca.variance), np.linalg.eigvalsh(np.cov(x.T)))


def test_isomap_unrolls_a_line(spark):
    t = np.linspace(0, 3, 60)
    x = np.stack([np.cos(t), np.sin(t)], axis=1)
    got = {r["id"]: r["coords"][0] for r in reduce.isomap_landmark(points(spark, x), 5, 1, landmarks=20).collect()}
    c = np.corrcoef([got[i] for i in range(60)], t)[0, 1]
    assert abs(c) > 0.999


def test_boost_rounds_add_up(spark):
    x = rng.random((200, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, y int")
    both = boost.NewtonBoost(objective="binary:logistic", num_round=2, max_depth=3).fit(df, "id", ["a", "b"], "y")
    one = boost.NewtonBoost(objective="binary:logistic", num_round=1, max_depth=3)
    first = one.fit(df, "id", ["a", "b"], "y")
    more = one.fit(df, "id", ["a", "b"], "y", model=first)
    p = both.predict(more.predict(df, out="p"), out="q").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert p < 1e-12
    based = first.predict(df, out="m", margin=True)
    second = one.fit(based, "id", ["a", "b"], "y", base_margin="m")
    r = both.predict(second.predict(based, out="p", base=F.col("m")), out="q").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert r < 1e-12


def test_boost_deep_trees_and_walk(spark):
    x = rng.random((400, 3))
    x[::9, 1] = np.nan
    y = np.sin(x[:, 0] * 9) + np.nan_to_num(x[:, 1])
    rows = [(i, *[None if math.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    model = boost.NewtonBoost(num_round=1, max_depth=9, eta=1.0, min_child_weight=2).fit(df, "id", ["a", "b", "c"], "y")
    assert max(model.trees[0].nodes) > 2 ** 8
    a = model.predict(df, out="p")
    limit = boost.CASE_NODES
    try:
        boost.CASE_NODES = 0
        b = model.predict(a, out="q")
        assert b.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-12
    finally:
        boost.CASE_NODES = limit
    assert a.agg(F.avg((F.col("p") - F.col("y")) ** 2)).first()[0] < 0.05


def test_boost_losses_fall_and_dart(spark):
    x = rng.random((150, 2))
    df = spark.createDataFrame([(i, *map(float, r), int(r[0] > 0.6)) for i, r in enumerate(x)], "id long, a double, b double, y int")
    m = boost.NewtonBoost(objective="binary:logistic", num_round=3, max_depth=2, cut_every=1).fit(
        df, "id", ["a", "b"], "y", watch={"train": df}, metric=lambda d: metrics.log_losses(d, "label", {"logloss": "pred"}).first()[0])
    line = [h["train"] for h in m.history]
    assert line == sorted(line, reverse=True)
    d = boost.dart_boost(objective="binary:logistic", num_round=3, max_depth=2, rate_drop=1.0).fit(df, "id", ["a", "b"], "y")
    assert d.trees[0].weight < 1.0


def test_c45_against_recursion(spark):
    rows = [(i, "ab"[i % 2], "xyz"[(i // 2) % 3], "pq"[(i * 7 // 5) % 2], str(int((i % 2 == 0) ^ (i % 11 == 0)))) for i in range(90)]
    names = ["a", "b", "c"]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string, y string")
    tree = {r["node"]: (r["split_attr"], r["n"]) for r in c45.c45_tree_fit(df, names, "y").collect()}

    def entropy(part):
        n = Counter(r[4] for r in part)
        return -sum(k / len(part) * math.log2(k / len(part)) for k in n.values())

    def walk(node, part, left):
        best, ratio = None, 1e-12
        for a in left:
            at = names.index(a) + 1
            groups = defaultdict(list)
            for r in part:
                groups[r[at]].append(r)
            info = -sum(len(g) / len(part) * math.log2(len(g) / len(part)) for g in groups.values())
            gain = entropy(part) - sum(len(g) / len(part) * entropy(g) for g in groups.values())
            if info > 0 and round(gain / info, 12) > ratio:
                best, ratio, chosen = a, round(gain / info, 12), groups
        out = {node: (best, len(part))}
        if best:
            for value, g in chosen.items():
                out.update(walk(f"{node}/{best}={value}", g, [x for x in left if x != best]))
        return out

    assert tree == walk("root", rows, names)


def test_auc_of_negated_score(spark):
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(rng.integers(0, 2, 80), rng.integers(0, 9, 80))], "y int, s double")
    a = metrics.auc_rank(df, "y", "s").first()[0]
    b = metrics.auc_rank(df.withColumn("s", -F.col("s")), "y", "s").first()[0]
    assert a == pytest.approx(1 - b)


def test_partitions_do_not_matter(spark, hot):
    _, df = hot
    out = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        rows = similarity.topn_similar(similarity.euclid_similarity(df.repartition(n)), 3).collect()
        out.append(sorted(map(tuple, rows)))
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert out[0] == out[1]


def test_splits_cover_and_balance(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    train, test = validate.holdout_split(df, "id", 0.3)
    validate.check_disjoint(train, test, "id")
    assert train.count() + test.count() == 1000
    sizes = [r["count"] for r in validate.kfold_assign(df, "id", 7).groupBy("fold").count().collect()]
    assert sorted(sizes) == [142] * 1 + [143] * 6
    folds = validate.stratified_kfold(df, "id", "y", 4).groupBy("fold").agg(F.sum("y").alias("p")).collect()
    assert {r["p"] for r in folds} == {50}


def test_als_loss_falls(spark, hot):
    _, df = hot
    mse = [factor.als_mse(factor.als_explicit(df, rank=3, iters=n, reg=0.02), df).first()[0] for n in (1, 8)]
    assert mse[1] < mse[0]
    rec = factor.als_recommend_topn(factor.als_explicit(df, rank=3, iters=3), df, 4)
    assert rec.join(df, ["u", "i"], "left_semi").isEmpty()


def test_streams_equal_batches(spark, sf, tmp_path):
    vec = views.vectors(spark, sf)
    path = str(tmp_path / "in")
    vec.repartitionByRange(3, "id").write.parquet(path)
    pca = jobs.stream_incremental_pca(jobs.file_stream(spark, path, vec.schema), "x", 3)
    batch = reduce.Pca(3).fit(vec, "x")
    assert np.allclose(pca.components, batch.components) and np.allclose(pca.variance, batch.variance)


def test_context_counts_by_hashes_equal_brute_force(spark, monkeypatch):
    texts = ["a b a a", "b", None, "", "c a b c c b", "solo"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    want = {}
    for t in texts:
        w = (t or "").split()
        for p, x in enumerate(w):
            for c in (c for c in range(max(0, p - 2), min(len(w), p + 3)) if c != p):
                n, near, at = want.get(x, (0, set(), 0))
                want[x] = n + 1, near | {w[c]}, at + c
    pairs = text.skipgram_pairs(df, "id", "t", 2)
    assert {r["target"]: tuple(r)[1:] for r in text.context_counts(pairs).collect()} == {x: (n, len(near), at) for x, (n, near, at) in want.items()}
    # where two words have one hash the next seed is taken
    asked = []
    plain = F.xxhash64
    monkeypatch.setattr(text.F, "xxhash64", lambda key, seed: (asked.append(seed), plain(key, seed) if len(asked) > 1 else F.lit(7).cast("long"))[1])
    assert text._distinct_seed(spark.createDataFrame([("x",), ("y",)], "w string"), "w") == 1 and len(asked) == 2


def test_skipgram_sample_is_subset(spark):
    df = spark.createDataFrame([(1, "a b c d e")], "id long, t string")
    every = {tuple(r) for r in text.skipgram_pairs(df, "id", "t", 2).collect()}
    some = {tuple(r) for r in text.skipgram_pairs(df, "id", "t", 2, num_skips=2).collect()}
    assert some <= every and len(some) == 10 and len(every) == 14


def test_f_survival_known_points():
    assert stats.f_survival(4.0, 1, 1e9) == pytest.approx(0.0455, abs=1e-4)
    assert stats.f_survival(1.0, 10, 10) == pytest.approx(0.5)


# --- behaviour that must not depend on size ------------------------------------------------------
def test_repeated_cells_count_alike_on_both_pair_paths(spark):
    rows = spark.createDataFrame([(1, 7, 1.0), (1, 7, 2.0), (2, 7, 4.0), (3, 7, 1.0), (3, 8, 2.0), (2, 8, 1.0)], "u long, i long, r double")
    light = sorted(map(tuple, pair_moments(rows, "u", "i", "r").collect()))
    heavy = sorted(map(tuple, pair_moments(rows, "u", "i", "r", heavy=0, tile=2, slab=1).collect()))
    assert light == heavy
    assert light[0][:4] == (1, 2, 1, 3.0)


def test_ranks_and_running_sums_do_not_depend_on_size(spark):
    rows = spark.createDataFrame([(i, i % 3 if i % 10 else None, float(i * 7 % 13), 1) for i in range(300)], "id long, g int, x double, w long")
    for by in ([], ["g"]):
        for down in (False, True):
            a, b = (sorted(map(tuple, ordered_rank(rows, by, "x", "id", down, bucket_rows=n).select("id", "rank").collect())) for n in (10**6, 10))
            assert a == b
    for down in (False, True):
        a, b = (sorted(map(tuple, running_sums(rows, "x", ["w"], down, bucket_rows=n).collect())) for n in (10**6, 3))
        assert a == b


def test_key_hash_seeds_are_independent_and_take_any_key(spark):
    rows = spark.range(20_000).select(F.col("id"), F.lit(0).alias("label"))
    folds = validate.stratified_kfold(rows, "id", "label", 5, 2).groupBy("id").pivot("repeat", [0, 1]).agg(F.max("fold"))
    counts = [r["count"] for r in folds.groupBy("0", "1").count().collect()]
    assert len(counts) == 25 and max(counts) < 1.2 * min(counts)
    train, _ = validate.holdout_split(rows, "id", 0.25)
    share = train.where(key_hash("id", 1) < 250_000).count() / train.count()
    assert abs(share - 0.25) < 0.01
    assert spark.createDataFrame([(2**63 - 1,), (-5,)], "id long").where(key_hash("id").between(0, 1_000_002)).count() == 2


def dense_item_prediction(train, u, i):
    items = sorted({x[1] for x in train})
    users = sorted({x[0] for x in train})
    m = np.zeros((len(users), len(items)))
    for a, b, r in train:
        m[users.index(a), items.index(b)] = r
    x = m / np.linalg.norm(m, axis=0)
    sim = (x.T @ x)[items.index(i)]
    return m[users.index(u)] @ sim / np.abs(sim).sum()


def test_signed_ratings_weigh_by_absolute_similarity(spark):
    rng = np.random.default_rng(5)
    rows = [(u, i, float(rng.integers(1, 6) * rng.choice([-1, 1]))) for u in range(6) for i in range(5) if rng.random() < 0.7]
    train = spark.createDataFrame(rows, "u long, i long, r double")
    cells = train.select("u", "i")
    for r in similarity.predict_item_based(train, cells).collect():
        assert r["pred"] == pytest.approx(dense_item_prediction(rows, r["u"], r["i"]), abs=1e-9)


def test_pearson_of_small_ratings(spark):
    rows = spark.createDataFrame([(u, i, (i + 1) * 1e-4) for u in (1, 2) for i in range(3)], "u long, i long, r double")
    assert similarity.pearson_similarity(rows).first()["sim"] == pytest.approx(1.0)


def test_stream_goes_on_without_new_files(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    spark.createDataFrame([([1.0, 2.0],), ([3.0, 5.0],)], "x array<double>").coalesce(1).write.parquet(source)

    def run():
        return sorted(map(str, jobs.stream_moments(jobs.file_stream(spark, source, "x array<double>"), "x", state).collect()))

    assert run() == run()


def test_ranking_scores_after_clustering_in_one_session(spark, sf):
    import __spark_entry__ as entry
    queries = entry.queries()
    for name in ("dbscan_clusters", "mean_shift", "ctr_ranking", "cv_with_preprocess"):
        assert queries[name](spark, sf).count() > 0


def test_unknown_loss_is_refused(spark):
    with pytest.raises(ValueError):
        linear.logreg_minibatch(spark.range(3).selectExpr("id", "id AS a", "0 AS y"), "id", ["a"], "y", loss="hinge")
