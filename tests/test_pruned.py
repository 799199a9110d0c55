"""Pruned joins and searches against brute force: same rows, and work that does not grow with the square of a hot group."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import als, factor, nearest, pairs, simjoin, tree
from millrace.session import cut


def dense(rows):
    ents, feats = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    at, col = {e: k for k, e in enumerate(ents)}, {f: k for k, f in enumerate(feats)}
    m, has = np.zeros((len(ents), len(feats))), np.zeros((len(ents), len(feats)))
    for u, i, r in rows:
        m[at[u], col[i]] += r
        has[at[u], col[i]] = 1
    size = np.sqrt((m * m).sum(1))
    return ents, (m @ m.T) / np.outer(size, size), has @ has.T > 0


@pytest.fixture(scope="module")
def hot_ratings():
    """Two features that a third and half of the entities hold, signed values, copies, entities with a hot feature only."""
    rng = np.random.default_rng(0)
    rows = []
    for u in range(90):
        rows += [(u, int(i), float(rng.integers(1, 6))) for i in rng.choice(50, int(rng.integers(1, 8)), replace=False)]
        if u % 3 == 0:
            rows.append((u, 100, float(rng.integers(1, 9))))
        if u % 2 == 0:
            rows.append((u, 101, float(rng.integers(-3, 9)) or 1.0))
    rows += [(200 + k, 100, 4.0) for k in range(8)] + [(300 + k, 100, float(k + 1)) for k in range(4)] + [(400, 7, 2.0), (400, 7, 3.0), (401, 7, 5.0)]
    return rows


@pytest.mark.parametrize("heavy", [4, 1000])
def test_cosine_pairs_above(spark, hot_ratings, heavy):
    ents, s, _ = dense(hot_ratings)
    df = spark.createDataFrame(hot_ratings, "u long, i long, r double")
    for bar in (0.31, 0.9):
        got = {(r["a"], r["b"]): r["sim"] for r in simjoin.cosine_pairs_above(df, bar, heavy=heavy).collect()}
        want = {(ents[a], ents[b]): s[a, b] for a in range(len(ents)) for b in range(a + 1, len(ents)) if s[a, b] >= bar}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        partners = {r["id"]: r["partners"] for r in simjoin.cosine_partners_above(df, bar, heavy=heavy).collect()}
        assert partners == {e: n for e in ents if (n := sum(e in k for k in want))}


@pytest.mark.parametrize("heavy", [4, 1000])
def test_topn_cosine(spark, hot_ratings, heavy):
    ents, s, common = dense(hot_ratings)
    df = spark.createDataFrame(hot_ratings, "u long, i long, r double")
    got = {}
    for r in simjoin.topn_cosine(df, 4, heavy=heavy).collect():
        got.setdefault(r["a"], []).append((r["rank"], r["b"]))
    for a, e in enumerate(ents):
        want = sorted((-round(s[a, b], 9), ents[b]) for b in range(len(ents)) if b != a and common[a, b])[:4]
        assert [b for _, b in sorted(got.get(e, []))] == [b for _, b in want]


def test_candidates_grow_with_the_rows(spark):
    """One feature is held by a third of the entities: four times the entities bring about four times the candidates, not sixteen."""
    def counts(n):
        rng = np.random.default_rng(1)
        rows = [(u, int(i), float(rng.integers(1, 6))) for u in range(n) for i in rng.choice(n, 6, replace=False)]
        rows += [(u, 10**6, float(rng.integers(1, 6))) for u in range(0, n, 3)]
        units = simjoin.UnitRows(spark.createDataFrame(rows, "u long, i long, r double"), heavy=64)
        assert units.any_heavy
        return simjoin.candidates_above(units, 0.8).count(), simjoin._class_topn(units, 5)[1].count()

    (above, top), (above4, top4) = counts(400), counts(1600)
    assert above4 <= 6 * max(above, 400) and top4 <= 6 * top
    assert above4 < 0.05 * (1600 / 3) ** 2 / 2


def brute_topn(s, seen, n):
    for u, i in seen:
        s[u, i] = -np.inf
    return {u: np.lexsort((np.arange(s.shape[1]), -s[u]))[:n].tolist() for u in range(len(s))}


@pytest.fixture(scope="module")
def factors():
    rng = np.random.default_rng(3)
    u, i = rng.standard_normal((200, 5)), rng.standard_normal((1500, 5)) * rng.gamma(0.7, 1, 1500)[:, None]
    i[10] = i[11]
    return u, i, {(int(a), int(b)) for a, b in zip(rng.integers(0, 200, 2000), rng.integers(0, 1500, 2000))}


def vectors(spark, x, name):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], f"{name} long, x array<double>")


def listed(rows):
    got = {}
    for r in rows.collect():
        got.setdefault(r["u"], []).append((r["rank"], r["i"]))
    return {u: [i for _, i in sorted(x)] for u, x in got.items()}


def test_inner_product_search(spark, factors, monkeypatch):
    monkeypatch.setattr(factor, "MIN_BLOCK", 20)
    u, i, seen = factors
    marks = spark.createDataFrame(sorted(seen), "u long, i long")
    found = factor.PrunedTopN(vectors(spark, u, "u"), vectors(spark, i, "i"), marks, 7, factor.dot_score, factor.dot_surplus, blocks=60, block_rows=10)
    assert listed(found.rows) == brute_topn(u @ i.T, seen, 7)
    assert found.skipped_share > 0.8
    one = factor.PrunedTopN(vectors(spark, u, "u"), vectors(spark, i, "i"), marks, 7, factor.dot_score, factor.dot_surplus, blocks=1)
    assert listed(one.rows) == brute_topn(u @ i.T, seen, 7)
    none = vectors(spark, i, "i").limit(0)
    assert factor.PrunedTopN(vectors(spark, u, "u"), none, marks, 7, factor.dot_score, factor.dot_surplus).rows.count() == 0


def test_latent_search(spark, factors, monkeypatch):
    monkeypatch.setattr(factor, "MIN_BLOCK", 20)
    rng = np.random.default_rng(4)
    _, i, seen = factors
    # four tight directions, so whole blocks can be passed over
    x = np.eye(5)[rng.integers(0, 4, len(i))] + 0.05 * rng.standard_normal(i.shape)
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = []
    for _ in range(200):
        pick, r = rng.choice(len(x), 8), rng.integers(1, 6, 8).astype(float)
        rows.append(np.concatenate([[r.sum(), 8], (x[pick] * r[:, None]).sum(0), x[pick].sum(0)]))
    u = np.array(rows)
    found = factor.PrunedTopN(vectors(spark, u, "u"), vectors(spark, x, "i"), spark.createDataFrame(sorted(seen), "u long, i long"), 7,
                              factor.latent_score, factor.latent_surplus, factor.mean_bar, "direction", blocks=60)
    want, s = brute_topn(factor.latent_score(u, x), set(seen), 7), factor.latent_score(u, x)
    got = listed(found.rows)
    # equal to the last bits of the score
    assert all(np.allclose(s[k, got[k]], s[k, want[k]], atol=1e-12) for k in want)
    assert found.skipped_share > 0.4


# --- neighbour tree --------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 64)) * 4
    x = centres[rng.integers(0, 40, 2500)] + rng.standard_normal((2500, 64)) * 0.5
    x[5] = x[6] = x[7]
    return x, spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, x array<double>")


def test_tree_of_three_levels_is_exact(spark, clustered):
    x, points = clustered
    grown = tree.NeighbourTree(points, fan=12, leaf=60)
    assert grown.levels >= 3
    got = {}
    for r in grown.search(points, 5).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["cid"]))
    for q in range(0, 2500, 5):
        d = ((x - x[q]) ** 2).sum(1)
        assert [i for _, i in sorted(got[q])] == np.lexsort((np.arange(2500), d))[:5].tolist()
    assert len(got) == 2500
    # queries that were sent to a leaf, both descents together
    assert grown.visits < 50 * 2500


def test_knn_join_by_tree_and_by_cells(spark, clustered):
    _, points = clustered
    few = points.where("id < 600")
    rows = lambda df: sorted(map(tuple, df.select("qid", "cid", "rank").collect()))
    assert rows(nearest.knn_join(few, few, 3, exclude_self=True, tree_rows=100)) == rows(nearest.knn_join(few, few, 3, exclude_self=True))
    assert nearest.knn_join(few.limit(0), few, 3, tree_rows=100).count() == 0


def test_queries_go_once_to_a_shard_where_no_cell_can_be_left_out(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16))
    x[7] = x[900]
    points = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, x array<double>")
    cells = nearest.Cells(points, 4, pivots=60)
    sent, held = cells.tiles(points, 300)
    shards = set(cells.shards(300).tolist())
    # by cells it would be nearly 60 rows a query
    assert 4 <= len(shards) <= 12
    assert sent.select("id", "shard").distinct().count() <= len(shards) * 1500
    assert held.groupBy("shard", "sub").agg(F.countDistinct("id").alias("n")).agg(F.max("n")).first()[0] <= 400
    got = {}
    for r in nearest.knn_join(points, points, 4, exclude_self=True, pivots=60, block=300).collect():
        got.setdefault(r["qid"], []).append((r["rank"], r["cid"]))
    for q in range(1500):
        d = ((x - x[q]) ** 2).sum(1)
        assert [i for _, i in sorted(got[q])] == [j for j in np.lexsort((np.arange(1500), d)) if j != q][:4]


def test_weights_of_a_user_and_channel_are_picked_once(spark, sf):
    from millrace.plans.registry import QUERIES
    import millrace.plans.preparation  # noqa: F401
    df = QUERIES["map_topk_weights_by_prefix"](spark, sf)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # the map is filtered below the join with the events, not on each of their rows
    joins = [k for k, line in enumerate(plan) if "Join" in line]
    picks = [k for k, line in enumerate(plan) if "map_filter" in line.lower() or "mapfilter" in line.lower()]
    assert picks and min(picks) > min(joins)
    assert df.count() == spark.read.parquet(f"{sf}/events.parquet").count()


# --- block ALS ------------------------------------------------------------------------------------
def numpy_als(rows, rank, reg, rounds):
    """The same rounds with dense normal equations, from the same start."""
    us, its = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    y = {i: np.array([(int(hashlib.md5(f"{i}:{j}".encode()).hexdigest()[:13], 16) % 1000003 + 0.5) / 1000003 - 0.5 for j in range(rank)]) for i in its}
    out = []
    for _ in range(rounds):
        x = {}
        for u in us:
            own = [(y[i], r) for a, i, r in rows if a == u]
            m = np.array([v for v, _ in own])
            x[u] = np.linalg.solve(m.T @ m + reg * len(own) * np.eye(rank), m.T @ np.array([r for _, r in own]))
        for i in its:
            own = [(x[u], r) for u, a, r in rows if a == i]
            m = np.array([v for v, _ in own])
            y[i] = np.linalg.solve(m.T @ m + reg * len(own) * np.eye(rank), m.T @ np.array([r for _, r in own]))
        out.append(np.sqrt(np.mean([(r - x[u] @ y[i]) ** 2 for u, i, r in rows])))
    return out, x, y


def test_block_als_matches_numpy_and_stops(spark):
    rng = np.random.default_rng(6)
    a, b = rng.standard_normal((30, 2)), rng.standard_normal((25, 2))
    rows = [(u, i, float(a[u] @ b[i] + 0.1 * rng.standard_normal())) for u in range(30) for i in range(25) if rng.random() < 0.4 or u == 3 or i == 4]
    df = spark.createDataFrame([*rows, (None, 1, 2.0), (1, None, 2.0), (1, 2, None)], "u long, i long, r double")
    model = als.BlockALS(rank=2, reg=0.05, max_iter=4, tol=0.0, cell_ratings=30).fit(df)
    want, x, y = numpy_als(rows, 2, 0.05, 4)
    assert np.allclose([h[1] for h in model.history], want, rtol=1e-8)
    got = {r["u"]: np.array(r["x"]) for r in model.users.collect()}
    assert all(np.allclose(got[u], x[u], atol=1e-8) for u in x)
    losses = [h[2] for h in model.history]
    assert all(p >= q - 1e-9 for p, q in zip(losses, losses[1:]))
    pred = {(r["u"], r["i"]): r["pred"] for r in model.predict(spark.createDataFrame([(3, 4), (3, 99)], "u long, i long")).collect()}
    assert abs(pred[3, 4] - x[3] @ y[4]) < 1e-8 and pred[3, 99] is None
    settled = als.BlockALS(rank=2, reg=0.05, max_iter=30, tol=0.02).fit(df)
    assert settled.converged and len(settled.history) < 30
    assert als.BlockALS(rank=2).fit(df.limit(0)).history == []


def test_top_items_write_no_row_for_each_user_and_block(spark, factors, monkeypatch):
    monkeypatch.setattr(factor, "MIN_BLOCK", 20)
    u, i, seen = factors
    u = np.random.default_rng(8).standard_normal((2000, 5))
    i = i / np.linalg.norm(i, axis=1)[:, None]
    written = []

    def counted(df, *args):
        out = cut(df, *args)
        written.append(out.count())
        return out

    monkeypatch.setattr(factor, "cut", counted)
    marks = spark.createDataFrame(sorted(seen), "u long, i long")
    found = factor.PrunedTopN(vectors(spark, u, "u"), vectors(spark, i, "i"), marks, 3, factor.dot_score, factor.dot_surplus)
    assert listed(found.rows) == brute_topn(u @ i.T, seen, 3)
    # items of one length leave much to be met
    assert found.visited > 10 * len(u) and max(written) <= 3 * len(u)


def test_pairs_are_summed_where_their_rows_are(spark):
    rng = np.random.default_rng(9)
    rows = spark.createDataFrame([(int(u), int(i), 1.0) for u, i in {tuple(x) for x in rng.integers(0, 40, (300, 2))}], "u long, i long, r double")
    sums = pairs.pair_moments(rows, "u", "i", "r", keep=["n"]).groupBy("a").agg(F.sum("n").alias("n"))
    dealt = re.findall(r"Exchange hashpartitioning\((.*?)\), ", sums._jdf.queryExecution().executedPlan().toString())
    # by cell, by feature and by entity, never by pair or by entity once more
    assert sum("a#" in d for d in dealt) == 1 and not any("b#" in d for d in dealt)
