"""No cap or switch drops rows: short benchmark items, frequent terms, small caches, tiles of near copies, repeated ids."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import decontaminate, flat, jaccard, packing, queries, toxicity


def test_short_items_are_found_between_word_ends(spark):
    docs = spark.createDataFrame([(1, "Is it the  capital\nof Peru?"), (2, "the capital of perugia"), (3, "xthe capital of peru"), (4, "Lima, (the capital of Peru)"),
                                  (5, "the capitol of peru"), (6, None), (7, "")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the capital of peru"), (2, "?"), (3, ""), (4, None)], "item_id long, text string")
    got = {(r[0], r[1], r[2]) for r in decontaminate.benchmark_hits(docs, items).collect()}
    assert got == {(1, 1, 0), (4, 1, 0), (1, 2, 0)}
    assert {r[0] for r in decontaminate.without_benchmark(docs, items).collect()} == {2, 3, 5, 6, 7}


def brute_bm25(items, idf, seed, k1=1.2, b=0.75):
    mean = max(sum(map(len, items)) / len(items), 1)
    out = []
    for item in items:
        tf = Counter(item)
        out.append(sum(idf[t] * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(item) / mean)) for t in set(items[seed]) if t in tf))
    return out


def test_bm25_of_frequent_and_rare_terms():
    rng = np.random.default_rng(1)
    items = [(rng.zipf(1.3, int(rng.integers(1, 80))) % 300).tolist() for _ in range(60)]
    df = Counter(t for i in items for t in set(i))
    idf = np.array([math.log1p((200 - df[t] + 0.5) / (df[t] + 0.5)) for t in range(300)])
    row, token = np.repeat(np.arange(60), [len(i) for i in items]), np.array([t for i in items for t in i])
    index = packing.Index(row, token, 60, idf, 1.2, 0.75)
    assert index.dense.shape[1] > 3 and len(index.weight) > 100
    for seed in range(60):
        got = index.scores(seed, [x for x in range(seed + 1, min(seed + 5, 60))])
        assert np.allclose(got, brute_bm25(items, idf, seed), rtol=1e-5, atol=1e-5)


def test_neighbours_share_a_frequent_topic(spark):
    """Ten documents, half of which share all their words: those fill windows together."""
    rng = np.random.default_rng(2)
    topic = ["alpha beta gamma delta epsilon"] * 5
    other = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 5)) for _ in range(5)]
    docs = spark.createDataFrame(list(enumerate(topic + other)), "doc_id long, text string")
    got = packing.pack(docs, queries.tokenizer_path(), window=64).collect()
    together = Counter(frozenset(r["doc_id"] < 5 for r in got if r["sequence_id"] == s) for s in {r["sequence_id"] for r in got})
    assert together[frozenset([True])] >= 1


def test_small_cache_and_long_text_give_the_same_ids(monkeypatch):
    path = queries.tokenizer_path()
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(f"w{x}," for x in rng.integers(0, 5000, 300)) for _ in range(40)] + ["long " * 400_000])
    plain = [(i, ids.tolist(), off.tolist()) for i, ids, off, _ in packing.tokens(texts, packing.Words(path), 1)]
    monkeypatch.setattr(packing, "CACHE_WORDS", 100)
    monkeypatch.setattr(packing, "ENCODE_WORDS", 7)
    words = packing.Words(path)
    assert [(i, ids.tolist(), off.tolist()) for i, ids, off, _ in packing.tokens(texts, words, 1)] == plain
    assert len(flat._powers[0]) == flat.BLOCK_BYTES + 2


@pytest.mark.parametrize("tile", [4, 7, 100])
def test_tiles_of_near_copies(spark, tile):
    """A node that cannot be split is compared in tiles; every link is counted once."""
    rng = np.random.default_rng(4)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 120)]
    texts = []
    for k in range(40):
        w = list(base)
        w[int(rng.integers(0, 120))] = f"x{k}"
        texts.append(" ".join(w))
    texts += texts[:5]
    sets = []
    for t in texts:
        w = re.findall(r"\S+", t)
        sets.append({tuple(w[i: i + 5]) for i in range(len(w) - 4)})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in jaccard.jaccard_join(docs, small=3, tile=tile, recall=1.0).collect()}
    want = {a: sum(a != b and len(x & y) >= 0.8 * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)}
    assert sum(got.values()) >= 0.99 * sum(want.values()) and all(got[k] <= want[k] for k in want)


def test_one_row_of_a_repeated_id_trains(spark):
    rows = [(1, f"foul{k} x y") for k in range(50)] + [(k, "clean words here") for k in range(2, 40)]
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 40)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert toxicity.severity(docs, labels, max_train=20).count() == len(rows)


def test_cumulative_link_likelihood_and_its_slopes():
    rng = np.random.default_rng(5)
    score, cuts, grade = rng.standard_normal(50) * 2, np.array([-0.3, 0.9, 1.7]), rng.integers(0, 4, 50)
    sigmoid = lambda x: 1 / (1 + math.exp(-x))

    def brute(score, cuts):
        total = 0.0
        for s, g in zip(score, grade):
            edges = [1.0, *[sigmoid(s - c) for c in cuts], 0.0]
            total -= math.log(edges[g] - edges[g + 1])
        return total / len(score)

    value, by_score, by_cut = toxicity.likelihood(score, cuts, grade)
    assert abs(value - brute(score, cuts)) < 1e-12
    for i in range(0, 50, 7):
        moved = score.copy()
        moved[i] += 1e-6
        assert abs((brute(moved, cuts) - value) / 1e-6 - by_score[i]) < 1e-5
    for k in range(3):
        moved = cuts.copy()
        moved[k] += 1e-6
        assert abs((brute(score, moved) - value) / 1e-6 - by_cut[k]) < 1e-5


def test_sets_are_looked_up_once_for_all_their_nodes(spark):
    grams = flat.mix(np.arange(40, dtype=np.uint64))
    sets = spark.createDataFrame([(bytearray(b"a"), grams.view(np.int64).tolist())], "cls binary, grams array<long>")
    nodes = [32 * k + k % 8 for k in range(50)]
    rows = spark.createDataFrame([(k, bytearray(b"a"), 40) for k in nodes], "node long, cls binary, size int")
    out = jaccard.split(rows, sets, 1, 0.8)
    want = Counter()
    for k in nodes:
        _, child = jaccard.chosen([grams], np.array([k], np.uint64), flat.seed(2, 1), 0.8)
        want.update((((child & ~jaccard.RUN_MASK) | np.uint64(k % 8)).view(np.int64)).tolist())
    got = out.collect()
    assert Counter(r["node"] for r in got) == want and {(bytes(r["cls"]), r["size"]) for r in got} == {(b"a", 40)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # rows are grouped by class before they meet the sets
    assert "collect_list" in plan and plan.index("Join") < plan.index("collect_list")


def test_sets_are_split_once_at_each_depth(spark, tmp_path, monkeypatch):
    """Counting the children and dealing them to small and large nodes read what one run of the split has written."""
    plain, made = jaccard.split, []

    def split(rows, sets, depth, threshold):
        out = plain(rows, sets, depth, threshold)
        made.append(at := tmp_path / str(depth))
        at.mkdir()

        def seen(batches):
            for batch in batches:
                for cls, node in zip(batch.column("cls").to_pylist(), batch.column("node").to_pylist()):
                    with open(at / f"{cls.hex()}{node}", "a") as f:
                        f.write("x")
                yield batch

        return out.mapInArrow(seen, out.schema)

    monkeypatch.setattr(jaccard, "split", split)
    rng = np.random.default_rng(6)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 120)]
    texts = [" ".join([*base[:k], f"x{k}", *base[k + 1:]]) for k in range(0, 120, 10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["n_links"] for r in jaccard.jaccard_join(docs, small=3, recall=0.5).collect()} == {11}
    times = [len(f.read_text()) for at in made for f in at.iterdir()]
    assert len(made) > 1 and times and set(times) == {1}
