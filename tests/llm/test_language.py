"""Language identification: features against a plain twin, the machine against its optimum, held-out accuracy and edge cases."""

import zlib

import numpy as np
import pytest

from millrace.llm import language, queries


def plain_features(text):
    data = [b if language._LETTER[b] else 0x20 for b in b" " + text.lower().encode()]
    data = [b for i, b in enumerate(data) if i == 0 or b != 0x20 or data[i - 1] != 0x20]
    return [tuple(data[i: i + n]) for i in range(len(data)) for n in language.ORDERS if i + n <= len(data)]


def test_features_do_not_depend_on_neighbours():
    texts = ["Ab,cd  ef", "", "É ß 12 x", "a", "...", "Ab,cd  ef", "long " * 50]
    feature, off = language.grams(texts)
    parts = [feature[a:b] for a, b in zip(off, off[1:])]
    known = {}
    for text, part in zip(texts, parts):
        alone, _ = language.grams([text])
        assert part.tolist() == alone.tolist()
        got = part[part < language.BUCKETS].tolist()
        want = plain_features(text)
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert known.setdefault(w, g) == g
    assert parts[0].tolist() == parts[5].tolist()


def test_machine_reaches_its_optimum():
    rng = np.random.default_rng(1)
    n, ridge = 60, 1e-2
    row, col = np.repeat(np.arange(n), 6), rng.integers(0, 20, 6 * n)
    val = rng.random(6 * n)
    sign = np.where(rng.random(n) < 0.4, 1.0, -1.0)
    val[(sign[row] > 0) & (col < 4)] += 1
    w, bias = language.fit_machine(row, col, val, sign, ridge, 2_000)
    x = np.zeros((n, 21))
    np.add.at(x, (row, col), val)
    x[:, 20] = 1
    weight = np.where(sign > 0, 0.5 / (sign > 0).sum(), 0.5 / (sign < 0).sum())

    def loss(v):
        return (weight * np.maximum(0, 1 - sign * (x @ v)) ** 2).sum() + ridge / 2 * (v @ v)

    v = np.append(w[:20], bias)
    slack = np.maximum(0, 1 - sign * (x @ v))
    assert np.abs(ridge * v - x.T @ (2 * weight * sign * slack)).max() < 1e-4
    assert all(loss(v) <= loss(v + 0.01 * rng.standard_normal(21)) for _ in range(50))
    assert not w[20:].any()


def test_families_and_duels():
    assert language.family_of("de") == language.family_of("en-GB") != language.family_of("fr")
    assert language.family_of("qx") == "qx"
    feature, off = np.array([0, 1, 2, 2]), np.array([0, 2, 4])
    weights = np.zeros(language.BUCKETS + 1)
    weights[:3] = 1, 1, -1
    best, sure = language._decide(["a", "b"], [language.Machine("a", "b", weights, 0.0)], feature, off)
    assert best.tolist() == [0, 1] and (sure > 0.5).all()
    best, _ = language._decide(["a", "b"], [language.Machine("a", "b", weights * 0, 0.0)], feature, off)
    assert best.tolist() == [0, 0]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    parts = {"en": "the ing tion wh ou ly ed", "de": "sch ung der ich ei ü pf", "fr": "eau eux que ai é oi tion", "es": "ción ía ue do os ar ñ", "qx": "zz kx qu xx"}
    out, i = [], 0
    for lang, pieces in parts.items():
        pieces = pieces.split()
        for _ in range(60):
            text = " ".join("".join(rng.choice(pieces, int(rng.integers(1, 4)))) for _ in range(int(rng.integers(5, 60))))
            out.append((i, text, lang))
            i += 1
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")


def test_odd_rows(spark, rows):
    odd = [(1000, None, "en"), (1001, "", "fr"), (1002, "12 34 ... \n", "de"), (1003, None, None), (None, "der schung ich", None), (1004, "schung " * 40_000, None),
           (1005, "eau que", None), (1005, "eau que", None), (1006, "Привет", None)]
    docs = frame(spark, rows + odd + rows[:5] * 3)
    got = language.identified(docs, language.train(docs)).collect()
    assert len(got) == len(rows) + len(odd) + 15 and all(0 <= r["score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["lang_pred"], r["score"]))
    assert all(len(x) == 1 for x in by.values())
    lang = {i: next(iter(x))[0] for i, x in by.items()}
    assert all(by[i] == {("und", 0.0)} for i in (1000, 1001, 1002, 1003))
    assert lang[None] == lang[1004] == "de" and lang[1005] == "fr" and lang[1006] in {"en", "de", "fr", "es", "qx"}
    assert sum(lang[i] == x for i, _, x in rows) >= 0.99 * len(rows)
    only = frame(spark, [r for r in rows if r[2] == "fr"])
    assert {(r[1], r[2]) for r in language.identified(docs.where("doc_id < 100"), language.train(only)).collect()} == {("fr", 1.0)}
    none = language.train(docs.where("lang is null"))
    assert none is None and {r[1] for r in language.identified(docs, none).collect()} == {"und"}
    assert language.identified(docs.limit(0), language.train(docs.limit(0))).count() == 0


def test_bounds_of_training(spark, rows):
    docs = frame(spark, rows + rows[:60] * 2)
    got = language.training_texts(docs, 7, 30, 4).groupBy("lang").count().collect()
    assert sorted(r["count"] for r in got) == [7, 7, 7, 7]
    assert language.training_texts(docs, 100, 10, 200).count() == 10


def test_held_out_accuracy(spark, sf):
    lang = {r[0]: (r[1], r[2]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = queries.QUERIES["op11_language"](spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(lang) and len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and lang[r["doc_id"]][1] and any(map(str.isalpha, lang[r["doc_id"]][1]))]
    assert sum(r["lang_pred"] == lang[r["doc_id"]][0] for r in held) >= 0.95 * len(held)
