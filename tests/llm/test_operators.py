"""The operators for training data against brute-force twins, round trips and held-out rows, with their edge cases."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import decontaminate, fingerprint, grouping, html, jaccard, licenses, lm, packing, queries, repeats, toxicity, warc

# extra columns whose names the operators use themselves
DOCS = "doc_id long, text string, cls string, row int, n int, rejected string, kept string, node long"
EXTRA = ("a", 1, 2, "b", "c", 3)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, *EXTRA) for i, t in rows], DOCS)


def word_text(rng, n, vocabulary=400):
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, very long and repeated rows, ids that repeat, no id."""
    long_text = word_text(np.random.default_rng(3), 30_000)
    return [(1, None), (2, ""), (3, " \t\n"), (4, long_text), (5, long_text), (5, long_text), (6, "one"), (None, "no id here"), (7, "é ́ \U0001F600 ß"), (7, "other text of seven")]


@pytest.fixture(scope="module")
def own_docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").persist()


@pytest.fixture(scope="module")
def own_texts(own_docs):
    return [(r[0], r[1] or "") for r in own_docs.collect()]


# --- 1: fingerprints -----------------------------------------------------------------------------
def shingle_set(text, width=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i: i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def test_fingerprint_edits_and_likeness(spark):
    rng = np.random.default_rng(1)
    texts = [word_text(rng, int(n)) for n in rng.integers(0, 600, 40)] + [None, "", "few words", "few words"]
    got = {r["doc_id"]: r for r in fingerprint.edited_fingerprints(documents(spark, enumerate(texts))).collect()}
    assert len(got) == len(texts)
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        other = plain[(i + 1) % len(plain)]
        take = len(t) // 4
        edited = t[: len(t) - take] + other[:take]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for near, b in ((r["near_edited"], edited), (r["near_next"], other)):
            x, y = shingle_set(t), shingle_set(b)
            true = len(x & y) / len(x | y) if x | y else 1.0
            assert 0 <= near <= 1 and abs(near - true) < 0.2
    assert got[42]["fingerprint"] == got[43]["fingerprint"] and got[42]["near_next"] == 1.0
    assert got[40]["near_next"] == 1.0


def test_fingerprint_odd_rows(spark, odd):
    assert fingerprint.edited_fingerprints(documents(spark, odd)).count() == len(odd)
    assert fingerprint.edited_fingerprints(documents(spark, [])).count() == 0
    one = fingerprint.edited_fingerprints(documents(spark, [(9, "abcdefgh")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


# --- 2: HTML -------------------------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.data())
def test_decoding_is_the_best_closed_set(data):
    n = data.draw(st.integers(1, 9))
    parents = [-1] + [data.draw(st.integers(0, e - 1)) for e in range(1, n)]
    score = [float(data.draw(st.integers(-9, 9))) for _ in range(n)]
    value = lambda kept: sum(s if k else -s for s, k in zip(score, kept))
    closed = [(True, *rest) for rest in itertools.product((False, True), repeat=n - 1)
              if all(not k or (True, *rest)[parents[e]] for e, k in enumerate((True, *rest)) if e)]
    kept = html.decode(parents, score)
    assert tuple(kept) in closed and value(kept) == max(map(value, closed))


def test_main_text_of_whole_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    body = "The river rose by two metres overnight, and the old bridge was closed to all traffic until the engineers had looked at it."
    made = "".join(["<html><head><title>T</title><style>p{}</style></head><body><nav class=menu><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>",
                    f"<article class=content><p>{body}\n Fish &amp; chips</p><script>var x=1</script><p>{body}</p></article>",
                    "<div class=comments><p>First! Great post</p></div><footer><p>Copyright</p></footer></body></html>"])
    extra = spark.createDataFrame([(-1, "u", made), (-2, None, None), (-3, "u", ""), (-4, "u", "<p"), (-5, "u", "<div>" * 3000 + "deep")], "page_id long, url string, html string")
    both = pages.select("page_id", "url", "html").unionByName(extra).withColumn("n", F.lit(1)).withColumn("n_chars", F.lit(0))
    got = {r["page_id"]: r for r in html.main_text(both).collect()}
    assert len(got) == pages.count() + 5
    assert got[-1]["text"] == f"{body} Fish & chips\n\n{body}"
    assert got[-2]["text"] == got[-3]["text"] == "" and got[-2]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) and r["n"] == 1 for r in got.values())
    assert html.main_text(pages.limit(0)).count() == 0


# --- 3: language model ---------------------------------------------------------------------------
def brute_lm(rows, strengths=(1.0, 5.0, 25.0, 125.0, 1000.0, 10_000.0)):
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (t or "").encode())), None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    one, two = Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            one.update(t)
            two.update(zip([None, *t[:-1]], t))
    n, v = sum(one.values()), len(one)
    n1, n2 = (sum(c == k for c in one.values()) for k in (1, 2))
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    root = lambda c: (c - d if c > 0 else d * v) / n
    less = lambda c: (c - 1 - d if c > 1 else d * v) / n
    scores, gains = [[0.0] * len(rows) for _ in strengths], [0.0] * len(strengths)
    for r, t in enumerate(tokens):
        for u, w in zip([None, *t[:-1]], t):
            for j, k in enumerate(strengths):
                s, p, c = one[u], two[u, w], one[w]
                scores[j][r] += math.log10((p + k * root(c)) / (s + k) if s else root(c))
                if not held[r]:
                    gains[j] += math.log10((max(p - 1, 0) + k * less(c)) / (max(s - 1, 0) + k) if s > 1 else less(c))
    best = max(range(len(strengths)), key=lambda j: gains[j])
    return [(i, h, len(t), sum(one[x] > 0 for x in t), n, sum(math.log10((one[x] + 1) / (n + v + 1)) for x in t), s)
            for (i, _), h, t, s in zip(rows, held, tokens, scores[best])]


def test_lm_matches_brute_force_in_many_chunks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, word_text(rng, int(n), 60)) for i, n in enumerate(rng.integers(0, 80, 60))] + [(90, None), (91, "A a B  end"), (92, "NEW Words only")]
    want = {r[0]: r for r in brute_lm(rows)}
    for options in ({}, {"chunk_chars": 900, "bucket_chars": 700}):
        got = lm.lm_scores(documents(spark, rows), **options).collect()
        assert len(got) == len(rows)
        for r in got:
            assert tuple(r)[:5] == want[r["doc_id"]][:5]
            assert tuple(r)[5:] == pytest.approx(want[r["doc_id"]][5:])


def test_lm_held_out_gain_and_odd_rows(spark, own_docs, odd):
    row = lm.lm_scores(own_docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]
    assert lm.lm_scores(documents(spark, odd)).count() == len(odd)
    assert lm.lm_scores(documents(spark, [])).count() == 0


# --- 4: licences ---------------------------------------------------------------------------------
def test_license_base_matches_plain_search(spark, own_texts, odd):
    rows = own_texts + [(10**9 + k, t) for k, (_, t) in enumerate(odd)] + [
        (-1, "MIT license, mit LICENSE; the Apache-License"), (-2, "Licensed under the GNU General Public License version 3"), (-3, "mit mit license general public"),
        (-4, "license"), (-5, "general public license general public license")]
    got = {r["doc_id"]: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = re.findall(licenses.WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        places = [(k, label) for phrase, label in licenses.BASE.items() for k in range(len(w)) if w[k: k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        base = sorted({x for _, x in places})
        assert r["base_labels"] == ",".join(base) and set(base) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
        for label, text, key in licenses.NOTICES:
            assert (label in r["labels"].split(",")) == (f" {key} " in f" {' '.join(w)} ") or key.split()[0] not in w or any(
                label == x and key in " ".join(w) for x, _, key in licenses.NOTICES)
    assert "gpl-3" in got[-2]["labels"].split(",")
    assert licenses.scan(documents(spark, [])).count() == 0


# --- 5: packing ----------------------------------------------------------------------------------
def check_packing(rows, pieces, path, window=2048):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for i, t in rows:
        want[i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    assert sum(p["length"] for p in pieces) == sum(len(ids) // 4 * k for (_, ids), k in want.items())
    sequences, texts = {}, {}
    for p in pieces:
        assert p["length"] > 0 and len(p["ids"]) == 4 * p["length"]
        sequences.setdefault(p["sequence_id"], []).append(p)
        texts.setdefault((p["doc_id"], p["doc_tokens"]), {}).setdefault(p["start"], []).append(p["ids"])
    padding = 0
    for held in sequences.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    for (i, ids), k in want.items():
        if k == 1 and sum(key[0] == i for key in want) == 1:
            parts = texts[i, len(ids) // 4]
            assert b"".join(parts[s][0] for s in sorted(parts)) == ids
    return padding


def test_packing_round_trip(spark, own_docs, own_texts, odd):
    path = queries.tokenizer_path()
    pieces = packing.pack(own_docs, path).collect()
    assert check_packing(own_texts, pieces, path) <= 0.02 * sum(p["length"] for p in pieces)
    check_packing(odd, packing.pack(documents(spark, odd), path, shard_tokens=5000, part_tokens=9000).collect(), path)
    check_packing(odd, packing.pack(documents(spark, odd), path, window=64).collect(), path, 64)
    assert packing.pack(documents(spark, []), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents(spark, []), path, window=100)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("abXY'.,-!09 \téİ́<|>中ẞ\U0001F600sTd"), max_size=40), max_size=6))
def test_tokens_are_the_tokenizers_own(texts):
    path = queries.tokenizer_path()
    words = packing.Words.of(path)
    for first, ids, off, _ in packing.tokens(pa.array(texts, pa.string()), words, 1):
        for k in range(len(off) - 1):
            assert ids[off[k]: off[k + 1]].tolist() == [*words.tokenizer.encode(texts[first + k], add_special_tokens=False).ids, 1]


# --- 6: WARC -------------------------------------------------------------------------------------
def test_warc_round_trip(spark, sf):
    same = "x" * 100
    rows = [(5, "u", same), (3, None, same), (8, "u\r\nWARC-Type: bad", same), (9, "u", "x" * 99), (10, "u", "x" * 99), (11, "u", None), (12, "u", ""),
            (None, "u", same), (3, None, same), (13, "u", "é" * 50), (14, "u", "é" * 50), (15, "u", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    got = warc.round_trip(spark, df).collect()
    assert len(got) == len(rows)
    refs = {5: 3, 8: 3, 14: 13}
    for r in got:
        raw = next((h or "") for i, _, h in rows if i == r["page_id"]).encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", refs[r["page_id"]]) if r["page_id"] in refs else ("response", None))
        assert r["record_type"] == "revisit" or r["payload"] == raw
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_warc_validates():
    raw = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, "2024-01-01T00:00:00Z")
    assert warc.parse(raw)[0] == 1
    for bad in (raw.replace(b"WARC/1.1", b"WARC/9.9"), raw[:-6], raw.replace(b"payload", b"PAYLOAD"), raw.replace(b"WARC-Date", b"WARC-Dote"), b"", raw + b"x"):
        with pytest.raises(warc.BadRecord):
            warc.parse(bad)


# --- 7: toxicity ---------------------------------------------------------------------------------
def test_toxicity_held_out(spark):
    """Trained on one half of the labels, held against the other; a few hundred labels are too few, so the largest tables are taken."""
    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("test tables are not here")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    got = toxicity.severity(docs, labels.where(half)).join(labels.where(~half).select("doc_id", "toxic"), "doc_id")
    r = got.agg(F.count_if(F.col("rejected") & (F.col("toxic") == 1)), F.count_if(F.col("toxic") == 1),
                F.count_if(F.col("rejected") & (F.col("toxic") == 0)), F.count_if(F.col("toxic") == 0)).first()
    assert r[0] >= 0.8 * r[1] and r[2] <= 0.005 * r[3]
    assert got.where("expected_severity not between 0 and 2 or p_severe > p_toxic").count() == 0


def test_toxicity_without_two_classes(spark, odd):
    labels = spark.createDataFrame([(1, 0), (2, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    docs = documents(spark, odd)
    for lab in (labels, labels.limit(0)):
        got = toxicity.severity(docs, lab).collect()
        assert len(got) == len(odd) and not any(r["rejected"] or r["expected_severity"] for r in got)
    assert toxicity.severity(documents(spark, []), labels).count() == 0


# --- 8: decontamination --------------------------------------------------------------------------
def passage_distance(item, text):
    """Smallest edit distance of the item to any stretch of the text, by the plain table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(item):
            new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_decontamination_matches_brute_force(spark, odd):
    rng = np.random.default_rng(8)
    items = [(k, word_text(rng, 9, 30)) for k in range(6)] + [(50, None), (51, ""), (52, "short"), (53, "ITEM  of\tits own in upper case letters"), (54, "item of its own in upper case letters")]
    rows = [(i, t) for i, t in odd if t is None or len(t) < 1000]
    for i in range(100, 160):
        item = list(str(items[i % 6][1]))
        for _ in range(int(rng.integers(0, 7))):
            at = int(rng.integers(0, len(item)))
            item[at: at + int(rng.integers(0, 2))] = "z" * int(rng.integers(0, 2))
        rows.append((i, word_text(rng, 5, 30) + " " + "".join(item) + " " + word_text(rng, 5, 30)))
    rows += [(200, "say: Item of its own in upper  case letters!")]
    table = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    want = {}
    for (i, t), (k, item) in itertools.product(rows, items):
        a, b = decontaminate.normal(item), decontaminate.normal(t)
        if len(a) >= 25 and (d := passage_distance(a, b)) <= int(0.1 * len(a)):
            want[i, k] = d
    assert len({k for _, k in want}) == 8 and 0 < max(want.values())
    for options in ({}, {"block_chars": 100}):
        got = decontaminate.benchmark_hits(documents(spark, rows), table, **options).collect()
        assert {(r["doc_id"], r["item_id"]): r["distance"] for r in got} == want
    kept = [r["doc_id"] for r in decontaminate.without_benchmark(documents(spark, rows), table).collect()]
    hit = {i for i, _ in want}
    assert Counter(kept) == Counter(i for i, _ in rows if i not in hit)
    assert decontaminate.benchmark_hits(documents(spark, rows), table.limit(0)).count() == 0
    assert decontaminate.benchmark_hits(documents(spark, []), table).count() == 0


# --- 9: suffix arrays ----------------------------------------------------------------------------
@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_matches_sorting(values):
    assert grouping.suffix_array(np.array(values, np.int64)).tolist() == sorted(range(len(values)), key=lambda i: values[i:])


def brute_repeats(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[k: k + length] for r in raws for k in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, bool)
        for k in range(len(r) - length + 1):
            if seen[r[k: k + length]] > 1:
                gone[k: k + length] = True
        kept = bytes(np.frombuffer(r, np.uint8)[~gone[:-1]]) if r else b""
        out.append((i, len(r), int(gone.sum()), int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if r else 0, kept))
    return out


def test_repeats_match_brute_force(spark, odd):
    rng = np.random.default_rng(9)
    shared = [word_text(rng, 90) for _ in range(3)]
    rows = [(i, " ".join([word_text(rng, int(rng.integers(0, 60))), shared[i % 3][: int(rng.integers(150, 330))], word_text(rng, 20)])) for i in range(40)]
    rows += [(50, "a" * 700), (51, "a" * 199), (52, "ab" * 300), (53, "x" + "ab" * 120), (54, "é" * 300), (55, "z" + "é" * 130)]
    rows += [(i, t) for i, t in odd if t is None or len(t) < 1000]
    want = Counter(brute_repeats(rows))
    for options in ({}, {"limit": 2, "task_bytes": 500}):
        got = repeats.remove_repeats(documents(spark, rows), **options).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == want
    assert repeats.remove_repeats(documents(spark, [])).count() == 0


def test_repeats_of_the_table(spark, own_docs, own_texts):
    got = repeats.remove_repeats(own_docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == Counter(brute_repeats(own_texts))


def test_long_repeated_rows(spark, odd):
    got = repeats.remove_repeats(documents(spark, odd)).where("doc_id in (4, 5)").collect()
    assert len(got) == 3 and all(r["n_removed"] == r["n_bytes"] > 0 and r["n_spans"] == 1 for r in got)


# --- 10: Jaccard join ----------------------------------------------------------------------------
def brute_join(rows):
    """doc_id -> (class_id, n_links) for rows with distinct ids."""
    sets = [(i, shingle_set(t or "")) for i, t in rows]
    root, n = {i: i for i, _ in sets}, Counter()

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
            n[i] += 1
            n[j] += 1
            a_top, b_top = sorted((top(i), top(j)))
            root[b_top] = a_top
    return {i: (top(i), n[i]) for i, _ in sets}


def near_rows(rng):
    rows = []
    for g in range(25):
        words = word_text(rng, int(rng.integers(3, 200)), 5000).split()
        for k in range(int(rng.integers(1, 9))):
            w = list(words)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = f"x{rng.integers(0, 9)}"
            rows.append((100 * g + k, " ".join(w)))
    return rows + [(9001, None), (9002, ""), (9003, " "), (9004, "ONE two"), (9005, "one  Two")]


def test_jaccard_join_matches_brute_force(spark):
    rows = near_rows(np.random.default_rng(10))
    want = brute_join(rows)
    for options in ({}, {"small": 3, "tile": 4, "recall": 1.0}):
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(documents(spark, rows), **options).collect()}
        assert got == want
    kept = {r["doc_id"] for r in jaccard.drop_near_duplicates(documents(spark, rows)).collect()}
    assert kept == {i for i, (c, _) in want.items() if i == c}


def test_jaccard_join_of_the_table(own_docs, own_texts):
    want = brute_join(own_texts)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(own_docs).collect()}
    assert len(got) == len(want) and sum(got[i] == w for i, w in want.items()) >= 0.99 * len(want)


def test_jaccard_join_odd_rows(spark, odd):
    got = jaccard.jaccard_join(documents(spark, odd)).collect()
    assert len(got) == len(odd) and {r["class_id"] for r in got if r["doc_id"] in (4, 5)} == {4}
    kept = jaccard.drop_near_duplicates(documents(spark, odd)).collect()
    assert sum((r["text"] or "").startswith("w") for r in kept) == 1 and len(kept) == len(odd) - 2
    # a table of fewer words than a shingle takes
    tiny = jaccard.jaccard_join(documents(spark, [(1, "a b"), (2, "A  b"), (3, None)]).coalesce(1)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in tiny} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
    assert jaccard.jaccard_join(documents(spark, [])).count() == 0 and jaccard.drop_near_duplicates(documents(spark, [])).count() == 0


# --- registered queries --------------------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    names = sorted(c[0] for c in cursor.description)
    want = Counter(tuple(dict(zip([c[0] for c in cursor.description], r))[c] for c in names) for r in cursor.fetchall())
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == names
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == want
