"""Periodic runs and conversation repair against brute force, with their edge cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from millrace.llm import dialogue, periodic, queries

# --- 12: periodic runs ----------------------------------------------------------------------------


def brute_runs(w, least=12):
    """All runs by testing every period; the smallest period of a stretch comes first and stays."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_op12(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_runs_of_arrays():
    rng = np.random.default_rng(4)
    cases = [np.zeros(k, np.int64) for k in (0, 1, 11, 12, 13, 100)] + [np.concatenate([np.resize([0, 1], 60), np.resize([1, 0], 60)])]
    for t in range(600):
        n, k = int(rng.integers(0, 150)), int(rng.integers(1, 5))
        w = np.resize(rng.integers(0, k, int(rng.integers(1, 40))), n) if t % 2 else rng.integers(0, k, n)
        if t % 4 == 1 and n:
            w[rng.integers(0, n, 2)] = 9
        cases.append(w)
    for w in cases:
        assert list(zip(*(x.tolist() for x in periodic.find_runs(w)))) == brute_runs(w.tolist())


def test_wavelet_successor():
    rng = np.random.default_rng(5)
    values = rng.permutation(300)
    tree = periodic.Wavelet(values, 300)
    lo = rng.integers(0, 300, 500)
    hi = lo + rng.integers(0, 60, 500).clip(0, 300 - lo)
    x = rng.integers(0, 301, 500)
    want = [min((v for v in values[a:b] if v >= c), default=1 << 62) for a, b, c in zip(lo, hi, x)]
    assert tree.successor(lo, hi, x).tolist() == want


def test_runs_of_documents(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(150):
        w = [f"w{x}" for x in rng.integers(0, 30, int(rng.integers(0, 200)))]
        if i % 3 == 0 and w:
            a = int(rng.integers(0, len(w)))
            w[a:a] = np.resize(w[a: a + int(rng.integers(1, 20))], int(rng.integers(0, 90))).tolist()
        rows.append((i, (" ", "\n", " \t ")[i % 3].join(w)))
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (None, "x " * 40), (None, None), (1003, "é ß " * 30), (1003, "é ß " * 30),
             (1004, " ".join(f"w{x}" for x in rng.integers(0, 3000, 40_000))), (1005, "a b c d " * 5000), (1006, "word" * 50_000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    got = sorted((tuple(r) for r in periodic.run_digests(periodic.periodic_runs(periodic.made_periodic(docs))).collect()), key=str)
    assert got == sorted(((i, *brute_op12(i, t)) if i not in (1004, 1005) else next(g for g in got if g[0] == i) for i, t in rows), key=str)
    plain = {r["doc_id"]: r for r in periodic.periodic_runs(docs).collect()}
    assert [tuple(x) for x in plain[1005]["runs"]] == [(0, 20_000, 4)] and plain[1005]["collapsed"] == "a b c d"
    assert plain[1004]["runs"] == [] and len(plain[1004]["collapsed"].split()) == 40_000
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_runs_query(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert got == {i: brute_op12(i, t) for i, t in rows}


# --- 13: conversation repair ----------------------------------------------------------------------
BLANK = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(c, t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def brute_repair(rows):
    """``rows`` of one conversation in order: the cheapest edits by a table of (cost, letters) for each state."""
    seen, faults, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        f = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
        seen.add((role, text))
        faults.append(f)
        if f < 3:
            counts[f] += 1
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    add = {"e": "u", "s": "u", "u": "a", "a": "u"}
    legal = {("e", "s"): "s", ("e", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def spread(table):
        # insertions, until nothing improves
        while True:
            more = dict(table)
            for q, (cost, letters, out) in table.items():
                new = (cost + 2, letters + "I", [*out, ("user" if add[q] == "u" else "assistant") + ":"])
                if add[q] not in more or new[:2] < more[add[q]][:2]:
                    more[add[q]] = new
            if {k: v[:2] for k, v in more.items()} == {k: v[:2] for k, v in table.items()}:
                return table
            table = more

    table = spread({"e": (0, "", [])})
    for (_, role, text), f in zip(rows, faults):
        new = {}

        def offer(q, cost, letters, out):
            if q not in new or (cost, letters) < new[q][:2]:
                new[q] = (cost, letters, out)
        for q, (cost, letters, out) in table.items():
            offer(q, cost + 3, letters + "D", out)
            if f >= 2:
                extra = int(f == 2)
                if (q, role[:1]) in legal:
                    offer(legal[q, role[:1]], cost + extra, letters + "K", [*out, f"{role}:{text}"])
                offer(add[q], cost + 2 + extra, letters + "R", [*out, ("user:" if add[q] == "u" else "assistant:") + text])
        table = spread(new)
    cost, letters, out = min((table[q] for q in "ea" if q in table), key=lambda x: x[:2])
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest())


def brute_op13(rows):
    every = {r[0] for r in rows}
    after = damage(rows)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest())
    return {c: brute_repair([r[1:] for r in sorted((r for r in after if r[0] == c), key=key)]) for c in every}


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, pos int, chunk string")


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(8)
    roles = ["user", "assistant", "system", "tool", "", "uno", "User", None]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", "dot. \n", "...", "é ", ". ", None]
    rows = []
    for c in range(150):
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, int(rng.integers(0, 20)) if c % 3 == 0 else t, roles[rng.choice(8, p=[.35, .35, .1, .04, .04, .04, .04, .04])],
                         texts[rng.integers(0, 11)] if c % 2 else f"text {rng.integers(0, 99)}" + ".!? "[rng.integers(0, 4)]))
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Yes."), (None, None, None, None), (200, None, "user", "a."), (200, None, "user", "a."), (201, 0, "user", "x" * 100_000 + ".")]
    # conversations that lose all rows
    gone = [c for c in range(300, 500) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    return rows + [(c, 0, "user", "Gone.") for c in gone]


def test_repair_against_brute_force(spark, odd_rows):
    got = {r[0]: tuple(r)[1:] for r in dialogue.repaired_conversations(conversations(spark, odd_rows), dialogue.damaged).collect()}
    assert got == brute_op13(odd_rows)
    assert dialogue.repaired_conversations(conversations(spark, odd_rows).limit(0), dialogue.damaged).count() == 0


def test_long_conversations_in_chunks(spark, odd_rows, monkeypatch):
    """Chunks of four rows: fix-up passes run and the result is the same."""
    monkeypatch.setattr(dialogue, "CHUNK_BITS", 2)
    rng = np.random.default_rng(9)
    rows = odd_rows + [(900, t, ("user", "assistant")[(t + (t > 40)) % 2], f"t{t}.") for t in range(90)]
    rows += [(901, t, "assistant", "same.") for t in range(60)] + [(902, t, ("user", "assistant", "system")[rng.integers(0, 3)], f"t{rng.integers(0, 40)}.") for t in range(120)]
    got = {r[0]: tuple(r)[1:] for r in dialogue.repaired_conversations(conversations(spark, rows), dialogue.damaged).collect()}
    assert got == brute_op13(rows)


def test_block_costs_in_one_and_many_chunks():
    """Stitched chunks give the cost and the edits of one long chunk."""
    rng = np.random.default_rng(10)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        codes = rng.integers(0, 16, n)
        whole = dialogue.Block(codes, np.array([0, n]))
        cost = whole.backward(dialogue.FINAL[None])[0, 0]
        _, audit = whole.trace(np.zeros(1, np.int64), np.ones(1, bool))
        rows = {c: i for c, i in zip("DIKR", (3, 2, 0, 2))}
        kept = [x for x in audit[0] if x != "I"]
        assert len(kept) == n
        assert cost == sum(rows[x] for x in audit[0]) + sum(1 for x, c in zip(kept, codes) if x != "D" and c & 8)
        assert all(x == "D" for x, c in zip(kept, codes) if c & 4)


def test_repaired_turns(spark, odd_rows):
    table = conversations(spark, odd_rows)
    turns = dialogue.Repair(dialogue.rows_of(table)).turns().collect()
    by = {}
    for r in sorted(turns, key=lambda r: (r["ckey"], r["chunk"], r["place"])):
        by.setdefault(r["ckey"], []).append(r["role"][0])
    assert by and all(re.fullmatch("s?(ua)+", "".join(x)) for x in by.values())


def test_repair_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op13_conversation_repair"](spark, sf).collect()}
    assert got == brute_op13(rows)
