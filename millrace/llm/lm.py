"""Language-model scores by a weighted backoff automaton over the corpus.

The states are the root and one for each word seen in training. A state has an arc for every pair seen in training, weighted by
``(c(uw) + k p(w)) / (c(u) + k)``, and a failure arc of weight ``k / (c(u) + k)`` to the root, whose arcs are the words
by absolute discounting and one arc for all unknown words, which takes the discounted mass. One pass from left to right carries the
state (the word before, or the root after an unknown word) and adds up the logarithms. ``k`` is chosen among ``strengths`` by the leave-one-out
likelihood of all training tokens.

The automaton grows with the corpus and no task holds it. Texts are dealt into chunks; a chunk asks for its distinct
arcs once, as sorted hashes cut into buckets, together with its own training counts; a bucket adds up the counts of
all chunks and answers each with the totals in the order it asked; the chunk then runs its texts. Words and pairs are
64-bit hashes. Both exchanges carry a distinct arc of a chunk once, so frequent pairs are no hot keys.

Defined results: null text is the empty text, which is the end token alone; null doc_id counts as a training document; without training tokens
base score and score are 0. Repeated rows are documents of their own, but equal ones share a chunk; a very long text lies in one chunk; equal likelihoods
choose the smaller k; an empty table gives no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.session import cut

END, BEGIN = flat.seed(3, 1), flat.seed(3, 2)
ONE = np.uint64(1)


def shrink(values: np.ndarray) -> bytes:
    """Sorted numbers or counts in few bytes: differences or values by byte planes, compressed."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes())


def grow(raw: bytes, dtype: type) -> np.ndarray:
    import zstandard

    size = np.dtype(dtype).itemsize
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(data.reshape(size, -1).T).reshape(-1).view(dtype)


def arcs(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(word keys, pair keys, token offsets of the texts)``; the last token of a text is the end. A key's lowest bit tells pairs from words."""
    data, off = flat.buffers(texts)
    tokens, lengths = [], []
    for i, j, part, o in flat.blocks(flat.LOWER[data], off):
        h, first = flat.word_hashes(part, o)
        tokens.append(np.insert(h, first[1:], END))
        lengths.append(np.diff(first) + 1)
    token = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]) if lengths else np.zeros(1, np.int64)
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[offsets[:-1]] = BEGIN
    return flat.mix(token) & ~ONE, flat.mix(before * flat.MULT + token) | ONE, offsets


def asked(word: np.ndarray, pair: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their training counts, and where each word and pair stands among them."""
    keys, back = np.unique(np.concatenate([word, pair]), return_inverse=True)
    return keys, np.bincount(back, np.concatenate([train, train]), len(keys)).astype(np.uint32), back


def requests(docs: DataFrame, bits: int) -> DataFrame:
    """``(bucket, chunk, keys, counts)`` of every chunk."""
    def task(table: pa.Table) -> pa.Table:
        word, pair, offsets = arcs(table.column("text"))
        train = np.repeat(~table.column("held_out").to_numpy(zero_copy_only=False), np.diff(offsets)).astype(float)
        keys, counts, _ = asked(word, pair, train)
        ends = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) if bits else np.array([0, len(keys)])
        some = np.flatnonzero(np.diff(ends))
        return pa.table({
            "bucket": pa.array(some, pa.int64()), "chunk": pa.array([table.column("chunk")[0].as_py()] * len(some), pa.int64()),
            "keys": pa.array([shrink(np.diff(keys[ends[b]: ends[b + 1]], prepend=np.uint64(0))) for b in some], pa.binary()),
            "counts": pa.array([shrink(counts[ends[b]: ends[b + 1]]) for b in some], pa.binary())})

    return docs.groupBy("chunk").applyInArrow(task, "bucket long, chunk long, keys binary, counts binary")


def answers(asks: DataFrame) -> DataFrame:
    """``(chunk, bucket, totals, n, v, n1, n2)``: totals in the order of the request, and word statistics once for each bucket."""
    def task(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(grow(k, np.uint64), dtype=np.uint64) for k in table.column("keys").to_pylist()]
        counts = np.concatenate([grow(c, np.uint32) for c in table.column("counts").to_pylist()])
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(back, counts, len(distinct)).astype(np.uint64)
        ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        of_words = total[(distinct & ONE) == 0]
        stats = [int(of_words.sum()), int((of_words > 0).sum()), int((of_words == 1).sum()), int((of_words == 2).sum())]
        rows = len(keys)
        return pa.table({
            "chunk": table.column("chunk"), "bucket": table.column("bucket"),
            "totals": pa.array([shrink(total[back[a:b]]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
            **{c: pa.array([s] + [0] * (rows - 1), pa.int64()) for c, s in zip(("n", "v", "n1", "n2"), stats)}})

    return asks.groupBy("bucket").applyInArrow(task, "chunk long, bucket long, totals binary, n long, v long, n1 long, n2 long")


def lm_scores(docs: DataFrame, strengths: tuple[float, ...] = (1.0, 5.0, 25.0, 125.0, 1000.0, 10_000.0), chunk_chars: int = 1 << 23,
              bucket_chars: int = 1 << 23) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row for each row of ``docs (doc_id, text)``."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks, bits = max(1, -(-chars // chunk_chars)), max(0, (chars // bucket_chars).bit_length())
    texts = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    got = cut(answers(requests(texts, bits)))
    n, v, n1, n2 = (int(x or 0) for x in got.agg(*(F.sum(c) for c in ("n", "v", "n1", "n2"))).first())
    discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, gains array<double>"

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        word, pair, offsets = arcs(left.column("text"))
        held_out = left.column("held_out").to_numpy(zero_copy_only=False)
        train = np.repeat(~held_out, np.diff(offsets))
        _, _, back = asked(word, pair, train.astype(float))
        order = np.argsort(right.column("bucket").to_numpy())
        raw = right.column("totals").to_pylist()
        total = np.concatenate([grow(raw[k], np.uint64) for k in order]) if len(order) else np.zeros(0, np.uint64)
        total = total[back].astype(float)
        c, pairs = total[: len(word)], total[len(word):]
        # the state before each token: how often the word before was seen, at the beginning of a text how many texts
        state = np.empty_like(c)
        state[1:] = c[:-1]
        state[offsets[:-1]] = c[offsets[1:] - 1]
        at = offsets[:-1]

        def sums(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, at) if len(at) else np.zeros(0)

        if not n:
            zero = np.zeros(len(at))
            columns = [zero, [[0.0] * len(strengths)] * len(at), [[0.0] * len(strengths)] * len(at)]
        else:
            root = np.where(c > 0, c - discount, discount * v) / n
            less = np.where(c > 1, c - 1 - discount, discount * v) / n
            scores, gains = [], []
            for k in strengths:
                p = np.where(state > 0, (pairs + k * root) / (state + k), root)
                scores.append(sums(np.log10(p)))
                # without the token itself; held-out texts have no part in the choice of k
                q = np.where(state > 1, (np.maximum(pairs - 1, 0) + k * less) / (np.maximum(state - 1, 0) + k), less)
                gains.append(sums(np.where(train, np.log10(q), 0)))
            columns = [sums(np.log10((c + 1) / (n + v + 1))), np.stack(scores, 1).tolist(), np.stack(gains, 1).tolist()]
        return pa.table([left.column("doc_id").cast(pa.int64()), left.column("held_out"), pa.array(np.diff(offsets)), pa.array(sums(c > 0).astype(np.int64)),
                         pa.array(columns[0], pa.float64()), pa.array(columns[1], pa.list_(pa.float64())), pa.array(columns[2], pa.list_(pa.float64()))],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "scores", "gains"])

    table = cut(texts.groupBy("chunk").cogroup(got.select("chunk", "bucket", "totals").groupBy("chunk")).applyInArrow(task, kinds))
    gains = table.agg(*(F.sum(F.col("gains")[i]) for i in range(len(strengths)))).first()
    best = max(range(len(strengths)), key=lambda i: gains[i] if gains[i] is not None else 0.0)
    return table.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", F.col("scores")[best].alias("score"))
