"""Toxicity by cumulative-link ordinal regression on sparse word features.

Grades are 0 (clean), 1 (toxic) and 2 (toxic, with at least the median number of marked words of the toxic
training rows). One weight vector serves all thresholds: ``P(grade >= k) = sigmoid(w.x - cut_k)`` with
``cut_1 < cut_2``. Features are ``log(1 + count)`` of words that stand in toxic rows far more often than in
others. The model is fitted on at most ``max_train`` labelled rows, taken by a hash
of their id; every whole text is scored.

Defined results: null or empty text has no words and the lowest severity; rows with a null label or a
label of no document are not used; of several labels of a document the largest counts; without both clean and toxic
rows nothing is rejected and all severities are 0. Repeated rows give repeated results, and one of the rows of a ``doc_id`` trains;
ties in the choice of words go by their hash. Very long texts are read whole, as blocks of their own. Input columns named ``p_toxic``,
``p_severe``, ``expected_severity`` or ``rejected`` are replaced, all others pass through; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.session import cut

# words are runs of ASCII letters and digits and of all other characters
SEPARATORS = np.zeros(256, bool)
SEPARATORS[:128] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    SEPARATORS[_a:_b] = False


@dataclass
class SeverityModel:
    words: np.ndarray      # sorted hashes of the features
    weights: np.ndarray    # one for each word
    cuts: np.ndarray       # ascending thresholds


def counts(texts: pa.Array, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: first row, words of each text, and (row, feature, count) of the known words."""
    data, off = flat.buffers(texts)
    for i, _, part, o in flat.blocks(flat.LOWER[data], off):
        h, first = flat.word_hashes(part, o, SEPARATORS)
        at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
        hit = np.flatnonzero(words[at] == h) if len(words) else np.zeros(0, np.int64)
        row = np.searchsorted(first, hit, "right") - 1
        key, n = np.unique(row * max(len(words), 1) + at[hit], return_counts=True)
        yield i, np.diff(first), key // max(len(words), 1), key % max(len(words), 1), n


def marked_words(sample: DataFrame, min_rows: int, min_chi2: float, min_lift: float, max_features: int) -> np.ndarray:
    """Hashes of the words that tell toxic rows from others, the strongest first in doubt."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            data, off = flat.buffers(batch.column("text"))
            for i, j, part, o in flat.blocks(flat.LOWER[data], off):
                h, first = flat.word_hashes(part, o, SEPARATORS)
                row = np.repeat(np.arange(i, j), np.diff(first))
                order = np.lexsort((row, h))
                h, row = h[order], row[order]
                one = np.ones(len(h), bool)
                one[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                word, at = np.unique(h[one], return_inverse=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(word.view(np.int64)), pa.array(np.bincount(at, minlength=len(word))),
                    pa.array(np.bincount(at, toxic[row[one]], len(word)).astype(np.int64))], ["word", "n", "pos"])

    total = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("pos")).first()
    n, pos = total["n"], total["pos"] or 0
    if not 0 < pos < n:
        return np.zeros(0, np.uint64)
    found = sample.select("text", "toxic").mapInArrow(task, "word long, n long, pos long").groupBy("word").agg(
        F.sum("n").cast("double").alias("n"), F.sum("pos").cast("double").alias("pos"))
    gap = F.col("pos") * n - F.col("n") * pos
    chi2 = gap * gap * n / (F.col("n") * (n - F.col("n")) * F.lit(float(pos)) * (n - pos))
    lift = (F.col("pos") / pos) / ((F.col("n") - F.col("pos") + 0.5) / (n - pos))
    picked = found.where((F.col("n") >= min_rows) & (F.col("n") < n)).where((chi2 >= min_chi2) & (lift >= min_lift)).orderBy(
        chi2.desc(), "word").limit(max_features).select("word")
    return np.sort(np.array([r[0] for r in picked.collect()], np.int64).view(np.uint64))


def likelihood(score: np.ndarray, cuts: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean of ``-log P(grade)`` with ``P(grade >= k) = sigmoid(score - cut_k)``, its slopes by score, and by cut."""
    n = len(grade)
    up = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts[None, :], -30, 30)))
    # P(grade >= k) for k = 0 to steps + 1
    tail = np.concatenate([np.ones((n, 1)), up, np.zeros((n, 1))], axis=1)
    at = np.arange(n)
    above, beyond = tail[at, grade], tail[at, grade + 1]
    p = np.maximum(above - beyond, 1e-12)
    by_cut = np.zeros(len(cuts))
    for k in range(len(cuts)):
        slope = up[:, k] * (1 - up[:, k]) / p
        by_cut[k] = (slope[grade == k + 1].sum() - slope[grade == k].sum()) / n
    return float(-np.log(p).mean()), (above + beyond - 1) / n, by_cut


def fit(words: np.ndarray, row: np.ndarray, col: np.ndarray, val: np.ndarray, grade: np.ndarray, ridge: float,
        rounds: int) -> SeverityModel:
    """Cumulative-link likelihood with a ridge on the weights, by adaptive gradient steps; all arrays are of the bounded training rows."""
    n, d, steps = len(grade), len(words), int(grade.max())
    w, c = np.zeros(d), np.linspace(1, 2, steps)
    state_m, state_s = np.zeros(d + steps), np.zeros(d + steps)
    for t in range(1, rounds + 1):
        score = np.bincount(row, val * w[col], n)
        _, by_score, by_cut = likelihood(score, c, grade)
        g = np.concatenate([np.bincount(col, val * by_score[row], d) + ridge * w, by_cut])
        state_m = 0.9 * state_m + 0.1 * g
        state_s = 0.999 * state_s + 0.001 * g * g
        move = 0.05 * (state_m / (1 - 0.9**t)) / (np.sqrt(state_s / (1 - 0.999**t)) + 1e-9)
        # ordered thresholds, a little apart, so that no grade has probability 0
        w, c = w - move[:d], np.sort(c - move[d:])
        c = np.maximum.accumulate(c + 1e-3 * np.arange(steps)) if (np.diff(c) < 1e-3).any() else c
    return SeverityModel(words, w, c)


def train(docs: DataFrame, labels: DataFrame, max_train: int = 30_000, min_rows: int = 5, min_chi2: float = 45.0,
          min_lift: float = 5.0, max_features: int = 20_000, ridge: float = 1e-5, rounds: int = 600) -> SeverityModel | None:
    """The model from at most ``max_train`` labelled rows, or None without two classes."""
    chosen = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # at most max_train rows of two numbers
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # copies say nothing new about a word
    sample = cut(sample.dropDuplicates(["text", "toxic"]))
    words = marked_words(sample, min_rows, min_chi2, min_lift, max_features)
    if not len(words):
        return None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic")
            for i, n_words, row, col, n in counts(batch.column("text"), words):
                ends = np.searchsorted(row, np.arange(len(n_words) + 1))
                yield pa.RecordBatch.from_arrays([
                    toxic.slice(i, len(n_words)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(col)),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(n))], ["toxic", "col", "n"])

    got = sample.select("text", "toxic").mapInArrow(task, "toxic int, col array<long>, n array<long>").toArrow()
    toxic = got["toxic"].to_numpy()
    col, n = (got[c].combine_chunks().flatten().to_numpy() for c in ("col", "n"))
    row = np.repeat(np.arange(len(toxic)), got["col"].combine_chunks().value_lengths().to_numpy())
    marked = np.bincount(row, n, len(toxic))
    grade = np.where(toxic > 0, 1 + (marked >= np.median(marked[toxic > 0])), 0)
    return fit(words, row, col, np.log1p(n), grade, ridge, rounds)


def severity(docs: DataFrame, labels: DataFrame, bar: float = 0.25, **train_options) -> DataFrame:
    """All columns of ``docs`` with ``p_toxic``, ``p_severe``, ``expected_severity`` (0 to 2) and ``rejected``.

    ``rejected`` is ``P(grade >= 1) >= bar``; clean texts are far below it, so it leans towards rejecting short toxic ones.
    """
    model = train(docs, labels, **train_options)
    own = ["p_toxic", "p_severe", "expected_severity", "rejected"]
    docs = docs.drop(*own)
    if model is None:
        return docs.select("*", *(F.lit(0.0).alias(c) for c in own[:3]), F.lit(False).alias("rejected"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.zeros(batch.num_rows)
            for i, n_words, row, col, n in counts(batch.column("text"), model.words):
                score[i: i + len(n_words)] = np.bincount(row, np.log1p(n) * model.weights[col], len(n_words))
            p = 1 / (1 + np.exp(-(score[:, None] - model.cuts[None, :])))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p[:, 0]), pa.array(p[:, -1]), pa.array(p.sum(1)), pa.array(p[:, 0] >= bar)],
                [*batch.schema.names, *own])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(task, f"{kinds}, p_toxic double, p_severe double, expected_severity double, rejected boolean")
