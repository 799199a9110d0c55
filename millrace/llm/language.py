"""Language identification by hierarchical discrimination.

The family of a text's language is decided first, then one-versus-one linear support vector machines tell the languages of that family
apart; families are decided by such machines too. Features are hashed n-grams of the lower-case text's bytes, where all ASCII bytes
but letters count as one space between words. A machine's margin is a sum of weights over the n-grams, divided by their number, so
texts of any length are read whole, block by block, and nothing is shuffled.

Machines minimize the squared hinge loss with a ridge by accelerated gradients, on at most ``per_language`` distinct texts of each
language and ``max_train`` in all, chosen by a hash of the text; of the languages the ``max_languages`` most frequent ones are learned. Those
three numbers bound what the driver holds: a list of hashed counts of each chosen text.

Defined results: null texts and texts without a letter (``str.isalpha``) are ``und`` with score 0; a tie goes to the name that comes first; very
long texts form a block of their own; repeated rows get repeated results, and copies count once in training; null languages are not learned;
with one language learned it is always the answer, with none all texts are ``und``; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm import flat
from millrace.session import cut

# Language families by ISO 639 code; a code that is not listed is a family of its own
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "semitic": "am ar he mt",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "iranian": "fa ku ps tg",
    "austronesian": "id jv mg ms tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

ORDERS = (2, 3, 4)
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
NOTHING = "und"
SMOOTH = 1e-4     # frequency that is added to a feature's own when features are scaled

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_FACTOR = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return FAMILY_OF.get(code, language)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the texts end to end and the n + 1 offsets; each text has one at least."""
    raw = [b" " + t.lower().encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    letter = _LETTER[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[off[:-1]] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    off = upto[off]
    data = np.where(letter, data, 0x20)[keep].astype(np.uint32)
    n, size = len(data), len(ORDERS)
    out = np.full((n, size), BUCKETS, np.int32)
    for k, order in enumerate(ORDERS):
        if n < order:
            continue
        h = np.full(n - order + 1, np.uint32(order))
        for j in range(order):
            h = (h ^ data[j: n - order + 1 + j]) * _FACTOR[j]
            h ^= h >> np.uint32(15)
        out[: n - order + 1, k] = (h * _FACTOR[0]) >> np.uint32(32 - BUCKET_BITS)
        # those that run into the next text count for nothing
        tail = off[1:, None] - np.arange(1, order)
        out[np.maximum(tail, off[:-1, None]).reshape(-1), k] = BUCKETS
    return out.reshape(-1), off * size


@dataclass
class Machine:
    """Margin of ``yes`` against ``no``: the mean weight of a text's features plus a bias."""
    yes: str
    no: str
    weights: np.ndarray
    bias: float


@dataclass
class Discriminator:
    """One-versus-one machines among the families, and among the languages of each family."""
    languages: dict[str, list[str]]
    families: list[Machine]
    within: dict[str, list[Machine]]


def _decide(names: list[str], machines: list[Machine], feature: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text the index of the name that wins most duels (ties: sum of margins, then order) and its least certainty in them."""
    n = len(off) - 1
    votes, total, least = np.zeros((n, len(names))), np.zeros((n, len(names))), np.ones((n, len(names)))
    at = {x: i for i, x in enumerate(names)}
    count = np.maximum(np.add.reduceat((feature < BUCKETS).astype(np.int64), off[:-1]), 1)
    for m in machines:
        margin = np.add.reduceat(m.weights[feature], off[:-1]) / count + m.bias
        p = 1 / (1 + np.exp(-np.clip(2 * margin, -40, 40)))
        for name, sign, q in ((m.yes, 1, p), (m.no, -1, 1 - p)):
            i = at[name]
            votes[:, i] += sign * margin > 0
            total[:, i] += sign * margin
            least[:, i] = np.minimum(least[:, i], q)
    order = np.lexsort((np.broadcast_to(np.arange(len(names)), votes.shape), -total, -votes), axis=1)
    best = order[:, 0]
    return best, least[np.arange(n), best]


def _classify(model: Discriminator, texts: list[str]) -> tuple[list[str], np.ndarray]:
    feature, off = grams(texts)
    names = list(model.languages)
    family, score = _decide(names, model.families, feature, off)
    out = [""] * len(texts)
    for f, name in enumerate(names):
        own = np.flatnonzero(family == f)
        if not len(own):
            continue
        inside = model.languages[name]
        if len(inside) == 1:
            best, sure = np.zeros(len(own), np.int64), np.ones(len(own))
        else:
            size = np.diff(off)[own]
            ends = np.cumsum(size)
            part = feature[np.repeat(off[own] - ends + size, size) + np.arange(ends[-1])]
            best, sure = _decide(inside, model.within[name], part, np.concatenate([[0], ends]))
        score[own] = np.minimum(score[own], sure)
        for i, b in zip(own.tolist(), best.tolist()):
            out[i] = inside[b]
    return out, score


# --- training --------------------------------------------------------------------------------------
def _scores(row: np.ndarray, col: np.ndarray, val: np.ndarray, n: int, w: np.ndarray) -> np.ndarray:
    return np.bincount(row, val * w[col], n)


def fit_machine(row: np.ndarray, col: np.ndarray, val: np.ndarray, sign: np.ndarray, ridge: float = 1e-3, rounds: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss, classes of equal weight; the last weight is the bias."""
    n, d = len(sign), BUCKETS + 1
    # the bias is a feature that is 1 everywhere
    row, col, val = np.concatenate([row, np.arange(n)]), np.concatenate([col, np.full(n, BUCKETS)]), np.concatenate([val, np.ones(n)])
    weight = np.where(sign > 0, 0.5 / max((sign > 0).sum(), 1), 0.5 / max((sign < 0).sum(), 1))
    v = np.ones(d) / np.sqrt(d)
    top = 1.0
    for _ in range(12):
        v = np.bincount(col, val * (weight * _scores(row, col, val, n, v))[row], d)
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    rate = 1 / (2.2 * top + ridge)
    w = ahead = np.zeros(d)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(0, 1 - sign * _scores(row, col, val, n, ahead))
        g = ridge * ahead - np.bincount(col, val * (2 * weight * sign * slack)[row], d)
        new = ahead - rate * g
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if np.dot(ahead - new, new - w) > 0:
            t2 = 1.0   # start the momentum anew where it leads uphill
        ahead, w, t = new + (t - 1) / t2 * (new - w) if t2 > 1 else new, new, t2
    return w[:BUCKETS], float(w[BUCKETS])


def training_texts(docs: DataFrame, per_language: int, max_train: int, max_languages: int) -> DataFrame:
    """``(lang, text)``: distinct texts of each language, chosen by a hash; no more than the bounds say."""
    rows = docs.where("lang is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", F.xxhash64("text").alias("key"))
    distinct = rows.groupBy("lang", "key").agg(F.min("doc_id").alias("doc_id"))
    counts = distinct.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return rows.select("lang", "text").limit(0)
    share = max(1, min(per_language, max_train // len(counts)))
    # rows above four times a language's share of hashes are passed over before they are ranked, so no language fills a task
    known = docs.sparkSession.createDataFrame([(r["lang"], 4.0 * share / r["count"]) for r in counts], "lang string, bar double")
    draw = F.xxhash64("key", F.lit(7))
    distinct = distinct.join(F.broadcast(known), "lang").where((F.shiftrightunsigned(draw, 11) / float(1 << 53)) < F.col("bar"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.shiftrightunsigned(draw, 11), "key"))
    picked = distinct.withColumn("place", place).where(F.col("place") <= share).select(
        "lang", "key", F.col("doc_id").alias("own"))
    # at most max_train rows of three numbers
    found = rows.join(F.broadcast(picked), ["lang", "key"]).where(F.col("doc_id").eqNullSafe(F.col("own")))
    return found.dropDuplicates(["lang", "key"]).select("lang", "text")


def train(docs: DataFrame, per_language: int = 500, max_train: int = 8_000, max_languages: int = 200) -> Discriminator | None:
    """The machines from ``docs`` with ``doc_id, text, lang``, or None without a language."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                feature, _ = grams([text])
                col, n = np.unique(feature[feature < BUCKETS], return_counts=True)
                if len(col):
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([col.astype(np.int32)], pa.list_(pa.int32())), pa.array(
                        [(n / n.sum()).astype(np.float32)], pa.list_(pa.float32()))], ["lang", "col", "share"])

    sample = cut(training_texts(docs, per_language, max_train, max_languages))
    got = sample.mapInArrow(task, "lang string, col array<int>, share array<float>").toArrow()
    if not got.num_rows:
        return None
    lang = np.array(got["lang"].to_pylist())
    lists = got["col"].combine_chunks()
    size = lists.value_lengths().to_numpy().astype(np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    col = lists.flatten().to_numpy().astype(np.int64)
    share = got["share"].combine_chunks().flatten().to_numpy().astype(np.float64)
    # frequent features weigh less, as the inverse root of their mean share
    scale = 1 / np.sqrt(np.bincount(col, share, BUCKETS) / len(lang) + SMOOTH)
    val = share * scale[col]

    def duel(yes: str, no: str, own: np.ndarray, other: np.ndarray) -> Machine:
        rows = np.concatenate([own, other])
        n = size[rows]
        ends = np.cumsum(n)
        at = np.repeat(first[rows] - ends + n, n) + np.arange(ends[-1])
        w, bias = fit_machine(np.repeat(np.arange(len(rows)), n), col[at], val[at], np.where(np.arange(len(rows)) < len(own), 1.0, -1.0))
        return Machine(yes, no, np.append(w * scale, 0.0), bias)

    languages: dict[str, list[str]] = {}
    for x in sorted(set(lang.tolist())):
        languages.setdefault(family_of(x), []).append(x)
    family = np.array([family_of(x) for x in lang.tolist()])
    families = [duel(a, b, np.flatnonzero(family == a), np.flatnonzero(family == b)) for a, b in combinations(languages, 2)]
    within = {f: [duel(a, b, np.flatnonzero(lang == a), np.flatnonzero(lang == b)) for a, b in combinations(own, 2)] for f, own in languages.items()}
    return Discriminator(languages, families, within)


def identified(docs: DataFrame, model: Discriminator | None) -> DataFrame:
    """``(doc_id, lang_pred, score)``; the score is the least certainty of the duels won, from 0 to 1."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = flat.buffers(batch.column("text"))
            for i, j, part, o in flat.blocks(data, off):
                raw = part.tobytes()
                texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(o[:-1].tolist(), o[1:].tolist())]
                some = [k for k, t in enumerate(texts) if any(map(str.isalpha, t))] if model else []
                lang, score = [NOTHING] * len(texts), np.zeros(len(texts))
                if some:
                    found, score[some] = _classify(model, [texts[k] for k in some])
                    for k, x in zip(some, found):
                        lang[k] = x
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(task, "doc_id long, lang_pred string, score double")


def held_out():
    """A quarter of the rows, by a hash of the id; a null id is hashed as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % 4 == 2
