"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are identical) and at least ``max(12, 2 * q)`` words that no
neighbouring word extends. Words of many texts are laid end to end, each text with word numbers of its own, so no run leaves its text.

* Prefix doubling over word triples ranks all stretches of 3, 6, 12, … words. The ranks give the suffix array, the interval
  of every such stretch in it, and longest common extensions in either direction.
* Dyadic blocks are the stretches of b = 3, 6, 12, … words that start at multiples of b. A run of period q holds a block with
  ``q <= 10`` (b = 3) or ``2 * b - 1 <= q <= 4 * b - 2`` whose copy q words on is in the run too. So every repeated block asks for its
  occurrences in that window to its right: a range successor in a wavelet matrix over the block's interval of the suffix array.
* Two occurrences at distance d open an arithmetic progression, as long as their common extension allows. Its members give the candidate
  periods, of which only d counts where the block itself belongs to the run of period d. Extending
  block and occurrence to both sides gives the run; of equal stretches the smallest period stays.

Every run repeats a stretch of six words, so texts without one (by hash; a collision costs time only) are passed over. Words themselves
are compared as bytes. A task works on blocks of whole texts of about a megabyte and holds one such block; nothing is shuffled.

Defined results: null, empty and blank texts have no words, no runs and an empty collapsed text; very long texts are one block each,
with memory in proportion to their words; of equal stretches, ties included, one run is given; repeated rows and rows of equal
or null ``doc_id`` each have their own result; an empty table gives none; extra columns, also those named like the results, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat

MIN_LENGTH = 12
GRAM = 3          # words of the smallest block
REPEAT = 6        # words that every run repeats
CANDIDATES = 1 << 19  # candidate periods that are extended at once
BLANK = "[\\x20\\x09-\\x0D]+"


class Ranks:
    """Ranks of the stretches of ``GRAM * 2**level`` words at every place; equal stretches have the rank of the first in suffix order."""

    def __init__(self, ids: np.ndarray):
        n = self.n = len(ids)
        self.ids = np.append(ids, -1)
        one = _first_places(ids.astype(np.int64))
        rank = one
        for k in range(1, GRAM):
            rank = _first_places(rank * (n + 1) + np.append(one[k:] + 1, np.zeros(min(k, n), np.int64))[:n])
        self.levels: list[np.ndarray] = []   # one more place at the end, which equals none
        self.sizes: list[np.ndarray] = []    # how many places share a rank, by rank
        length = GRAM
        while True:
            size = np.bincount(rank, minlength=n)
            self.levels.append(np.append(rank, -1))
            self.sizes.append(size)
            at = np.flatnonzero(size[rank] > 1)
            if not len(at):
                break
            ahead = at + length
            key = rank[at] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            old = rank[at]
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            group = np.concatenate([[True], old[1:] != old[:-1]])
            place = np.arange(len(at))
            rank = rank.copy()
            rank[at] = old + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
            length *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are the same; i < j."""
        i, begin, j = i.copy(), i, j.copy()
        for level in range(len(self.levels) - 2, -1, -1):
            same = (self.levels[level][i] == self.levels[level][j]) * (GRAM << level)
            i += same
            j += same
        for _ in range(GRAM - 1):
            same = self.ids[i] == self.ids[j]
            i += same
            j += same
        return i - begin

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are the same; i < j."""
        i, begin, j = i.copy(), i, j.copy()
        for level in range(len(self.levels) - 2, -1, -1):
            length, rank = GRAM << level, self.levels[level]
            back = np.maximum(i - length, 0)
            same = ((i >= length) & (rank[back] == rank[np.maximum(j - length, 0)])) * length
            i -= same
            j -= same
        for _ in range(GRAM - 1):
            same = (i > 0) & (self.ids[i - 1] == self.ids[j - 1])
            i -= same
            j -= same
        return begin - i


def _first_places(key: np.ndarray) -> np.ndarray:
    """For each key the place of the first equal one in sorted order."""
    order = np.argsort(key, kind="stable")
    value = key[order]
    head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(key) else np.zeros(0, np.int64)
    out = np.zeros(len(key), np.int64)
    out[order] = np.repeat(head, np.diff(np.append(head, len(key))))
    return out


class Wavelet:
    """Wavelet matrix over numbers below ``limit``: the least number of a range of places that is not below a bound."""

    def __init__(self, values: np.ndarray, limit: int):
        self.bits = max(1, int(limit).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            values = np.concatenate([values[~one], values[one]])

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        count = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[lo], zeros[hi]
            one = (x >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        value = np.zeros(len(lo), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            k = k - np.where(one, b - a, 0)
            value |= one.astype(np.int64) << bit
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least number of places [lo, hi) from x on; a number above all if there is none."""
        out = np.full(len(lo), 1 << 62)
        k = self.below(lo, hi, x)
        some = np.flatnonzero(lo + k < hi)
        out[some] = self.smallest(lo[some], hi[some], k[some])
        return out


def find_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, length, period)`` of all runs of an array of word numbers, by start, then period."""
    none = np.zeros(0, np.int64)
    if len(ids) < min_length:
        return none, none, none
    ranks = Ranks(ids)
    n, lowest = ranks.n, ranks.levels[0][:-1]
    live = ranks.sizes[0][lowest] > 1
    if not live.any():
        return none, none, none
    suffixes = np.empty(n, np.int64)
    suffixes[ranks.levels[-1][:-1]] = np.arange(n)
    repeated = live[suffixes]
    wavelet = Wavelet(suffixes[repeated], n)
    place = np.concatenate([[0], np.cumsum(repeated)])
    queries = []
    for level, (rank, size) in enumerate(zip(ranks.levels, ranks.sizes)):
        b = GRAM << level
        p = np.arange(0, n, b)
        p = p[size[rank[p]] > 1]
        lo = place[rank[p]]
        queries.append((p, np.full(len(p), b), lo, lo + size[rank[p]], p + (2 * b - 1 if level else 1), np.minimum(p + 4 * b - 2, n - 1)))
    p, b, lo, hi, x, last = (np.concatenate(q) for q in zip(*queries))
    found = []
    while len(p):
        q1 = wavelet.successor(lo, hi, np.minimum(x, n))
        keep = q1 <= last
        p, b, lo, hi, last, q1 = (a[keep] for a in (p, b, lo, hi, last, q1))
        if not len(p):
            break
        q2 = wavelet.successor(lo, hi, np.minimum(q1 + 1, n))
        single = q2 > last
        found.append(_extend(ranks, p[single], q1[single], np.zeros(single.sum(), np.int64), np.ones(single.sum(), np.int64), min_length))
        p, b, lo, hi, last, q1, q2 = (a[~single] for a in (p, b, lo, hi, last, q1, q2))
        d = q2 - q1
        count = 1 + np.minimum((ranks.forward(q1, q2) + d - b) // d, (last - q1) // d)
        end = q1 + (count - 1) * d
        # where the block itself belongs to the run of period d, the other members give nothing new
        own = ranks.forward(p, p + d) >= end + b - p - d
        found.append(_extend(ranks, p, np.where(own, p + d, q1), d, np.where(own, 1, count), min_length))
        x = end + 1
    start, stop, period = (np.concatenate(a) for a in zip(*found)) if found else (none, none, none)
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    one = np.ones(len(start), bool)
    one[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[one], stop[one], period[one]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def _extend(ranks: Ranks, p: np.ndarray, first: np.ndarray, step: np.ndarray, count: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, period)`` of the stretches that the members of progressions give and that are long enough."""
    out = [(np.zeros(0, np.int64),) * 3]
    upto = np.cumsum(count)
    at = 0
    while at < len(p):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CANDIDATES, "right")))
        n = count[at:end]
        member = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(p[at:end], n)
        j = np.repeat(first[at:end], n) + member * np.repeat(step[at:end], n)
        q = j - i
        start, stop = i - ranks.backward(i, j), j + ranks.forward(i, j)
        good = stop - start >= np.maximum(min_length, 2 * q)
        out.append((start[good], stop[good], q[good]))
        at = end
    return tuple(np.concatenate(a) for a in zip(*out))


def repeating(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The texts that hold some stretch of ``REPEAT`` words twice."""
    n = len(hashes) - REPEAT + 1
    if n < 2:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = text[:n] == text[REPEAT - 1:]
    key = flat.mix(text[:n].astype(np.uint64) * flat.MULT + np.uint64(1))
    for k in range(REPEAT):
        key = flat.mix(key * flat.MULT + hashes[k: k + n])
    key, text = key[inside], text[:n][inside]
    order = np.argsort(key, kind="stable")
    return np.unique(text[order[1:]][key[order[1:]] == key[order[:-1]]])


def block_runs(part: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """For each text ``(number of words, its runs, the collapsed text)``."""
    raw = part.tobytes()
    hashes, first = flat.word_hashes(part, off)
    some = repeating(hashes, first)
    words = {i: raw[off[i]: off[i + 1]].split() for i in some.tolist()}
    ids, base = [], 0
    for own in words.values():
        numbers: dict[bytes, int] = {}
        ids.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own)) + base)
        base += len(numbers)
    start, length, period = find_runs(np.concatenate(ids)) if ids else (np.zeros(0, np.int64),) * 3
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words.values()])]).astype(np.int64)
    cover = np.zeros(int(bounds[-1]) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    dropped = np.cumsum(cover)[:-1] > 0
    cut = np.searchsorted(start, bounds)
    at = {i: k for k, i in enumerate(words)}
    for i, n in enumerate(np.diff(first).tolist()):
        k = at.get(i)
        if k is None:
            yield n, [], b" ".join(raw[off[i]: off[i + 1]].split())
        else:
            a, b = cut[k], cut[k + 1]
            keep = ~dropped[bounds[k]: bounds[k + 1]]
            yield n, list(zip((start[a:b] - bounds[k]).tolist(), length[a:b].tolist(), period[a:b].tolist())), b" ".join(
                w for w, x in zip(words[i], keep.tolist()) if x)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``: the runs ``(start, length, period)`` of each text, by start, then period, and the
    text without the words that a run holds after its first period, with one space between words."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = flat.buffers(batch.column("text"))
            for i, j, part, o in flat.blocks(data, off):
                n, runs, text = zip(*block_runs(part, o))
                size = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
                columns = list(zip(*(x for r in runs for x in r))) or [()] * 3
                struct = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(run))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(size, pa.int32()), struct),
                    pa.array(text, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        task, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def made_periodic(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: a tenth of the texts, by a hash of the id, end in a repeated stretch of their own words.

    A null id is hashed as the empty string.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), BLANK), lambda w: w != "")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary"))
    n = F.size("words")

    def word(i: Column, a: Column, p: Column) -> Column:
        return F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

    table = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    table = table.withColumn("n", n.cast("long")).withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    table = table.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    again = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: word(i, F.col("a"), F.col("p"))), " ")
    return table.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """One row for each text: the longest run, and digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"), F.floor(F.lit(1000) * F.col("best.l") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
