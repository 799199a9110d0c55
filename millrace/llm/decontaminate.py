"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may differ by ``k = floor(rate * n)`` edits. Cut into k + 1 pieces, at least one piece stands unchanged in every
such passage, so the exact hits of all pieces (one Aho-Corasick pass over a text) give all places to look at;
each is verified with Myers' bit-parallel edit distance against the best stretch of the text around it. Texts and items are
compared in lower case with runs of white space as one space.

Items are sent to the tasks in blocks of about ``block_chars`` characters, one pass over the texts for each block, so no
table is broadcast whole.

Items under ``short`` characters (normalized) are searched without edits, and count only between word ends: no letter, digit or underscore
stands next to them.

Defined results: null, empty and blank texts and items have no hits; items of equal text are all reported; of several passages of an item with the
least distance the first is given; repeated rows of a document each have their own hits; very long texts are searched whole; extra columns
pass through ``without_benchmark`` and are not looked at by ``benchmark_hits``; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers(pattern: str, text: str, limit: int) -> tuple[int, int]:
    """``(least distance, its first end)`` of the pattern against any stretch of the text; distance limit + 1 if all are farther."""
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = limit + 1, -1
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | down
        diagonal = ((((eq & up) + up) ^ up) | eq) & full
        rise = (down | ~(diagonal | up)) & full
        fall = up & diagonal
        if rise & last:
            score += 1
        elif fall & last:
            score -= 1
        rise = rise << 1 & full
        up = (fall << 1 | ~(vertical | rise)) & full
        down = rise & vertical
        if score < best:
            best, end = score, j + 1
            if not best:
                break
    return best, end


# length of the blocks that a window is first searched for
BLOCK_CHARS = 5


class Finder:
    """All items of a block in one automaton of pieces.

    Before the distance is computed, the item is cut into blocks of ``BLOCK_CHARS`` characters: k edits spoil k of them at most, so a window
    that lacks more than k blocks has no passage within k edits.
    """

    def __init__(self, items: list[tuple[list[int], str]], rate: float, short: int):
        import ahocorasick

        self.items, self.rate, self.short = items, rate, short
        self.limits = [int(rate * len(t)) if len(t) >= short else 0 for _, t in items]
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, ((_, text), k) in enumerate(zip(items, self.limits)):
            cuts = [len(text) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces[text[a:b]].append((i, a))
        self.blocks = [[t[j: j + BLOCK_CHARS] for j in range(0, len(t) - BLOCK_CHARS + 1, BLOCK_CHARS)] for _, t in items]
        self.automaton = ahocorasick.Automaton()
        for piece, at in pieces.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def __reduce__(self):
        # tasks get the items and build the automaton themselves
        return Finder, (self.items, self.rate, self.short)

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``(item index, distance, start, end)`` of the best passage of each item in the text."""
        places: dict[int, set[int]] = defaultdict(set)
        for end, (size, at) in self.automaton.iter(text):
            for i, offset in at:
                places[i].add(end + 1 - size - offset)
        for i, starts in places.items():
            item, k = self.items[i][1], self.limits[i]
            found = None
            for d in starts:
                if d >= 0 and text.startswith(item, d) and (len(item) >= self.short or _apart(text, d, d + len(item))):
                    found = (0, d, d + len(item)) if found is None else min(found, (0, d, d + len(item)))
            if found is None and k:
                for lo, hi in self._windows(sorted(starts), k, len(item), len(text)):
                    window = text[lo:hi]
                    if sum(b not in window for b in self.blocks[i]) > k:
                        continue
                    distance, end = myers(item, window, k)
                    if distance <= k and (found is None or distance < found[0]):
                        back = text[max(0, lo + end - len(item) - k): lo + end][::-1]
                        _, length = myers(item[::-1], back, k)
                        found = (distance, lo + end - length, lo + end)
            if found:
                yield i, *found

    @staticmethod
    def _windows(starts: list[int], k: int, m: int, n: int) -> Iterator[tuple[int, int]]:
        """Stretches around the possible starts, joined where they overlap."""
        lo = hi = None
        for d in starts:
            a, b = max(0, d - k), min(n, d + m + k)
            if lo is None:
                lo, hi = a, b
            elif a <= hi:
                hi = max(hi, b)
            else:
                yield lo, hi
                lo, hi = a, b
        if lo is not None:
            yield lo, hi


def _apart(text: str, a: int, b: int) -> bool:
    """Whether text[a:b] neither begins nor ends inside a word."""
    def inside(left: str, right: str) -> bool:
        return all(c.isalnum() or c == "_" for c in (left, right))

    return not (a and inside(text[a - 1], text[a])) and not (b < len(text) and inside(text[b - 1], text[b]))


def blocks(items: DataFrame, rate: float, short: int, block_chars: int) -> Iterator[Finder]:
    """The items in blocks of about ``block_chars`` characters, one at a time."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for b in range(n):
        ids: dict[str, list[int]] = defaultdict(list)
        for item_id, text in items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b).collect():
            if text := normal(text):
                ids[text].append(item_id)
        if ids:
            yield Finder([(own, text) for text, own in sorted(ids.items())], rate, short)


def benchmark_hits(docs: DataFrame, items: DataFrame, rate: float = 0.1, short: int = 25, block_chars: int = 1 << 21) -> DataFrame:
    """``(doc_id, item_id, distance, start, end)``: the best passage of each item in each text of ``docs``.

    ``start`` and ``end`` count characters of the normalized text.
    """
    kind = "doc_id long, item_id long, distance long, start long, end long"
    out = docs.sparkSession.createDataFrame([], kind)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for finder in blocks(items, rate, short, block_chars):
        def task(batches: Iterator[pa.RecordBatch], finder: Finder = finder) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(doc, item, distance, start, end)
                        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                        for i, distance, start, end in finder.find(normal(text)) for item in finder.items[i][0]]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["doc_id", "item_id", "distance", "start", "end"])

        out = out.unionByName(texts.mapInArrow(task, kind))
    return out


def without_benchmark(docs: DataFrame, items: DataFrame, rate: float = 0.1, short: int = 25, block_chars: int = 1 << 21) -> DataFrame:
    """The rows of ``docs`` whose text has no passage of an item; no shuffle, one pass for each block of items."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    for finder in blocks(items, rate, short, block_chars):
        def task(batches: Iterator[pa.RecordBatch], finder: Finder = finder) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [next(finder.find(normal(text)), None) is None for text in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(task, kinds)
    return docs
