"""Removal of long repeated strings by suffix arrays.

Every 200-byte string has an anchor: the smallest hash among its 50-byte pieces. Neighbouring strings of a text that share an
anchor form a segment, equal strings have equal anchors, and so only segments whose anchor stands elsewhere too can
hold repeats. Those are collapsed by content. A content that stands twice is repeated throughout; the other contents of an anchor
are laid end to end in tasks of bounded size, where a suffix array over their words (``grouping.suffix_array``)
and the common prefixes of its neighbours tell which strings have an equal: those whose first whole word lies in the
same interval of suffixes and whose bytes before it are equal. If an anchor has too many contents for a task, they are cut
into shorter ranges of start positions and collapsed again, down to single strings, which are then only counted.

Defined results: null text is the empty text; texts shorter than ``length`` bytes lose nothing; matches never cross rows,
and rows of equal ``doc_id`` are separate documents; equal rows lose the same bytes; very long texts are cut into segments like all others; an empty table gives no rows.
Extra columns pass through ``remove_repeats``, but for ``kept``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans__`` and ``span_id__``, which are dropped first. Within a task, strings
are told by 64-bit hashes of their bytes before and in the first word boundary: two different ones of a million meet with probability about 3e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.grouping import suffix_array
from millrace.session import cut

# sliding minima are taken over stretches of this many positions, which the low bits of a key can tell apart
STRETCH = 1 << 22
POSITION_BITS = np.uint64(23)
# segments that leave a task at once
BLOCK_ROWS = 5_000

SEGMENT = "anchor long, doc_id long, text_hash long, first long, n int"


def text_hash(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def segments(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(anchor hash, anchor position, first start, number of starts)`` of the segments of one text."""
    n, width = len(text), length - gram + 1
    if n < length:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    parts = []
    for lo in range(0, n - length + 1, STRETCH):
        piece = text[lo: lo + STRETCH + length - 1]
        pre = flat.prefix_hash(piece)
        _, down = flat.powers(len(piece))
        g = flat.mix((pre[gram:] - pre[:-gram]) * down[: len(pre) - gram])
        key = (g >> POSITION_BITS << POSITION_BITS) | np.arange(len(g), dtype=np.uint64)
        starts = len(g) - width + 1
        # minima of all windows from running minima of blocks, forwards and backwards
        size = -(-len(key) // width) * width
        padded = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[: len(key)] = key
        fore = np.minimum.accumulate(padded.reshape(-1, width), 1).reshape(-1)
        back = np.minimum.accumulate(padded.reshape(-1, width)[:, ::-1], 1)[:, ::-1].reshape(-1)
        low = np.minimum(back[:starts], fore[width - 1: width - 1 + starts])
        at = (low & ((np.uint64(1) << POSITION_BITS) - np.uint64(1))).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        parts.append((g[at[edge]], at[edge] + lo, edge + lo, np.diff(np.append(edge, starts))))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _texts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    data, off = flat.buffers(batch.column("text"))
    for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
        yield data[a:b]


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows, found = [], []
            hashes = []
            for i, text in enumerate(_texts(batch)):
                h, _, first, n = segments(text, length, gram)
                if len(h):
                    rows.append(np.full(len(h), i))
                    hashes.append(np.full(len(h), text_hash(text.tobytes())))
                    found.append((h, first, n))
            if rows:
                h, first, n = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([
                    pa.array(h.view(np.int64)), ids.take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(hashes)),
                    pa.array(first), pa.array(n.astype(np.int32))], ["anchor", "doc_id", "text_hash", "first", "n"])

    return docs.select("doc_id", "text").mapInArrow(task, SEGMENT)


def contents(docs: DataFrame, repeated: DataFrame, length: int, gram: int) -> DataFrame:
    """``(cid, anchor, off, n, body, doc_id, text_hash, first)``: the bytes of the segments in ``repeated``."""
    def columns(out: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array(out["cid"], pa.binary()), pa.array(out["anchor"], pa.int64()), pa.array(out["off"], pa.int32()), pa.array(out["n"], pa.int32()),
            pa.array(out["body"], pa.binary()), pa.array(out["doc_id"], pa.int64()), pa.array(out["text_hash"], pa.int64()), pa.array(out["first"], pa.int64())], list(out))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # segments overlap and are longer than their texts together, so they leave in blocks
        out: dict[str, list] = {c: [] for c in ("cid", "anchor", "off", "n", "body", "doc_id", "text_hash", "first")}
        for batch in batches:
            for i, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), _texts(batch))):
                own = text_hash(raw := text.tobytes())
                mine = {s["first"] for s in batch.column("wanted")[i].as_py() if s["text_hash"] == own}
                if not mine:
                    continue
                for h, at, first, n in zip(*(x.tolist() for x in segments(text, length, gram))):
                    if first in mine:
                        body = raw[first: first + n + length - 1]
                        cid = hashlib.blake2b(b"%d %d %d " % (h, at - first, n) + body, digest_size=16).digest()
                        for c, v in zip(out, (cid, h - (1 << 64) if h >> 63 else h, first - at, n, body, doc, own, first)):
                            out[c].append(v)
                        if len(out["cid"]) >= BLOCK_ROWS:
                            yield columns(out)
                            out = {c: [] for c in out}
        yield columns(out)

    by_doc = repeated.groupBy(F.col("doc_id").alias("want_id")).agg(F.collect_set(F.struct("text_hash", "first")).alias("wanted"))
    return docs.join(by_doc, docs.doc_id.eqNullSafe(by_doc.want_id)).select("doc_id", "text", "wanted").mapInArrow(
        task, "cid binary, anchor long, off int, n int, body binary, doc_id long, text_hash long, first long")


def equal_starts(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each body, which of its starts begin a string of ``length`` bytes that begins elsewhere in the list too."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(b) for b in bodies], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    # words with the white space byte that ends them, so that none is the beginning of another unless a body ends in it
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    edge[1:] |= flat.SPACE[data]
    word = np.flatnonzero(edge)
    body = np.searchsorted(off, word[:-1], "right") - 1
    pieces = [data[a:b].tobytes() for a, b in zip(word[:-1].tolist(), word[1:].tolist())]
    rank = {w: i + 1 for i, w in enumerate(sorted(set(pieces)))}
    ids = np.fromiter((rank[w] for w in pieces), np.int64, len(pieces))
    del pieces, rank
    # a zero, smaller than every word, ends each body
    text = np.insert(ids, np.flatnonzero(np.diff(body)) + 1, 0)
    at = np.insert(word[:-1], np.flatnonzero(np.diff(body)) + 1, -1)
    order = at[suffix_array(text)]
    order = order[order >= 0]
    # bytes that neighbours share, within their bodies, up to the length
    room = np.minimum(off[np.searchsorted(off, order, "right")] - order, length)
    lcp = np.zeros(len(order), np.int64)
    padded = np.concatenate([data, np.zeros(length, np.uint8)])
    reach = np.arange(length)
    for i in range(1, len(order), 4096):
        j = min(i + 4096, len(order))
        unlike = padded[order[i:j, None] + reach] != padded[order[i - 1: j - 1, None] + reach]
        lcp[i:j] = np.where(unlike.any(1), unlike.argmax(1), length)
        lcp[i:j] = np.minimum(lcp[i:j], np.minimum(room[i:j], room[i - 1: j - 1]))
    place = np.zeros(len(data) + 1, np.int32)
    place[order] = np.arange(len(order))
    # each start with the first word that begins inside its string, or with the string's end if none does
    starts = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(off[:-1], off[1:])])
    begin = np.append(np.flatnonzero(flat.SPACE[data]) + 1, len(data) + length)
    nxt = begin[np.searchsorted(begin, starts, "right")]
    before = np.minimum(nxt - starts, length)
    pre = flat.prefix_hash(data)
    left = flat.piece_hash(pre, starts, starts + before)
    key = np.zeros(len(starts), np.uint64)
    by = np.argsort(before, kind="stable")
    bounds = np.searchsorted(before[by], np.arange(length + 2))
    for s in range(length + 1):
        own = by[bounds[s]: bounds[s + 1]]
        if len(own):
            interval = np.cumsum(lcp < length - s) if s < length else np.zeros(len(lcp), np.int64)
            where = interval[place[nxt[own]]] if s < length else 0
            key[own] = flat.mix(left[own] * flat.MULT + flat.mix(np.uint64(s) + (np.zeros(len(own), np.int64) + where).astype(np.uint64) * np.uint64(256)))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    ends = np.cumsum(size - length + 1)
    return [twice[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the runs of True."""
    x = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(x == 1), np.flatnonzero(x == -1)


def in_arrays(pieces: DataFrame, length: int, task_bytes: int) -> DataFrame:
    """``(cid, lo, hi)``: the repeated starts of the distinct contents, found by suffix arrays; a group stays in one array."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        weight, last = 0, None
        for batch in batches:
            for grp, cid, body in zip(batch.column("grp").to_pylist(), batch.column("cid").to_pylist(), batch.column("body").to_pylist()):
                if grp != last and weight >= task_bytes:
                    yield solve(held)
                    held, weight = [], 0
                held.append((cid, body))
                weight, last = weight + len(body), grp
        if held:
            yield solve(held)

    def solve(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        cid, lo, hi = [], [], []
        for (c, _), mask in zip(held, equal_starts([b for _, b in held], length)):
            a, b = runs(mask)
            cid += [c] * len(a)
            lo.append(a)
            hi.append(b)
        return pa.RecordBatch.from_arrays([pa.array(cid, pa.binary()), pa.array(np.concatenate(lo), pa.int32()), pa.array(np.concatenate(hi), pa.int32())], ["cid", "lo", "hi"])

    return pieces.repartition("grp").sortWithinPartitions("grp").select("grp", "cid", "body").mapInArrow(task, "cid binary, lo int, hi int")


def resolve(pieces: DataFrame, length: int, gram: int, limit: int, task_bytes: int) -> DataFrame:
    """``(cid, lo, hi)`` for distinct contents ``(cid, grp, off, n, body, copies)``."""
    out, span = [], length - gram + 1
    chain: list[DataFrame] = []
    level = pieces
    while True:
        sizes = level.groupBy("grp").agg(F.count(F.lit(1)).alias("m"))
        level = cut(level.join(sizes.where("m > 1"), "grp", "left"))
        whole = level.where("copies > 1").select("cid", F.lit(0).alias("lo"), F.col("n").alias("hi"))
        few = in_arrays(level.where(F.col("m").between(2, limit)), length, task_bytes)
        found = whole.unionByName(few.join(level.where("copies > 1").select("cid"), "cid", "left_anti"))
        out.append(found)
        many = level.where(F.col("m") > limit)
        if span == 1 or many.isEmpty():
            break
        span = max(1, -(-span // 4)) if span > 8 else 1
        # aligned ranges of start positions relative to the anchor
        block = F.floor((F.col("off") + length) / span)
        last = F.floor((F.col("off") + F.col("n") - 1 + length) / span)
        cutup = many.select("cid", "grp", "off", "n", "body", "copies", F.explode(F.sequence(block, last)).alias("block"))
        first = F.greatest(F.col("off"), (F.col("block") * span - length).cast("int"))
        count = F.least(F.col("off") + F.col("n"), ((F.col("block") + 1) * span - length).cast("int")) - first
        cutup = cutup.select(F.col("cid").alias("parent"), F.xxhash64("grp", "block").alias("grp"), first.alias("off"), count.alias("n"),
                             (first - F.col("off")).alias("shift"), "copies",
                             F.expr("body").substr(first - F.col("off") + 1, count + length - 1).alias("body"))
        cutup = cut(cutup.withColumn("cid", F.unhex(F.md5(F.concat(F.encode(F.concat_ws(" ", "grp", "off", "n"), "UTF-8"), "body")))))
        chain.append(cutup.select("cid", "parent", "shift"))
        level = cutup.groupBy("cid").agg(F.first("grp").alias("grp"), F.first("off").alias("off"), F.first("n").alias("n"), F.first("body").alias("body"),
                                         F.sum("copies").alias("copies"))
    found = out.pop()
    while out:
        parents = chain.pop()
        up = found.join(parents, "cid").select(F.col("parent").alias("cid"), (F.col("lo") + F.col("shift")).alias("lo"), (F.col("hi") + F.col("shift")).alias("hi"))
        found = out.pop().unionByName(up)
    return found


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = 50, limit: int = 2_000, task_bytes: int = 1 << 20) -> DataFrame:
    """``(doc_id, text_hash, lo, hi)``: byte ranges covered by strings of ``length`` bytes that also start elsewhere.

    ``text_hash`` tells rows of equal doc_id apart; ranges may overlap. ``limit`` contents of an anchor at most go to one task, the
    rest are cut into shorter ranges.
    """
    if not 8 <= gram < length <= 255:
        raise ValueError("gram must be at least 8 and below length, and length at most 255")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    table = cut(anchors(docs, length, gram))
    twice = table.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor")
    segs = cut(contents(docs, table.join(twice, "anchor").select("doc_id", "text_hash", "first"), length, gram))
    pieces = segs.groupBy("cid").agg(F.first("anchor").alias("grp"), F.first("off").alias("off"), F.first("n").alias("n"),
                                     F.first("body").alias("body"), F.count(F.lit(1)).alias("copies"))
    found = resolve(pieces, length, gram, limit, task_bytes)
    return segs.select("cid", "doc_id", "text_hash", "first").join(found, "cid").select(
        "doc_id", "text_hash", (F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi") + length - 1).alias("hi"))


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` with ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans``."""
    own = ["kept", "n_bytes", "n_removed", "n_spans"]
    docs = docs.drop(*own, "spans__", "span_id__")
    spans = repeated_spans(docs, **options).groupBy(F.col("doc_id").alias("span_id__")).agg(
        F.collect_set(F.struct("text_hash", "lo", "hi")).alias("spans__"))
    joined = docs.join(spans, docs.doc_id.cast("long").eqNullSafe(F.col("span_id__")), "left").drop("span_id__")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(_texts(batch), batch.column("spans__").to_pylist()):
                raw = text.tobytes()
                own_hash = text_hash(raw) if spans else 0
                kept, at, n, k = [], 0, 0, 0
                end = -1
                for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or () if s["text_hash"] == own_hash):
                    if lo > end:
                        kept.append(raw[at:lo])
                        k += 1
                        n += hi - lo
                        at = end = hi
                    elif hi > end:
                        n += hi - end
                        at = end = hi
                kept.append(raw[at:])
                rows.append((b"".join(kept), len(raw), n, k))
            new = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), *[pa.int64()] * 3))] if rows else [pa.array([], t) for t in (pa.binary(), *[pa.int64()] * 3)]
            names = [c for c in batch.schema.names if c != "spans__"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], [*names, *own])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return joined.mapInArrow(task, f"{kinds}, kept binary, n_bytes long, n_removed long, n_spans long")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` and ``n_chars`` counted anew.

    Where a removed range begins or ends inside a character, the rest of that character goes too. Null texts stay null.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid = batch.column("text").is_valid().to_pylist()
            texts = [k.decode("utf-8", "ignore") if v else None for v, k in zip(valid, batch.column("kept").to_pylist())]
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c) for c in names], names)

    columns = docs.schema.fields
    names = [f.name for f in columns]
    kinds = ", ".join(f"`{f.name}` {'long' if f.name == 'n_chars' else f.dataType.simpleString()}" for f in columns)
    return remove_repeats(docs, **options).select(*names, "kept").mapInArrow(task, kinds)
