"""Lexical retrieval packing: windows of related documents, found by BM25.

Every text is tokenized once (distinct words of a block, through a cache) and stored as token ids. Documents are ordered by a minimum
hash of their words, which brings alike ones together, and cut into shards of about ``shard_tokens`` tokens. A shard has its own BM25
inverted index, with document frequencies of the whole table. Full windows of a long document stand alone; its
rest, and every shorter document, is a seed or a neighbour: the longest unused one is the next seed, the index returns its unused
neighbours by score, and they fill the window. The one that does not fit is cut there, and its rest stays in
the pool. What a shard has left at its end is cut into powers of two, so no sequence needs padding.

Defined results: null text is the empty text, which has the end token alone; equal rows and rows of equal or null ``doc_id`` are separate
documents; a very long text is tokenized as one block and held whole in the task that packs it; equal BM25 scores go by the order of the shard, which is that of
the minimum hash and the id; extra columns are not looked at. An empty table gives no pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.session import cut

# words whose ids a worker keeps, about 30 bytes each, and words that the tokenizer gets at once
CACHE_WORDS = 1_200_000
ENCODE_WORDS = 4_096
# a term that more than this share of a shard's items have is scored as a dense column
DENSE_SHARE = 1 / 8
SEED_BLOCK = 128
_tokenizers: dict[str, "Words"] = {}

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
# ASCII punctuation, the apostrophe apart, which may begin a contraction
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[0x21:0x7F] = True
PUNCTUATION[0x30:0x3A] = PUNCTUATION[0x41:0x5B] = PUNCTUATION[0x61:0x7B] = PUNCTUATION[0x27] = False
# first bytes of combining marks, which join a letter before they are lower-cased
MARKS = np.zeros(256, bool)
MARKS[[0xCC, 0xCD]] = True


class Words:
    """Token ids of words, cached by hash in sorted arrays."""

    def __init__(self, path: str):
        # a task has one core, and threads of the tokenizer keep memory of their own
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # the vocabulary is lower case and ends words at punctuation, so words may be taken apart and lower-cased before
        probe = ["Ab,cD. eF", "ab", ",", "cd", ".", "ef"]
        whole, *parts = (e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False))
        self.folds = whole == sum(parts, [])
        self._empty()

    def _empty(self) -> None:
        self.keys, self.first, self.size, self.pool = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    @classmethod
    def of(cls, path: str) -> "Words":
        if path not in _tokenizers:
            _tokenizers[path] = cls(path)
        return _tokenizers[path]

    def places(self, hashes: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``pool`` the ids of the distinct words begin, and how many they are; ``hashes`` ascend."""
        at = np.searchsorted(self.keys, hashes)
        missing = np.flatnonzero(np.append(self.keys, np.uint64(0))[at] != hashes) if len(self.keys) else np.arange(len(hashes))
        if len(missing):
            if len(self.keys) + len(missing) > CACHE_WORDS and len(self.keys):
                self._empty()
                return self.places(hashes, raw, start, end)
            texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(start[missing].tolist(), end[missing].tolist())]
            sizes, new = [], []
            for lo in range(0, len(texts), ENCODE_WORDS):
                lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts[lo: lo + ENCODE_WORDS], add_special_tokens=False)]
                sizes.append(np.fromiter(map(len, lists), np.int64, len(lists)))
                new.append(np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes[-1].sum())))
            size, new = np.concatenate(sizes), np.concatenate(new)
            first = len(self.pool) + np.cumsum(size) - size
            where = at[missing]
            self.keys, self.first, self.size = np.insert(self.keys, where, hashes[missing]), np.insert(self.first, where, first), np.insert(self.size, where, size)
            self.pool = np.concatenate([self.pool, new])
            at = np.searchsorted(self.keys, hashes)
        return self.first[at].astype(np.int64), self.size[at].astype(np.int64)


def pieces_of_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, per text: first piece)``: words, cut where ASCII punctuation follows a letter."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1: n + 1] = ~flat.SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    edge[1:n] |= LETTER[data[:-1]] & PUNCTUATION[data[1:]]
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    return start, np.flatnonzero(inside[:-1] & (~inside[1:] | edge)), np.searchsorted(start, off)


def tokens(texts: pa.Array, words: Words, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of texts: first row, ids end to end, n + 1 offsets (the end id included), and the least word hash of each text."""
    data, off = flat.buffers(texts)
    for i, j, part, o in flat.blocks(data, off):
        raw = part.tobytes()
        if words.folds and b"<|" not in raw and not MARKS[part].any():
            part = flat.LOWER[part]
            raw = part.tobytes()
            start, end, first = pieces_of_words(part, o)
        else:
            start, end, first = flat.words(part, o)
        h = flat.piece_hash(flat.prefix_hash(part), start, end)
        distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
        base, size = words.places(distinct, raw, start[at], end[at])
        n = size[back]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = words.pool[np.repeat(base[back] - upto[:-1], n) + np.arange(upto[-1])]
        ends = upto[first[1:]]
        ids = np.insert(ids, ends, np.uint32(end_id))
        offsets = np.concatenate([[0], ends + np.arange(1, j - i + 1)])
        low = np.zeros(j - i, np.uint64)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            low[some] = np.minimum.reduceat(flat.mix(h), first[some])
        yield i, ids, offsets, low


def id_type(path: str) -> str:
    """Two bytes for an id where the vocabulary allows it."""
    return "<u2" if Words.of(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def token_table(docs: DataFrame, path: str, end_id: int, kind: str) -> DataFrame:
    """``(doc_id, near, n, ids, terms, df)``; terms and df, on the first row of a batch, count the batch's documents by token."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.of(path)
        for batch in batches:
            count = np.zeros(0, np.int64)
            rows: dict[str, list] = {"near": [], "n": [], "ids": []}
            for _, ids, offsets, low in tokens(batch.column("text"), words, end_id):
                row = np.repeat(np.arange(len(low)), np.diff(offsets))
                token = np.unique(row << 32 | ids) & 0xFFFFFFFF
                more = np.bincount(token)
                if len(more) > len(count):
                    count, more = more, count
                count[: len(more)] += more
                rows["near"].append(low.view(np.int64))
                rows["n"].append(np.diff(offsets))
                raw, w = ids.astype(kind).tobytes(), np.dtype(kind).itemsize
                rows["ids"] += [raw[w * a: w * b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            if not rows["near"]:
                continue
            terms = np.flatnonzero(count)
            rest = [None] * (batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.concatenate(rows["near"])), pa.array(np.concatenate(rows["n"])), pa.array(rows["ids"], pa.binary()),
                pa.array([terms.astype(np.int32), *rest], pa.list_(pa.int32())), pa.array([count[terms], *rest], pa.list_(pa.int64()))],
                ["doc_id", "near", "n", "ids", "terms", "df"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        task, "doc_id long, near long, n long, ids binary, terms array<int>, df array<long>")


class Index:
    """BM25 inverted index of the items of a shard, with every term at its idf over all documents.

    Postings of terms that many items have form a dense matrix, of at most ``1 / DENSE_SHARE`` times the postings' size, which scores a block
    of seeds in one product; the others are added up posting by posting.
    """

    def __init__(self, row: np.ndarray, token: np.ndarray, n_items: int, idf: np.ndarray, k1: float, b: float):
        size = np.bincount(row, minlength=n_items)
        key, tf = np.unique(token.astype(np.int64) * n_items + row, return_counts=True)
        term, item = key // n_items, key % n_items
        norm = k1 * (1 - b + b * size / max(size.mean(), 1))
        weight = idf[term] * tf * (k1 + 1) / (tf + norm[item])
        count = np.bincount(term, minlength=len(idf))
        column = np.cumsum(count > DENSE_SHARE * n_items) - 1
        often = (count > DENSE_SHARE * n_items)[term]
        self.dense = np.zeros((n_items, int(column[-1]) + 1 if len(column) else 0), np.float32)
        self.dense[item[often], column[term[often]]] = weight[often]
        term, self.item, self.weight = term[~often], item[~often], weight[~often]
        self.first = np.searchsorted(term, np.arange(len(idf) + 1))
        order = np.argsort(self.item, kind="stable")
        self.terms, self.at, self.n = term[order], np.searchsorted(self.item[order], np.arange(n_items + 1)), n_items
        self.ready: dict[int, np.ndarray] = {}

    def scores(self, seed: int, following: list[int]) -> np.ndarray:
        """The score of every item for the seed; the dense part is computed for the seeds that may follow too."""
        if seed not in self.ready:
            block = [seed, *following]
            part = (self.dense[block] > 0).astype(np.float32) @ self.dense.T
            self.ready = dict(zip(block, part))
        terms = self.terms[self.at[seed]: self.at[seed + 1]]
        lo, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        end = np.cumsum(size)
        dense = self.ready.pop(seed).astype(np.float64)
        if not len(end):
            return dense
        where = np.repeat(lo - end + size, size) + np.arange(end[-1])
        return dense + np.bincount(self.item[where], self.weight[where], self.n)


def pack_shard(sizes: np.ndarray, ids: np.ndarray, window: int, idf: np.ndarray, k1: float = 1.2, b: float = 0.75) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of the documents of one shard."""
    out: list[tuple[int, int, int, int, int]] = []
    seq = 0
    base = np.concatenate([[0], np.cumsum(sizes)])
    doc, begin, left = [], [], []
    for d, n in enumerate(sizes.tolist()):
        at = 0
        while n - at >= window:
            out.append((d, at, window, seq, 0))
            seq, at = seq + 1, at + window
        if n > at:
            doc.append(d)
            begin.append(at)
            left.append(n - at)
    m = len(doc)
    if not m:
        return out
    row = np.repeat(np.arange(m), left)
    tail = np.concatenate([ids[base[d] + a: base[d + 1]] for d, a in zip(doc, begin)])
    index = Index(row, tail, m, idf, k1, b)
    rest = np.array(left)
    order = np.argsort(-rest, kind="stable").tolist()
    at = 0
    used: list[tuple[int, int]] = []

    def take(i: int, n: int) -> None:
        used.append((i, n))
        rest[i] -= n

    while True:
        while at < m and not rest[order[at]]:
            at += 1
        if at == m:
            break
        seed, used = order[at], []
        free = window - int(rest[seed])
        take(seed, int(rest[seed]))
        if free:
            score = index.scores(seed, [i for i in order[at + 1: at + SEED_BLOCK] if rest[i]])
            score[rest == 0] = -1
            ranked = np.argsort(-score, kind="stable")
            ranked = ranked[: np.searchsorted(-score[ranked], 0.5, "left")]
            for i in ranked.tolist():
                n = min(int(rest[i]), free)
                take(i, n)
                free -= n
                if not free:
                    break
        # a last window that is not full goes into sequences of a power of two
        total, offset = window - free, 0
        room = window if total == window else 1 << total.bit_length() - 1
        for i, n in used:
            while n:
                k = min(n, room - offset)
                out.append((doc[i], begin[i], k, seq, offset))
                begin[i] += k
                n, offset, total = n - k, offset + k, total - k
                if offset == room:
                    seq, offset = seq + 1, 0
                    room = 1 << total.bit_length() - 1 if total else 0
    return out


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, shard_tokens: int = 1 << 21, part_tokens: int = 1 << 23) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``: every token of ``docs`` in exactly one piece.

    ``ids`` holds little-endian unsigned 32-bit ids; ``window`` is a power of two.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    kind = id_type(path)
    wide = np.dtype(kind).itemsize
    table = cut(token_table(docs, path, end_id, kind))
    total, n_docs = table.agg(F.sum("n"), F.count(F.lit(1))).first()
    # bounded by the vocabulary; a term of many documents has a small idf, never none
    df = table.where("terms is not null").select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy("x.terms").agg(
        F.sum("x.df").alias("df")).toArrow()
    idf = np.zeros(int(df["terms"].to_numpy().max()) + 1 if len(df) else 1)
    if len(df):
        n = df["df"].to_numpy()
        idf[df["terms"].to_numpy()] = np.log1p((n_docs - n + 0.5) / (n + 0.5))
    parts = max(1, -(-(total or 0) // part_tokens))
    rows = table.select("doc_id", "near", "ids").repartitionByRange(parts, "near", "doc_id").sortWithinPartitions("near", "doc_id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, bytes]] = []
        weight = 0

        def solve() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            sizes = np.array([len(x) // wide for _, x in held], np.int64)
            ids = np.frombuffer(b"".join(x for _, x in held), kind)
            pieces = pack_shard(sizes, ids, window, idf)
            raw, base = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(sizes)]).tolist()
            for lo in range(0, len(pieces), 5000):
                some = pieces[lo: lo + 5000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([held[d][0] for d, *_ in some], pa.int64()), pa.array([p[1] for p in some], pa.int64()), pa.array([p[2] for p in some], pa.int64()),
                    pa.array([raw[4 * (base[d] + a): 4 * (base[d] + a + n)] for d, a, n, *_ in some], pa.binary()), pa.array([int(sizes[p[0]]) for p in some], pa.int64()),
                    pa.array([sequence + p[3] for p in some], pa.int64()), pa.array([p[4] for p in some], pa.int64())],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            sequence += max((p[3] for p in pieces), default=-1) + 1

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                held.append((doc_id, ids))
                weight += len(ids) // wide
                if weight >= shard_tokens:
                    yield from solve()
                    held, weight = [], 0
        if held:
            yield from solve()

    return rows.mapInArrow(task, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
