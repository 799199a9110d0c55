"""Repair of conversation structure by rank-convergence parallel Viterbi.

The cheapest edits turn a conversation into an optional system turn and alternating user and assistant turns: ``(s?(ua)+)?`` in role
initials. Keep costs 0, Rerole to user or assistant 2, Insert an empty user or assistant turn 2, Delete 3 (blank and repeated
turns must go), and a truncated turn that stays costs 1. States are E (nothing yet), S (system only), U and A (last role).

* Rows are placed once by ranges of conversation, turn, role and text digest; every 4,096 places make a chunk, so a conversation of any
  length is many bounded chunks, and the first of equal texts is found by an aggregate.
* Backward costs: every chunk starts from a speculative cost vector at its right edge. Fix-up passes give a chunk the
  vector its successor found, and rerun those where the two differ by more than a constant, until none does. The constants add up to the cost.
* Tracing: the settled vectors drive a forward pass that takes, of the edits that keep the cost, the one with the least letter (Delete, Insert,
  Keep, Rerole). A chunk starts from a speculative state; fix-up passes rerun those whose predecessor ends in another state.
* Inside a task, all chunks of a block advance in step as arrays. Conversations of one chunk, nearly all, need no fix-up.

The repaired turns come from chunks too. Only a digest over a whole conversation must read its turns in order: SHA-256 can't
be split, so conversations of several chunks are streamed for it, one task each, with constant memory.

Defined results: null ids, turns, roles and texts: see ``rows_of``; turns sort with nulls first, ties by role, then SHA-256 of the text; equal rows
are interchangeable, and all but the first are duplicates; empty roles have no initial; very long texts are read whole by Spark's string functions
and hashes; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.session import cut

CHUNK_BITS = 12        # a chunk has at most 2**12 rows
BLOCK_ROWS = 1 << 18   # rows that a task works on at once
BLANKS = " \t\n\x0b\x0c\r"

E, S, U, A = range(4)
# the state after an inserted or reroled turn
ADD = np.array([U, U, A, U])
# the state after a kept turn, by state and class of its role (other, s, u, a); -1: not allowed
KEEP = np.array([[-1, S, U, -1], [-1, -1, U, -1], [-1, -1, -1, A], [-1, -1, U, -1]])
# costs after the last turn: S and U still need turns
FINAL = np.array([0, 4, 2, 0])
NEVER = 1 << 40
DELETE, INSERT, KEPT, REROLE = b"DIKR"


# --- arrays of one block of chunks ------------------------------------------------------------------
class Block:
    """Chunks of row codes, end to end: role class in bits 0 and 1, must go in bit 2, truncated in bit 3."""

    def __init__(self, codes: np.ndarray, off: np.ndarray):
        size = np.diff(off)
        self.by = np.argsort(-size, kind="stable")
        self.off, self.size, self.n = off[self.by], size[self.by], len(size)
        self.steps = int(size.max(initial=0))
        self.active = [int(k) for k in np.searchsorted(-self.size, -np.arange(1, self.steps + 1), "right")]
        self.role, self.go, self.cut = codes & 3, codes >> 2 & 1, codes >> 3 & 1
        # costs stand at the boundaries of rows: one more than rows in each chunk
        self.edge = self.off + self.by
        self.cost = np.zeros((4, len(codes) + self.n), np.int64)

    def backward(self, right: np.ndarray) -> np.ndarray:
        """Costs at the left edges from ``right``, those at the right edges; both (chunk, state)."""
        v = right[self.by].T.astype(np.int64)
        self.cost[:, self.edge + self.size] = v
        for t in range(self.steps):
            k = self.active[t]
            row = self.off[:k] + self.size[:k] - 1 - t
            ve, vs, vu, va = v[:, :k]
            role, stay = self.role[row], self.cut[row] + self.go[row] * NEVER
            to_u = stay + np.where(role == U, 0, 2) + vu
            to_a = stay + np.where(role == A, 0, 2) + va
            we = np.minimum(np.minimum(3 + ve, to_u), stay + np.where(role == S, 0, NEVER) + vs)
            ws, wu, wa = np.minimum(3 + vs, to_u), np.minimum(3 + vu, to_a), np.minimum(3 + va, to_u)
            u, a = np.minimum(wu, 2 + wa), np.minimum(wa, 2 + wu)
            v[:, :k] = np.minimum(we, 2 + u), np.minimum(ws, 2 + u), u, a
            self.cost[:, self.edge[:k] + self.size[:k] - 1 - t] = v[:, :k]
        out = np.empty((self.n, 4), np.int64)
        out[self.by] = v.T
        return out

    def trace(self, start: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """After ``backward``: the end states and the edits from the states ``start``; ``last`` marks ends of conversations."""
        q = start[self.by].copy()
        inserts, kind = np.zeros(len(self.role), np.int64), np.zeros(len(self.role), np.uint8)

        def insert(q: np.ndarray, at: np.ndarray, deleted: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            count = np.zeros(len(q), np.int64)
            while True:
                more = ~deleted(q) & (2 + self.cost[ADD[q], at] == self.cost[q, at])
                if not more.any():
                    return q, count
                q, count = np.where(more, ADD[q], q), count + more

        for t in range(self.steps):
            k = self.active[t]
            at, row = self.edge[:k] + t, self.off[:k] + t
            gone = lambda x: 3 + self.cost[x, at + 1] == self.cost[x, at]  # noqa: E731, B023
            state, inserts[row] = insert(q[:k], at, gone)
            to = KEEP[state, self.role[row]]
            delete = gone(state)
            keep = ~delete & (to >= 0) & (self.go[row] == 0) & (self.cut[row] + self.cost[to, at + 1] == self.cost[state, at])
            kind[row] = np.where(delete, DELETE, np.where(keep, KEPT, REROLE))
            q[:k] = np.where(delete, state, np.where(keep, to, ADD[state]))
        ends = np.flatnonzero(last[self.by])
        tail = np.zeros(self.n, np.int64)
        q[ends], tail[self.by[ends]] = insert(q[ends], self.edge[ends] + self.size[ends], lambda x: np.zeros(len(x), bool))
        off = np.append(np.sort(self.off), len(self.role))
        upto = np.cumsum(inserts + 1)
        text = np.full(int(upto[-1]) if len(upto) else 0, INSERT, np.uint8)
        text[upto - 1] = kind
        bounds = np.concatenate([[0], upto])[off].tolist()
        raw = text.tobytes().decode()
        end = np.empty(self.n, np.int64)
        end[self.by] = q
        return end, [raw[a:b] + "I" * int(n) for a, b, n in zip(bounds, bounds[1:], tail)]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    codes = batch.column("codes")
    off = codes.offsets.to_numpy().astype(np.int64)
    flat = codes.values.to_numpy().astype(np.int64) & 15
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(off, off[i] + BLOCK_ROWS, "right")) - 1)
        yield i, j, flat[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


def _vectors(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * 4, pa.int32()), pa.array(x.reshape(-1), pa.int64()))


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy().reshape(-1, 4)


LEFT = "ckey string, no long, n long, right array<long>, left array<long>, base long"


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Left edge vectors with least cost 0, that cost, and the right edge vectors they came from."""
    for batch in batches:
        for i, j, codes, off in _blocks(batch):
            part = batch.slice(i, j - i)
            left = Block(codes, off).backward(_matrix(part.column("right")))
            base = left.min(1)
            yield pa.RecordBatch.from_arrays([part.column("ckey"), part.column("no"), part.column("n"), part.column("right"), _vectors(left - base[:, None]),
                                              pa.array(base)], ["ckey", "no", "n", "right", "left", "base"])


TRACED = "ckey string, no long, n long, chunk long, right array<long>, start int, end int, audit string"


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, codes, off in _blocks(batch):
            part = batch.slice(i, j - i)
            block = Block(codes, off)
            block.backward(_matrix(part.column("right")))
            last = part.column("no").to_numpy() == part.column("n").to_numpy()
            end, audit = block.trace(part.column("start").to_numpy(), last)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("ckey", "no", "n", "chunk", "right", "start")), pa.array(end, pa.int32()), pa.array(audit, pa.string())],
                                             ["ckey", "no", "n", "chunk", "right", "start", "end", "audit"])


# --- rows and chunks ------------------------------------------------------------------------------
def rows_of(table: DataFrame) -> DataFrame:
    """``(conv_id, ckey, turn, role, text)``: null roles and texts are one space; null ids are one conversation of their own."""
    return table.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(" ")).alias("ckey"),
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """Faults by a hash of conversation and turn, one null each as one space: of 20 values, 0 drops a row, 1 empties its text, 2 takes out
    sentence ends, 3 repeats it and 4 makes it a user's."""
    h = F.crc32(F.concat(F.col("ckey"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(h == 0, 0).when(h == 3, 2).otherwise(1)
    return rows.select("conv_id", "ckey", "turn", F.when(h == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(0), copies)).alias("copy")).drop("copy")


def placed(rows: DataFrame) -> DataFrame:
    """Rows with a place in the order of conversation and turn, written once; equal rows are told apart, so a hot one is split too."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    table = rows.withColumns({"key": F.unhex(F.sha2("text", 256)), "blank": body == "", "cut": ~F.right(body, F.lit(1)).isin(".", "!", "?"),
                              "one": F.monotonically_increasing_id()})
    order = [F.col("ckey"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key"), F.col("one")]
    return cut(table.repartitionByRange(*order).sortWithinPartitions(*order).drop("one").withColumn("pos", F.monotonically_increasing_id()))


def chunked(table: DataFrame) -> DataFrame:
    """``(ckey, chunk, no, n, codes, blank, duplicate, truncated, illegal)``; ``no`` counts from 1 to ``n`` in a conversation."""
    light = table.select("ckey", "pos", "role", "key", "blank", "cut")
    first = light.where(~F.col("blank")).groupBy("ckey", "role", "key").agg(F.min("pos").alias("first"))
    rows = light.join(first, ["ckey", "role", "key"], "left")
    again = ~F.col("blank") & (F.col("pos") > F.col("first"))
    short = F.col("cut") & ~F.col("blank") & ~again
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in (("s", S), ("u", U), ("a", A)) for x in p]), F.left("role", F.lit(1))), F.lit(0))
    code = kind + F.when(F.col("blank") | again, 4).otherwise(0) + F.when(short, 8).otherwise(0)
    within = F.col("pos").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    count = lambda c: F.count_if(c)
    chunks = cut(rows.groupBy("ckey", F.shiftright("pos", CHUNK_BITS).alias("chunk")).agg(
        F.array_sort(F.collect_list((within * 16 + code).cast("int"))).alias("codes"), count(F.col("blank")).alias("blank"),
        count(again).alias("duplicate"), count(short).alias("truncated")))
    role = lambda x: x.bitwiseAND(F.lit(3))
    odd = lambda x, y: ~(((role(x) == S) & (role(y) == U)) | ((role(x) == U) & (role(y) == A)) | ((role(x) == A) & (role(y) == U)))
    pairs = F.zip_with(F.slice("codes", 1, F.size("codes") - 1), F.slice("codes", 2, F.size("codes")), lambda x, y: odd(x, y).cast("long"))
    # chunks of a conversation are numbered without their rows
    w = W.partitionBy("ckey").orderBy("chunk")
    before = F.lag("tail").over(w)
    light = chunks.select("ckey", "chunk", F.element_at("codes", 1).alias("head"), F.element_at("codes", -1).alias("tail")).select(
        "ckey", "chunk", F.row_number().over(w).cast("long").alias("no"), F.count(F.lit(1)).over(W.partitionBy("ckey")).alias("n"),
        F.when(before.isNull(), 0).otherwise(odd(before, F.col("head")).cast("long")).alias("seam"))
    return cut(chunks.join(light, ["ckey", "chunk"]).select(
        "ckey", "chunk", "no", "n", "codes", "blank", "duplicate", "truncated",
        (F.aggregate(pairs, F.lit(0).cast("long"), lambda s, x: s + x) + F.col("seam")).alias("illegal")))


def _settle(chunks: DataFrame, found: DataFrame, step: Callable, kinds: str, given: str, gives: str, toward: int) -> DataFrame:
    """Fix-up passes: what a chunk was ``given`` must be what its neighbour (``toward``) ``gives``; the others run again."""
    single, several = found.where("n = 1"), found.where("n > 1")
    if several.isEmpty():
        return found
    several = cut(several)
    while True:
        beside = several.select("ckey", (F.col("no") - toward).alias("no"), F.col(gives).alias("true"))
        wrong = cut(several.select("ckey", "no", given).join(beside, ["ckey", "no"]).where(F.col(given) != F.col("true")).select("ckey", "no", "true"))
        if wrong.isEmpty():
            return single.unionByName(several)
        redo = chunks.where("n > 1").join(wrong, ["ckey", "no"]).withColumn(given, F.col("true")).drop("true")
        several = cut(several.join(wrong, ["ckey", "no"], "left_anti").unionByName(redo.mapInArrow(step, kinds)))


def edits(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ckey, cost)``, and the traced chunks ``(ckey, no, n, chunk, start, end, audit)``."""
    final = F.array(*[F.lit(int(x)).cast("long") for x in FINAL])
    codes = chunks.select("ckey", "no", "n", "chunk", "codes")
    found = cut(codes.withColumn("right", final).mapInArrow(_backward, LEFT))
    found = _settle(codes.withColumn("right", final), found, _backward, LEFT, "right", "left", 1)
    # the first chunk starts in E; the least costs of all edges add up
    cost = found.groupBy("ckey").agg((F.sum("base") + F.sum(F.when(F.col("no") == 1, F.col("left")[E]))).alias("cost"))
    codes = codes.join(found.select("ckey", "no", "right"), ["ckey", "no"]).withColumn("start", F.when(F.col("no") == 1, E).otherwise(A))
    codes = cut(codes)
    traced = cut(codes.mapInArrow(_trace, TRACED))
    return cost, _settle(codes, traced, _trace, TRACED, "start", "end", -1)


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, str, str]]:
    """``(ckey, chunk, n, place, role, text)`` of rows that come chunk by chunk, each after its edits (``pos`` is null)."""
    audit, at, state, place, head = "", 0, E, 0, ("", 0, 0)

    def turn(role: str, text: str) -> tuple[str, int, int, int, str, str]:
        nonlocal place
        place += 1
        return *head, place, role, text

    def inserted() -> Iterator[tuple[str, int, int, int, str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            at, state = at + 1, ADD[state]
            yield turn("user" if state == U else "assistant", "")

    for batch in batches:
        for ckey, chunk, pos, role, text, n, start, own in zip(*(batch.column(c).to_pylist() for c in ("ckey", "chunk", "pos", "role", "text", "n", "start", "audit"))):
            if pos is None:
                yield from inserted()
                audit, at, state, place, head = own, 0, start, 0, (ckey, chunk, n)
                continue
            yield from inserted()
            op, at = audit[at], at + 1
            if op == "K":
                state = {"s": S, "u": U, "a": A}[role[0]]
                yield turn(role, text)
            elif op == "R":
                state = ADD[state]
                yield turn("user" if state == U else "assistant", text)
    yield from inserted()


def _replay(table: DataFrame, traced: DataFrame) -> DataFrame:
    rows = table.select("ckey", F.shiftright("pos", CHUNK_BITS).alias("chunk"), "pos", "role", "text")
    heads = traced.select("ckey", "chunk", F.col("n"), "start", "audit")
    return rows.unionByName(heads, allowMissingColumns=True).repartition("ckey", "chunk").sortWithinPartitions("ckey", "chunk", F.col("pos").asc_nulls_first())


TURN = "ckey string, chunk long, n long, place long, role string, text string"


def _batched(rows: Iterator[tuple], kinds: list[tuple[str, pa.DataType]], size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``size`` characters of their last column."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 64 + len(row[-1] or "")
        if weight >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), kinds)], [k for k, _ in kinds])
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), kinds)], [k for k, _ in kinds])


TURN_ARROW = [("ckey", pa.string()), ("chunk", pa.int64()), ("n", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batched(_replayed(batches), TURN_ARROW)


def _digests(turns: Iterator[tuple], whole: bool) -> Iterator[tuple]:
    """Turns of single chunks become ``(ckey, digest)``; those of several pass, until they come as a ``whole`` conversation."""
    key, h = None, None
    for row in turns:
        if row[2] > 1 and not whole:
            yield *row[:5], None, row[5]
            continue
        if h is None or row[0] != key:
            if h is not None:
                yield key, None, None, None, None, h.hexdigest(), None
            key, h = row[0], hashlib.sha256()
        else:
            h.update(b"\n")
        h.update(f"{row[4]}:{row[5]}".encode())
    if h is not None:
        yield key, None, None, None, None, h.hexdigest(), None


DIGEST = "ckey string, chunk long, n long, place long, role string, digest string, text string"
DIGEST_ARROW = [*TURN_ARROW[:5], ("digest", pa.string()), TURN_ARROW[5]]


def _chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _batched(_digests(_replayed(batches), False), DIGEST_ARROW)


def _whole_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c, _ in TURN_ARROW)))
    yield from _batched(_digests(rows, True), DIGEST_ARROW)


class Repair:
    """The repair of rows ``(conv_id, ckey, turn, role, text)``, held as tables in the shared folder."""

    def __init__(self, rows: DataFrame):
        self.table = placed(rows)
        self.chunks = chunked(self.table)
        self.cost, self.traced = edits(self.chunks)

    def turns(self) -> DataFrame:
        """``(ckey, chunk, place, role, text)``: the repaired conversations, in order of chunk and place."""
        return _replay(self.table, self.traced).mapInArrow(_turns, TURN).drop("n")

    def digests(self) -> DataFrame:
        """``(ckey, digest)`` of the repaired ``role:text``, newline-joined; conversations without turns are absent."""
        found = cut(_replay(self.table, self.traced).mapInArrow(_chunk_digests, DIGEST))
        long = found.where("digest is null").drop("digest").repartition("ckey").sortWithinPartitions("ckey", "chunk", "place")
        return found.where("digest is not null").unionByName(long.mapInArrow(_whole_digests, DIGEST)).select("ckey", "digest")

    def report(self) -> DataFrame:
        """``(ckey, gaps, blank, duplicate, truncated, illegal, cost, audit)`` for each conversation."""
        turns = self.table.groupBy("ckey").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0).cast("long")).alias("gaps"))
        counts = self.chunks.groupBy("ckey").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])
        audit = self.traced.groupBy("ckey").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("no", "audit"))), lambda x: x["audit"]), "").alias("audit"))
        return turns.join(counts, "ckey").join(self.cost, "ckey").join(audit, "ckey")


def repaired_conversations(conversations: DataFrame, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row for each conversation of the table, also where ``prepare`` leaves it no rows: counts, cost, edits and digest."""
    rows = rows_of(conversations)
    repair = Repair(prepare(rows) if prepare else rows)
    every = rows.select("conv_id", "ckey").distinct()
    zero: Callable[[str], Column] = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(repair.report(), "ckey", "left").join(repair.digests(), "ckey", "left").select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
