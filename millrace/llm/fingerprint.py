"""Document fingerprints by one-permutation MinHash, in DataFrame expressions only.

Every shingle of five words is hashed once; the top bits of the hash name its bin and a bin keeps its smallest hash. An empty bin takes
the value of the first filled bin on a probe path of its own, which visits all bins in an order that depends on
the bin alone (optimal densification), so texts with the same filled bins borrow alike. Of each value the low bits are
stored, as hex digits of four bits. Two bins agree by chance with probability ``2 ** -4``, which the likeness takes off.

Defined results: null is the empty text; a text without words has the empty fingerprint, which is like itself (1.0) and unlike all
others (0.0); a text of 1 to 4 words is one shingle. Very long texts are one row's expression each; equal hashes are one shingle; repeated rows have equal
fingerprints; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import cut

BIN_BITS = 8
BINS = 1 << BIN_BITS
LOW = 64 - BIN_BITS
EMPTY = (1 << LOW) - 1        # low part of the marker of an empty bin, larger than any value in it
DIGIT_BITS = 4
PROBES = 16


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for each row."""
    return F.transform(F.array(value), body).getItem(0)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def probe_rule(b: int) -> tuple[int, int, int]:
    """Step, offset and inverse step of bin b: probe j is ``(step * j + offset) % BINS``; an odd step visits every bin."""
    x = (b + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
    x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 % (1 << 64)
    step, offset = (x >> 20) % BINS | 1, (x >> 40) % BINS
    return step, offset, pow(step, -1, BINS)


def fingerprint(text: Column, width: int = 5) -> Column:
    """Hex digits, one for each bin; the empty string for a text without words."""
    rules = [probe_rule(b) for b in range(BINS)]
    step, offset, inverse = (F.array(*[F.lit(r[k]) for r in rules]) for k in range(3))
    markers = F.array(*[F.lit((b << LOW | EMPTY)) for b in range(-BINS // 2, BINS // 2)])

    def bins(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, width)))
        # with one marker for each bin, the first of a bin in order is its least hash, or the marker
        return let(F.sort_array(F.concat(hashes, markers)), lambda s: F.filter(
            s, lambda x, i: (i == 0) | (F.shiftright(x, LOW) != F.shiftright(F.get(s, i - 1), LOW))))

    def full(x: Column) -> Column:
        return x.bitwiseAND(F.lit(EMPTY)) != EMPTY

    def digits(v: Column) -> Column:
        filled = F.filter(F.transform(v, lambda x, i: F.when(full(x), i)), lambda i: i.isNotNull())
        return let(filled, lambda s: F.array_join(F.transform(v, lambda x, i: digit(
            F.when(full(x), x).otherwise(F.get(v, donor(v, s, i))))), ""))

    def donor(v: Column, s: Column, i: Column) -> Column:
        # place on the probe path in the high part, the bin in the low one
        nearest = F.array_min(F.transform(s, lambda b: F.pmod((b - F.get(offset, i)) * F.get(inverse, i), F.lit(BINS)) * BINS + b)) % BINS
        early = F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda j: F.pmod(F.get(step, i) * j + F.get(offset, i), F.lit(BINS))),
                               lambda b: full(F.get(v, b))), F.lit(0))
        return F.when(F.size(s) < PROBES, nearest).otherwise(F.coalesce(early, nearest)).cast("int")

    def digit(x: Column) -> Column:
        return F.substring(F.lit("0123456789abcdef"), x.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int") + 1, F.lit(1))

    return let(words(text), lambda w: F.when(F.size(w) == 0, F.lit("")).otherwise(let(bins(w), digits)))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingles of two fingerprinted texts, 0 to 1."""
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda z: z))
    chance = 2.0**-DIGIT_BITS
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance)))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)`` with a ``row`` that no two rows share: doc_id where it is unique, else a number."""
    n, ids = docs.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if n == ids:
        return docs.withColumn("row", F.col("doc_id").cast("long"))
    return cut(docs.withColumn("row", F.monotonically_increasing_id()))


def successors(rows: DataFrame) -> DataFrame:
    """``(row, doc_id, n_chars, next)``: the following row in order of doc_id (ties by text), cyclic. Only ids and lengths move."""
    light = rows.select("row", "doc_id", F.xxhash64("text").alias("tie"), F.length("text").cast("long").alias("n_chars"))
    order = ["doc_id", "tie", "row"]
    placed = cut(light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    # one row for each partition
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(starts, "part long, start long")
    ranked = placed.join(F.broadcast(offsets), part == F.col("part")).select(
        "row", "doc_id", "n_chars", (F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("rank"))
    after = ranked.select(F.col("row").alias("next"), F.pmod(F.col("rank") - 1, F.lit(max(total, 1))).alias("rank"))
    return ranked.join(after, "rank").select("row", "doc_id", "n_chars", "next")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.

    The edited text has its last quarter of code points, rounded down, replaced by as many of the next document's first ones.
    """
    rows = numbered(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    follow = cut(successors(rows))
    # the same two columns on both sides, so that the texts are shuffled once for both joins
    rows = rows.select("row", "text")
    heads = rows.join(follow.select(F.col("row").alias("to"), F.col("next").alias("row"), F.floor(F.col("n_chars") / 4).cast("int").alias("take")), "row").select(
        F.col("to").alias("row"), F.col("text").substr(F.lit(1), F.col("take")).alias("head"))
    n = F.length("text")
    edited = F.concat(F.col("text").substr(F.lit(1), n - F.floor(n / 4).cast("int")), F.col("head"))
    prints = cut(rows.join(heads, "row").select(
        "row", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(edited).alias("edited_fingerprint")))
    nexts = follow.select("row", "doc_id", "next").join(prints.select(F.col("row").alias("next"), F.col("fingerprint").alias("next_fingerprint")), "next")
    return prints.join(nexts, "row").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
