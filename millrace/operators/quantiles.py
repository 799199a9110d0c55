"""Exact quantiles and ordered running sums that hold no unbounded group in one task."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.session import cut

GROUP_VALUES = 1_000_000   # distinct values one aggregate buffer may hold
BUCKET_ROWS = 100_000    # rows one window partition should hold
MAX_BUCKETS = 4_000      # cuts of one narrowing round; a bucket that is still too full is cut again


def exact_quantiles(df: DataFrame, by: list[str], value: str, probs: list[float],
                    group_values: int = GROUP_VALUES) -> DataFrame:
    """Interpolated quantiles per group as columns ``q0, q1, …`` in the order of ``probs``.

    ``percentile`` keeps a group's distinct values in one buffer. That is used only
    where no group has more than ``group_values`` of them; otherwise the wanted
    ranks are narrowed down by value buckets first (same result). A null key is no group.
    """
    rows = df.dropna(subset=[*by, value]).select(*by, F.col(value).cast("double").alias("_v"))
    widest = rows.groupBy(*by).agg(F.approx_count_distinct("_v").alias("n")).agg(F.max("n")).first()[0] or 0
    if widest * 1.1 <= group_values:
        q = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs]))
        agg = rows.groupBy(*by).agg(q.alias("_q"))
        return agg.select(*by, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))])
    return _quantiles_by_rank(rows, by, probs, group_values)


def _quantiles_by_rank(rows: DataFrame, by: list[str], probs: list[float], group_values: int) -> DataFrame:
    if not by:
        rows = rows.withColumn("_all", F.lit(0))
    keys = list(by) or ["_all"]
    work = cut(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    sizes = work.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    spec = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    want = sizes.select(*keys, F.explode(spec).alias("s"), "_total").select(
        *keys, F.col("s.i").alias("_i"), (F.col("s.p") * (F.col("_total") - 1)).alias("_pos"))
    side = F.explode(F.array(F.lit(0), F.lit(1))).alias("_side")
    targets = cut(want.select(*keys, "_i", "_pos", side).withColumn(
        "_need", F.when(F.col("_side") == 0, F.floor("_pos")).otherwise(F.ceil("_pos")).cast("bigint")))
    narrowed = list(keys)
    while True:
        widest = work.groupBy(*narrowed).count().agg(F.max("count")).first()[0]
        if widest <= group_values:
            break
        buckets = min(MAX_BUCKETS, math.ceil(widest / group_values) * 8)
        points = F.percentile_approx("_v", F.array(*[F.lit(j / buckets) for j in range(1, buckets)]), F.lit(10 * buckets))
        cuts = work.groupBy(*narrowed).agg(points.alias("_cuts"), F.min("_v").alias("_lo"))
        placed = work.join(cuts, narrowed).withColumn(
            "_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts", "_lo")
        placed = cut(placed)
        totals = placed.groupBy(*narrowed, "_b").agg(F.sum("_n").alias("_bn"))
        ahead = W.partitionBy(*narrowed).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
        totals = totals.withColumn("_before", F.coalesce(F.sum("_bn").over(ahead), F.lit(0)))
        chosen = targets.join(totals, narrowed).where(
            (F.col("_need") >= F.col("_before")) & (F.col("_need") < F.col("_before") + F.col("_bn")))
        targets = cut(chosen.withColumn("_need", F.col("_need") - F.col("_before"))
                      .withColumn("_slot", F.col("_i") * 2 + F.col("_side"))
                      .select(*keys, "_i", "_pos", "_side", "_need", "_slot", "_b"))
        old = [c for c in narrowed if c != "_slot"] + (["_slot"] if "_slot" in narrowed else [])
        link = targets.select(*dict.fromkeys([*old, "_slot", "_b"]))
        work = cut(placed.join(link, [*old, "_b"]).select(*keys, "_slot", "_v", "_n"))
        targets = targets.drop("_b")
        narrowed = [*keys, "_slot"]
    upto = W.partitionBy(*narrowed).orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ranked = work.withColumn("_cum", F.sum("_n").over(upto))
    hit = targets.join(ranked, narrowed).where(
        (F.col("_need") < F.col("_cum")) & (F.col("_need") >= F.col("_cum") - F.col("_n")))
    ends = hit.groupBy(*keys, "_i", "_pos").agg(F.min("_v").alias("a"), F.max("_v").alias("b"))
    ends = ends.withColumn("_q", F.col("a") + (F.col("b") - F.col("a")) * (F.col("_pos") - F.floor("_pos")))
    out = ends.groupBy(*keys).agg(*[F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(f"q{i}")
                                    for i in range(len(probs))])
    return out if by else out.drop("_all")


def positions(df: DataFrame, order: list, out: str = "_pos") -> DataFrame:
    """1-based place of every row in the given order, which no window has to hold.

    Rows are dealt by ranges and sorted in their partitions, of which there are as many as the session shuffles to; one count for
    each partition reaches the driver. The table is written first, so the places stay as they are.
    """
    placed = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("_p")).count().collect())
    starts = list(zip((p for p, _ in sizes), itertools.accumulate((n for _, n in sizes), initial=0)))
    table = df.sparkSession.createDataFrame(starts, "_p int, _start long")
    return placed.join(F.broadcast(table), part == F.col("_p")).withColumn(
        out, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_p", "_start", "_at")


def running_sums(df: DataFrame, order: str, sums: list[str], descending: bool = False,
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Inclusive running totals ``cum_x`` of ``sums`` over distinct values of ``order``.

    Rows with one ``order`` value are added up first. A long table is dealt by ranges; totals per partition, one row each,
    give every partition its start, so no task sees more than its range.
    """
    base = df.groupBy(F.col(order).cast("double").alias(order)).agg(*[F.sum(s).alias(s) for s in sums])
    way = F.col(order).desc() if descending else F.col(order).asc()
    upto = W.partitionBy("_b").orderBy(way).rowsBetween(W.unboundedPreceding, 0)
    if base.count() <= bucket_rows:
        return base.withColumn("_b", F.lit(0)).select(
            "*", *[F.sum(s).over(upto).alias(f"cum_{s}") for s in sums]).drop("_b")
    placed = cut(base.repartitionByRange(way).withColumn("_b", F.spark_partition_id()))
    totals = sorted((tuple(r) for r in placed.groupBy("_b").agg(*[F.sum(s).alias(f"t_{s}") for s in sums]).collect()))
    starts, ahead = [], [0] * len(sums)
    for b, *more in totals:
        starts.append((b, *ahead))
        ahead = [x + (y or 0) for x, y in zip(ahead, more)]
    kinds = ", ".join(f"s_{s} {placed.schema[s].dataType.simpleString()}" for s in sums)
    table = df.sparkSession.createDataFrame(starts, f"_b int, {kinds}")
    return placed.join(F.broadcast(table), "_b").select(
        order, *sums, *[(F.col(f"s_{s}") + F.sum(s).over(upto)).alias(f"cum_{s}") for s in sums])


def ordered_rank(df: DataFrame, by: list[str], order: str, tie: str, descending: bool = False, out: str = "rank",
                 bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """1-based rank per group by ``order``, then ``tie`` ascending.

    A long table is placed in the order of group, ``order`` and ``tie`` as a whole, so a group may be of any size; the rank is the
    distance to the group's first place.
    """
    way = F.col(order).desc() if descending else F.col(order).asc()
    if df.count() <= bucket_rows:
        w = W.partitionBy(*by).orderBy(way, F.col(tie).asc())
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    placed = positions(df, [*[F.col(c).asc() for c in by], way, F.col(tie).asc()])
    if not by:
        return placed.withColumn(out, F.col("_pos").cast("bigint")).select(*df.columns, out)
    first = placed.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]).agg(F.min("_pos").alias("_first"))
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)]
    return placed.join(first, same).withColumn(out, (F.col("_pos") - F.col("_first") + 1).cast("bigint")).select(*df.columns, out)


def previous_rows(df: DataFrame, by: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Adds ``prev_x`` for ``values``: those of the row before in ascending ``order`` within a group, null for its first row.

    Rows are dealt by ranges of group and order, whatever the size of a group, and every partition gets one border row, the last of
    the partition before it. Only the border rows reach the driver.
    """
    keys = [*by, *order]
    placed = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_p", F.shiftright("_at", 33)))
    kept = list(dict.fromkeys([*by, *values]))
    ends = sorted(tuple(r) for r in placed.groupBy("_p").agg(F.max_by(F.struct(*kept), "_at").alias("end")).collect())
    kinds = ", ".join(f"`{c}` {placed.schema[c].dataType.simpleString()}" for c in kept)
    borders = df.sparkSession.createDataFrame([(p, before) for (p, _), (_, before) in zip(ends[1:], ends)], f"_p long, border struct<{kinds.replace('` ', '`: ')}>")
    w = W.partitionBy("_p").orderBy("_at")
    before = F.coalesce(F.lag(F.struct(*kept)).over(w), F.when(F.row_number().over(w) == 1, F.col("border")))
    out = placed.join(F.broadcast(borders), "_p", "left").withColumn("_before", before)
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"_before.{c}").eqNullSafe(F.col(c))
    return out.select(*df.columns, *[F.when(same, F.col(f"_before.{v}")).alias(f"prev_{v}") for v in values])
