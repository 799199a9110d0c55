"""Cosine similarity joins that meet only pairs which can matter.

Rows are scaled to length one, so a pair's similarity is the sum of products over common features. Features with at most
``heavy`` entities are joined directly: a row meets a bounded number of partners, and the sum over those
features is exact. Heavy features, which a third of all entities may hold, never meet pairwise as they are. They are ordered by
frequency in quarter octaves, and an entity's mass from one level on bounds what a pair that first meets there can still add:

* size bound: a pair of the light join is dropped when its sum plus the product of both heavy masses stays below the bar;
* prefix bound: a pair that shares heavy features only must meet at a level where the product of both masses reaches the bar. Postings
  are cut into bands of mass, and a row goes to the bands that reach its bar only, so a hot feature's list is not run through;
* running top-n bound: the bar of a top-n search is each entity's own n-th best among verified first candidates.

What is left is verified exactly. Entities with equal rows are one class throughout, so copies never meet each other; classes are told by
two 64-bit sums of hashes and the row count, which differ for different rows but with probability about 2**-100.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.pairs import best_partners, both_ways, feature_sizes, listed_sums
from millrace.operators.windows import topn_per_group
from millrace.session import cut, small

HEAVY = 256      # entities of a light feature at most
BAND = 0.1       # width of a band of masses, as a natural logarithm
BANDS = 100      # the last band holds all that is smaller
SLACK = 1e-9


class UnitRows:
    """Rows of length one of the distinct entities, light and heavy features apart.

    ``members (class, id)`` and ``classes (class, copies)`` tell which entities have the same row; a class is named by its smallest id.
    Several rows of one entity and feature count as one with the sum of their values; entities whose values are all 0 are left out.
    """

    def __init__(self, ratings: DataFrame, axis: str = "user", heavy: int = HEAVY):
        entity, feature = ("u", "i") if axis == "user" else ("i", "u")
        held = ratings.select(F.col(entity).cast("bigint").alias("e"), F.col(feature).cast("bigint").alias("f"), F.col("r").cast("double").alias("r"))
        held = held.repartition("e").groupBy("e", "f").agg(F.sum("r").alias("v"))
        squares = held.groupBy("e").agg(F.sum(F.col("v") * F.col("v")).alias("q")).where("q > 0")
        rows = cut(held.join(squares, "e").select("e", "f", "v", "q"))
        mark = lambda k: F.sum(F.xxhash64("f", "v", F.lit(k)).cast("decimal(38,0)"))
        marks = cut(rows.groupBy("e").agg(F.sqrt(F.max("q")).alias("norm"), mark(1).alias("m1"), mark(2).alias("m2"), F.count(F.lit(1)).alias("size")))
        names = cut(marks.groupBy("m1", "m2", "size").agg(F.min("e").alias("class"), F.count(F.lit(1)).alias("copies")))
        self.classes = names.select("class", "copies")
        self.copied = not names.where("copies > 1").isEmpty()
        self.members = marks.select(F.col("e").alias("class"), F.col("e").alias("id"), "norm")
        if self.copied:
            self.members = cut(marks.join(names, ["m1", "m2", "size"]).select("class", F.col("e").alias("id"), "norm"))
            rows = rows.join(small(self.members.where("class <> id").select(F.col("id").alias("e"))), "e", "left_anti")
        rows = rows.where("f is not null")
        sizes = rows.groupBy("f").agg(F.count(F.lit(1)).alias("size"))
        n_hot, _, self.met = feature_sizes(sizes, heavy)
        self.light, self.any_heavy = rows, n_hot > 0
        if not n_hot:
            return
        hot = cut(sizes.where(F.col("size") > heavy))
        self.light = rows.join(small(hot.select("f")), "f", "left_anti")
        hot = rows.join(hot, "f").select("e", "f", (F.col("v") / F.sqrt("q")).alias("x"), F.floor(4 * F.log2("size")).alias("level"))
        # at most some hundred levels for each entity
        onward = W.partitionBy("e").orderBy(F.desc("level")).rowsBetween(W.unboundedPreceding, 0)
        mass = hot.groupBy("e", "level").agg(F.sum(F.col("x") * F.col("x")).alias("m"), F.min("x").alias("least")).withColumns(
            {"s": F.sqrt(F.sum("m").over(onward)), "signed": F.min("least").over(onward) < 0})
        self.heavy = cut(hot.join(mass.select("e", "level", "s"), ["e", "level"]).select("e", "f", "x", "s", _band(F.col("s")).alias("band")))
        self.mass = cut(mass.groupBy("e").agg(F.max("s").alias("s"), F.max("signed").alias("signed")))

    def light_pairs(self, both: bool = False, best: Callable | None = None) -> DataFrame:
        """``(a, b, dot)`` with ``a < b``, or in both directions: sums over common light features; those that ``best`` keeps."""
        return listed_sums(self.light, ["sab"], both, self.met, best).withColumnRenamed("sab", "dot")

    def with_reach(self, pairs: DataFrame) -> DataFrame:
        """Pairs with ``most``, which their similarity cannot exceed."""
        left, right = (self.mass.select(F.col("e").alias(c), F.col("s").alias(f"s_{c}")) for c in ("a", "b"))
        out = pairs.join(left, "a", "left").join(right, "b", "left")
        return out.withColumn("most", F.col("dot") + F.coalesce(F.col("s_a") * F.col("s_b"), F.lit(0.0))).drop("s_a", "s_b")

    def heavy_pairs(self, bars: DataFrame | None, bar: float | None = None) -> DataFrame:
        """``(a, b)`` that first meet at a heavy feature and may reach the bar, one for all or ``bars (e, bar)`` for each a."""
        rows = self.heavy.withColumn("bar", F.lit(bar)) if bars is None else self.heavy.join(bars, "e", "left")
        need = (F.coalesce("bar", F.lit(-2.0)) - SLACK) / F.col("s")
        last = F.when(need > 1 + SLACK, -1).otherwise(_band(need))
        probes = rows.withColumns({"need": need, "last": last}).where("last >= 0")
        probes = probes.select(F.col("e").alias("a"), "f", "need", F.explode(F.sequence(F.lit(0), "last")).alias("band"))
        met = probes.join(self.heavy.select(F.col("e").alias("b"), "f", "band", "s"), ["f", "band"]).where(F.col("s") >= F.col("need"))
        return met.where("a <> b" if bars is not None else "a < b").select("a", "b").distinct()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """``(a, b, sim)`` from pairs ``(a, b, dot)``, whose ``dot`` is exact on the light features."""
        if not self.any_heavy:
            return pairs.select("a", "b", F.col("dot").alias("sim"))
        a = self.heavy.select(F.col("e").alias("a"), "f", F.col("x").alias("xa"))
        b = self.heavy.select(F.col("e").alias("b"), "f", F.col("x").alias("xb"))
        rest = pairs.select("a", "b").join(a, "a").join(b, ["b", "f"]).groupBy("a", "b").agg(F.sum(F.col("xa") * F.col("xb")).alias("more"))
        return pairs.join(rest, ["a", "b"], "left").select("a", "b", (F.col("dot") + F.coalesce("more", F.lit(0.0))).alias("sim"))


def _band(s):
    return F.least(F.floor(-F.log(F.greatest(F.least(s, F.lit(1.0)), F.lit(1e-300))) / BAND), F.lit(BANDS - 1)).cast("int")


def candidates_above(rows: UnitRows, bar: float) -> DataFrame:
    """``(a, b, dot)``: the class pairs whose similarity may reach ``bar``; only these are verified."""
    if not rows.any_heavy:
        return rows.light_pairs(best=lambda a, b, sums: np.flatnonzero(sums["sab"] >= bar - SLACK))
    light = cut(rows.light_pairs())
    kept = rows.with_reach(light).where(F.col("most") >= bar - SLACK).select("a", "b", "dot")
    new = rows.heavy_pairs(None, bar).join(light, ["a", "b"], "left_anti").withColumn("dot", F.lit(0.0))
    return cut(kept.unionByName(new))


def cosine_classes_above(rows: UnitRows, bar: float) -> DataFrame:
    """``(a, b, sim)`` of classes with ``a < b`` and a cosine of at least ``bar`` (above 0)."""
    if not bar > 0:
        raise ValueError("the bar must be above 0")
    return rows.verified(candidates_above(rows, bar)).where(F.col("sim") >= bar)


def cosine_pairs_above(ratings: DataFrame, bar: float, axis: str = "user", heavy: int = HEAVY) -> DataFrame:
    """``(a, b, sim)`` of all entities with ``a < b`` and a cosine of at least ``bar``; copies are spelt out."""
    rows = UnitRows(ratings, axis, heavy)
    own = rows.members.select("class", "id")
    a, b = (own.select(F.col("class").alias(c), F.col("id").alias(f"id_{c}")) for c in ("a", "b"))
    across = cosine_classes_above(rows, bar).join(a, "a").join(b, "b").select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), "sim")
    other = own.select("class", F.col("id").alias("other"))
    within = own.join(other, "class").where(F.col("id") < F.col("other")).select(F.col("id").alias("a"), F.col("other").alias("b"), F.lit(1.0).alias("sim"))
    return across.unionByName(within) if bar <= 1 else across


def cosine_partners_above(ratings: DataFrame, bar: float, axis: str = "user", heavy: int = HEAVY) -> DataFrame:
    """``(id, partners, total, best)`` of every entity with a partner: their number, and the sum and the largest of the cosines.

    Copies are counted, not spelt out.
    """
    rows = UnitRows(ratings, axis, heavy)
    pairs = both_ways(cosine_classes_above(rows, bar)).join(rows.classes.select(F.col("class").alias("b"), "copies"), "b")
    own = rows.classes.where("copies > 1").select(F.col("class").alias("a"), F.lit(1.0).alias("sim"), (F.col("copies") - 1).alias("copies"))
    sums = pairs.select("a", "sim", "copies").unionByName(own).groupBy("a").agg(
        F.sum("copies").alias("partners"), F.sum(F.col("sim") * F.col("copies")).alias("total"), F.max("sim").alias("best"))
    return rows.members.select(F.col("class").alias("a"), "id").join(sums, "a").select("id", "partners", "total", "best")


def _class_topn(rows: UnitRows, n: int) -> tuple[DataFrame, DataFrame]:
    """``(a, b, sim, rank)``: the n most similar other classes of each class; and the candidates that were verified for it."""
    order = [F.round("sim", 9).desc(), F.asc("b")]
    if not rows.any_heavy:
        # what is equal to nine digits to the n-th is ranked below
        sims = rows.light_pairs(both=True, best=best_partners(n, lambda sums: sums["sab"], 2e-9)).withColumnRenamed("dot", "sim")
        return topn_per_group(sims, ["a"], order, n), sims
    light = cut(rows.with_reach(rows.light_pairs(both=True)))
    first = topn_per_group(light, ["a"], [F.desc("most"), F.asc("b")], 2 * n, "_r").select("a", "b", "dot")
    strongest = topn_per_group(rows.heavy, ["f"], [F.abs("x").desc(), F.asc("e")], 2 * n, "_r").select("f", F.col("e").alias("b"))
    own = topn_per_group(rows.heavy, ["e"], [F.abs("x").desc(), F.asc("f")], 2, "_r").select("f", F.col("e").alias("a"))
    more = own.join(strongest, "f").where("a <> b").select("a", "b").distinct().join(light, ["a", "b"], "left_anti").withColumn("dot", F.lit(0.0))
    seeds = cut(rows.verified(first.unionByName(more)))
    bars = cut(topn_per_group(seeds, ["a"], order, n, "_r").where(F.col("_r") == n).select(F.col("a").alias("e"), F.col("sim").alias("bar")))
    kept = light.join(bars.withColumnRenamed("e", "a"), "a", "left").where(F.col("most") >= F.coalesce("bar", F.lit(-2.0)) - SLACK).select("a", "b", "dot")
    met = rows.heavy_pairs(bars).join(light, ["a", "b"], "left_anti").withColumn("dot", F.lit(0.0))
    candidates = cut(kept.unionByName(met))
    return topn_per_group(rows.verified(candidates), ["a"], order, n), candidates


def topn_cosine(ratings: DataFrame, n: int, axis: str = "user", heavy: int = HEAVY) -> DataFrame:
    """``(a, b, sim, rank)``: the n most similar partners of every entity; cosines equal to nine digits go by the lower id."""
    rows = UnitRows(ratings, axis, heavy)
    best, _ = _class_topn(rows, n)
    if not rows.copied:
        return best
    best = best.drop("rank")
    same = rows.classes.where("copies > 1").select(F.col("class").alias("a"), F.col("class").alias("b"), F.lit(1.0).alias("sim"))
    # n + 1 ids of a class are enough for all, and one of them may be the entity itself
    few = topn_per_group(rows.members.select("class", "id"), ["class"], [F.asc("id")], n + 1, "_r").select(F.col("class").alias("b"), F.col("id").alias("other"))
    listed = topn_per_group(best.unionByName(same).join(few, "b").select("a", "other", "sim"), ["a"], [F.round("sim", 9).desc(), F.asc("other")], n + 1, "_r").drop("_r")
    met = rows.members.select(F.col("class").alias("a"), "id").join(listed, "a").where(F.col("id") != F.col("other"))
    return topn_per_group(met.select(F.col("id").alias("a"), F.col("other").alias("b"), "sim"), ["a"], [F.round("sim", 9).desc(), F.asc("b")], n)
