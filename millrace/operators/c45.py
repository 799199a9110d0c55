"""C4.5 trees on categorical columns, one job set per level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.stats import gain_ratio_table
from millrace.session import cut

ROOT = "root"


def c45_tree_fit(df: DataFrame, attributes: list[str], cls: str, max_depth: int | None = None) -> DataFrame:
    """Node table ``(node, parent, depth, attr, value, n, label, split_attr)``.

    A node splits by the attribute with the largest positive gain ratio among those its
    path has not used (ties to the first), one child per value; ``split_attr`` is null in a
    leaf. ``label`` is the most frequent class, ties to the smaller. Rows carry their node
    as a path and all nodes of a level are scored together.
    """
    order = F.array(*[F.lit(a) for a in attributes])
    rows = cut(df.select(F.col(cls).alias("_cls"), *[F.col(a).cast("string").alias(a) for a in attributes],
                         F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"),
                         F.lit(None).cast("string").alias("attr"), F.lit(None).cast("string").alias("value"),
                         F.array().cast("array<string>").alias("used")))
    levels = []
    for depth in range((len(attributes) if max_depth is None else max_depth) + 1):
        per_class = rows.groupBy("node", "parent", "attr", "value", "used", "_cls").agg(F.count(F.lit(1)).alias("n"))
        nodes = per_class.groupBy("node", "parent", "attr", "value", "used").agg(
            F.sum("n").alias("n"), F.min(F.struct((-F.col("n")).alias("k"), F.col("_cls").alias("c")))["c"].alias("label"))
        final = depth == (len(attributes) if max_depth is None else max_depth)
        if final:
            best = None
        else:
            gains = gain_ratio_table(rows, attributes, "_cls", ["node"]).where(F.round("gain_ratio", 12) > 0)
            gains = gains.join(nodes.select("node", "used"), "node").where(~F.array_contains("used", F.col("attr")))
            rank = F.struct(F.round("gain_ratio", 12).alias("g"), (-F.array_position(order, F.col("attr"))).alias("o"))
            best = cut(gains.groupBy("node").agg(F.max_by("attr", rank).alias("split_attr")))
        level = nodes.join(best, "node", "left") if best is not None else nodes.withColumn(
            "split_attr", F.lit(None).cast("string"))
        levels.append(cut(level.select("node", "parent", F.lit(depth).alias("depth"), "attr", "value", "n", "label",
                                       "split_attr")))
        if best is None or best.isEmpty():
            break
        value = F.create_map(*[x for a in attributes for x in (F.lit(a), F.col(a))])[F.col("split_attr")]
        moved = rows.join(best, "node").withColumn("value", value)
        rows = cut(moved.select(
            "_cls", *attributes, F.concat_ws("/", "node", F.concat_ws("=", "split_attr", "value")).alias("node"),
            F.col("node").alias("parent"), F.col("split_attr").alias("attr"), "value",
            F.array_append("used", F.col("split_attr")).alias("used")))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def c45_tree_edges(tree: DataFrame) -> DataFrame:
    """``(parent, child, label)``: label is the branch value, or the class under a leaf."""
    inner = tree.where("parent is not null").select("parent", F.col("node").alias("child"), F.col("value").alias("label"))
    leaves = tree.where("split_attr is null").select(
        F.col("node").alias("parent"), F.concat("node", F.lit("/class")).alias("child"),
        F.col("label").cast("string").alias("label"))
    return inner.unionByName(leaves)


def c45_predict(df: DataFrame, tree: DataFrame, attributes: list[str], key: str) -> DataFrame:
    """``(key, pred)``: rows follow their values down; an unseen value stops at its node."""
    at = df.select(key, *[F.col(a).cast("string").alias(a) for a in attributes], F.lit(ROOT).alias("node"))
    nodes = tree.select("node", "split_attr", "label")
    value = F.create_map(*[x for a in attributes for x in (F.lit(a), F.col(a))])[F.col("split_attr")]
    names = tree.select(F.col("node").alias("next"))
    depth = tree.agg(F.max("depth")).first()[0]
    for _ in range(depth):
        step = at.join(nodes.drop("label"), "node").withColumn(
            "next", F.when(F.col("split_attr").isNotNull(),
                           F.concat_ws("/", "node", F.concat_ws("=", "split_attr", value))))
        known = step.join(names.withColumn("_ok", F.lit(True)), "next", "left")
        at = cut(known.withColumn("node", F.when(F.col("_ok"), F.col("next")).otherwise(F.col("node"))).select(at.columns))
    return at.join(nodes, "node").select(key, F.col("label").alias("pred"))
