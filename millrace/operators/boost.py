"""Second-order boosted trees on binned rows.

A round adds one tree, or one per class or parallel slot. Rows are read once per tree
level: the node of a row is an expression over its bins, a task adds up one histogram of
its partition over (slot, node, feature, bin), these are merged by key, and the best split of
a node is found in Spark. Only best splits, a bounded number per level, reach the driver. Which
features a tree, level or node may use follows from hashes in the plan.

Gain is ``GL²/(HL+λ) + GR²/(HR+λ) - G²/(H+λ)`` without the factor one half, and a split
under ``gamma`` is taken back from the leaves upward.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.functions.scalar import double_array, sigmoid, uniform
from millrace.session import cut

Gradient = Callable[[Column, Column], tuple[Column, Column]]
MISSING = -1
INLINE_DEPTH = 6          # deeper levels keep the row's node in a table
CASE_NODES = 1_500        # larger models are applied by a vectorised walk
PAIR_TILE = 1_024         # combinations of a ranking group that are paired at once
NODE_SCHEMA = ("tree int, node int, cls int, feature int, threshold double, yes int, no int, missing int, "
               "leaf double, gain double, cover double")


@dataclass
class Params:
    objective: str | Gradient = "reg:linear"
    num_round: int = 10
    max_depth: int = 6
    eta: float = 0.3
    gamma: float = 0.0
    min_child_weight: float = 1.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    max_delta_step: float | None = None
    base_score: float = 0.5
    max_bins: int = 32
    num_class: int = 1
    num_parallel_tree: int = 1
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    colsample_bylevel: float = 1.0
    colsample_bynode: float = 1.0
    scale_pos_weight: float = 1.0
    tweedie_variance_power: float = 1.5
    rate_drop: float = 0.0
    skip_drop: float = 0.0
    one_drop: bool = False
    sample_type: str = "uniform"
    normalize_type: str = "tree"
    dart: bool = False
    cut_every: int = 8
    seed: int = 0

    @property
    def delta_limit(self) -> float:
        if self.max_delta_step is not None:
            return self.max_delta_step
        return 0.7 if self.objective == "count:poisson" else 0.0


LOGISTIC = ("binary:logistic", "reg:logistic", "binary:logitraw")
LOG_LINK = ("count:poisson", "reg:gamma", "reg:tweedie")
MULTI = ("multi:softmax", "multi:softprob")


def gradients(objective: str | Gradient, margin: Column, label: Column, rho: float = 1.5,
              delta: float = 0.7) -> tuple[Column, Column]:
    """First and second derivative of a single-margin loss."""
    if callable(objective):
        return objective(margin, label)
    if objective == "reg:linear":
        return margin - label, F.lit(1.0)
    if objective in LOGISTIC:
        p = sigmoid(margin)
        return p - label, F.greatest(p * (1 - p), F.lit(1e-16))
    mean = F.exp(margin)
    if objective == "count:poisson":
        return mean - label, F.exp(margin + delta)
    if objective == "reg:gamma":
        return 1 - label / mean, label / mean
    if objective == "reg:tweedie":
        a, b = F.exp((1 - rho) * margin), F.exp((2 - rho) * margin)
        return b - label * a, (2 - rho) * b - label * (1 - rho) * a
    raise ValueError(f"unknown objective {objective}")


def softmax_gradients(margins: list[Column], label: Column) -> list[tuple[Column, Column]]:
    """Per class ``p - 1{y = c}`` and ``2 p (1 - p)``."""
    top = F.greatest(*margins)
    weights = [F.exp(m - top) for m in margins]
    total = sum(weights[1:], weights[0])
    out = []
    for c, w in enumerate(weights):
        p = w / total
        out.append((p - (label == c).cast("double"), F.greatest(2 * p * (1 - p), F.lit(1e-16))))
    return out


def pairwise_gradients(df: DataFrame, group: str, label: str, margin: str, tile: int = PAIR_TILE) -> DataFrame:
    """Adds ``g, h`` of the pairwise logistic loss over pairs of different label in a group.

    Rows with equal (group, label, margin) have equal derivatives, so pairs are formed
    between these combinations with their counts, not between rows. A group of at most ``tile`` combinations is an equi join;
    a larger one is cut into tiles, and each pair of tiles is one task's matrix, whose sums over either side are added up by combination.
    """
    combos = cut(df.groupBy(group, label, margin).agg(F.count(F.lit(1)).alias("_n")))
    sizes = combos.groupBy(group).agg(F.count(F.lit(1)).alias("_size"))
    large = cut(sizes.where(F.col("_size") > tile).withColumn("_tiles", F.ceil(F.col("_size") / tile).cast("int")))
    a, b = combos.join(large, group, "left_anti").alias("a"), combos.alias("b")
    p = sigmoid(F.when(F.col(f"a.{label}") > F.col(f"b.{label}"), F.col(f"b.{margin}") - F.col(f"a.{margin}"))
                .otherwise(F.col(f"a.{margin}") - F.col(f"b.{margin}")))
    sign = F.when(F.col(f"a.{label}") > F.col(f"b.{label}"), -1.0).otherwise(1.0)
    met = a.join(b, (F.col(f"a.{group}") == F.col(f"b.{group}")) & (F.col(f"a.{label}") != F.col(f"b.{label}")))
    sums = met.groupBy(*[F.col(f"a.{c}").alias(c) for c in (group, label, margin)]).agg(
        F.sum(F.col("b._n") * sign * p).alias("g"), F.sum(F.col("b._n") * 2 * p * (1 - p)).alias("h"))
    if not large.isEmpty():
        sums = sums.unionByName(_tiled_gradients(combos.join(large.select(group, "_tiles"), group), group, label, margin))
    return df.join(sums, [group, label, margin], "left").na.fill(0.0, ["g", "h"])


def _tiled_gradients(combos: DataFrame, group: str, label: str, margin: str) -> DataFrame:
    """``(group, label, margin, g, h)`` of groups that are cut into ``_tiles`` tiles by a hash of the combination."""
    own = combos.withColumn("_own", F.pmod(F.xxhash64(label, margin), F.col("_tiles")).cast("int"))
    dealt = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1))).select(
        group, label, margin, "_n", "_own", F.least("_own", "_other").alias("_p"), F.greatest("_own", "_other").alias("_q"))

    def pairs(pdf: pd.DataFrame) -> pd.DataFrame:
        first = (pdf["_own"] == pdf["_p"]).to_numpy()
        across = bool((pdf["_p"] != pdf["_q"]).iloc[0])
        left = pdf[first]
        right = pdf[~first] if across else left
        y, m, n = (x.to_numpy(dtype="float64") for x in (left[label], left[margin], left["_n"]))
        y2, m2, n2 = (x.to_numpy(dtype="float64") for x in (right[label], right[margin], right["_n"]))
        # 1 where the left one should rank higher
        sign = np.sign(y[:, None] - y2[None, :])
        p = np.where(sign != 0, 1 / (1 + np.exp(np.clip(sign * (m[:, None] - m2[None, :]), -700, 700))), 0.0)
        curve = 2 * p * (1 - p)
        out = [left.assign(g=-(sign * p) @ n2, h=curve @ n2)]
        if across:
            out.append(right.assign(g=n @ (sign * p), h=n @ curve))
        return pd.concat(out)[[group, label, margin, "g", "h"]]

    kinds = ", ".join(f"`{c}` {combos.schema[c].dataType.simpleString()}" for c in (group, label, margin))
    found = dealt.groupBy(group, "_p", "_q").applyInPandas(pairs, f"{kinds}, g double, h double")
    return found.groupBy(group, label, margin).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def class_weight_scale(df: DataFrame, label: str) -> DataFrame:
    """Negatives over positives."""
    y = F.col(label)
    return df.agg(F.try_divide(F.count_if(y == 0), F.count_if(y == 1)).alias("scale_pos_weight"))


@dataclass
class Node:
    id: int
    g: float
    h: float
    feature: int = -1
    bin: int = 0
    threshold: float = 0.0
    missing_left: bool = True
    gain: float = 0.0
    leaf: float = 0.0


@dataclass
class Tree:
    cls: int = 0
    nodes: dict[int, Node] = field(default_factory=dict)
    weight: float = 1.0

    def is_leaf(self, i: int) -> bool:
        return self.nodes[i].feature < 0


@dataclass
class BoostModel:
    features: list[str]
    params: Params
    trees: list[Tree]
    history: list[dict] = field(default_factory=list)
    best_round: int | None = None
    first_trees: int = 0      # trees of the model that the fit went on from

    def per_round(self) -> int:
        return max(1, self.params.num_class) * self.params.num_parallel_tree

    def base_margin(self) -> float:
        s, objective = self.params.base_score, self.params.objective
        if objective in LOGISTIC:
            return math.log(s / (1 - s))
        return math.log(s) if objective in LOG_LINK else s

    def node_table(self, spark) -> DataFrame:
        rows = []
        for t, tree in enumerate(self.trees):
            for i, n in sorted(tree.nodes.items()):
                if n.feature < 0:
                    rows.append((t, i, tree.cls, None, None, None, None, None, float(n.leaf * tree.weight), None, float(n.h)))
                else:
                    yes, no = 2 * i + 1, 2 * i + 2
                    rows.append((t, i, tree.cls, n.feature, n.threshold, yes, no, yes if n.missing_left else no,
                                 None, float(n.gain), float(n.h)))
        return spark.createDataFrame(rows, NODE_SCHEMA)

    def save(self, spark, path: str) -> None:
        """Trees, features and parameters; a custom objective has no stored form."""
        if callable(self.params.objective):
            raise ValueError("a model with a custom objective cannot be saved; save its node_table and set the objective again")
        about = json.dumps({"features": self.features, "params": asdict(self.params), "best_round": self.best_round, "history": self.history})
        self.node_table(spark).write.parquet(f"{path}/nodes")
        spark.createDataFrame([(about,)], "about string").write.parquet(f"{path}/about")

    @staticmethod
    def load(spark, path: str) -> BoostModel:
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        return BoostModel(about["features"], Params(**about["params"]), trees_from_table(spark.read.parquet(f"{path}/nodes")),
                          about["history"], about["best_round"])

    def best_trees(self) -> int:
        """Trees up to the best round of the watched table, or all."""
        return len(self.trees) if self.best_round is None else (self.best_round + 1) * self.per_round() + self.first_trees


    def margins(self, n_trees: int | None = None, base: Column | None = None) -> list[Column]:
        """One margin column per class from the first ``n_trees`` trees; null and NaN values go the missing way."""
        trees = self.trees if n_trees is None else self.trees[:n_trees]
        start = F.lit(self.base_margin()) if base is None else base
        classes = max(1, self.params.num_class)
        if sum(len(t.nodes) for t in trees) > CASE_NODES:
            sums = _walk(trees, classes)(F.array(*[F.col(f).cast("double") for f in self.features]))
            return [start + sums[c] for c in range(classes)]

        def test(n: Node) -> str:
            x = f"CAST(`{self.features[n.feature]}` AS DOUBLE)"
            return (f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN {str(n.missing_left).lower()} "
                    f"ELSE {x} < double('{float(n.threshold)!r}') END)")

        out = []
        for c in range(classes):
            terms = [_case(t, test) for t in trees if t.cls == c]
            out.append(sum(terms, start))
        return out

    def predict(self, df: DataFrame, n_trees: int | None = None, out: str = "pred", margin: bool = False,
                base: Column | None = None) -> DataFrame:
        """Adds the prediction: probability, mean, class (``multi:softmax``) or probabilities."""
        m = self.margins(n_trees, base)
        objective = self.params.objective
        if objective in MULTI:
            df = df.withColumn("_m", F.array(*m))
            cells = [F.col("_m")[c] for c in range(len(m))]
            if margin:
                value = F.col("_m")
            elif objective == "multi:softmax":
                value = F.array_position("_m", F.array_max("_m")).cast("int") - 1
            else:
                top = F.greatest(*cells)
                total = sum((F.exp(c - top) for c in cells), F.lit(0.0))
                value = F.array(*[F.exp(c - top) / total for c in cells])
            return df.withColumn(out, value).drop("_m")
        return df.withColumn(out, m[0] if margin else transform_margin(objective, m[0]))


def transform_margin(objective, margin: Column) -> Column:
    if objective in ("binary:logistic", "reg:logistic"):
        return sigmoid(margin)
    return F.exp(margin) if objective in LOG_LINK else margin


def trees_from_table(table: DataFrame) -> list[Tree]:
    """A model is a bounded table of nodes, read back on the driver."""
    trees: dict[int, Tree] = {}
    for r in table.collect():
        tree = trees.setdefault(r["tree"], Tree(cls=r["cls"]))
        node = Node(r["node"], 0.0, r["cover"] or 0.0)
        if r["feature"] is None:
            node.leaf = r["leaf"]
        else:
            node.feature, node.threshold, node.gain = r["feature"], r["threshold"], r["gain"] or 0.0
            node.missing_left = r["missing"] == r["yes"]
        tree.nodes[r["node"]] = node
    return [trees[t] for t in sorted(trees)]


def _case(tree: Tree, test: Callable[[Node], str]) -> Column:
    """Leaf value of a tree as one parsed CASE expression."""
    def walk(i: int) -> str:
        n = tree.nodes[i]
        if n.feature < 0:
            return f"double('{float(n.leaf * tree.weight)!r}')"
        return f"CASE WHEN {test(n)} THEN {walk(2 * i + 1)} ELSE {walk(2 * i + 2)} END"
    return F.expr(walk(0))


def _unit_case(tree: Tree, test: Callable[[Node], str]) -> Column:
    """Leaf value of a tree with weight 1."""
    return _case(replace(tree, weight=1.0), test)


def _walk(trees: list[Tree], classes: int):
    """Vectorised walk of many trees over Arrow batches."""
    packed = []
    for t in trees:
        size = max(t.nodes) + 1
        f, thr, miss, leaf = (np.full(size, -1), np.zeros(size), np.zeros(size, bool), np.zeros(size))
        for i, n in t.nodes.items():
            f[i], thr[i], miss[i], leaf[i] = n.feature, n.threshold, n.missing_left, n.leaf * t.weight
        packed.append((t.cls, f, thr, miss, leaf))

    @F.pandas_udf("array<double>")
    def apply(x: pd.Series) -> pd.Series:
        rows = np.array([[np.nan if v is None else v for v in r] for r in x], dtype="float64")
        out = np.zeros((len(rows), classes))
        at = np.arange(len(rows))
        for cls, f, thr, miss, leaf in packed:
            node = np.zeros(len(rows), "int64")
            while True:
                inner = f[node] >= 0
                if not inner.any():
                    break
                v = rows[at, np.where(inner, f[node], 0)]
                left = np.where(np.isnan(v), miss[node], v < thr[node])
                node = np.where(inner, 2 * node + np.where(left, 1, 2), node)
            out[:, cls] += leaf[node]
        return pd.Series(list(out))

    return apply


def bin_cuts(df: DataFrame, features: list[str], max_bins: int) -> list[list[float]]:
    """Cut points per feature: its minimum (parts present from missing) and approximate quantiles."""
    steps = F.array(*[F.lit(i / max_bins) for i in range(1, max_bins)])
    row = df.agg(*[F.min(F.col(f).cast("double")).alias(f"m{j}") for j, f in enumerate(features)],
                 *[F.percentile_approx(F.col(f).cast("double"), steps, F.lit(100 * max_bins)).alias(f"q{j}")
                   for j, f in enumerate(features)]).first()
    return [sorted({row[f"m{j}"], *row[f"q{j}"]}) if row[f"m{j}"] is not None else [0.0] for j in range(len(features))]


def bin_rows(df: DataFrame, features: list[str], cuts: list[list[float]]) -> Column:
    splits = [[-math.inf, *c, math.inf] for c in cuts]
    names = [f"_b{j}" for j in range(len(features))]
    ready = df.withColumns({f"_x{j}": F.col(f).cast("double") for j, f in enumerate(features)})
    tool = Bucketizer(splitsArray=splits, inputCols=[f"_x{j}" for j in range(len(features))], outputCols=names,
                      handleInvalid="keep")
    binned = tool.transform(ready)
    cells = [F.when(F.col(f"_x{j}").isNull() | F.isnan(f"_x{j}"), MISSING).otherwise(F.col(n)).cast("smallint")
             for j, n in enumerate(names)]
    return binned.withColumn("bins", F.array(*cells)).drop(*names, *[f"_x{j}" for j in range(len(features))])


def _bin_test(n: Node) -> str:
    b = f"bins[{n.feature}]"
    return f"(CASE WHEN {b} = {MISSING} THEN {str(n.missing_left).lower()} ELSE {b} < {n.bin} END)"


def _node_of(tree: Tree) -> Column:
    def walk(i: int) -> str:
        n = tree.nodes[i]
        if n.feature < 0:
            return str(i)
        return f"CASE WHEN {_bin_test(n)} THEN {walk(2 * i + 1)} ELSE {walk(2 * i + 2)} END"
    return F.expr(walk(0))


class NewtonBoost:
    """Fits a :class:`BoostModel`; parameters as in :class:`Params`."""

    def __init__(self, **params):
        self.p = Params(**params)
        if self.p.objective in MULTI and self.p.num_class < 2:
            raise ValueError("give num_class")

    def fit(self, df: DataFrame, key: str, features: list[str], label: str, weight: str | None = None,
            base_margin: str | None = None, model: BoostModel | None = None, group: str | None = None,
            watch: dict[str, DataFrame] | None = None, metric: Callable | dict[str, Callable] | str | list[str] | None = None,
            early_stop: int | None = None, maximize: bool | None = None, save_every: int = 0, save_path: str | None = None) -> BoostModel:
        """``watch`` tables get ``metric(df with label, pred, w and grp)`` after every round, or each of several
        metrics, given as functions by name or as names of ``ready_metric`` (history keys are then ``table-metric``); with ``early_stop`` the
        last one of the last table ends the fit after that many rounds without gain. Larger is better if ``maximize`` says so, and by
        default for auc, ndcg and map. ``BoostModel.best_trees`` counts the trees up to the best round."""
        p = self.p
        names = [metric] if isinstance(metric, str) else metric
        if isinstance(names, list):
            metric = {name: ready_metric(name) for name in names}
        if maximize is None:
            judge = names[-1] if isinstance(names, list) else "ndcg" if metric is None and p.objective == "rank:pairwise" else ""
            maximize = judge.partition("@")[0] in ("auc", "ndcg", "map")
        old = list(model.trees) if model else []
        self.model = BoostModel(features, p, old, first_trees=len(old))
        self.cuts = bin_cuts(df, features, p.max_bins)
        self.group = group
        self.table = self._prepare(df, key, label, weight, base_margin, features)
        watched = {name: self._prepare(t, key, label, weight, base_margin, features) for name, t in (watch or {}).items()}
        self.pending: list[Tree] = []
        best, best_at = None, 0
        for step in range(p.num_round):
            new = self._round(step + len(old))
            self.model.trees.extend(new)
            self.pending.extend(new)
            if p.dart:
                self.table = self._with_margins(self.table, new)
                watched = {name: self._with_margins(t, new) for name, t in watched.items()}
            if watched:
                named = metric if isinstance(metric, dict) else {"": metric}
                line = {f"{name}-{m}" if m else name: self._metric(t, f) for name, t in watched.items() for m, f in named.items()}
                self.model.history.append(line)
                value = list(line.values())[-1]
                if best is None or (value > best if maximize else value < best):
                    best, best_at = value, step
                self.model.best_round = best_at
                if early_stop and step - best_at >= early_stop:
                    break
            if save_every and (step + 1) % save_every == 0:
                self.model.save(df.sparkSession, f"{save_path}/round-{step + 1:04d}")
            if not p.dart and len(self.pending) >= p.cut_every * self.model.per_round():
                self.table = self._settle(self.table)
                watched = {name: self._settle(t) for name, t in watched.items()}
                self.pending = []
        return self.model

    def _prepare(self, df, key, label, weight, base_margin, features) -> DataFrame:
        p, classes = self.p, max(1, self.p.num_class)
        w = F.col(weight).cast("double") if weight else F.lit(1.0)
        if p.scale_pos_weight != 1.0:
            w = w * F.when(F.col(label) == 1, p.scale_pos_weight).otherwise(1.0)
        base = F.col(base_margin).cast("double") if base_margin else F.lit(self.model.base_margin())
        if p.dart:
            start = [base] * classes
        else:
            start = self.model.margins(base=base)
        group = [F.col(self.group).alias("grp")] if self.group else []
        ready = df.withColumns({"_w": w, "_start": F.array(*start)})
        # with dropped trees every tree's own margin is kept, without its changing weight
        own = []
        if p.dart:
            own = [F.array(*[c for t in self.model.trees for c in [_unit_case(t, self._value_test)]]).cast("array<double>").alias("t")]
        return cut(bin_rows(ready, features, self.cuts).select(
            F.col(key).alias("key"), F.col(label).cast("double").alias("y"), F.col("_w").alias("w"),
            F.col("_start").alias("m"), "bins", *own, *group))

    def _value_test(self, n: Node) -> str:
        x = f"CAST(`{self.model.features[n.feature]}` AS DOUBLE)"
        return f"(CASE WHEN {x} IS NULL OR isnan({x}) THEN {str(n.missing_left).lower()} ELSE {x} < double('{float(n.threshold)!r}') END)"

    def _with_margins(self, table: DataFrame, new: list[Tree]) -> DataFrame:
        """The table with the margins of the new trees behind those of the others; the plan does not grow with the rounds."""
        return cut(table.withColumn("t", F.concat("t", F.array(*[_unit_case(t, _bin_test) for t in new]))))

    def _margins(self, dropped: set[int] = frozenset()) -> list[Column]:
        """Stored margins plus the trees since the last cut; for dart, plus the weighted margins of all trees that are not dropped."""
        trees, out = self.pending, []
        if self.p.dart:
            for c in range(max(1, self.p.num_class)):
                weights = [t.weight if t.cls == c and i not in dropped else 0.0 for i, t in enumerate(self.model.trees)]
                terms = F.zip_with("t", double_array(weights), lambda x, w: x * w) if weights else None
                out.append(F.col("m")[c] if terms is None else F.col("m")[c] + F.aggregate(terms, F.lit(0.0), lambda s, x: s + x))
            return out
        for c in range(max(1, self.p.num_class)):
            terms = [_case(t, _bin_test) for i, t in enumerate(trees) if t.cls == c and i not in dropped]
            out.append(sum(terms, F.col("m")[c]))
        return out

    def _settle(self, table: DataFrame) -> DataFrame:
        return cut(table.withColumn("m", F.array(*self._margins())))

    def _metric(self, table: DataFrame, metric: Callable | None) -> float:
        m = self._margins()
        if self.p.objective in MULTI:
            rows = table.withColumn("_m", F.array(*m)).withColumn(
                "pred", (F.array_position("_m", F.array_max("_m")) - 1).cast("double"))
        else:
            rows = table.withColumn("pred", transform_margin(self.p.objective, m[0]))
        rows = rows.select(F.col("y").alias("label"), "pred", "w", *(["grp"] if self.group else []))
        return (metric or default_metric(self.p.objective))(rows)

    def _drops(self, step: int, rng: np.random.Generator) -> set[int]:
        p, n = self.p, len(self.model.trees)
        if not p.dart or not n or rng.random() < p.skip_drop:
            return set()
        share = np.full(n, p.rate_drop)
        if p.sample_type == "weighted":
            weights = np.array([t.weight for t in self.model.trees])
            share = np.minimum(1.0, p.rate_drop * n * weights / weights.sum())
        dropped = set(np.flatnonzero(rng.random(n) < share).tolist())
        if p.one_drop and not dropped:
            dropped = {int(rng.integers(n))}
        return dropped

    def _round(self, step: int) -> list[Tree]:
        p = self.p
        rng = np.random.default_rng([p.seed, step])
        dropped = self._drops(step, rng)
        margins = self._margins(dropped)
        y = F.col("y")
        table = self.table
        if p.objective in MULTI:
            pairs = softmax_gradients(margins, y)
        elif p.objective == "rank:pairwise":
            table = cut(pairwise_gradients(table.withColumn("mm", margins[0]), "grp", "y", "mm"))
            pairs = [(F.col("g"), F.col("h"))]
        else:
            pairs = [gradients(p.objective, margins[0], y, p.tweedie_variance_power, p.delta_limit or 0.7)]
        gh = {f"g{c}": F.col("w") * g for c, (g, _) in enumerate(pairs)}
        gh.update({f"h{c}": F.col("w") * h for c, (_, h) in enumerate(pairs)})
        table = table.withColumns(gh)
        slots = [Tree(cls=c) for c in range(len(pairs)) for _ in range(p.num_parallel_tree)]
        self._grow(table, slots, step)
        scale, k = p.eta / p.num_parallel_tree, len(dropped)
        for tree in slots:
            self._prune(tree)
            for n in tree.nodes.values():
                if n.feature < 0:
                    n.leaf = self._weight(n.g, n.h) * scale
            if k:
                bottom = k + p.eta if p.normalize_type == "tree" else 1 + p.eta
                tree.weight = 1 / bottom
        if k:
            down = k / (k + p.eta) if p.normalize_type == "tree" else 1 / (1 + p.eta)
            for i in dropped:
                self.model.trees[i].weight *= down
        return slots

    def _grow(self, table: DataFrame, slots: list[Tree], step: int) -> None:
        p = self.p
        sampled = []
        for s in range(len(slots)):
            sampled.append(uniform("key", F.lit(p.seed * 7919 + step * 104729 + s)) < p.subsample
                           if p.subsample < 1 else F.lit(True))
        active = {(s, 0) for s in range(len(slots))}
        for tree in slots:
            tree.nodes[0] = Node(0, 0.0, 0.0)
        for level in range(p.max_depth):
            if not active:
                break
            if level > INLINE_DEPTH:
                table = cut(table.withColumns({f"n{s}": self._place(t, s, table) for s, t in enumerate(slots)}))
            cells = []
            for s, tree in enumerate(slots):
                live = [i for t, i in active if t == s]
                if live:
                    node = self._place(tree, s, table)
                    cells.append(F.when(sampled[s] & node.isin(live), F.struct(
                        F.lit(s).alias("s"), node.alias("node"), F.col(f"g{tree.cls}").alias("g"),
                        F.col(f"h{tree.cls}").alias("h"))))
            rows = table.select("bins", F.array_compact(F.array(*cells)).alias("c")).where(F.size("c") > 0)
            parts = rows.mapInArrow(_histograms(max(len(c) for c in self.cuts) + 3), "s int, node int, f int, b int, g double, h double")
            hist = parts.groupBy("s", "node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            hist = self._chosen_features(hist, step, level)
            active = self._split(hist, slots)

    def _place(self, tree: Tree, s: int, table: DataFrame) -> Column:
        """Node of a row; below INLINE_DEPTH it continues from the stored node."""
        column = f"n{s}"
        if column not in table.columns:
            return _node_of(tree)
        at = F.col(column)
        moved = at
        for i, n in tree.nodes.items():
            if n.feature >= 0 and 2 * i + 1 in tree.nodes and i >= 2 ** INLINE_DEPTH - 1:
                moved = F.when(at == i, F.when(F.expr(_bin_test(n)), F.lit(2 * i + 1)).otherwise(2 * i + 2)).otherwise(moved)
        return moved

    def _chosen_features(self, hist: DataFrame, step: int, level: int) -> DataFrame:
        """The features that a tree, a level of it and a node may use: the first shares of them in orders that hashes give."""
        p, kept = self.p, len(self.model.features)
        for rate, place in ((p.colsample_bytree, [F.lit(0)]), (p.colsample_bylevel, [F.lit(level + 1)]), (p.colsample_bynode, [F.lit(-1 - level), F.col("node")])):
            if rate >= 1:
                continue
            kept = max(1, int(round(kept * rate)))
            order = F.xxhash64(F.lit(p.seed), F.lit(step), "s", *place, "f")
            # a node has a row for each feature and bin, whatever the number of rows
            hist = hist.withColumn("_k", F.dense_rank().over(W.partitionBy("s", "node").orderBy(order, "f"))).where(F.col("_k") <= kept).drop("_k")
        return hist

    def _score(self, g: str, h: str) -> str:
        """Twice the loss that the best weight of a node takes away."""
        p = self.p
        t = f"greatest(abs({g}) - {p.reg_alpha}D, 0D)" if p.reg_alpha else g
        if not p.delta_limit:
            return f"({t}) * ({t}) / ({h} + {p.reg_lambda}D)"
        m = p.delta_limit
        w = f"greatest(least(-sign({g}) * abs({t}) / ({h} + {p.reg_lambda}D), {m}D), -{m}D)"
        return f"-2 * ({g} * {w} + 0.5D * ({h} + {p.reg_lambda}D) * {w} * {w} + {p.reg_alpha}D * abs({w}))"

    def _weight(self, g: float, h: float) -> float:
        p = self.p
        if h < p.min_child_weight or h + p.reg_lambda <= 0:
            return 0.0
        w = -math.copysign(max(abs(g) - p.reg_alpha, 0.0), g) / (h + p.reg_lambda)
        return max(-p.delta_limit, min(p.delta_limit, w)) if p.delta_limit else w

    def _split(self, hist: DataFrame, slots: list[Tree]) -> set[tuple[int, int]]:
        """Best split per node from prefix sums over at most max_bins + 2 bins, and the new nodes."""
        whole, ahead = "OVER (PARTITION BY s, node, f)", ("OVER (PARTITION BY s, node, f ORDER BY b ROWS BETWEEN UNBOUNDED "
                                                          "PRECEDING AND 1 PRECEDING)")
        sums = hist.selectExpr(
            "s", "node", "f", "b", f"sum(g) {whole} AS G", f"sum(h) {whole} AS H",
            f"coalesce(sum(CASE WHEN b < 0 THEN g END) {whole}, 0D) AS gm", f"coalesce(sum(CASE WHEN b < 0 THEN h END) {whole}, 0D) AS hm",
            f"coalesce(sum(CASE WHEN b >= 0 THEN g END) {ahead}, 0D) AS gl", f"coalesce(sum(CASE WHEN b >= 0 THEN h END) {ahead}, 0D) AS hl")
        # every place is tried with the missing rows on the left and on the right
        options = sums.where("b >= 0").selectExpr(
            "s", "node", "f", "b", "G", "H", "inline(array(struct(true AS left, gl + gm AS a, hl + hm AS c), struct(false AS left, gl AS a, hl AS c)))")
        fits = "c > 0 AND H - c > 0 AND c >= {0}D AND H - c >= {0}D".format(float(self.p.min_child_weight))
        gain = f"{self._score('a', 'c')} + {self._score('(G - a)', '(H - c)')} - {self._score('G', 'H')}"
        best = options.groupBy("s", "node").agg(F.expr("max(G)").alias("G"), F.expr("max(H)").alias("H"), F.expr(
            f"max(struct(CAST(CASE WHEN {fits} THEN {gain} ELSE -1D END AS FLOAT) AS key, -f AS nf, -b AS nb, left, a AS gl, c AS hl, "
            f"CASE WHEN {fits} THEN {gain} ELSE -1D END AS gain))").alias("best"))
        # gains that differ in the order of summation only are ties, so a fit does not depend on how rows are dealt
        active = set()
        for r in best.collect():
            tree, i, b = slots[r["s"]], r["node"], r["best"]
            node = tree.nodes[i]
            if i == 0:
                node.g, node.h = r["G"], r["H"]
            if b["gain"] <= 1e-6:
                continue
            f, at = -b["nf"], -b["nb"]
            node.feature, node.bin, node.gain, node.missing_left = f, at, b["gain"], b["left"]
            node.threshold = self.cuts[f][at - 1] if at > 0 else -math.inf
            tree.nodes[2 * i + 1] = Node(2 * i + 1, b["gl"], b["hl"])
            tree.nodes[2 * i + 2] = Node(2 * i + 2, node.g - b["gl"], node.h - b["hl"])
            active |= {(r["s"], 2 * i + 1), (r["s"], 2 * i + 2)}
        return active

    def _prune(self, tree: Tree) -> None:
        for i in sorted(tree.nodes, reverse=True):
            n = tree.nodes[i]
            if n.feature >= 0 and tree.is_leaf(2 * i + 1) and tree.is_leaf(2 * i + 2) and n.gain < self.p.gamma:
                n.feature = -1
                del tree.nodes[2 * i + 1], tree.nodes[2 * i + 2]


def _histograms(width: int, cells: int = 1 << 22):
    """Gradient sums of a partition by (slot, node, feature, bin): what leaves a task does not depend on its number of rows.

    The sums of ``cells`` bins are held at most; with more nodes than that a task sends on several partial histograms.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[int, int] = {}
        held = np.zeros((3, 0, 0, width))

        def sums() -> pa.RecordBatch:
            node, f, b = np.nonzero(held[2])
            code = np.array(list(index), np.int64)[node]
            return pa.RecordBatch.from_arrays([
                pa.array(code >> 32, pa.int32()), pa.array(code & 0xFFFFFFFF, pa.int32()), pa.array(f, pa.int32()), pa.array(b - 1, pa.int32()),
                pa.array(held[0][node, f, b]), pa.array(held[1][node, f, b])], ["s", "node", "f", "b", "g", "h"])

        for batch in batches:
            if not batch.num_rows:
                continue
            bins = batch.column("bins").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, -1) + 1
            d = bins.shape[1]
            row = np.repeat(np.arange(batch.num_rows), batch.column("c").value_lengths().to_numpy())
            s, node, g, h = (x.to_numpy() for x in batch.column("c").flatten().flatten())
            codes, at = np.unique(s.astype(np.int64) << 32 | node.astype(np.int64), return_inverse=True)
            if len(index) * d * width > cells:
                yield sums()
                index, held = {}, np.zeros((3, 0, d, width))
            for c in codes.tolist():
                index.setdefault(c, len(index))
            n = len(index)
            if held.shape[1] < n:
                held = np.concatenate([held.reshape(3, -1, d, width), np.zeros((3, n - held.shape[1], d, width))], axis=1)
            base = np.array([index[c] for c in codes.tolist()], np.int64)[at] * width
            for f in range(d):
                place = base + bins[row, f]
                for k, values in enumerate((g, h, None)):
                    held[k, :, f] += np.bincount(place, values, n * width).reshape(n, width)
        if index:
            yield sums()

    return task


def ready_metric(name: str) -> Callable[[DataFrame], float]:
    """A watched metric by name: ``rmse``, ``mae``, ``logloss``, ``error`` or ``error@t``, ``merror``, ``auc``, and, by group, ``ndcg`` or ``ndcg@n``,
    ``map`` or ``map@n``. Rows come with ``label, pred, w`` and, for the last two, ``grp``."""
    from millrace.operators import metrics

    kind, _, at = name.partition("@")
    label, pred, w = F.col("label"), F.col("pred"), F.col("w")
    mean = lambda x: lambda df: df.agg(F.sum(x * w) / F.sum(w)).first()[0]
    if kind == "rmse":
        return lambda df: math.sqrt(mean((pred - label) ** 2)(df))
    if kind == "mae":
        return mean(F.abs(pred - label))
    if kind == "logloss":
        return mean(metrics.log_loss_terms("logloss", "label", "pred"))
    if kind == "error":
        return mean(((pred > float(at or 0.5)).cast("int") != label).cast("double"))
    if kind == "merror":
        return mean((pred != label).cast("double"))
    if kind == "auc":
        return lambda df: metrics.auc_rank(df, "label", "pred").first()["auc"]
    if kind in ("ndcg", "map"):
        n = int(at) if at else None

        def by_group(df: DataFrame) -> float:
            # equal scores are ranked by a hash, the same in every round
            rows = df.withColumn("_id", F.xxhash64("grp", "label", "pred"))
            return (metrics.ndcg_at if kind == "ndcg" else metrics.map_at)(rows, "grp", "label", "pred", "_id", n).agg(F.avg("ndcg" if kind == "ndcg" else "ap")).first()[0]
        return by_group
    raise ValueError(f"unknown metric {name}")


def default_metric(objective) -> Callable[[DataFrame], float]:
    if objective in ("binary:logistic", "reg:logistic", "binary:logitraw"):
        cutoff = 0.0 if objective == "binary:logitraw" else 0.5
        return lambda df: df.agg(F.avg(((F.col("pred") > cutoff).cast("int") != F.col("label")).cast("double"))).first()[0]
    if objective in MULTI:
        return lambda df: df.agg(F.avg((F.col("pred") != F.col("label")).cast("double"))).first()[0]
    if objective == "rank:pairwise":
        return ready_metric("ndcg")
    return lambda df: df.agg(F.sqrt(F.avg((F.col("pred") - F.col("label")) ** 2))).first()[0]


def boosted_random_forest(num_trees: int = 100, **params) -> NewtonBoost:
    """Forest mode: all trees in one round, eta 1, rows 0.9 and node features 0.2 by default."""
    return NewtonBoost(**{"eta": 1.0, "subsample": 0.9, "colsample_bynode": 0.2, **params,
                          "num_round": 1, "num_parallel_tree": num_trees})


def dart_boost(**params) -> NewtonBoost:
    return NewtonBoost(**{**params, "dart": True})


def dump_trees(model: BoostModel, spark, names: DataFrame | None = None) -> DataFrame:
    """One text row per node, indented by depth; ``names (feature, name)`` is optional."""
    table = model.node_table(spark)
    label = F.concat(F.lit("f"), F.col("feature").cast("string"))
    if names is not None:
        table = table.join(names, "feature", "left")
        label = F.coalesce(F.col("name"), label)
    depth = F.floor(F.log2(F.col("node") + 1)).cast("int")
    text = F.when(F.col("feature").isNull(), F.format_string("%d:leaf=%.6f", "node", "leaf")).otherwise(
        F.format_string("%d:[%s<%.6f] yes=%d,no=%d,missing=%d", F.col("node"), label, "threshold", "yes", "no", "missing"))
    return table.select("tree", "node", F.concat(F.repeat(F.lit("\t"), depth), text).alias("line"))


def feature_importance(nodes: DataFrame) -> DataFrame:
    """Number of splits per feature in a node table."""
    return nodes.where("feature is not null").groupBy("feature").agg(F.count(F.lit(1)).alias("splits"))


def continue_params(params: Params, num_round: int) -> dict:
    return {k: getattr(replace(params, num_round=num_round), k) for k in params.__dataclass_fields__}


class LinearBooster:
    """Elastic-net linear booster: a round moves every weight once by its shrunken Newton step.

    Gradient sums of all features come from one aggregate. Steps are taken together, so
    each is divided by the number of features.
    """

    def __init__(self, objective: str = "binary:logistic", num_round: int = 20, eta: float = 0.5, reg_lambda: float = 0.0,
                 reg_alpha: float = 0.0, lambda_bias: float = 0.0, base_score: float = 0.5):
        self.objective, self.num_round, self.eta = objective, num_round, eta
        self.reg_lambda, self.reg_alpha, self.lambda_bias, self.base_score = reg_lambda, reg_alpha, lambda_bias, base_score

    def margin(self, features: list[str]) -> Column:
        terms = [F.col(f).cast("double") * F.lit(w) for f, w in zip(features, self.weights)]
        return sum(terms, F.lit(self.start + self.bias))

    def fit(self, df: DataFrame, features: list[str], label: str) -> LinearBooster:
        s = self.base_score
        self.start = math.log(s / (1 - s)) if self.objective in LOGISTIC else s
        self.weights, self.bias = [0.0] * len(features), 0.0
        df = df.select(*features, F.col(label).cast("double").alias("_y")).persist()
        try:
            n = df.count()
            for _ in range(self.num_round):
                g, h = gradients(self.objective, self.margin(features), F.col("_y"))
                rows = df.withColumns({"_g": g, "_h": h})
                sums = rows.agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"), *[
                    e for j, f in enumerate(features) for e in (
                        F.sum(F.col("_g") * F.col(f)).alias(f"g{j}"),
                        F.sum(F.col("_h") * F.col(f) * F.col(f)).alias(f"h{j}"))]).first()
                self.bias -= self.eta * (sums["g"] + self.lambda_bias * n * self.bias) / (sums["h"] + self.lambda_bias * n)
                for j in range(len(features)):
                    self.weights[j] += self.eta / len(features) * self._step(self.weights[j], sums[f"g{j}"], sums[f"h{j}"], n)
            return self
        finally:
            df.unpersist()

    def _step(self, w: float, g: float, h: float, n: int) -> float:
        lam, alpha = self.reg_lambda * n, self.reg_alpha * n
        g, h = g + lam * w, h + lam
        if h < 1e-12:
            return 0.0
        if w - g / h >= 0:
            return max(-(g + alpha) / h, -w)
        return min(-(g - alpha) / h, -w)
