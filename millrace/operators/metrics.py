"""Classification, regression and ranking metrics as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.quantiles import ordered_rank, previous_rows, running_sums
from millrace.operators.windows import topn_per_group


def binary_confusion(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.groupBy(*(by or [])).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))


def classification_scores(df: DataFrame, label: str, score: str, threshold: float = 0.5, beta: float = 1.0,
                          by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall (= TPR), FPR, error and F-beta; positive is ``score > threshold``."""
    hard = df.withColumn("_p", (F.col(score) > threshold).cast("int"))
    c = binary_confusion(hard, label, "_p", by)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    n, b2 = tp + fp + tn + fn, beta * beta

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return c.select(*(by or []), ratio(tp + tn, n).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
                    ratio(tp, tp + fn).alias("recall"), ratio(tp, tp + fn).alias("tpr"),
                    ratio(fp, fp + tn).alias("fpr"), ratio(fp + fn, n).alias("error"),
                    ratio((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias("f_beta"))


def multiclass_confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))


def merror(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.agg((F.count_if(F.col(label) != F.col(pred)) / F.count(F.lit(1))).alias("merror"))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    y = (F.col(label) == 1).cast("bigint")
    return df.select(F.col(score).cast("double").alias("score"), y.alias("pos"), (1 - y).alias("neg"))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, fpr, tpr) at each distinct score, from the highest down; ties make one point."""
    counts = score_counts(df, label, score)
    total = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    run = running_sums(counts, "score", ["pos", "neg"], descending=True)
    return run.select("score", F.try_divide(F.col("cum_neg"), F.lit(float(total["n"]))).alias("fpr"),
                      F.try_divide(F.col("cum_pos"), F.lit(float(total["p"]))).alias("tpr"))


def auc_polygon(points: DataFrame, x: str = "fpr", y: str = "tpr", by: list[str] | None = None) -> DataFrame:
    """Trapezoid area under the given corner points, closed by (0,0) and (1,1); points of any number, in any order.

    Equal points make one corner. Points are put in order by ranges, and each partition knows the point before it, so no task
    holds them all.
    """
    by = by or []
    corners = points.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).distinct()
    steps = previous_rows(corners, by, ["x", "y"], ["x", "y"])
    px, py = F.coalesce("prev_x", F.lit(0.0)), F.coalesce("prev_y", F.lit(0.0))
    area = F.sum((F.col("x") - px) * (F.col("y") + py) / 2)
    last = (1 - F.max("x")) * (1 + F.max("y")) / 2
    return steps.groupBy(*by).agg((area + last).alias("auc"))


def auc_hard(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Area of the polygon of hard labels: ``(1 + tpr - fpr) / 2``."""
    c = binary_confusion(df, label, pred)
    tpr = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    fpr = F.try_divide(F.col("fp"), F.col("fp") + F.col("tn"))
    return auc_polygon(c.select(fpr.alias("fpr"), tpr.alias("tpr")))


def auc_rank(df: DataFrame, label: str, score: str) -> DataFrame:
    """Probability that a positive outranks a negative, ties half; null if one class is missing."""
    run = running_sums(score_counts(df, label, score), "score", ["pos", "neg"])
    below = F.col("cum_neg") - F.col("neg") / 2
    return run.agg(F.try_divide(F.sum(F.col("pos") * below), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))


def log_loss_terms(kind: str, label: str, pred: str, rho: float = 1.5) -> Column:
    """Per-row loss. ``pred`` is the predicted mean (probability for logloss)."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    if kind == "logloss":
        q = F.greatest(F.least(p, F.lit(1 - 1e-16)), F.lit(1e-16))
        return -(y * F.log(q) + (1 - y) * F.log(F.greatest(1 - q, F.lit(1e-16))))
    if kind == "poisson-nloglik":
        return p - y * F.log(p) + log_gamma(y + 1)
    if kind == "gamma-nloglik":
        return y / p + F.log(p)
    if kind == "gamma-deviance":
        return 2 * (F.log(p / y) + y / p - 1)
    if kind == "tweedie-nloglik":
        return -y * F.pow(p, F.lit(1 - rho)) / (1 - rho) + F.pow(p, F.lit(2 - rho)) / (2 - rho)
    raise ValueError(kind)


def log_gamma(x: Column) -> Column:
    """Stirling series after moving the argument up by 8 with the recurrence."""
    z = x + 8
    series = ((z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z)
              + 1 / (1260 * z * z * z * z * z))
    shift = F.lit(0.0)
    for i in range(8):
        shift = shift + F.log(x + i)
    return series - shift


def log_losses(df: DataFrame, label: str, preds: dict[str, str], rho: float = 1.5) -> DataFrame:
    """Mean of each wanted loss: ``{kind: prediction column}``."""
    return df.agg(*[F.avg(log_loss_terms(k, label, p, rho)).alias(k.replace("-", "_")) for k, p in preds.items()])


def mlogloss(df: DataFrame, label: str, probs: str) -> DataFrame:
    """``probs`` is the array of class probabilities, ``label`` its 0-based index."""
    p = F.element_at(F.col(probs), F.col(label).cast("int") + 1)
    return df.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-16)))).alias("mlogloss"))


def regression_scores(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    sse = F.sum((y - p) * (y - p))
    return df.agg(F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"), F.avg(F.abs(y - p)).alias("mae"),
                  F.avg((y - p) * (y - p)).alias("mse"),
                  (1 - F.try_divide(sse, F.var_pop(y) * F.count(y))).alias("r2"))


def _ranked(df: DataFrame, group: str, score: str, tie: str, n: int | None) -> DataFrame:
    if n:
        return topn_per_group(df, [group], [F.desc(score), F.asc(tie)], n)
    return ordered_rank(df, [group], score, tie, descending=True)


def ndcg_at(df: DataFrame, group: str, label: str, score: str, tie: str, n: int | None = None,
            empty: float = 1.0) -> DataFrame:
    """Per-group NDCG with gain ``2^rel - 1``; a list without positives scores ``empty``."""
    gain = (F.pow(F.lit(2.0), F.col(label)) - 1) / F.log2(F.col("rank") + 1)
    got = _ranked(df, group, score, tie, n).groupBy(group).agg(F.sum(gain).alias("dcg"))
    best = _ranked(df, group, label, tie, n).groupBy(group).agg(F.sum(gain).alias("idcg"))
    return got.join(best, group).select(
        group, F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(F.lit(empty)).alias("ndcg"))


def map_at(df: DataFrame, group: str, label: str, score: str, tie: str, n: int | None = None,
           empty: float = 1.0) -> DataFrame:
    """Per-group average precision over the positives in the first n places."""
    hits = _ranked(df, group, score, tie, n).where(F.col(label) > 0).select(group, "rank")
    if n:
        nth = hits.withColumn("_h", F.row_number().over(W.partitionBy(group).orderBy("rank")))
    else:
        nth = ordered_rank(hits, [group], "rank", "rank", out="_h")
    ap = nth.groupBy(group).agg(F.avg(F.col("_h") / F.col("rank")).alias("ap"))
    return df.select(group).distinct().join(ap, group, "left").select(
        group, F.coalesce("ap", F.lit(empty)).alias("ap"))


def mrr(df: DataFrame, group: str, label: str, score: str, tie: str) -> DataFrame:
    """Mean over groups of 1 / rank of the first positive (0 without one).

    The rank of the first positive is one plus the rows ordered before it, so no
    group is sorted: best positive per group, then a count.
    """
    way = F.struct((-F.col(score)).alias("s"), F.col(tie).alias("t"))
    first = df.groupBy(group).agg(F.min(F.when(F.col(label) > 0, way)).alias("_first"))
    ahead = df.join(first, group).groupBy(group).agg(
        F.max(F.col("_first").isNotNull()).alias("_any"), F.count_if(way < F.col("_first")).alias("_ahead"))
    return ahead.agg(F.avg(F.when(F.col("_any"), 1 / (F.col("_ahead") + 1)).otherwise(0.0)).alias("mrr"))
