"""Splits, cross-validation and parameter search."""

from __future__ import annotations

import itertools
import statistics
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import HASH_PRIME, key_hash, seeded_hash
from millrace.operators.quantiles import ordered_rank

FitScore = Callable[[DataFrame, DataFrame], float]


def holdout_split(df: DataFrame, key: str, test_share: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test part by key hash; the same rows on every run and cluster."""
    bar = int(round(test_share * HASH_PRIME))
    return df.where(key_hash(key, seed) >= bar), df.where(key_hash(key, seed) < bar)


def check_disjoint(train: DataFrame, test: DataFrame, key: str) -> None:
    if not train.join(test.select(key), key, "left_semi").isEmpty():
        raise ValueError("train and test share keys")


def with_fold(df: DataFrame, key: str, folds: int, seed: int = 0, out: str = "fold") -> DataFrame:
    return df.withColumn(out, (key_hash(key, seed) % folds).cast("int"))


def fold_extract(df: DataFrame, key: str, k: int, folds: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test part where fold ``k`` is the test part."""
    placed = with_fold(df, key, folds, seed, "_fold")
    return placed.where(F.col("_fold") != k).drop("_fold"), placed.where(F.col("_fold") == k).drop("_fold")


def kfold_assign(df: DataFrame, key: str, folds: int, shuffle: bool = True, seed: int = 0) -> DataFrame:
    """Folds of equal size: rows in hash order (or key order) cut into ``folds`` runs like ntile."""
    n = df.count()
    if shuffle:
        ranked = ordered_rank(df.withColumn("_o", key_hash(key, seed)), [], "_o", key, out="_r").drop("_o")
    else:
        ranked = ordered_rank(df, [], key, key, out="_r")
    size, extra = divmod(n, folds)
    long = extra * (size + 1)
    r = F.col("_r") - 1
    fold = F.when(r < long, F.floor(r / (size + 1))).otherwise(
        F.lit(extra) + F.floor((r - long) / max(size, 1)))
    return ranked.withColumn("fold", fold.cast("int")).drop("_r")


def stratified_kfold(df: DataFrame, key: str, label: str, folds: int, repeats: int = 1, seed: int = 0) -> DataFrame:
    """``repeat`` and ``fold`` columns; every fold has the class shares of the table."""
    many = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    ranked = ordered_rank(many.withColumn("_o", seeded_hash(key, F.col("repeat") + seed)), [label, "repeat"], "_o", key, out="_r")
    return ranked.withColumn("fold", ((F.col("_r") - 1) % folds).cast("int")).drop("_o", "_r")


def cross_val_scores(df: DataFrame, key: str, folds: int, fit_score: FitScore, seed: int = 0,
                     preprocess: Callable | None = None, parallel: int = 4) -> dict:
    """Score per fold, mean and population deviation.

    ``preprocess(train, test)`` may change both tables of a fold before the fit; ``parallel`` folds run at a time.
    """
    def one(k: int) -> float:
        train, test = fold_extract(df, key, k, folds, seed)
        if preprocess:
            train, test = preprocess(train, test)
        return float(fit_score(train, test))

    with ThreadPoolExecutor(min(parallel, folds)) as pool:
        scores = list(pool.map(one, range(folds)))
    return {"scores": scores, "mean": statistics.fmean(scores), "std": statistics.pstdev(scores)}


def two_fold_swap(df: DataFrame, key: str, fit_score: FitScore, seed: int = 0) -> dict:
    return cross_val_scores(df, key, 2, fit_score, seed)


def cv_with_preprocess(df: DataFrame, key: str, folds: int, preprocess: Callable, fit_score: FitScore) -> dict:
    return cross_val_scores(df, key, folds, fit_score, preprocess=preprocess)


def grid_search(df: DataFrame, key: str, grid: dict[str, list], folds: int,
                fit_score: Callable[[DataFrame, DataFrame, dict], float], maximize: bool = True, parallel: int = 4) -> list[dict]:
    """All combinations, best first, with mean and deviation over the folds; ``parallel`` combinations run at a time."""
    def one(values: tuple) -> dict:
        params = dict(zip(grid, values))
        found = cross_val_scores(df, key, folds, lambda a, b: fit_score(a, b, params), parallel=1)
        return {"params": params, "mean": found["mean"], "std": found["std"]}

    with ThreadPoolExecutor(parallel) as pool:
        rows = list(pool.map(one, itertools.product(*grid.values())))
    return sorted(rows, key=lambda r: -r["mean"] if maximize else r["mean"])


def sweep_one_parameter(df: DataFrame, key: str, name: str, values: list, folds: int, fit_score: Callable) -> list[dict]:
    """Validation curve: mean score in the order of the values."""
    found = grid_search(df, key, {name: values}, folds, fit_score)
    place = {v: i for i, v in enumerate(values)}
    return sorted(found, key=lambda r: place[r["params"][name]])


def learning_curve(df: DataFrame, key: str, shares: list[float], fit_score: FitScore, test_share: float = 0.25,
                   seed: int = 0) -> list[dict]:
    """Train and test score against nested shares of the train part, whose hash is independent of the split's."""
    train, test = holdout_split(df, key, test_share, seed)
    out = []
    for share in shares:
        part = train.where(key_hash(key, seed + 1) < int(round(share * HASH_PRIME)))
        out.append({"share": share, "rows": part.count(), "train": float(fit_score(part, part)), "test": float(fit_score(part, test))})
    return out


def ml_grid_search(pipeline, grid: list, evaluator, df: DataFrame, fold_col: str, folds: int, parallelism: int = 4):
    """Search over a pyspark.ml pipeline with given folds."""
    from pyspark.ml.tuning import CrossValidator
    return CrossValidator(estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
                          foldCol=fold_col, parallelism=parallelism).fit(df)
