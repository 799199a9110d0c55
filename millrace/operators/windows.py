"""Ranking and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def sort_limit(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def topn_per_group(df: DataFrame, by: list[str], order: list, n: int, rank: str = "rank") -> DataFrame:
    """First n rows per group in a total order.

    The filter on ``row_number`` lets Spark keep n rows per group in every map task
    before the shuffle, so a hot group is cut down where it is read.
    """
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def topn_per_user(scores: DataFrame, n: int, user: str = "u", item: str = "i", score: str = "score") -> DataFrame:
    return topn_per_group(scores, [user], [F.desc(score), F.asc(item)], n)


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Stack both parts; columns missing in one of them (the label) become null."""
    return train.unionByName(test, allowMissingColumns=True)


def split_by_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull()).drop(label)


def intersect_items(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    return a.select(*cols).intersect(b.select(*cols))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()
