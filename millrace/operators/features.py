"""Feature operators that need more than one column expression."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import flag_member
from millrace.operators.quantiles import positions
from millrace.session import small

MAX_CATEGORIES = 5_000  # a category becomes a column, and a plan cannot hold more


def project_rename(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Choose, reorder and rename columns: ``{old: new}``."""
    return df.select(*[F.col(old).alias(new) for old, new in cols.items()])


def filter_predicate(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.where(condition)


def one_hot(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every category of each column becomes a 0/1 column ``col_value``; null gives zeros."""
    generated = []
    for c in cols:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(rows) > MAX_CATEGORIES:
            raise ValueError(f"{c} has over {MAX_CATEGORIES} categories; use indicator_encode")
        for (value,) in sorted(map(tuple, rows)):
            generated.append(F.when(F.col(c) == F.lit(value), 1).otherwise(0).alias(f"{c}_{value}"))
    return df.select("*", *generated)


def indicator_encode(df: DataFrame, key: str, attributes: list[str], dictionary: DataFrame) -> DataFrame:
    """Sparse indicators ``(key, feature_id, val)`` from a dictionary ``(attr, value, feature_id)``.

    A value that is not in the dictionary is an error, raised while the job runs.
    """
    long = df.select(key, *[F.col(a).cast("string").alias(a) for a in attributes]).unpivot(
        key, attributes, "attr", "value")
    hit = long.join(small(dictionary), ["attr", "value"], "left")
    message = F.concat(F.lit("unknown value "), F.col("attr"), F.lit("="), F.col("value"))
    checked = F.when(F.col("feature_id").isNull(), F.raise_error(message).cast("int")).otherwise(F.col("feature_id"))
    return hit.where("value is not null").select(key, checked.alias("feature_id"), F.lit(1.0).alias("val"))


def feature_dictionary(df: DataFrame, attributes: list[str]) -> DataFrame:
    """Dictionary ``(attr, value, feature_id)``: ids follow attribute order, then value order."""
    order = F.array(*[F.lit(a) for a in attributes])
    long = df.select(*[F.col(a).cast("string").alias(a) for a in attributes]).unpivot(
        [], attributes, "attr", "value").where("value is not null").distinct()
    placed = positions(long.withColumn("_o", F.array_position(order, F.col("attr"))), ["_o", "value"])
    return placed.select("attr", "value", (F.col("_pos") - 1).cast("int").alias("feature_id"))


class ZScore:
    """Population z-score; the fitted row of means and deviations can be used on new rows."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df: DataFrame) -> ZScore:
        row = df.agg(*[f(c).alias(f"{n}_{c}") for c in self.cols
                       for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        self.mean = {c: row[f"m_{c}"] for c in self.cols}
        self.std = {c: row[f"s_{c}"] or 1.0 for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_z": (F.col(c) - F.lit(self.mean[c])) / F.lit(self.std[c]) for c in self.cols})


def conditional_overwrite(df: DataFrame, keys: DataFrame, on: list[str], values: dict) -> DataFrame:
    """Rows whose key is in ``keys`` take the new values."""
    out = flag_member(df, keys, on, "_hit")
    for name, value in values.items():
        out = out.withColumn(name, F.when(F.col("_hit"), value if isinstance(value, Column) else F.lit(value))
                             .otherwise(F.col(name)))
    return out.drop("_hit").select(df.columns)


def replicate_rows(df: DataFrame, n: int) -> DataFrame:
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("copy"))


def to_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def with_row_function(df: DataFrame, out: str, fn: Callable[[pd.Series], pd.Series], col: str,
                      dtype: str) -> DataFrame:
    """User function on whole column batches, for what built-in expressions cannot say."""
    udf = F.pandas_udf(fn, dtype)
    return df.withColumn(out, udf(F.col(col)))


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                   schema: str) -> DataFrame:
    """User generator over the batches of a partition."""
    return df.mapInPandas(fn, schema)
