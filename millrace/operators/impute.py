"""Missing-value treatment."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_quantiles


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


class MedianFill:
    """Exact medians of the fitted rows; a test part may use the medians of the train part."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df: DataFrame) -> MedianFill:
        self.median = {c: exact_quantiles(df, [], c, [0.5]).first()[0] for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(self.median[c])) for c in self.cols})


def fill_group_median(df: DataFrame, by: list[str], c: str, known=None) -> DataFrame:
    """Null -> median of the row's group; ``known`` restricts the rows the medians come from."""
    source = df if known is None else df.where(known)
    medians = exact_quantiles(source, by, c, [0.5]).withColumnRenamed("q0", "_median")
    out = df.join(medians, by, "left")
    return out.withColumn(c, F.coalesce(F.col(c).cast("double"), "_median")).select(df.columns)


def fill_by_model(df: DataFrame, target: str, features: list[str], trees: int = 20, depth: int = 5,
                  seed: int = 0) -> DataFrame:
    """A regression forest trained on the known rows predicts the unknown ones."""
    assembled = VectorAssembler(inputCols=features, outputCol="_x").transform(df)
    forest = RandomForestRegressor(featuresCol="_x", labelCol=target, predictionCol="_p", numTrees=trees,
                                   maxDepth=depth, seed=seed)
    model = forest.fit(assembled.where(F.col(target).isNotNull()))
    return model.transform(assembled).withColumn(
        target, F.coalesce(F.col(target).cast("double"), "_p")).select(df.columns)
