"""Tree ensembles of pyspark.ml with the parameters the jobs use."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_features(df: DataFrame, features: str | list[str]) -> DataFrame:
    arr = F.col(features) if isinstance(features, str) else F.array(*[F.col(f).cast("double") for f in features])
    return df.withColumn("features", array_to_vector(arr.cast("array<double>")))


def random_forest_classifier(df: DataFrame, features: str | list[str], label: str, trees: int = 100, min_leaf: int = 1,
                             depth: int = 5, subset: str = "sqrt", seed: int = 0):
    return RandomForestClassifier(labelCol=label, numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=depth,
                                  featureSubsetStrategy=subset, seed=seed).fit(with_features(df, features))


def gbt_classifier(df: DataFrame, features: str | list[str], label: str, trees: int = 25, depth: int = 3,
                   seed: int = 0):
    return GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, seed=seed).fit(with_features(df, features))


def ensemble_average(parts: list[DataFrame], key: str, weights: list[float] | None = None,
                     threshold: float = 0.5) -> DataFrame:
    """Weighted mean of ``(key, prob)`` tables and the class ``mean > threshold``."""
    weights = weights or [1.0] * len(parts)
    joined = None
    for n, part in enumerate(parts):
        part = part.select(key, F.col("prob").alias(f"p{n}"))
        joined = part if joined is None else joined.join(part, key)
    mean = sum((F.col(f"p{n}") * w for n, w in enumerate(weights)), F.lit(0.0)) / sum(weights)
    return joined.select(key, mean.alias("prob")).withColumn("pred", (F.col("prob") > threshold).cast("int"))
