"""Gaussian naive Bayes in closed form."""

from __future__ import annotations

import math
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import double_array

SMOOTHING = 1e-9


class GaussianNB:
    """Class priors and per-dimension mean and population variance.

    The variance gets ``1e-9`` of the largest variance of any dimension. The model has
    classes x dimensions numbers; a row is classified by two dot products per class.
    """

    def fit(self, df: DataFrame, array_col: str, label: str) -> GaussianNB:
        long = df.select(F.col(label).alias("c"), F.posexplode(F.col(array_col).cast("array<double>")).alias("d", "v"))
        per = long.groupBy("c", "d").agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
        rows = sorted(per.collect())
        # the variance of a dimension over all classes: within them and between their means
        widest = 0.0
        for _, own in groupby(sorted(rows, key=lambda r: r["d"]), key=lambda r: r["d"]):
            own = list(own)
            n = sum(r["n"] for r in own)
            mean = sum(r["n"] * r["m"] for r in own) / n
            widest = max(widest, sum(r["n"] * (r["s"] + (r["m"] - mean) ** 2) for r in own) / n)
        self.extra = SMOOTHING * widest
        self.classes = sorted({r["c"] for r in rows})
        self.count = {r["c"]: r["n"] for r in rows}
        self.mean = {c: [r["m"] for r in rows if r["c"] == c] for c in self.classes}
        self.var = {c: [r["s"] + self.extra for r in rows if r["c"] == c] for c in self.classes}
        return self

    def joint(self, array_col: str) -> list[Column]:
        """Log of prior times likelihood per class."""
        total = sum(self.count.values())
        x = F.col(array_col).cast("array<double>")
        out = []
        for c in self.classes:
            offset = math.log(self.count[c] / total) - 0.5 * sum(math.log(2 * math.pi * v) for v in self.var[c])
            gaps = F.zip_with(x, double_array(self.mean[c]), lambda a, m: (a - m) * (a - m))
            terms = F.zip_with(gaps, double_array(self.var[c]), lambda g, v: g / v)
            out.append(F.lit(offset) - 0.5 * F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t))
        return out

    def transform(self, df: DataFrame, array_col: str, out: str = "pred") -> DataFrame:
        options = [F.struct(s.alias("s"), F.lit(-i).alias("i")) for i, s in enumerate(self.joint(array_col))]
        best = F.array_max(F.array(*options))["i"]
        names = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(out, F.element_at(names, 1 - best))
