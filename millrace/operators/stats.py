"""Aggregations, correlation, frequency and information measures."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.quantiles import GROUP_VALUES, exact_quantiles


def count_distinct(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(*[f(c).alias(f"n_{c}") for c in cols])


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), c)


def group_mean_rate(df: DataFrame, by: list[str], target: str | Column) -> DataFrame:
    target = F.col(target) if isinstance(target, str) else target
    return df.groupBy(*by).agg(F.avg(target.cast("double")).alias("rate"), F.count(F.lit(1)).alias("n"))


def two_way_count(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).pivot(column, values).count().na.fill(0)


def group_median(df: DataFrame, by: list[str], c: str) -> DataFrame:
    return exact_quantiles(df, by, c, [0.5]).withColumnRenamed("q0", "median")


def describe_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles, max; one row per column that has a value.

    One pass for the moments and the number of distinct values, one for the quartiles; only a column with more distinct
    values than one buffer may hold has its quartiles narrowed down by rank.
    """
    ready = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    parts = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "distinct": F.approx_count_distinct}
    found = ready.agg(*[f(c).alias(f"{c} {name}") for c in cols for name, f in parts.items()]).first()
    cols = [c for c in cols if found[f"{c} n"]]
    few = [c for c in cols if found[f"{c} distinct"] * 1.1 <= GROUP_VALUES]
    probs = F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])
    quartiles = dict(ready.agg(*[F.percentile(c, probs).alias(c) for c in few]).first().asDict()) if few else {}
    for c in cols:
        if c not in few:
            quartiles[c] = tuple(exact_quantiles(ready, [], c, [0.25, 0.5, 0.75], GROUP_VALUES).select("q0", "q1", "q2").first())
    rows = [(c, *[found[f"{c} {name}"] for name in list(parts)[:-1]], *quartiles[c]) for c in cols]
    return df.sparkSession.createDataFrame(rows, "column string, n long, mean double, std double, min double, max double, q25 double, q50 double, q75 double")


def null_profile(df: DataFrame) -> DataFrame:
    """Non-null count and type per column from one pass."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return counts.unpivot([], df.columns, "column", "non_null").withColumn("type", types[F.col("column")])


def nested_group_rate(df: DataFrame, by: list[str], target: str | Column) -> DataFrame:
    """Mean per group, then the number of groups that have each mean."""
    inner = group_mean_rate(df, by, target)
    return inner.withColumn("rate", F.round("rate", 6)).groupBy("rate").agg(F.count(F.lit(1)).alias("groups"))


def pearson_corr(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("corr"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairs ``(a, b, corr)`` from one aggregate; the diagonal is 1."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"c{i}").alias("corr"))
             for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))]
    cells += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("corr")) for c in cols]
    return row.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


def corr_with_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    row = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    return row.unpivot([], cols, "feature", "corr").orderBy(F.desc("corr"), "feature")


def boxplot_stats(df: DataFrame, by: list[str], c: str) -> DataFrame:
    """Quartiles, whisker ends (outermost values within 1.5 IQR) and outlier count per group."""
    q = exact_quantiles(df, by, c, [0.25, 0.5, 0.75])
    q = q.withColumns({"lo": F.col("q0") - 1.5 * (F.col("q2") - F.col("q0")),
                       "hi": F.col("q2") + 1.5 * (F.col("q2") - F.col("q0"))})
    rows = _with_fences(df.where(F.col(c).isNotNull()), q, by)
    inside = F.col(c).between(F.col("lo"), F.col("hi"))
    return rows.groupBy(*by, "q0", "q1", "q2").agg(
        F.min(F.when(inside, F.col(c))).alias("whisker_low"), F.max(F.when(inside, F.col(c))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))


def boxplot_outliers(df: DataFrame, by: list[str], c: str) -> DataFrame:
    q = exact_quantiles(df, by, c, [0.25, 0.75])
    q = q.select(*by, (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("lo"),
                 (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("hi"))
    return _with_fences(df, q, by).where(~F.col(c).between(F.col("lo"), F.col("hi"))).select(df.columns)


def _with_fences(df: DataFrame, fences: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return df.join(fences, by)
    row = fences.first()
    return df.withColumns({k: F.lit(row[k]) for k in fences.columns})


def kde_density(df: DataFrame, by: list[str], c: str, points: int = 32) -> DataFrame:
    """Gaussian kernel density per group at ``points`` places from min to max of all rows.

    Bandwidth is Scott's rule ``std * n^(-1/5)`` of the group; without spread the density is
    null. Equal values are counted
    first, and each row meets the fixed list of places inside its own task.
    """
    counts = df.dropna(subset=[*by, c]).groupBy(*by, F.col(c).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_w"))
    n, s, ss = F.sum("_w"), F.sum(F.col("_w") * F.col("_v")), F.sum(F.col("_w") * F.col("_v") * F.col("_v"))
    bands = counts.groupBy(*by).agg(n.alias("_n"), F.sqrt(F.try_divide(ss - s * s / n, n - 1)).alias("_std"))
    bands = bands.withColumn("_h", F.col("_std") * F.pow(F.col("_n"), F.lit(-0.2)))
    low, high = df.agg(F.min(c), F.max(c)).first()
    grid = [float(low) + (float(high) - float(low)) * i / (points - 1) for i in range(points)]
    places = F.posexplode(F.array(*[F.lit(g) for g in grid])).alias("point", "x")
    z = F.try_divide(F.col("x") - F.col("_v"), F.col("_h"))
    joined = counts.join(bands, by) if by else counts.withColumns(
        {k: F.lit(v) for k, v in bands.first().asDict().items()})
    spread = joined.select(*by, "_v", "_w", "_h", "_n", places)
    density = F.sum(F.try_divide(F.col("_w") * F.exp(-0.5 * z * z), F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)))
    return spread.groupBy(*by, "point", "x").agg(density.alias("density"))


def entropy(df: DataFrame, cls: str, by: list[str] | None = None) -> DataFrame:
    """Class entropy in bits: ``log2 N - sum(n log2 n) / N`` over class counts."""
    by = by or []
    counts = df.groupBy(*by, cls).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by).agg(_entropy_of("n").alias("entropy"))


def _entropy_of(n: str) -> Column:
    total = F.sum(n)
    return F.log2(total) - F.sum(F.col(n) * F.log2(n)) / total


def gain_ratio_table(df: DataFrame, attributes: list[str], cls: str, by: list[str] | None = None) -> DataFrame:
    """Conditional entropy, split info and gain ratio per attribute (and per group ``by``).

    An attribute with one value has split info 0 and gets a null ratio.
    """
    by = by or []
    long = df.select(*by, F.col(cls).alias("_cls"), *[F.col(a).cast("string").alias(a) for a in attributes]).unpivot(
        [*by, "_cls"], attributes, "attr", "value")
    cells = long.groupBy(*by, "attr", "value", "_cls").agg(F.count(F.lit(1)).alias("n"))
    values = cells.groupBy(*by, "attr", "value").agg(F.sum("n").alias("n"), _entropy_of("n").alias("h"))
    split = values.groupBy(*by, "attr").agg(
        (F.sum(F.col("n") * F.col("h")) / F.sum("n")).alias("conditional"), _entropy_of("n").alias("split_info"),
        F.sum("n").alias("rows"))
    classes = cells.groupBy(*by, "attr", "_cls").agg(F.sum("n").alias("n")).groupBy(*by, "attr").agg(
        _entropy_of("n").alias("entropy"))
    out = split.join(classes, [*by, "attr"])
    gain = F.col("entropy") - F.col("conditional")
    return out.withColumn("gain_ratio", F.when(F.round("split_info", 12) > 0, gain / F.col("split_info")))


def anova_f(df: DataFrame, features: list[str], cls: str) -> DataFrame:
    """One-way F statistic per feature from per-class sums."""
    long = df.select(cls, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        cls, features, "feature", "v").where("v is not null")
    g = long.groupBy("feature", cls).agg(F.count("v").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s2"))
    mean = F.sum(F.col("n") * F.col("m")) / F.sum("n")
    parts = g.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("s2")).alias("within"),
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - mean * F.sum(F.col("n") * F.col("m"))).alias("between"))
    f = F.try_divide(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1))
    return parts.select("feature", f.alias("f"), (F.col("k") - 1).alias("df1"), (F.col("n") - F.col("k")).alias("df2"))


def select_k_best(df: DataFrame, features: list[str], cls: str, k: int) -> DataFrame:
    """The k features with the largest F, with ``score = -log10(p)``."""
    best = anova_f(df, features, cls).orderBy(F.desc("f"), "feature").limit(k)
    rows = [(r["feature"], r["f"], -math.log10(max(f_survival(r["f"], r["df1"], r["df2"]), 1e-300)))
            for r in best.collect()]
    return df.sparkSession.createDataFrame(rows, "feature string, f double, score double")


def f_survival(f: float, d1: float, d2: float) -> float:
    """P(F > f), by the regularised incomplete beta function as a continued fraction (Lentz)."""
    x, a, b = d2 / (d2 + d1 * f), d2 / 2, d1 / 2
    if x <= 0 or x >= 1:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_fraction(1 - x, b, a)
    return _beta_fraction(x, a, b)


def _beta_fraction(x: float, a: float, b: float) -> float:
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d, c = 1 / ((1 + term * d) or 1e-300), (1 + term / c) or 1e-300
            value *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * value


def vocabulary_topn(tokens: DataFrame, n: int, token: str = "token") -> DataFrame:
    """``UNK`` at index 0, then the n-1 most frequent tokens by rank (ties by token).

    The count of ``UNK`` is the number of tokens left out.
    """
    counts = tokens.groupBy(token).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), token).limit(n - 1)
    rank = F.row_number().over(W.orderBy(F.desc("n"), token))  # at most n-1 rows, a parameter
    ranked = top.select(F.col(token).alias("word"), F.col("n"), rank.alias("idx"))
    # all tokens less those that are kept
    rest = counts.select("n").unionByName(top.select((-F.col("n")).alias("n")))
    unknown = rest.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("UNK").alias("word"), "n", F.lit(0).alias("idx"))
    return unknown.unionByName(ranked)


def encode_tokens(tokens: DataFrame, vocabulary: DataFrame, token: str = "token") -> DataFrame:
    """Tokens with their vocabulary index, 0 for words outside."""
    words = vocabulary.where("idx > 0").select(F.col("word").alias(token), "idx")
    return tokens.join(words, token, "left").withColumn("idx", F.coalesce("idx", F.lit(0)))
