"""Column expressions for feature preparation. Everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_PRIME = 1000003


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def double_array(values: Iterable[float]) -> Column:
    """Constant array of doubles, parsed as one expression (a model row, not data)."""
    return F.expr("array(" + ", ".join(f"double('{float(x)!r}')" for x in values) + ")")


def weighted_sum(columns: Iterable[str], weights: Iterable[float], start: float = 0.0) -> Column:
    """``start + sum w_j column_j`` with constant weights."""
    terms = [f"`{c}` * double('{float(w)!r}')" for c, w in zip(columns, weights)]
    return F.expr(" + ".join([f"double('{float(start)!r}')", *terms]))


def key_hash(key: str | Column, seed: int = 0) -> Column:
    """Portable hash of any key in ``[0, 1000003)``: 52 bits of the MD5 of ``key:seed``; seeds are independent of each other."""
    return seeded_hash(key, F.lit(str(seed)))


def seeded_hash(key: str | Column, seed: Column) -> Column:
    digest = F.md5(F.concat(col(key).cast("string"), F.lit(":"), seed.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint"), F.lit(HASH_PRIME))


def hash_sql(key: str, seed: str | int = 0) -> str:
    """``key_hash`` in DuckDB."""
    return f"(('0x' || substr(md5(({key})::VARCHAR || ':' || ({seed})::VARCHAR), 1, 13))::BIGINT % {HASH_PRIME})"


def uniform(*keys: str | Column) -> Column:
    """Uniform draw in (0, 1) fixed by the keys, so a recomputed task draws the same."""
    return (F.shiftrightunsigned(F.xxhash64(*[col(k) for k in keys]), 11) + 0.5) / float(1 << 53)


def sigmoid(x: str | Column) -> Column:
    return 1.0 / (1.0 + F.exp(-col(x)))


def sigmoid_threshold(x: str | Column, threshold: float = 0.5) -> Column:
    """1 where the logistic transform exceeds ``threshold``, else 0."""
    return F.when(sigmoid(x) > threshold, 1).otherwise(0)


def dot(a: str | Column, b: str | Column) -> Column:
    terms = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def squared_distance(a: str | Column, b: str | Column) -> Column:
    terms = F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    return F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: str | Column) -> Column:
    """v / |v|; the zero vector stays as it is."""
    def scale(length: Column) -> Column:
        return F.transform(col(a), lambda x: x.cast("double") / F.when(length > 0, length).otherwise(1.0))

    # as a lambda argument the length is worked out once per row, not once per element
    return F.element_at(F.transform(F.array(norm(a)), scale), 1)


def scaled_cosine(cosine: str | Column) -> Column:
    """Cosine moved from [-1, 1] to [0, 1]."""
    return 0.5 + 0.5 * col(cosine)


def map_topk_values(weights: str | Column, k: int = 10) -> Column:
    """The k largest map values, descending, padded with 0.0; null map gives zeros."""
    zeros = F.array_repeat(F.lit(0.0), k)
    values = F.coalesce(F.map_values(col(weights)), F.array().cast("array<double>"))
    return F.slice(F.concat(F.sort_array(values, asc=False), zeros), 1, k)


def map_topk_weights_by_prefix(weights: str | Column, prefix: str | Column, k: int = 10) -> Column:
    """As :func:`map_topk_values`, over keys ``prefix:word`` of the row's prefix only."""
    wanted = col(prefix).cast("string")
    return map_topk_values(F.map_filter(col(weights), lambda key, _: F.split_part(key, F.lit(":"), F.lit(1)) == wanted), k)


# The three title rules.
TITLE_PATTERNS = {"word": r"([A-Za-z]+)\.", "spaced": r" ([A-Za-z]+)\."}


def extract_title(name: str | Column, mode: str = "word") -> Column:
    """Title in a person's name: ``word``, ``spaced`` (blank before it) or ``between`` comma and dot."""
    if mode == "between":
        after = F.split_part(col(name), F.lit(","), F.lit(2))
        return F.trim(F.split_part(after, F.lit("."), F.lit(1)))
    return F.regexp_extract(col(name), TITLE_PATTERNS[mode], 1)


def surname(name: str | Column) -> Column:
    return F.split_part(col(name), F.lit(","), F.lit(1))


def recode_values(value: str | Column, mapping: Mapping, default="keep") -> Column:
    """Dictionary recoding. ``default`` is ``'keep'``, ``None`` (null) or a literal."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    hit = F.try_element_at(F.create_map(*pairs), col(value))
    if default == "keep":
        return F.coalesce(hit, col(value))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def bucket_ranges(value: str | Column, ranges: Iterable[tuple]) -> Column:
    """Label of the first closed range ``(low, high, label)`` holding the value, else null."""
    out = F.lit(None)
    for low, high, label in reversed(list(ranges)):
        out = F.when(col(value).between(low, high), F.lit(label)).otherwise(out)
    return out


def polynomial_features(x: str, degree: int) -> list[Column]:
    """Columns ``x_pow_0`` .. ``x_pow_degree``."""
    return [F.pow(F.col(x), F.lit(float(d))).alias(f"{x}_pow_{d}") for d in range(degree + 1)]


def assemble_array(*parts: str | Column) -> Column:
    """Scalars and arrays joined into one array of doubles in the given order."""
    return F.concat(*[col(p) for p in parts]).cast("array<double>")


def flag_member(df: DataFrame, keys: DataFrame, on: list[str], flag: str) -> DataFrame:
    """Left join that marks rows whose key occurs in ``keys``."""
    marked = keys.select(*on).distinct().withColumn(flag, F.lit(True))
    return df.join(marked, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
