"""Views the registered queries share, each with its SQL twin for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalar import HASH_PRIME, hash_sql, key_hash
from millrace.operators.text import words
from millrace.session import cut, spread

# (u * CELL + i) names a rating cell in hashes
CELL = 31337
TEST_SHARE = 0.25


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def rnd(c: str | Column, digits: int = 6) -> Column:
    """Rounded for the comparison, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def ratings(spark: SparkSession, sf: str, write: bool = True) -> DataFrame:
    """``(u, i, r)``: quantity a customer bought of a part. Written once per query that reads it often."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("u"))
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("i"), "l_quantity")
    out = orders.join(lines, "o_orderkey").groupBy("u", "i").agg(F.sum("l_quantity").alias("r"))
    return cut(out) if write else out


def cell_hash() -> Column:
    return key_hash(F.col("u") * CELL + F.col("i"))


def split_ratings(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    bar = int(TEST_SHARE * HASH_PRIME)
    return r.where(cell_hash() >= bar), r.where(cell_hash() < bar)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label")


def coordinates(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """``(id, x0, x1, …)`` and the names of the coordinates: the whole vectors as columns."""
    rows = vectors(spark, sf)
    names = [f"x{j}" for j in range(len((rows.first() or {"x": []})["x"]))]
    return rows.select("id", *[F.col("x")[j].alias(c) for j, c in enumerate(names)]), names


def first_vectors(spark: SparkSession, sf: str, k: int) -> list[list[float]]:
    """The vectors of the k lowest ids, as given centres."""
    return [list(r["x"]) for r in vectors(spark, sf).orderBy("id").limit(k).collect()]


def points2d(spark: SparkSession, sf: str) -> DataFrame:
    return vectors(spark, sf).select("id", F.col("x")[0].alias("x"), F.col("x")[1].alias("y"))


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Events as clicks on articles; the channel is the label of the article."""
    emb = table(spark, sf, "embeddings")
    n = emb.agg(F.count(F.lit(1)).alias("n"))
    ev = table(spark, sf, "events").withColumn("article_id", F.col("event_id") % n.scalar())
    items = emb.select(F.col("vec_id").alias("article_id"), F.col("label").cast("string").alias("channel_id"))
    return ev.join(items, "article_id").select(
        "event_id", "user_id", "article_id", "channel_id", "event_type", "value",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("click_flag"))


def profiles(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """One row per user: nested basics and mean value per ``channel:event_type``.

    A user has at most channels x event types entries, whatever the number of events.
    """
    means = (clicks(spark, sf) if events is None else events).where("click_flag = 0").groupBy(
        "user_id", F.concat_ws(":", "channel_id", "event_type").alias("k")).agg(F.avg("value").alias("v"))
    prefs = means.groupBy("user_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("preference_info"))
    return prefs.select(
        "user_id", F.struct((F.col("user_id") % 2).cast("int").alias("gender"),
                            (18 + F.col("user_id") % 50).cast("int").alias("age")).alias("basic_info"),
        "preference_info")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    names = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda j: j.cast("string"))
    sizes = F.transform("embedding", lambda v: F.abs(v.cast("double")))
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("article_id"), F.map_from_arrays(names, sizes).alias("keywords"),
        F.col("embedding").cast("array<double>").alias("vector"))


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with three numeric features."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return _with_features(d, "quality", "toxic")


def all_docs(spark: SparkSession, sf: str) -> DataFrame:
    """All documents with the features, which need no label."""
    return _with_features(table(spark, sf, "documents"))


def _with_features(d: DataFrame, *more: str) -> DataFrame:
    n = F.size(words("text"))
    return d.select("doc_id", "lang", "source", F.col("n_chars"), n.cast("bigint").alias("n_words"),
                    *more).withColumns({
                        "one": F.lit(1.0), "f0": F.col("n_chars") / 1000.0, "f1": F.col("n_words") / 1000.0,
                        "f2": F.col("n_chars") / F.greatest(F.col("n_words"), F.lit(1)) / 10.0})


DOC_FEATURES = ["f0", "f1", "f2"]

# SQL twins -------------------------------------------------------------------------------
RATINGS = ("ratings AS (SELECT o_custkey AS u, l_partkey AS i, sum(l_quantity) AS r FROM orders "
           "JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)")
CELL_HASH = hash_sql(f"u * {CELL} + i")
SPLIT = (f"{RATINGS}, train AS (SELECT * FROM ratings WHERE {CELL_HASH} >= {int(TEST_SHARE * HASH_PRIME)}), "
         f"test AS (SELECT * FROM ratings WHERE {CELL_HASH} < {int(TEST_SHARE * HASH_PRIME)})")
WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"
DOCS = (f"docs AS (SELECT *, n_chars / 1000.0::double AS f0, n_words / 1000.0::double AS f1, "
        f"n_chars / greatest(n_words, 1)::double / 10.0::double AS f2 FROM (SELECT d.doc_id, d.lang, d.source, d.n_chars, "
        f"len({WORDS})::bigint AS n_words, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)))")
ALL_DOCS = (f"docs AS (SELECT *, n_chars / 1000.0::double AS f0, n_words / 1000.0::double AS f1, "
            f"n_chars / greatest(n_words, 1)::double / 10.0::double AS f2 FROM (SELECT doc_id, lang, source, n_chars, "
            f"len({WORDS})::bigint AS n_words FROM documents))")
TOKENS = (f"tokens AS (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS token FROM "
          f"(SELECT doc_id, {WORDS} AS w FROM documents))")
VECTORS = "vectors AS (SELECT vec_id AS id, embedding::double[] AS x, label FROM embeddings)"
POINTS = "points AS (SELECT vec_id AS id, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings)"
LONG = ("cells AS (SELECT id, label, unnest(range(len(x))) AS d, unnest(x) AS v FROM vectors)")
CLICKS = ("clicks AS (SELECT event_id, user_id, vec_id AS article_id, label::varchar AS channel_id, event_type, value, "
          "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS click_flag FROM events JOIN embeddings "
          "ON event_id % (SELECT count(*) FROM embeddings) = vec_id)")
PREFS = ("prefs AS (SELECT user_id, channel_id || ':' || event_type AS k, channel_id, avg(value) AS v FROM clicks "
         "WHERE click_flag = 0 GROUP BY 1, 2, 3)")


def sql_d2(a: str, b: str) -> str:
    """Squared distance of two list columns."""
    return (f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))")
