"""Tokens, context pairs and word vectors."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import l2_normalize
from millrace.operators.nearest import knn_join
from millrace.operators.reduce import Pca
from millrace.operators.stats import vocabulary_topn
from millrace.session import cut


def words(text: str | Column) -> Column:
    """Blank-separated tokens of the whole text, empty ones dropped."""
    return F.array_remove(F.split(text, r"\s+"), "")


def tokenize_corpus(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, pos, token)`` in document order."""
    return df.select(key, F.posexplode(words(text)).alias("pos", "token"))


def skipgram_pairs(df: DataFrame, key: str, text: str, window: int = 1, num_skips: int | None = None,
                   seed: int = 0) -> DataFrame:
    """``(key, pos, offset, target, context)`` for every word within ``window`` places.

    With ``num_skips`` each target keeps that many contexts, chosen by hash. The token
    array is zipped with its own shifted copies inside the row, so nothing is shuffled and
    the work is linear in the length of a text.
    """
    offsets = [o for o in range(-window, window + 1) if o]
    rows = df.select(key, words(text).alias("t")).withColumn("n", F.size("t"))
    rows = rows.select(key, "t", *[_shifted(o).alias(f"s{n}") for n, o in enumerate(offsets)])
    zipped = F.arrays_zip("t", *[f"s{n}" for n in range(len(offsets))])
    rows = rows.select(key, F.posexplode(zipped).alias("pos", "z")).where(F.col("z.t").isNotNull())
    cells = F.array(*[F.struct(F.lit(o).alias("offset"), F.col(f"z.s{n}").alias("context")) for n, o in enumerate(offsets)])
    if num_skips is not None:
        keyed = F.transform(F.filter(cells, lambda c: c["context"].isNotNull()), lambda c: F.struct(
            F.xxhash64(F.col(key), F.col("pos"), c["offset"], F.lit(seed)).alias("h"), c.alias("c")))
        cells = F.transform(F.slice(F.array_sort(keyed), 1, num_skips), lambda c: c["c"])
    rows = rows.select(key, "pos", F.col("z.t").alias("target"), F.explode(cells).alias("c"))
    return rows.where("c.context is not null").select(key, "pos", "c.offset", "target", "c.context")


def context_counts(pairs: DataFrame) -> DataFrame:
    """``(target, pairs, contexts, places)``: of each word its ``pairs``, its distinct contexts and the sum of their places.

    ``pairs`` is that of ``skipgram_pairs`` without ``num_skips``. A word is a context of its own contexts, so each pair of words is looked for once, from the left
    one, and by hashes that are checked to differ; the sums need no pairs of words and are combined before their shuffle.
    """
    sums = cut(pairs.groupBy("target").agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.col("pos") + F.col("offset")).alias("places")))
    seed = _distinct_seed(sums, "target")
    a, b = (F.xxhash64(c, F.lit(seed)) for c in ("target", "context"))
    met = pairs.where("offset > 0").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
    ends = F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))
    contexts = met.select(F.explode(ends).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("contexts"))
    return sums.withColumn("h", F.xxhash64("target", F.lit(seed))).join(contexts, "h").select("target", "pairs", "contexts", "places")


def _distinct_seed(table: DataFrame, key: str) -> int:
    """The first seed by which no two keys of ``table``, which has each once, have one hash."""
    seed = 0
    while True:
        n, hashes = table.agg(F.count(F.lit(1)), F.countDistinct(F.xxhash64(key, F.lit(seed)))).first()
        if n == hashes:
            return seed
        seed += 1


def _shifted(o: int) -> Column:
    """Tokens moved by ``o`` places, so that place p holds token p + o (null before the first)."""
    if o > 0:
        return F.slice("t", o + 1, F.greatest(F.col("n") - o, F.lit(0)))
    return F.concat(F.array_repeat(F.lit(None).cast("string"), -o), F.slice("t", 1, F.greatest(F.col("n") + o, F.lit(0))))


def nearest_words(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(qid, cid, cosine, rank)``: the k nearest by cosine, the vector itself left out.

    Both tables are ``(id, x)``. On unit vectors the smallest distance is the largest
    cosine: ``cos = 1 - d² / 2``.
    """
    unit = [t.select("id", l2_normalize("x").alias("x")) for t in (queries, vectors)]
    near = knn_join(unit[0], unit[1], k, exclude_self=True)
    return near.select("qid", "cid", (1 - F.col("dist") * F.col("dist") / 2).alias("cosine"), "rank")


def word_vectors(df: DataFrame, text: str, dim: int = 128, window: int = 1, vocabulary: int = 50_000,
                 max_iter: int = 1, partition_tokens: int = 200_000, seed: int = 0):
    """Skip-gram vectors ``(word, vector)``; words outside the vocabulary become UNK.

    The vocabulary bound also bounds the model every task receives. Training runs in one partition for every ``partition_tokens``
    tokens, as many as the session has cores at most; their models are added up after each round, so more partitions mean
    vectors of lower quality for the same number of rounds.
    """
    rows = df.select(words(text).alias("_w")).withColumn("_row", F.monotonically_increasing_id())
    tokens = rows.select("_row", F.posexplode("_w").alias("_at", "token"))
    vocab = cut(vocabulary_topn(tokens.select("token"), vocabulary))
    # at most ``vocabulary`` rows
    known = F.broadcast(vocab.where("idx > 0").select(F.col("word").alias("token"), F.col("word").alias("_known")))
    kept = tokens.join(known, "token", "left").groupBy("_row").agg(F.array_sort(F.collect_list(
        F.struct("_at", F.coalesce("_known", F.lit("UNK")).alias("w")))).alias("_w"))
    rows = cut(kept.select(F.transform("_w", lambda x: x["w"]).alias("words")))
    n = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    model = Word2Vec(vectorSize=dim, windowSize=window, minCount=1, maxIter=max_iter, numPartitions=max(1, min(-(-n // partition_tokens), cores)),
                     inputCol="words", outputCol="vec", seed=seed).fit(rows)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector")), vocab


def project_top_words(vectors: DataFrame, vocab: DataFrame, n: int) -> DataFrame:
    """2-D coordinates of the n most frequent words."""
    top = vocab.where(F.col("idx").between(1, n)).select("word", "idx").join(vectors, "word")
    pca = Pca(2).fit(top, "vector")
    out = pca.transform(top, "vector", "xy")
    return out.select("idx", "word", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"))
