"""A training corpus from ``documents``: each stage gets what its predecessor kept, written as Parquet.

Toxic documents go; of near duplicates one stays; long repeated strings are taken out of the texts; documents with a benchmark
passage go; the rest is packed into token sequences. The last stage's rows are the result.

Every stage takes any table with ``doc_id`` and ``text`` and returns its columns (packing: pieces), whatever other columns it has, and an
empty table gives an empty one. Each stage says what it does with null, empty and very long texts, ties and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import without_benchmark
from millrace.llm.jaccard import drop_near_duplicates
from millrace.llm.packing import pack
from millrace.llm.queries import PIECES, table, tokenizer_path
from millrace.llm.repeats import without_repeats
from millrace.llm.toxicity import severity
from millrace.session import cut, ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the severity model rejects. Null and empty texts have no words and stay; very long texts are read whole; rows at the bar itself go;
    repeated rows share their fate; without labels of both kinds all rows stay. Columns of ``docs`` named like the model's results take its values.
    """
    return severity(docs, table(spark, sf_dir, "labels")).where(~F.col("rejected")).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of every class of near duplicates the row with the smallest ``doc_id``; where ids are null or repeated, rows are numbered first and the first
    stays. Null, empty and blank texts are no copies of each other and stay; very long texts are one set; repeated rows are copies.
    """
    ship_package(spark)
    return drop_near_duplicates(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 200 bytes that start elsewhere too out of the texts and counts ``n_chars`` anew. Null texts stay null, shorter ones as they are;
    very long texts are cut into segments; rows of equal or null ``doc_id`` are documents of their own, and repeated rows lose all they share.
    """
    ship_package(spark)
    return without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows with a benchmark passage. Null and empty texts stay, as nothing is found in them; null and empty items find nothing; very long texts
    are searched whole; repeated rows share their fate, and which of several passages is found makes no difference.
    """
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in windows of 2,048 tokens. Null and empty texts are their end token; very long texts fill windows of their own; equal scores go
    by the order of the shard; repeated rows and rows of equal or null ``doc_id`` are packed as documents of their own.
    """
    ship_package(spark)
    return pack(docs, tokenizer_path()).selectExpr(*PIECES)


STAGES = [("toxicity", toxicity), ("jaccard_join", jaccard_join), ("suffix_dedup", suffix_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# training, sampling and packing order have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
