"""The registered queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import benchmark_hits
from millrace.llm.dialogue import damaged, repaired_conversations
from millrace.llm.fingerprint import edited_fingerprints
from millrace.llm.html import main_text
from millrace.llm.jaccard import jaccard_join
from millrace.llm.language import held_out, identified, train
from millrace.llm.licenses import scan
from millrace.llm.lm import lm_scores
from millrace.llm.packing import pack
from millrace.llm.periodic import made_periodic, periodic_runs, run_digests
from millrace.llm.repeats import remove_repeats
from millrace.llm.toxicity import severity
from millrace.llm.warc import round_trip
from millrace.session import ship_package

# the vocabulary file that packing uses
TOKENIZER = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


# rows of long texts that Spark hands to a Python task at once, where the session has Spark's own setting
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join(table(spark, sf, "documents"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_fingerprints")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf, "documents"))


@query("op2_html_extraction")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return main_text(table(spark, sf, "pages"))


@query("op3_lm_scoring")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return lm_scores(table(spark, sf, "documents"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return scan(table(spark, sf, "documents").select("doc_id", "text")).drop("places")


PIECES = ["doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset"]


@query("op5_packing")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), tokenizer_path()).selectExpr(*PIECES)


@query("op6_warc", """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     q AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest, min(page_id) OVER (PARTITION BY h) AS first FROM p),
     r AS (SELECT *, payload_bytes >= 100 AND page_id <> first AS again FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM r""")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(spark, table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_decontamination")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return benchmark_hits(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op7_toxicity")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return severity(table(spark, sf, "documents"), table(spark, sf, "labels")).select(
        "doc_id", "p_toxic", "p_severe", "expected_severity", "rejected")


@query("op9_suffix_dedup")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return remove_repeats(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_language")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return identified(docs, train(docs.where(~held_out()))).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return run_digests(periodic_runs(made_periodic(table(spark, sf, "documents"))))


@query("op13_conversation_repair")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return repaired_conversations(table(spark, sf, "conversations"), damaged)
