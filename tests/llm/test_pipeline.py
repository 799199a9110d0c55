"""The corpus pipeline on planted rows: every stage's decisions take effect, and clean documents come through whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import queries


TOXIC = 2 * 10**7


def text_of(rng, n):
    return " ".join(f"clean{x}" for x in rng.integers(0, 5000, n))


@pytest.fixture(scope="module")
def planted(spark, sf, tmp_path_factory):
    """The small tables with own rows: copies, near copies, a shared passage, a benchmark passage, empty and null texts."""
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rng = np.random.default_rng(2)
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where(F.length("text") > 60).orderBy("item_id").first()["text"]
    base, shared = text_of(rng, 200), text_of(rng, 60)
    rows = [(10**7 + 1, base), (10**7 + 2, base), (10**7 + 3, base + " more words"), (10**7 + 4, text_of(rng, 80) + " " + shared), (10**7 + 5, shared + " " + text_of(rng, 80)),
            (10**7 + 6, text_of(rng, 30) + " " + item + " " + text_of(rng, 30)), (10**7 + 7, None), (10**7 + 8, ""), (10**7 + 9, text_of(rng, 40))]
    # toxic texts of own marked words; the last 20 have no label
    rows += [(TOXIC + k, " ".join([text_of(rng, 20), *[f"foul{x}" for x in rng.integers(0, 6, 6)], text_of(rng, 20)])) for k in range(80)]
    own = spark.createDataFrame(rows, "doc_id long, text string")
    docs.unionByName(own.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text"), allowMissingColumns=True).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    marked = spark.createDataFrame([(i, 1) for i in range(TOXIC, TOXIC + 60)], "doc_id long, toxic int")
    labels.unionByName(marked.select(*(F.col(c).cast(labels.schema[c].dataType) for c in labels.columns))).write.parquet(f"{folder}/labels.parquet")
    return folder, dict(rows), shared


def test_stages_take_effect(spark, planted):
    folder, rows, shared = planted
    docs = start = queries.table(spark, folder, "documents")
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, folder))
        assert docs.columns == start.columns
        after[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    clean = {i for i, t in labels.items() if t == 0}
    assert not any(i >= TOXIC for i in after["toxicity"]) and len(clean - set(after["toxicity"])) <= 0.01 * len(clean)
    at = lambda k: 10**7 + k
    assert {i for i in rows if i < TOXIC} <= set(after["toxicity"])
    assert {at(k) for k in range(1, 10)} & set(after["jaccard_join"]) == {at(k) for k in (1, 4, 5, 6, 7, 8, 9)}
    deduped = after["suffix_dedup"]
    assert set(deduped) == set(after["jaccard_join"])
    assert all(shared[:200] not in deduped[at(k)] for k in (4, 5)) and deduped[at(9)] == rows[at(9)] and deduped[at(7)] is None
    assert at(6) not in after["decontamination"] and {at(k) for k in (1, 4, 5, 7, 8, 9)} <= set(after["decontamination"])
    packed = corpus_pipeline.packing(spark, docs, folder)
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == len(after["decontamination"])
    assert packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n <> m").count() == 0


def test_run_on_empty_and_odd_tables(spark, sf, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
