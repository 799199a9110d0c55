"""Streams whose state is a mergeable aggregate.

State of batch n is a table at ``<state>/epoch-n`` made from epoch n-1 and the batch, so a
batch that is run again after a failure writes the same table again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.metrics import auc_polygon
from millrace.operators.reduce import Pca, merge_moments, moments
from millrace.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _run(stream: DataFrame, on_batch, state: str) -> None:
    query = (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{state}/offsets")
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _epoch(state: str, n: int) -> str:
    return f"{state}/epoch-{n:08d}"


def _last_epoch(spark: SparkSession, state: str) -> int | None:
    """The newest epoch in the state folder, also one that an earlier run has left."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{state}/epoch-*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return max((int(f.getPath().getParent().getName().removeprefix("epoch-")) for f in found or []), default=None)


def stream_moments(stream: DataFrame, array_col: str, state: str | None = None) -> DataFrame:
    """Moment table after all available batches; with a ``state`` of an earlier run it goes on from there."""
    spark = stream.sparkSession
    state = state or scratch_path(spark, "moments")

    def on_batch(batch: DataFrame, n: int) -> None:
        new = moments(batch, array_col)
        if n > 0:
            new = merge_moments(spark.read.parquet(_epoch(state, n - 1)), new)
        new.coalesce(1).write.mode("overwrite").parquet(_epoch(state, n))

    _run(stream, on_batch, state)
    last = _last_epoch(spark, state)
    if last is None:
        raise ValueError("the stream has had no batch")
    return spark.read.parquet(_epoch(state, last))


def stream_incremental_pca(stream: DataFrame, array_col: str, k: int, state: str | None = None) -> Pca:
    """Components from moments updated per micro-batch; equal to the PCA of all rows."""
    return Pca(k).fit_moments(stream_moments(stream, array_col, state))


def score_bins(df: DataFrame, label: str, score: str, bins: int) -> DataFrame:
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(F.count_if(F.col(label) == 1).alias("pos"),
                                          F.count_if(F.col(label) != 1).alias("neg"))


def auc_of_bins(counts: DataFrame) -> DataFrame:
    """Trapezoid area over at most ``bins`` rows; 0.0 without a positive (or a negative)."""
    from pyspark.sql import Window as W
    down = W.orderBy(F.col("bin").desc()).rowsBetween(W.unboundedPreceding, 0)  # bounded by the number of bins
    total = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    points = counts.select(F.sum("pos").over(down).alias("cp"), F.sum("neg").over(down).alias("cn")).withColumns(
        {"p": total.select("p").scalar(), "n": total.select("n").scalar()})
    curve = points.where("p > 0 and n > 0").select((F.col("cn") / F.col("n")).alias("fpr"), (F.col("cp") / F.col("p")).alias("tpr"))
    return auc_polygon(curve).select(F.coalesce("auc", F.lit(0.0)).alias("auc"))


def stream_accumulated_auc(stream: DataFrame, label: str, score: str, bins: int = 200,
                           state: str | None = None) -> DataFrame:
    """``(batch, rows, accumulated_auc, batch_auc)`` for every micro-batch."""
    spark = stream.sparkSession
    state = state or scratch_path(spark, "auc")

    def on_batch(batch: DataFrame, n: int) -> None:
        own = score_bins(batch, label, score, bins).persist()
        total = own
        if n > 0:
            total = own.unionByName(spark.read.parquet(_epoch(state, n - 1))).groupBy("bin").agg(
                F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        total.coalesce(1).write.mode("overwrite").parquet(_epoch(state, n))
        rows = own.agg(F.coalesce(F.sum(F.col("pos") + F.col("neg")), F.lit(0)).alias("rows"))
        line = rows.withColumns({
            "accumulated_auc": auc_of_bins(spark.read.parquet(_epoch(state, n))).scalar(),
            "batch_auc": auc_of_bins(own).scalar()}).withColumn("batch", F.lit(n))
        line.write.mode("overwrite").parquet(f"{state}/lines/batch={n}")
        own.unpersist()

    _run(stream, on_batch, state)
    return spark.read.parquet(f"{state}/lines").select(
        F.col("batch").cast("int"), "rows", "accumulated_auc", "batch_auc")
