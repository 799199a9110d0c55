"""Delimited, sparse and table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_header(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV with quoted fields; the schema is given, so no pass is spent on inference."""
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=False, enforceSchema=False)


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=sep, header=False)


def read_whitespace_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(fields, cls)``: blank-separated lines whose last field is the class."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "").select(parts.alias("p"))
    return rows.select(F.slice("p", 1, F.size("p") - 1).alias("fields"), F.element_at("p", -1).alias("cls"))


def read_libsvm_long(spark: SparkSession, path: str) -> DataFrame:
    """``(row_id, label, idx, val)``; indices may start at 0 and come in any order.

    A row without entries keeps one line with null ``idx``.
    """
    parts = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).where(F.trim("value") != "").select(
        F.monotonically_increasing_id().alias("row_id"), parts.alias("p"))
    cells = rows.select("row_id", F.element_at("p", 1).cast("double").alias("label"),
                        F.explode_outer(F.slice("p", 2, F.size("p"))).alias("cell"))
    pair = F.split("cell", ":")
    return cells.select("row_id", "label", F.try_element_at(pair, F.lit(1)).cast("int").alias("idx"),
                        F.try_element_at(pair, F.lit(2)).cast("double").alias("val"))


def libsvm_lines(df: DataFrame, row: str, label: str, idx: str, val: str) -> DataFrame:
    """One text line per row from long cells, indices ascending. A row is one line by
    definition, so its cells are gathered; rows are spread by key."""
    cell = F.struct(F.col(idx), F.col(val))
    rows = df.groupBy(row, label).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    text = F.transform("cells", lambda c: F.concat_ws(":", c[idx].cast("string"), c[val].cast("string")))
    return rows.select(row, F.concat_ws(" ", F.col(label).cast("string"), F.array_join(text, " ")).alias("value"))


def write_libsvm(df: DataFrame, path: str, row: str, label: str, idx: str, val: str) -> None:
    libsvm_lines(df, row, label, idx, val).select("value").write.text(path)


def read_table_sql(spark: SparkSession, tables: dict[str, str], sql: str) -> DataFrame:
    """Named Parquet tables queried by SQL; nested fields by dot path."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.sql(sql)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", overwrite: bool = False) -> None:
    mode = "overwrite" if overwrite else "errorifexists"
    df.write.mode(mode).csv(path, header=header, sep=sep, quote='"', escape='"')


def write_predictions(df: DataFrame, path: str, key: str, prediction: str) -> None:
    """``(key, prediction)`` CSV with header and integer prediction."""
    write_csv(df.select(key, F.col(prediction).cast("int").alias(prediction)), path)
