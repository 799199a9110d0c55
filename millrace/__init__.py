"""Analytics operators written as PySpark DataFrame, SQL and pyspark.ml jobs."""
