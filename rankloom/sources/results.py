"""Per-query results as text lines ``query, value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = ", "


def write_results(results: DataFrame, path: str) -> None:
    """One line per query in order of its number, replacing what is there."""
    line = F.concat_ws(SEPARATOR, F.col("query_id").cast("string"), F.col("value").cast("string"))
    results.sort("query_id").select(line).write.mode("overwrite").text(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, value)``; empty lines are left out."""
    parts = F.split("value", SEPARATOR)
    return (spark.read.text(path).filter(F.col("value") != "")
            .select(parts[0].cast("int").alias("query_id"), parts[1].cast("double").alias("value")))
