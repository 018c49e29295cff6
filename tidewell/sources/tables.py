"""Named Parquet tables below one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table; Spark resolves the path, so any file system it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
