"""Reading the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from frond.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; only the columns a query uses are read."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
