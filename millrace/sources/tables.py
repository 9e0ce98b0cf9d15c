"""Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Table ``name`` of ``data_dir``; columns are pruned and filters pushed down by the reader."""
    return spark.read.parquet(f"{data_dir}/{name}.parquet")
