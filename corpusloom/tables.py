"""Reading tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.workers import reachable


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The Parquet table `name` of `folder`, with only `columns` if any are given."""
    df = reachable(spark).read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
