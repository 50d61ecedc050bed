"""Tables as event sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_json_events(df: DataFrame, *columns: str) -> DataFrame:
    """One JSON object for each row, in `value`."""
    return df.select(F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"}).alias("value"))
