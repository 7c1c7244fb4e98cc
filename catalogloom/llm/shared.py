"""Tables kept in the shared folder, so that work is done once and survives lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from catalogloom.session import scratch_dir


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; nulls and types stay."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
