"""Reading the input tables, and tables written to the shared folder to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name in the folder that the cluster names in spark.checkpoint.dir."""
    return scratch_path(spark, "llm")


def written(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder and read back: they outlive the loss of executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
