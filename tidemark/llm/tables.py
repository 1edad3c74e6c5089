"""Reading the input tables, and cutting plans by tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes a table below spark.checkpoint.dir and reads it again, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_column: str, text_column: str) -> Column:
    """128 bits of a row's id and text: equal rows share it, whatever their number."""
    return F.substring(F.sha2(F.concat_ws("\x00", F.coalesce(F.col(id_column).cast("string"), F.lit("\x01")), F.coalesce(F.col(text_column), F.lit(""))), 256), 1, 32)
