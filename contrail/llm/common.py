"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: later jobs neither
    recompute it nor depend on the executors that made it."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(taken, name: str) -> str:
    """``name``, with underscores before it until no column in ``taken`` has it."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def crc_fold(id_col: str | Column, folds: int = 5) -> Column:
    """crc32 of the id's text, modulo ``folds`` (a NULL id counts as the empty text)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds


def field(df: DataFrame, col: str, as_name: str):
    """``as_name type`` of a column, for the schema text of Arrow functions."""
    return f"`{as_name}` {df.schema[col].dataType.simpleString()}"
