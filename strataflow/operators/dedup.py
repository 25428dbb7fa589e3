"""Keeping one of several rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key; Spark limits each group before and after the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_by_row_hash(df: DataFrame, ties: tuple[str, ...] = ("_source_file",)) -> DataFrame:
    """Of rows with the same content the one loaded first; ``ties`` makes the choice total."""
    order = [F.col(c).asc_nulls_last() for c in ("_ingested_at", "_batch_id", *ties) if c in df.columns]
    return keep_first(df, ["_row_hash"], order)


def most_frequent(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the value each key has most often, the alphabetically first on a tie. Nulls don't count."""
    counted = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    return keep_first(counted, [key], [F.col("_n").desc(), F.col(value).asc_nulls_last()]).drop("_n")
