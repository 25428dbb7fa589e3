"""Runs of rows: gaps and islands, calendar gaps, frozen values, spikes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, key: str, order: str, state: str, name: str = "island") -> DataFrame:
    """Rows with the number of their run of equal state: difference of two row numbers."""
    whole = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last())
    same = Window.partitionBy(key, state).orderBy(F.col(order).asc_nulls_last())
    return df.withColumn(name, (F.row_number().over(whole) - F.row_number().over(same)).cast("long"))


def day_runs(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, first_day, last_day, days): runs of consecutive days on which the key has rows."""
    days = df.select(key, day).distinct()
    number = F.row_number().over(Window.partitionBy(key).orderBy(day))
    marked = days.withColumn("_anchor", F.date_sub(F.col(day), number))
    runs = marked.groupBy(key, "_anchor").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days"))
    return runs.drop("_anchor")


def day_gaps(df: DataFrame, key: str, day: str) -> DataFrame:
    """(key, gap_after, missing_days): where a key has no row for one or more days."""
    days = df.select(key, day).distinct()
    before = F.lag(day).over(Window.partitionBy(key).orderBy(day))
    gaps = days.withColumn("gap_after", before).withColumn("missing_days", F.datediff(F.col(day), F.col("gap_after")) - 1)
    return gaps.where("missing_days > 0").select(key, "gap_after", "missing_days")


def frozen_runs(df: DataFrame, key: str, order: str, value: str, least: int = 3) -> DataFrame:
    """(key, value, first_at, last_at, length): runs of ``least`` or more equal non-zero values."""
    rows = islands(df.where(F.col(value).isNotNull()), key, order, value)
    runs = rows.groupBy(key, value, "island").agg(F.min(order).alias("first_at"), F.max(order).alias("last_at"), F.count("*").alias("length"))
    return runs.where((F.col("length") >= least) & (F.col(value) != 0)).drop("island")


def spikes(df: DataFrame, key: str, order: str, value: str, times: float = 5.0) -> DataFrame:
    """Rows whose step from the row before is over ``times`` the key's standard deviation."""
    step = F.abs(F.col(value) - F.lag(value).over(Window.partitionBy(key).orderBy(order)))
    spread = F.stddev_samp(value).over(Window.partitionBy(key))
    return df.withColumn("_step", step).withColumn("_spread", spread).where(F.col("_step") > times * F.col("_spread")).drop("_step", "_spread")


_AGGREGATES = {
    "min": lambda c, order: F.min(c),
    "max": lambda c, order: F.max(c),
    "sum": lambda c, order: F.sum(c),
    "first": lambda c, order: F.min_by(c, order),
    "last": lambda c, order: F.max_by(c, order),
}


def spans(df: DataFrame, key: str, order: str, state: str, measures: dict[str, tuple[str, str]], chunk: str | None = None) -> DataFrame:
    """One row per run: key, state, started_at, ended_at, samples and the measures, numbered by state_seq.

    A measure is a column and how its values go together: min, max, sum, first or last. With ``chunk``,
    a column that cuts the order into stretches, runs are put together within (key, chunk) first and
    joined across chunks after, so that no task gets all rows of a large key.
    """
    by = [key] if chunk is None else [key, chunk]
    whole = Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_last())
    same = Window.partitionBy(*by, state).orderBy(F.col(order).asc_nulls_last())
    rows = df.withColumn("_island", F.row_number().over(whole) - F.row_number().over(same))
    found = [_AGGREGATES[how](c, order).alias(n) for n, (c, how) in measures.items()]
    runs = rows.groupBy(*by, state, "_island").agg(F.min(order).alias("started_at"), F.max(order).alias("ended_at"), F.count("*").alias("samples"), *found)
    if chunk is not None:
        rows = islands(runs.drop("_island"), key, "started_at", state, "_island")
        again = [_AGGREGATES[how](n, "started_at").alias(n) for n, (_, how) in measures.items()]
        runs = rows.groupBy(key, state, "_island").agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"), F.sum("samples").alias("samples"), *again)
    sequence = F.row_number().over(Window.partitionBy(key).orderBy("started_at"))
    return runs.withColumn("state_seq", sequence).drop("_island")
