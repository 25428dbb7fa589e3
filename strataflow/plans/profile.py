"""Figures that describe production data, for calibrating fixtures and spotting anomalies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strataflow.functions.scalars import safe_divide, seconds_between
from strataflow.operators.runs import day_runs


def uptime_buckets(daily: DataFrame, hours: str = "on_stream_hrs") -> DataFrame:
    h = F.col(hours)
    bucket = F.when(h.isNull(), "null").when(h == 0, "shut_in").when(h >= 23.5, "full").otherwise("partial")
    return daily.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("days"))


def rate_statistics(daily: DataFrame, key: str = "wellbore_uid") -> DataFrame:
    some = daily.where("oil_sm3 > 0")
    return some.groupBy(key).agg(F.count("*").alias("days"), F.avg("oil_sm3").alias("mean_oil"), F.stddev_samp("oil_sm3").alias("sd_oil"), F.max("oil_sm3").alias("max_oil"))


def decline(daily: DataFrame, key: str = "wellbore_uid", day: str = "prod_date") -> DataFrame:
    """Mean oil of each year over the wellbore's best year."""
    years = daily.where("oil_sm3 > 0").groupBy(key, F.year(day).alias("year")).agg(F.avg("oil_sm3").alias("mean_oil"))
    return years.withColumn("share_of_best", safe_divide("mean_oil", F.max("mean_oil").over(Window.partitionBy(key))))


def water_cut_rise(daily: DataFrame, key: str = "wellbore_uid", day: str = "prod_date") -> DataFrame:
    """Rise of the yearly water cut per year, of each wellbore with two years or more."""
    years = daily.groupBy(key, F.year(day).alias("year")).agg(safe_divide(F.sum("water_sm3"), F.sum(F.col("oil_sm3") + F.col("water_sm3"))).alias("cut"))
    known = years.where("cut is not null").groupBy(key).agg(F.min_by("cut", "year").alias("first"), F.max_by("cut", "year").alias("last"), F.count("*").alias("years"))
    return known.where("years > 1").select(key, ((F.col("last") - F.col("first")) / (F.col("years") - 1)).alias("rise_per_year"))


def anomaly_counts(daily: DataFrame, key: str = "wellbore_uid", day: str = "prod_date", spike: float = 5.0) -> DataFrame:
    """(kind, count): shutdown runs, missing days, frozen runs and spikes, in one pass over each wellbore's days.

    What begins a run is told from the few rows before: a shutdown day not preceded by one the day
    before, and the third of equal values after a different one.
    """
    w = Window.partitionBy(key).orderBy(day)
    before = lambda c, n=1: F.lag(c, n).over(w)
    oil = F.col("oil_sm3")
    steps = F.datediff(day, before(day))
    rows = daily.select(
        (F.col("on_stream_hrs").eqNullSafe(0.0) & ~F.coalesce((before("on_stream_hrs") == 0) & (steps <= 1), F.lit(False))).alias("_shut"),
        F.greatest(F.coalesce(steps - 1, F.lit(0)), F.lit(0)).alias("_missing"),
        F.coalesce((oil != 0) & (oil == before(oil)) & (oil == before(oil, 2)) & ~oil.eqNullSafe(before(oil, 3)), F.lit(False)).alias("_frozen"),
        F.coalesce(F.abs(oil - before(oil)) > spike * F.stddev_samp(oil).over(Window.partitionBy(key)), F.lit(False)).alias("_spike"),
    )
    counts = rows.agg(
        F.count_if("_shut").alias("shutdown_runs"), F.coalesce(F.sum("_missing"), F.lit(0)).cast("long").alias("missing_days"), F.count_if("_frozen").alias("frozen_runs"), F.count_if("_spike").alias("spikes")
    )
    return counts.unpivot([], ["shutdown_runs", "missing_days", "frozen_runs", "spikes"], "kind", "count")


def sentinel_shares(samples: DataFrame) -> DataFrame:
    return samples.groupBy("mnemonic").agg(F.count("*").alias("samples"), F.count_if("was_sentinel").alias("sentinels"), (F.count_if("was_sentinel") / F.count("*")).alias("share"))


def shutdown_statistics(daily: DataFrame, key: str = "wellbore_uid", day: str = "prod_date") -> DataFrame:
    """Of each wellbore that was ever shut in: runs of consecutive days without uptime, their mean and greatest length."""
    runs = day_runs(daily.where("on_stream_hrs = 0"), key, day)
    return runs.groupBy(key).agg(F.count("*").alias("runs"), F.avg("days").alias("mean_days"), F.max("days").alias("longest_days"))


def water_cut_by_year(daily: DataFrame, day: str = "prod_date") -> DataFrame:
    """Water in all that was produced in a year, over all wellbores."""
    return daily.groupBy(F.year(day).alias("year")).agg(safe_divide(F.sum("water_sm3"), F.sum(F.col("oil_sm3") + F.col("water_sm3"))).alias("water_cut"))


def gas_oil_ratios(daily: DataFrame, key: str = "wellbore_uid") -> DataFrame:
    """Gas over oil of each wellbore in all, and the share of its producing days that have gas."""
    some = daily.where("oil_sm3 > 0")
    return some.groupBy(key).agg(safe_divide(F.sum("gas_sm3"), F.sum("oil_sm3")).alias("gas_oil_ratio"), (F.count_if(F.col("gas_sm3") > 0) / F.count("*")).alias("days_with_gas"))


def gap_statistics(daily: DataFrame, key: str = "wellbore_uid", day: str = "prod_date") -> DataFrame:
    """Gaps between a wellbore's days: how many, and the days missing in all and at most."""
    missing = F.datediff(day, F.lag(day).over(Window.partitionBy(key).orderBy(day))) - 1
    gaps = daily.select(key, day).distinct().withColumn("_missing", missing).where("_missing > 0")
    return gaps.groupBy(key).agg(F.count("*").alias("gaps"), F.sum("_missing").alias("missing_days"), F.max("_missing").alias("longest_gap"))


def telemetry_spacing(telemetry: DataFrame, key: str = "wellbore_uid", long_s: int = 3600) -> DataFrame:
    """Seconds between a wellbore's samples: mean, greatest, and how many are over ``long_s``."""
    step = seconds_between(F.lag("ts").over(Window.partitionBy(key).orderBy("ts")), F.col("ts"))
    steps = telemetry.select(key, step.alias("_step")).where("_step is not null")
    return steps.groupBy(key).agg(F.count("*").alias("steps"), F.avg("_step").alias("mean_s"), F.max("_step").alias("greatest_s"), F.count_if(F.col("_step") > long_s).alias("long_steps"))


def identity_figures(identities: DataFrame) -> DataFrame:
    """Spellings and systems of each resolved wellbore, and the rows that carry them."""
    return identities.where("wellbore_uid is not null").groupBy("wellbore_uid").agg(
        F.count_distinct("source_identifier").alias("spellings"), F.count_distinct("source_system").alias("systems"), F.sum("occurrences").alias("rows")
    )
