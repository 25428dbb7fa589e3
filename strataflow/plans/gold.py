"""Dimensions and facts over the typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.scalars import date_key, date_spine, month_key, surrogate_key
from strataflow.operators.dedup import keep_first, most_frequent
from strataflow.operators.history import asof_join, scd2, unresolved_key
from strataflow.operators.rig import state_spans

FIELD_FIRST, FIELD_LAST = "2008-06-01", "2016-09-30"


def dim_date(spark: SparkSession, first: str = FIELD_FIRST, last: str = FIELD_LAST) -> DataFrame:
    days = date_spine(spark, first, last)
    parts = {"year": F.year, "quarter": F.quarter, "month": F.month, "day_of_month": F.dayofmonth}
    return days.select(date_key("day").alias("date_key"), F.col("day").alias("date"), month_key("day").alias("month_key"), *[f("day").cast("int").alias(n) for n, f in parts.items()])


def dim_wellbore(daily: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Versions of each wellbore by role and operator; the role follows the days' well type."""
    role = F.when(F.col("well_type") == "WI", "INJECTOR").when(F.col("well_type") == "OP", "PRODUCER").otherwise("UNKNOWN")
    days = daily.select("wellbore_uid", "prod_date", role.alias("well_role"), "_row_hash")
    if names is None:
        days = days.withColumn("operator_label", F.lit(None).cast("string"))
    else:
        usable = ~F.upper(F.trim("operator")).isin("XXXXX", "UNKNOWN", "NA", "N/A", "")
        label = most_frequent(names.where(usable), "wellbore_uid", "operator").withColumnRenamed("operator", "operator_label")
        days = days.join(label, "wellbore_uid", "left")
    # A wellbore may hold much of the data: its history is collapsed year by year first.
    return scd2(days, "wellbore_uid", ["well_role", "operator_label"], "prod_date", ties=("_row_hash",), chunk=F.year("prod_date")).withColumnRenamed("key_hash", "wellbore_key")


def dim_well(identities: DataFrame) -> DataFrame:
    return identities.where("well_uid is not null").groupBy("well_uid").agg(
        F.count_distinct("wellbore_uid").alias("wellbores"), F.count_distinct(F.when(F.col("sidetrack").isNotNull(), F.col("wellbore_uid"))).alias("sidetracks"),
        F.count_distinct("source_system").alias("source_systems"), F.sum("occurrences").alias("occurrences"),
    ).withColumn("well_key", surrogate_key("well_uid"))


def dim_curve(curves: DataFrame) -> DataFrame:
    return curves.groupBy("mnemonic").agg(
        F.min("unit").alias("unit"), F.count_distinct("unit").alias("units"), F.count_distinct("wellbore_uid").alias("wellbores"), F.count_distinct("_source_file").alias("files")
    ).withColumns({"has_mixed_units": F.col("units") > 1, "curve_key": surrogate_key("mnemonic")})


def dim_facility(daily: DataFrame) -> DataFrame:
    known = daily.where("npd_facility_code is not null")
    return known.groupBy("npd_facility_code").agg(
        F.max("npd_facility_name").alias("facility_name"), F.count_distinct("wellbore_uid").alias("wellbores"), F.min("prod_date").alias("first_seen"), F.max("prod_date").alias("last_seen")
    ).withColumn("facility_key", surrogate_key("npd_facility_code"))


def _with_fallback(df: DataFrame) -> DataFrame:
    return df.withColumn("wellbore_key", F.coalesce("wellbore_key", unresolved_key("_source_identifier")))


def fct_production_daily(daily: DataFrame, wellbores: DataFrame) -> DataFrame:
    """Daily volumes with the wellbore version of the day; never without a key."""
    joined = asof_join(daily, wellbores, "wellbore_uid", "prod_date", {"wellbore_key": "wellbore_key"}, chunk=F.year)
    return _with_fallback(joined).withColumn("date_key", date_key("prod_date"))


def current_versions(wellbores: DataFrame) -> DataFrame:
    return wellbores.where("is_current").select("wellbore_uid", "wellbore_key")


def with_current_key(facts: DataFrame, wellbores: DataFrame) -> DataFrame:
    return _with_fallback(facts.join(current_versions(wellbores), "wellbore_uid", "left"))


def fct_production_monthly(monthly: DataFrame, wellbores: DataFrame) -> DataFrame:
    return with_current_key(monthly, wellbores)


def fct_log_sample(samples: DataFrame, wellbores: DataFrame) -> DataFrame:
    return with_current_key(samples, wellbores).withColumn("curve_key", surrogate_key("mnemonic"))


def fct_simulation(results: DataFrame, wellbores: DataFrame) -> DataFrame:
    return with_current_key(results, wellbores).withColumn("date_key", date_key("report_date"))


def fct_trajectory(stations: DataFrame, wellbores: DataFrame) -> DataFrame:
    """One station per well and depth, the latest survey's; wells without uid stay apart by their own names."""
    order: list[Column] = [F.col("station_date").desc_nulls_last(), F.col("trajectory_uid").asc_nulls_last(), F.col("station_seq").asc_nulls_last()]
    owned = stations.withColumn("_owner", F.coalesce("wellbore_uid", "_source_identifier"))
    return with_current_key(keep_first(owned, ["_owner", "md"], order).drop("_owner"), wellbores)


def fct_drilling_state(telemetry: DataFrame, chunk_minutes: int = 1440) -> DataFrame:
    """Spans of rig states, put together day by day first, as a wellbore may hold much of the data."""
    return state_spans(telemetry, chunk_minutes=chunk_minutes)
