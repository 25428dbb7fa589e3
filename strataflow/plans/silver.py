"""Typed tables from landing tables: each takes and gives DataFrames and drops repeated content first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.scalars import date_from_iso, date_from_serial, null_if_sentinel, to_number
from strataflow.operators.dedup import dedup_by_row_hash
from strataflow.operators.survey import to_degrees

LINEAGE = ("_source_system", "_source_file", "_source_identifier", "_row_hash", "_replay_date")


def _lineage(df: DataFrame) -> list[Column]:
    return [F.col("_wellbore_uid").alias("wellbore_uid"), *[F.col(c) for c in LINEAGE]]


def _int(c: str) -> Column:
    return to_number(c).cast("int")


def production_daily(bronze: DataFrame) -> DataFrame:
    """Typed daily volumes. An injector's produced volumes are zero, whatever was reported, which stays beside.

    The choke is in per cent by its row's own unit. Rows without a date drop out. Each text is parsed
    once, before its number is used.
    """
    rows = dedup_by_row_hash(bronze)
    volumes = ("bore_oil_vol", "bore_gas_vol", "bore_wat_vol", "bore_wi_vol")
    others = [c for c in ("on_stream_hrs", "avg_downhole_pressure", "avg_downhole_temperature", "avg_dp_tubing", "avg_annulus_press", "avg_whp_p", "avg_wht_p", "dp_choke_size") if c in rows.columns]
    rows = rows.withColumns({f"_{c}": to_number(c) for c in ("dateprd", "avg_choke_size_p", *volumes)} | {c: to_number(c) for c in others})
    rows = rows.withColumns({"prod_date": date_from_serial("_dateprd"), "well_type": F.upper(F.trim("well_type")), "_unit": F.upper(F.trim("avg_choke_uom"))}).where("prod_date is not null")
    injector = F.col("well_type") == "WI"
    produced = lambda c: F.when(injector, 0.0).otherwise(F.coalesce(f"_{c}", F.lit(0.0)))
    unit, size = F.col("_unit"), F.col("_avg_choke_size_p")
    names = [F.col(c) for c in ("well_bore_code", "npd_well_bore_code", "npd_well_bore_name", "npd_field_code", "npd_field_name", "npd_facility_code", "npd_facility_name") if c in rows.columns]
    return rows.select(
        *_lineage(rows),
        "prod_date",
        *names,
        *others,
        F.when(unit.isin("%", "PCT", "PERCENT"), size).when(unit.isin("FRAC", "FRACTION"), size * 100).alias("choke_pct"),
        F.col("avg_choke_uom").alias("reported_choke_uom"),
        produced("bore_oil_vol").alias("oil_sm3"),
        produced("bore_gas_vol").alias("gas_sm3"),
        produced("bore_wat_vol").alias("water_sm3"),
        F.when(injector, F.coalesce("_bore_wi_vol", F.lit(0.0))).otherwise(0.0).alias("injected_sm3"),
        *[F.col(f"_{c}").alias(f"reported_{c}") for c in volumes],
        "flow_kind",
        "well_type",
    )


def production_monthly(bronze: DataFrame) -> DataFrame:
    """Reported months; produced volumes are zero where blank, injected ones stay null."""
    rows = dedup_by_row_hash(bronze)
    zero = lambda c: F.coalesce(to_number(c), F.lit(0.0))
    return rows.select(
        *_lineage(rows), "wellbore_name", "npdcode", (_int("year") * 100 + _int("month")).alias("month_key"), to_number("on_stream").alias("on_stream_hrs"),
        zero("oil").alias("oil_sm3"), zero("gas").alias("gas_sm3"), zero("water").alias("water_sm3"), to_number("gi").alias("gas_injected_sm3"), to_number("wi").alias("water_injected_sm3"),
    )


def log_curve(bronze: DataFrame) -> DataFrame:
    """Curve headers with the file's own sentinel as text and number."""
    rows = dedup_by_row_hash(bronze)
    return rows.select(
        *_lineage(rows), "mnemonic", "unit", F.col("description").alias("curve_description"), to_number("start").alias("start_index"), to_number("stop").alias("stop_index"),
        F.col("null_value_declared").alias("sentinel_text"), to_number("null_value_declared").alias("sentinel"),
    )


def log_sample(bronze: DataFrame, headers: DataFrame) -> DataFrame:
    """Samples with sentinels as null, by the row's own declaration or else its file's."""
    rows = dedup_by_row_hash(bronze)
    per_file = headers.groupBy("_source_file").agg(F.max("null_value_declared").alias("_file_sentinel"))
    joined = rows.join(per_file, "_source_file", "left")
    value = null_if_sentinel("value", F.coalesce("null_value_declared", "_file_sentinel"))
    return joined.select(
        *_lineage(joined), "mnemonic", "index_mnemonic", to_number("index_value").alias("index_value"), "index_unit", F.col("value").alias("raw_value"), value.alias("value"),
        (value.isNull() & F.col("value").isNotNull()).alias("was_sentinel"),
    )


def trajectory_station(bronze: DataFrame) -> DataFrame:
    """Stations with angles in degrees by their declared units; a station without depth drops out."""
    rows = dedup_by_row_hash(bronze)
    angle = lambda c: to_degrees(to_number(c), F.coalesce(F.col(f"{c}_uom"), F.lit("dega")), strict=False)
    out = rows.select(
        *_lineage(rows), "trajectory_uid", _int("station_seq").alias("station_seq"), F.coalesce(date_from_iso("dtim_station"), date_from_iso("dtim_traj_start")).alias("station_date"), to_number("md").alias("md"), to_number("tvd").alias("tvd"),
        angle("incl").alias("inclination_deg"), angle("azi").alias("azimuth_deg"), to_number("dls").alias("reported_dls"), F.col("dls_uom").alias("reported_dls_uom"), F.col("source_crs"),
    )
    return out.where("md is not null")


def ddr_activity(bronze: DataFrame) -> DataFrame:
    """Report activities; times stay text, as their zones differ by report."""
    rows = dedup_by_row_hash(bronze)
    return rows.select(
        *_lineage(rows), date_from_iso("report_date").alias("report_date"), _int("activity_seq").alias("activity_seq"), "activity_dtim_start", "activity_dtim_end", to_number("activity_md").alias("md"),
        "phase", "proprietary_code", "state", "state_detail_activity", "comments", F.col("activity_seq").isNull().alias("is_empty_report"),
    )


def vsp_checkshot(bronze: DataFrame) -> DataFrame:
    rows = dedup_by_row_hash(bronze)
    out = rows.select(*_lineage(rows), *[to_number(c).alias(c) for c in ("md_m", "tvd_m", "tvd_below_datum_m", "tvd_subsea_m", "two_way_time_ms")])
    return out.where("tvd_m is not null")


def simulation_result(bronze: DataFrame) -> DataFrame:
    """Totals by phase: three columns become three rows."""
    rows = dedup_by_row_hash(bronze)
    wide = rows.select(*_lineage(rows), date_from_iso("report_date").alias("report_date"), *[to_number(f"{p}_total").alias(p.upper()) for p in ("oil", "water", "gas")])
    keys = [c for c in wide.columns if c not in ("OIL", "WATER", "GAS")]
    return wide.unpivot(keys, ["OIL", "WATER", "GAS"], "phase", "volume")


def wellbore_identity(sources: list[DataFrame]) -> DataFrame:
    """One row per system and identifier as written, over all landing tables, counted without repeats."""
    slim = [dedup_by_row_hash(s).select("_source_system", "_source_identifier", "_wellbore_uid", "_source_file") for s in sources]
    every = reduce(DataFrame.unionByName, slim).where("_source_identifier is not null")
    out = every.groupBy(F.col("_source_system").alias("source_system"), F.col("_source_identifier").alias("source_identifier")).agg(
        F.max("_wellbore_uid").alias("wellbore_uid"), F.min("_source_file").alias("first_file"), F.count("*").alias("occurrences")
    )
    space = F.instr("wellbore_uid", " ")
    return out.withColumns(
        {
            "well_uid": F.when(space > 0, F.substring_index("wellbore_uid", " ", 1)).otherwise(F.col("wellbore_uid")),
            "sidetrack": F.when(space > 0, F.expr("substring(wellbore_uid, instr(wellbore_uid, ' ') + 1)")),
            "is_resolved": F.col("wellbore_uid").isNotNull(),
        }
    )
