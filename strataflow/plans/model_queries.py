"""Queries of models and figures that the core's other queries don't reach: typed reports, observers, exports, calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators import checks, identity
from strataflow.plans import export, profile, silver
from strataflow.plans.queries import _SPELLED, DAILY, TELEMETRY, _bronze, _observed, daily, events, query, rounded, spellings, stations_bronze, table, telemetry
from strataflow.plans.source_queries import _join, _put
from strataflow.sources import observers
from strataflow.sources.columns import DDR_ACTIVITY, VSP_CHECKSHOT


@query("""SELECT a.n AS left_rows, b.n AS right_rows FROM (SELECT count(*) AS n FROM events) a, (SELECT count(*) AS n FROM orders) b WHERE a.n <> b.n""")
def check_same_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.same_count(events(spark, sf_dir), table(spark, sf_dir, "orders"))


def _landing(df: DataFrame, names: tuple[str, ...], given: dict, system: str) -> DataFrame:
    rows = df.select(*[given.get(c, F.lit(None)).cast("string").alias(c) for c in names], given["_source_identifier"].alias("_source_identifier"))
    return _bronze(rows, list(names), system)


@query("""
    SELECT '15/9-F-' || CAST(o_custkey AS VARCHAR) AS wellbore_uid, CAST(o_orderdate AS DATE) AS report_date, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS INTEGER) END AS activity_seq, CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey / 2 END AS DOUBLE) AS md,
           strftime(o_orderdate, '%Y-%m-%d') || 'T08:00:00+02:00' AS activity_dtim_start, o_orderpriority AS comments, o_orderkey % 4 = 0 AS is_empty_report FROM orders""")
def silver_ddr_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    given = {
        "report_date": day, "activity_seq": F.when(key % 4 != 0, key), "activity_md": F.when(key % 3 == 0, "n/a").otherwise((key / 2).cast("string")), "activity_dtim_start": F.concat(day, F.lit("T08:00:00+02:00")),
        "comments": F.col("o_orderpriority"), "name_well": key, "_source_identifier": _join("15/9-F-", F.col("o_custkey")),
    }
    out = silver.ddr_activity(_landing(table(spark, sf_dir, "orders"), DDR_ACTIVITY, given, "DDR"))
    return out.select("wellbore_uid", "report_date", "activity_seq", "md", "activity_dtim_start", "comments", "is_empty_report")


@query("""SELECT '15/9-F-' || CAST(o_custkey AS VARCHAR) AS wellbore_uid, CAST(o_orderkey AS DOUBLE) AS md_m, CAST(o_orderkey % 1000 AS DOUBLE) / 4 AS tvd_m, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 77 END AS DOUBLE) AS two_way_time_ms FROM orders WHERE o_orderkey % 5 <> 0""")
def silver_vsp_checkshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a vertical depth drop out, as the rule says; all are landed."""
    key = F.col("o_orderkey")
    given = {"md_m": key, "tvd_m": F.when(key % 5 != 0, F.replace(((key % 1000) / 4).cast("string"), F.lit("."), F.lit(","))), "two_way_time_ms": F.when(key % 2 == 0, key % 77), "_source_identifier": _join("15/9-F-", F.col("o_custkey"))}
    return silver.vsp_checkshot(_landing(table(spark, sf_dir, "orders"), VSP_CHECKSHOT, given, "VSP")).select("wellbore_uid", "md_m", "tvd_m", "two_way_time_ms")


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'no name' WHEN 1 THEN 'not a well name' WHEN 2 THEN 'incomplete name' WHEN 3 THEN 'unknown suffix' END AS category FROM supplier""")
def categorise_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_suppkey") % 5
    name = F.when(kind == 0, "  ").when(kind == 1, F.col("s_name")).when(kind == 2, "15/9-F").when(kind == 3, "15/9-F-1 MAIN WELLBORE").otherwise("15/9-F-1 A")
    named = identity.with_normalized_name(table(spark, sf_dir, "supplier").select("s_suppkey", name.alias("name")), "name")
    return named.select("s_suppkey", identity.failure_category("failure").alias("category"))


@query("""SELECT event_type AS source_system, CAST(user_id AS VARCHAR) AS source_identifier FROM events GROUP BY event_type, user_id HAVING user_id % 2 = 0 AND user_id % 3 = 0""")
def identity_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.col("event_type").alias("source_system"), F.col("user_id").cast("string").alias("source_identifier"), "user_id").distinct()
    before = rows.withColumn("wellbore_uid", F.when(F.col("user_id") % 2 == 0, "w"))
    return identity.regressions(before, rows.withColumn("wellbore_uid", F.when(F.col("user_id") % 3 != 0, "w")))


@query(f"""
    WITH {_SPELLED}, all_seen AS (
        SELECT 'DDR' AS source_system, spelling AS source_identifier, 2 AS occurrences, CASE WHEN s_suppkey % 2 = 0 THEN CAST(100000 + s_suppkey AS VARCHAR) END AS identifier, s_suppkey % 2 = 0 AS defines FROM named
        UNION ALL SELECT 'FOLDER', q || '_' || b || '_' || n || '_' || CAST(s_suppkey AS VARCHAR), 1, NULL, false FROM named
        UNION ALL SELECT 'ECLIPSE', 'P-F-' || CAST(s_suppkey AS VARCHAR), 1, NULL, false FROM named)
    SELECT source_system, source_identifier, CAST(occurrences AS BIGINT) AS occurrences, coalesce(identifier, '') AS identifiers, defines AS defines_identifier FROM all_seen""")
def observers_of_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names seen in a landing table, in folders' names and in simulator decks."""
    named = spellings(spark, sf_dir)
    key = F.col("s_suppkey")
    twice = named.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    given = {"npd_code_wellbore": F.when(key % 2 == 0, (100000 + key).cast("string")).otherwise("none"), "activity_seq": F.col("n"), "_source_identifier": F.col("spelling")}
    landing = observers.observe_table(_landing(twice, DDR_ACTIVITY, given, "DDR"), *observers.OBSERVED["ddr_activity"])
    q = F.expr("cast(15 + 3 * (s_suppkey div 1000 % 300) + s_nationkey % 3 as string)")
    b = F.expr("cast(1 + 9 * (s_suppkey div 300000) + s_nationkey % 9 as string)")
    paths = table(spark, sf_dir, "supplier").select(_join("logs/well ", q, "_", b, "_", key % 1000, "_", key, "/a.las").alias("path"))
    folders = observers.observe_names(paths, "FOLDER", "well ([^/]+)/")
    deck = _join("-- WELSPECS\nWELSPECS\n 'P-F-", key, "' 'OP' 1 2 /\n/\n'not' a well /\n")
    decks = observers.observe_welspecs(spark, _put(spark, "decks", table(spark, sf_dir, "supplier"), _join(key, ".DATA"), deck))
    out = landing.unionByName(folders).unionByName(decks)
    return identity.in_order(out.select("source_system", "source_identifier", "occurrences", F.array_join("identifiers", ",").alias("identifiers"), "defines_identifier"))


@query("""
    WITH s AS (SELECT o_custkey, o_orderkey % 50 AS md, o_orderkey % 7 AS t FROM orders)
    SELECT CAST(t AS VARCHAR) AS trajectory_uid, CAST(min(md) AS DOUBLE) AS top, CAST(max(md) AS DOUBLE) AS base, count(*) AS stations, 'MD' AS first_property FROM s GROUP BY t""")
def export_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = silver.trajectory_station(stations_bronze(spark, sf_dir)).withColumn("trajectory_uid", (F.col("trajectory_uid").cast("long") % 7).cast("string"))
    field = lambda path, kind="string": F.get_json_object("record", f"$.data.{path}").cast(kind)
    return export.trajectory_records(stations).select(
        "trajectory_uid", field("TopDepthMeasuredDepth", "double").alias("top"), field("BaseDepthMeasuredDepth", "double").alias("base"),
        field("ExtensionProperties.StationCount", "long").alias("stations"), field("AvailableTrajectoryStationProperties[0].Name").alias("first_property"),
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record per supplier, some of them spoilt: without a legal tag, of a kind nobody declared, without a name, with a text for a version."""
    key = F.col("s_suppkey")
    fault = key % 6
    data = F.struct(F.when(fault != 3, F.col("s_name")).alias("FacilityName"), F.struct(F.lit("PRODUCER").alias("WellRole")).alias("ExtensionProperties"))
    kind = F.when(fault == 2, "osdu:wks:master-data--Rig:1.0.0").otherwise("osdu:wks:master-data--Wellbore:1.0.0")
    tags = F.when(fault != 1, F.array(F.lit("tag")))
    body = F.struct(
        F.when(fault == 5, "no id").otherwise(_join("p:master-data--Wellbore:", key)).alias("id"), F.when(fault == 4, "one").otherwise("1").alias("version"), kind.alias("kind"),
        F.struct(F.array(F.lit("o")).alias("owners"), F.array(F.lit("v")).alias("viewers")).alias("acl"), F.struct(tags.alias("legaltags")).alias("legal"), data.alias("data"),
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.to_json(body).alias("record"))


@query("""
    SELECT s_suppkey, CASE s_suppkey % 6 WHEN 1 THEN 'legal is incomplete' WHEN 2 THEN 'kind is not declared: master-data--Rig' WHEN 3 THEN '$.data.FacilityName is missing' WHEN 4 THEN '$.version is not a number' WHEN 5 THEN 'id is malformed' END AS failure FROM supplier WHERE s_suppkey % 6 > 0""")
def validate_osdu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All failures of all records: of the envelope and of what their kind declares."""
    records = _records(spark, sf_dir)
    envelope = export.invalid_records(records).select("s_suppkey", F.explode("reasons").alias("failure"))
    return envelope.unionByName(export.schema_failures(records).select("s_suppkey", "failure"))


@query("""SELECT s_suppkey FROM supplier ORDER BY s_name, s_suppkey LIMIT 7""")
def export_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.first_records(_records(spark, sf_dir).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey"), ["s_name", "s_suppkey"], 7).select("s_suppkey")


@query(f"""
    WITH {_SPELLED} SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'FILES' ELSE 'REPORTS' END AS source_system, spelling AS source_identifier, 4 AS occurrences, CASE WHEN s_suppkey % 8 = 3 THEN CAST(s_suppkey - 3 AS VARCHAR) WHEN s_suppkey % 4 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE '' END AS identifiers FROM named""")
def merge_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observation twice: one row each, occurrences added."""
    seen = _observed(spark, sf_dir)
    merged = identity.merge_observations(seen.unionByName(seen))
    return merged.select("source_system", "source_identifier", F.col("occurrences").cast("int").alias("occurrences"), F.array_join("identifiers", ",").alias("identifiers"))


# ---------------------------------------------------------------- calibration

@query(f"""
    WITH {DAILY}, d AS (SELECT DISTINCT wellbore_uid, prod_date FROM silver WHERE on_stream_hrs = 0), m AS (SELECT *, prod_date - CAST(row_number() OVER (PARTITION BY wellbore_uid ORDER BY prod_date) AS INTEGER) AS anchor FROM d),
    r AS (SELECT wellbore_uid, count(*) AS days FROM m GROUP BY wellbore_uid, anchor)
    SELECT wellbore_uid, count(*) AS runs, round(avg(days), 6) AS mean_days, max(days) AS longest_days FROM r GROUP BY 1""")
def shutdown_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.shutdown_statistics(daily(spark, sf_dir)))


@query(f"""WITH {DAILY} SELECT CAST(year(prod_date) AS INTEGER) AS year, round(1e6 * sum(water_sm3) / nullif(sum(oil_sm3 + water_sm3), 0), 4) AS water_cut_ppm FROM silver GROUP BY 1""")
def water_cut_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.water_cut_by_year(daily(spark, sf_dir)).select("year", F.round(1e6 * F.col("water_cut"), 4).alias("water_cut_ppm"))


@query(f"""WITH {DAILY} SELECT wellbore_uid, round(1e6 * sum(gas_sm3) / sum(oil_sm3), 4) AS gas_oil_ppm, round(1.0 * count(*) FILTER (gas_sm3 > 0) / count(*), 6) AS days_with_gas FROM silver WHERE oil_sm3 > 0 GROUP BY 1""")
def gas_oil_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.gas_oil_ratios(daily(spark, sf_dir)).select("wellbore_uid", F.round(1e6 * F.col("gas_oil_ratio"), 4).alias("gas_oil_ppm"), F.round("days_with_gas", 6).alias("days_with_gas"))


@query(f"""
    WITH {DAILY}, g AS (SELECT wellbore_uid, prod_date - lag(prod_date) OVER (PARTITION BY wellbore_uid ORDER BY prod_date) - 1 AS missing FROM (SELECT DISTINCT wellbore_uid, prod_date FROM silver))
    SELECT wellbore_uid, count(*) AS gaps, CAST(sum(missing) AS BIGINT) AS missing_days, CAST(max(missing) AS INTEGER) AS longest_gap FROM g WHERE missing > 0 GROUP BY 1""")
def gap_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.gap_statistics(daily(spark, sf_dir))


@query(f"""
    WITH {TELEMETRY}, s AS (SELECT wellbore_uid, CAST(date_sub('second', lag(ts) OVER (PARTITION BY wellbore_uid ORDER BY ts), ts) AS BIGINT) AS step FROM telemetry)
    SELECT wellbore_uid, count(*) AS steps, round(avg(step), 6) AS mean_s, max(step) AS greatest_s, count(*) FILTER (step > 3600) AS long_steps FROM s WHERE step IS NOT NULL GROUP BY 1""")
def telemetry_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.telemetry_spacing(telemetry(spark, sf_dir)))


@query("""
    WITH i AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT 'W' || CAST(user_id % 40 AS VARCHAR) AS wellbore_uid, count(DISTINCT user_id) AS spellings, count(DISTINCT event_type) AS systems, CAST(sum(n) AS BIGINT) AS rows FROM i WHERE user_id % 5 <> 0 GROUP BY 1""")
def identity_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose number fives divide stay unresolved and have no figures."""
    rows = events(spark, sf_dir).groupBy(F.col("event_type").alias("source_system"), F.col("user_id").cast("string").alias("source_identifier"), "user_id").agg(F.count("*").alias("occurrences"))
    return profile.identity_figures(rows.withColumn("wellbore_uid", F.when(F.col("user_id") % 5 != 0, F.concat(F.lit("W"), (F.col("user_id") % 40).cast("string")))))
